"""Run leaderboards and champion decisions as queries over run, version and event tables.

Every operator works for all models at once. Ranks use ``ranked``, and bests are struct
minima with map-side combining, so a model holding most of the versions is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.functions.columns import hex_number
from wattlane.functions.ranking import ranked

MODEL, VERSION = "model_name", "version"


def _asc(names: list[str]) -> list[Column]:
    return [F.asc_nulls_last(name) for name in names]


def run_leaderboard(
    runs: DataFrame,
    parent: str = "parent_run_id",
    order: tuple[str, ...] = ("validation_rmse", "validation_mae", "start_time"),
    run_id: str = "run_id",
) -> DataFrame:
    """Runs of each parent ranked by the order columns that exist."""
    present = [c for c in order if c in runs.columns]
    return ranked(runs, _asc([*present, run_id]), [parent])


def comparable_runs(
    runs: DataFrame, run_id: str, digests: tuple[str, ...] = ("train_digest", "validation_digest")
) -> DataFrame:
    """Runs on the same data as one run; an unknown digest is equal to nothing."""
    own = runs.where(F.col("run_id") == run_id).agg(
        F.struct(*[F.max(d).alias(d) for d in digests])
    ).scalar()
    for digest in digests:
        runs = runs.where(F.col(digest) == own[digest])
    return runs


def cycle_decision(
    runs: DataFrame,
    digests: tuple[str, ...] = ("train_digest", "validation_digest"),
    order: tuple[str, ...] = (
        "test_rmse",
        "test_mae",
        "validation_rmse",
        "validation_mae",
        "start_time",
    ),
) -> DataFrame:
    """For every run: the best run on the same data, and whether that is the run itself."""
    present = [c for c in order if c in runs.columns]
    # A missing metric sorts after every number.
    ladder = [x for c in present for x in (F.col(c).isNull().alias(f"{c}_gone"), F.col(c))]
    best = runs.na.drop(subset=list(digests)).groupBy(*digests).agg(
        F.min(F.struct(*ladder, F.col("run_id"))).alias("_best"),
        F.count("*").alias("n_candidates"),
    )
    return runs.join(best, list(digests)).select(
        "run_id",
        *digests,
        F.col("_best.run_id").alias("best_run_id"),
        F.col(f"_best.{present[0]}").alias(f"best_{present[0]}"),
        F.col(f"_best.{present[1]}").alias(f"best_{present[1]}"),
        (F.col("_best.run_id") == F.col("run_id")).alias("same_run_selected"),
        "n_candidates",
    )


def _tag(name: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.try_element_at("tags", F.lit(name)), F.lit(""))))


def has_flag(name: str) -> Column:
    """A tag reads "true", in any case and spacing; a missing one does not."""
    return _tag(name) == "true"


def is_validated() -> Column:
    """Both flags are true, or the status is "passed"; a missing tag counts as false."""
    flags = has_flag("validated") & has_flag("passed_validation")
    return flags | (_tag("validation_status") == "passed")


def validated_versions(versions: DataFrame) -> DataFrame:
    return versions.where(is_validated())


def version_number() -> Column:
    return F.col(VERSION).cast("int")


def alias_current(events: DataFrame) -> DataFrame:
    """Version each alias points at: the last write wins."""
    return events.groupBy(MODEL, "alias").agg(F.max_by(VERSION, "seq").alias(VERSION))


def alias_history(events: DataFrame) -> DataFrame:
    """Events of each alias in order, with the version it pointed at before."""
    steps = ranked(
        events.select(MODEL, "alias", VERSION, "seq"), [F.asc("seq")], [MODEL, "alias"], rank="step"
    )
    before = steps.select(
        MODEL, "alias", (F.col("step") + 1).alias("step"), F.col(VERSION).alias("previous_version")
    )
    return steps.join(before, [MODEL, "alias", "step"], "left")


def alias_versions(events: DataFrame, alias: str) -> DataFrame:
    return alias_current(events.where(F.col("alias") == alias)).select(
        MODEL, F.col(VERSION).alias(f"{alias}_version")
    )


def version_tags(events: DataFrame) -> DataFrame:
    """Latest value of each tag of each version."""
    return events.groupBy(MODEL, VERSION, "key").agg(F.max_by("value", "seq").alias("value"))


def latest_version(versions: DataFrame) -> DataFrame:
    return versions.groupBy(MODEL).agg(F.max(version_number()).alias("latest_version"))


def govern_rank(versions: DataFrame, events: DataFrame) -> DataFrame:
    """Validated versions of each model by RMSE, MAE and number."""
    table = validated_versions(versions).withColumn("_number", version_number())
    order = _asc(["rmse", "mae", "_number"])
    placed = ranked(table, order, [MODEL]).drop("_number")
    champions = alias_versions(events, "champion")
    return (
        placed.join(champions, MODEL, "left")
        .withColumn("is_best", F.col("rank") == 1)
        .withColumn(
            "is_current_champion",
            F.coalesce(F.col("champion_version") == F.col(VERSION), F.lit(False)),
        )
        .drop("champion_version")
    )


def percent(share: Column) -> Column:
    return F.format_string("%.2f%%", share * 100)


def _metrics_of(versions: DataFrame, events: DataFrame, alias: str) -> DataFrame:
    chosen = alias_versions(events, alias).withColumnRenamed(f"{alias}_version", VERSION)
    return versions.join(chosen, [MODEL, VERSION]).select(
        MODEL,
        F.col(VERSION).alias(f"{alias}_version"),
        F.col("rmse").alias(f"{alias}_rmse"),
        F.col("mae").alias(f"{alias}_mae"),
        has_flag("validated").alias(f"{alias}_validated"),
        has_flag("passed_validation").alias(f"{alias}_passed"),
        (_tag("validation_status") == "passed").alias(f"{alias}_status_passed"),
    )


def gain(champion: str, other: str) -> Column:
    """Relative improvement on the champion; negative means worse."""
    return F.when(F.col(champion) != 0, (F.col(champion) - F.col(other)) / F.col(champion))


def govern_decision(versions: DataFrame, events: DataFrame, min_gain: float = 0.02) -> DataFrame:
    """Per model: accept the best validated version if it beats the champion by enough.

    Every model of ``versions`` has a row. Without a champion or without a validated version
    nothing can be decided: the decision is "none" and the reason says what is missing.
    """
    best = validated_versions(versions).groupBy(MODEL).agg(
        F.min(
            F.struct("rmse", "mae", version_number().alias("_number"), F.col(VERSION))
        ).alias("_best")
    )
    table = (
        versions.select(MODEL)
        .distinct()
        .join(_metrics_of(versions, events, "champion"), MODEL, "left")
        .join(best, MODEL, "left")
    )
    table = table.select(
        MODEL,
        "champion_version",
        "champion_rmse",
        "champion_mae",
        F.col(f"_best.{VERSION}").alias("best_version"),
        F.col("_best.rmse").alias("best_rmse"),
        F.col("_best.mae").alias("best_mae"),
    )
    table = table.withColumns(
        {
            "rmse_gain": gain("champion_rmse", "best_rmse"),
            "mae_gain": gain("champion_mae", "best_mae"),
        }
    )
    same = F.col("best_version") == F.col("champion_version")
    accepted = F.coalesce(~same & (F.col("rmse_gain") >= min_gain), F.lit(False))
    floor = percent(F.lit(min_gain))
    missing = F.col("champion_version").isNull() | F.col("best_version").isNull()
    reason = (
        F.when(F.col("champion_version").isNull(), "no champion")
        .when(F.col("best_version").isNull(), "no validated version")
        .when(
            accepted,
            F.concat(F.lit("gain "), percent(F.col("rmse_gain")), F.lit(" >= "), floor),
        )
        .when(same, F.lit("best is the champion"))
        .otherwise(F.concat(F.lit("gain "), percent(F.col("rmse_gain")), F.lit(" < "), floor))
    )
    return table.withColumn(
        "decision",
        F.when(missing, "none").when(accepted, "accepted").otherwise("rejected"),
    ).withColumn("reason", reason)


def alias_changes(decisions: DataFrame, events: DataFrame) -> DataFrame:
    """Alias writes that follow from the decisions, only where they change something."""
    challenger = decisions.where(F.col("decision") != "none").select(
        MODEL, F.lit("challenger").alias("alias"), F.col("best_version").alias(VERSION)
    )
    champion = decisions.where(F.col("decision") == "accepted").select(
        MODEL, F.lit("champion").alias("alias"), F.col("best_version").alias(VERSION)
    )
    current = alias_current(events).withColumnRenamed(VERSION, "_held")
    return (
        challenger.unionByName(champion)
        .join(current, [MODEL, "alias"], "left")
        .where(~F.col(VERSION).eqNullSafe(F.col("_held")))
        .drop("_held")
    )


def promotion_gate(
    versions: DataFrame, events: DataFrame, min_gain: float = 0.02, status_counts: bool = False
) -> DataFrame:
    """Per model: whether the challenger may replace the champion, with every reason if not.

    The challenger needs both flags, ``validated`` and ``passed_validation``, and each that
    is missing is a reason of its own; with ``status_counts`` a status "passed" stands for both.
    Every model of ``versions`` has a row; without a champion or challenger its status is "none".
    """
    table = (
        versions.select(MODEL)
        .distinct()
        .join(_metrics_of(versions, events, "champion"), MODEL, "left")
        .join(_metrics_of(versions, events, "challenger"), MODEL, "left")
    )
    rmse_gain = gain("champion_rmse", "challenger_rmse")
    short = F.coalesce(rmse_gain < min_gain, F.lit(True))
    by_status = F.col("challenger_status_passed") & F.lit(status_counts)
    validated = F.col("challenger_validated") | by_status
    passed = F.col("challenger_passed") | by_status
    no_champion, no_challenger = F.col("champion_version").isNull(), F.col("challenger_version").isNull()
    missing = no_champion | no_challenger
    reasons = F.concat_ws(
        " ; ",
        F.when(no_champion, F.lit("no champion")),
        F.when(no_challenger, F.lit("no challenger")),
        F.when(~missing & ~validated, F.lit("validated is not true")),
        F.when(~missing & ~passed, F.lit("passed_validation is not true")),
        F.when(
            ~missing & short,
            F.concat(F.lit("gain "), percent(rmse_gain), F.lit(" < "), percent(F.lit(min_gain))),
        ),
    )
    status = F.when(missing, "none").when(validated & passed & ~short, "accepted").otherwise("rejected")
    return table.select(
        MODEL,
        "champion_version",
        "challenger_version",
        rmse_gain.alias("rmse_gain"),
        gain("champion_mae", "challenger_mae").alias("mae_gain"),
        status.alias("promotion_status"),
        reasons.alias("reasons"),
    )


def promotion_events(
    gate: DataFrame, environments: tuple[str, ...] = ("development", "staging", "production")
) -> DataFrame:
    """Alias writes of accepted promotions, in order from 1 for each model.

    The old champion becomes the rollback, then the challenger becomes the champion and the
    version of every environment. Rejected promotions write nothing.
    """
    writes = [("rollback", "champion_version"), ("champion", "challenger_version")]
    writes += [(name, "challenger_version") for name in environments]
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("alias"), F.col(v).alias(VERSION), F.lit(i).cast("long").alias("seq"))
            for i, (a, v) in enumerate(writes, start=1)
        ]
    )
    accepted = gate.where(F.col("promotion_status") == "accepted")
    return accepted.select(MODEL, F.explode(rows).alias("_e")).select(MODEL, "_e.*")


def six_digits(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%.6f", value))


# How a promotion is told on the challenger.
PROMOTED, HELD, BASIS = "promoted_to_champion", "held_as_challenger", "champion_vs_challenger"


def promotion_tags(gate: DataFrame, min_gain: float = 0.02) -> DataFrame:
    """Tag writes that record a round of ``promotion_gate`` on the challengers; gains and threshold to six digits."""
    accepted = F.col("promotion_status") == "accepted"
    met = F.concat(F.lit("gain "), percent(F.col("rmse_gain")), F.lit(" >= "), percent(F.lit(min_gain)))
    writes = [
        ("promotion_status", F.col("promotion_status")),
        ("governance_decision", F.when(accepted, PROMOTED).otherwise(HELD)),
        ("decision_note", F.concat(F.col("promotion_status"), F.lit(": "), F.when(accepted, met).otherwise(F.col("reasons")))),
        ("rejected_reason", F.when(~accepted, F.col("reasons"))),
        ("rmse_gain", six_digits(F.col("rmse_gain"))),
        ("mae_gain", six_digits(F.col("mae_gain"))),
        ("promotion_threshold", six_digits(F.lit(min_gain))),
        ("comparison_basis", F.lit(BASIS)),
    ]
    rows = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value"), F.lit(i).cast("long").alias("seq")) for i, (k, v) in enumerate(writes, start=1)])
    judged = gate.where(F.col("promotion_status") != "none")
    written = judged.select(MODEL, F.col("challenger_version").alias(VERSION), F.explode(rows).alias("_e")).select(MODEL, VERSION, "_e.*")
    return written.where(F.col("value").isNotNull())


def governance_tags(ranks: DataFrame, decisions: DataFrame) -> DataFrame:
    """Tag writes that record a governance round on the validated versions.

    ``ranks`` comes from ``govern_rank`` and ``decisions`` from ``govern_decision``. Every ranked
    version gets its rank, that it is validated and whether it was selected; the best one also the decision, its
    reason, the gains (to six digits, so that they can be compared) and the champion it was compared with.
    """
    table = ranks.select(MODEL, VERSION, "rank", "is_best").join(
        decisions.select(MODEL, "decision", "reason", "rmse_gain", "mae_gain", "champion_version"),
        MODEL,
        "left",
    )
    best = F.col("is_best")
    writes = [
        ("governance_rank", F.col("rank").cast("string")),
        ("governance_selected", F.col("is_best").cast("string")),
        ("governance_decision", F.when(best, F.col("decision"))),
        ("governance_reason", F.when(best, F.col("reason"))),
        ("governance_rmse_gain", F.when(best, six_digits(F.col("rmse_gain")))),
        ("governance_mae_gain", F.when(best, six_digits(F.col("mae_gain")))),
        ("governance_compared_with", F.when(best, F.col("champion_version"))),
        ("governance_validated", F.lit("true")),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(key).alias("key"), value.alias("value"), F.lit(i).cast("long").alias("seq"))
            for i, (key, value) in enumerate(writes, start=1)
        ]
    )
    written = table.select(MODEL, VERSION, F.explode(rows).alias("_e")).select(MODEL, VERSION, "_e.*")
    return written.where(F.col("value").isNotNull())


def dataset_digest(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Content fingerprint that does not depend on row order: row count and summed row hashes.

    A value enters with its length and a null as "-", so neither nulls and empty texts nor
    values that contain a separator are mixed up.
    """

    def tagged(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    digest = hex_number(F.md5(F.concat(*map(tagged, columns))), 8)
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("rows"), F.sum(digest).alias("digest")
    )
