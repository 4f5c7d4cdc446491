import pytest

from wattlane.operators import governance


@pytest.fixture(scope="module")
def versions(spark):
    rows = [
        ("m", "1", 10.0, 5.0, {"validated": "TRUE", "passed_validation": "true"}),
        ("m", "2", 9.0, 5.0, {"validated": "true", "passed_validation": " false "}),
        ("m", "10", 9.5, 4.0, {"validation_status": " Passed"}),
        ("m", "3", 9.5, 4.0, {"validated": "True ", "passed_validation": "TRUE"}),
        ("m", "4", 1.0, 1.0, {}),
        ("n", "1", 7.0, 3.0, {"validation_status": "passed"}),
    ]
    return spark.createDataFrame(
        rows, "model_name string, version string, rmse double, mae double, tags map<string,string>"
    )


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        ("m", "champion", "1", 1), ("m", "challenger", "2", 2), ("m", "champion", "2", 3),
        ("m", "champion", "1", 4), ("n", "champion", "1", 5), ("n", "challenger", "1", 6),
    ]
    return spark.createDataFrame(rows, "model_name string, alias string, version string, seq long")


def test_tags_decide_validation(versions):
    got = {(r.model_name, r.version) for r in governance.validated_versions(versions).collect()}
    assert got == {("m", "1"), ("m", "10"), ("m", "3"), ("n", "1")}


def test_rank_breaks_ties_by_number(versions, events):
    rows = governance.govern_rank(versions, events).where("model_name = 'm'").orderBy("rank").collect()
    assert [r.version for r in rows] == ["3", "10", "1"]
    assert [r.is_best for r in rows] == [True, False, False]
    assert [r.is_current_champion for r in rows] == [False, False, True]


def test_decisions(versions, events):
    rows = {r.model_name: r for r in governance.govern_decision(versions, events).collect()}
    assert rows["m"].decision == "accepted" and rows["m"].best_version == "3"
    assert rows["m"].reason == "gain 5.00% >= 2.00%"
    assert rows["n"].reason == "best is the champion"
    strict = governance.govern_decision(versions, events, 0.5).where("model_name = 'm'").first()
    assert strict.decision == "rejected" and strict.reason == "gain 5.00% < 50.00%"
    changes = governance.alias_changes(governance.govern_decision(versions, events), events)
    assert {(r.model_name, r.alias, r.version) for r in changes.collect()} == {
        ("m", "challenger", "3"), ("m", "champion", "3")
    }


def test_gate_lists_every_reason(versions, events):
    rows = {r.model_name: r for r in governance.promotion_gate(versions, events, 0.2).collect()}
    assert rows["m"].promotion_status == "rejected"
    assert rows["m"].reasons == "passed_validation is not true ; gain 10.00% < 20.00%"


def test_alias_log(events):
    history = governance.alias_history(events).where("model_name = 'm' and alias = 'champion'")
    rows = history.orderBy("step").collect()
    assert [(r.version, r.previous_version) for r in rows] == [("1", None), ("2", "1"), ("1", "2")]


def test_cycle_ignores_unknown_digests_and_puts_missing_metrics_last(spark):
    rows = [
        ("a", "d", "v", None, 1.0), ("b", "d", "v", 3.0, 1.0), ("c", "d", "v", 2.0, 9.0),
        ("x", None, None, 0.1, 0.1),
    ]
    runs = spark.createDataFrame(
        rows,
        "run_id string, train_digest string, validation_digest string, test_rmse double, test_mae double",
    )
    got = {r.run_id: r for r in governance.cycle_decision(runs).collect()}
    assert set(got) == {"a", "b", "c"} and {r.best_run_id for r in got.values()} == {"c"}
    assert got["c"].same_run_selected and got["a"].n_candidates == 3
    assert governance.comparable_runs(runs, "x").count() == 0
    assert governance.comparable_runs(runs, "a").count() == 3


def test_digest_ignores_order_and_sees_changes(spark, make_panel):
    p = make_panel({"a": [1.0, 2.0, 3.0]})
    columns = ["series_id", "ts", "value"]
    one = governance.dataset_digest(p, columns).first()
    assert governance.dataset_digest(p.orderBy("value", ascending=False), columns).first() == one
    assert governance.dataset_digest(make_panel({"a": [1.0, 2.0, 4.0]}), columns).first() != one


def test_promotion_needs_both_flags_and_keeps_every_model(spark):
    tags = "map<string,string>"
    ok = {"validated": " TRUE ", "passed_validation": "true"}
    rows = [
        ("a", "1", 10.0, 5.0, ok), ("a", "2", 5.0, 4.0, ok),
        ("b", "1", 10.0, 5.0, ok), ("b", "2", 5.0, 4.0, {"validated": "true", "validation_status": "Passed"}),
        ("c", "1", 10.0, 5.0, ok), ("d", "1", 9.0, 5.0, {}),
    ]
    versions = spark.createDataFrame(rows, f"model_name string, version string, rmse double, mae double, tags {tags}")
    log = [("a", "champion", "1", 1), ("a", "challenger", "2", 2), ("b", "champion", "1", 1), ("b", "challenger", "2", 2), ("c", "champion", "1", 1)]
    events = spark.createDataFrame(log, "model_name string, alias string, version string, seq long")
    gate = governance.promotion_gate(versions, events)
    got = {r.model_name: (r.promotion_status, r.reasons) for r in gate.collect()}
    assert got == {
        "a": ("accepted", ""), "b": ("rejected", "passed_validation is not true"),
        "c": ("none", "no challenger"), "d": ("none", "no champion ; no challenger"),
    }
    loose = governance.promotion_gate(versions, events, status_counts=True)
    assert {r.model_name: r.promotion_status for r in loose.collect()}["b"] == "accepted"
    writes = sorted((r.seq, r.alias, r.version) for r in governance.promotion_events(gate).collect())
    assert writes[:2] == [(1, "rollback", "1"), (2, "champion", "2")] and len(writes) == 5
    decided = {r.model_name: (r.decision, r.reason) for r in governance.govern_decision(versions, events).collect()}
    assert decided["d"] == ("none", "no champion") and decided["a"][0] == "accepted" and len(decided) == 4


def test_digest_tells_nulls_and_separators_apart(spark):
    def digest(rows):
        frame = spark.createDataFrame(rows, "a string, b string")
        return governance.dataset_digest(frame, ["a", "b"]).first().digest

    kinds = [[("", "")], [(None, "")], [("", None)], [("x|", "y")], [("x", "|y")], [("1:", "")]]
    assert len({digest(k) for k in kinds}) == len(kinds)
