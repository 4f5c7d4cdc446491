"""Linear regression over a panel from one aggregation.

Counts, means and covariances of the features and target are all a least-squares fit
needs. One distributed pass computes them per group (part or fold segment); what reaches
the driver is a matrix of the size of the feature list, whatever the number of rows. From
it follow every feature subset, penalty and fold, and their RMSE and R² as well, since the
squared error of a linear model is a quadratic form in the same moments.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.functions.gram import cross_products, independent_columns, triangular_factor
from wattlane.operators.splits import Fold, fold_segment, in_validation
from wattlane.schema import PART, VALUE, require_columns


@dataclass(frozen=True)
class LinearModel:
    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float

    def prediction(self) -> Column:
        out = F.lit(float(self.intercept))
        for name, weight in zip(self.features, self.weights):
            out = out + F.lit(float(weight)) * F.col(name).cast("double")
        return out


@dataclass(frozen=True)
class Moments:
    """Row count, means and centred cross-products; the target is the last column."""

    features: tuple[str, ...]
    n: int
    mean: np.ndarray
    cross: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return other if not self.n else self
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moments(
            self.features,
            n,
            self.mean + gap * (other.n / n),
            self.cross + other.cross + np.outer(gap, gap) * (self.n * other.n / n),
        )

    def fit(
        self, alpha: float = 0.0, features: list[str] | None = None, standardize: bool = False
    ) -> LinearModel:
        """Ridge with a free intercept; least squares at ``alpha`` 0.

        Scaling the features to unit variance before the penalty is the same as penalising
        each weight in proportion to its feature's variance.
        """
        if not self.n:
            raise ValueError("no complete rows to fit on")
        names = list(features) if features is not None else list(self.features)
        if not names:
            return LinearModel((), (), float(self.mean[-1]))
        at = [self.features.index(name) for name in names]
        xx, xy = self.cross[np.ix_(at, at)], self.cross[at, -1]
        if alpha:
            scale = np.diag(xx) / self.n if standardize else np.ones(len(at))
            scale = np.where(scale > 0, scale, 1.0)
            weights = np.linalg.solve(xx + alpha * np.diag(scale), xy)
        else:
            weights = np.linalg.lstsq(xx, xy, rcond=None)[0]
        return self._model(names, at, weights)

    def _model(self, names: list[str], at: list[int], weights: np.ndarray) -> LinearModel:
        intercept = self.mean[-1] - weights @ self.mean[at]
        return LinearModel(tuple(names), tuple(float(w) for w in weights), float(intercept))

    def fit_bayesian(
        self, features: list[str] | None = None, rounds: int = 300, tolerance: float = 1e-3
    ) -> LinearModel:
        """Evidence iteration for the noise and weight precisions under weak gamma priors."""
        names = list(features or self.features)
        at = [self.features.index(name) for name in names]
        xx, xy, yy = self.cross[np.ix_(at, at)], self.cross[at, -1], self.cross[-1, -1]
        prior = 1e-6
        spectrum, basis = np.linalg.eigh(xx)
        spectrum = np.clip(spectrum, 0.0, None)
        noise = 1.0 / (yy / self.n + np.finfo(float).eps)
        spread = 1.0

        def weights_at() -> np.ndarray:
            return basis @ ((basis.T @ xy) / (spectrum + spread / noise))

        previous = None
        for _ in range(rounds):
            weights = weights_at()
            error = max(yy - 2 * weights @ xy + weights @ xx @ weights, 0.0)
            known = float(np.sum(noise * spectrum / (spread + noise * spectrum)))
            spread = (known + 2 * prior) / (weights @ weights + 2 * prior)
            noise = (self.n - known + 2 * prior) / (error + 2 * prior)
            if previous is not None and np.sum(np.abs(previous - weights)) < tolerance:
                break
            previous = weights
        return self._model(names, at, weights_at())

    def score(self, model: LinearModel) -> dict[str, float | None]:
        """RMSE, R² and bias of a model on these rows, without another pass."""
        if not self.n:
            raise ValueError("no complete rows to score")
        at = [self.features.index(name) for name in model.features]
        w = np.asarray(model.weights)
        xx, xy, yy = self.cross[np.ix_(at, at)], self.cross[at, -1], self.cross[-1, -1]
        bias = self.mean[-1] - model.intercept - w @ self.mean[at]
        squared = yy - 2 * w @ xy + w @ xx @ w + self.n * bias**2
        return {
            "rmse": float(np.sqrt(max(squared, 0.0) / self.n)),
            "r2": float(1 - squared / yy) if yy > 0 else None,
            "bias": float(bias),
        }


def moments(
    df: DataFrame, features: list[str], target: str = VALUE, by: Column | None = None
) -> dict[object, Moments]:
    """Moments of the complete rows, overall (key None) or per value of ``by``.

    ``by`` is a part, fold or segment: a fixed handful of values, never a series. Partial
    products are centred and merge by the shift of their means, so large values do not cancel.
    """
    require_columns(df, [*features, target])
    columns = [*features, target]
    found = cross_products(df.na.drop(subset=columns), columns, by)
    if by is None and not found:
        found = {None: (0, np.zeros(len(columns)), np.zeros((len(columns), len(columns))))}
    return {key: Moments(tuple(features), n, mean, cross) for key, (n, mean, cross) in found.items()}


@dataclass(frozen=True)
class LeastSquares:
    """A fit from a triangular factor; ``dependent`` features are combinations of the others."""

    model: LinearModel
    n: int
    residual: float  # square sum of the errors
    dependent: tuple[str, ...]


def fit_least_squares(df: DataFrame, features: list[str], target: str = VALUE) -> LeastSquares:
    """Least squares with a free intercept from a QR factorisation in a tree.

    The factor of (1, features, target) holds that of the centred features, so the
    condition number of the columns is never squared. Among features that depend on each other the
    shortest weights are taken.
    """
    require_columns(df, [*features, target])
    rows = df.na.drop(subset=[*features, target])
    r = triangular_factor(rows, [F.lit(1.0), *features, target])
    if r is None:
        raise ValueError("no complete rows to fit on")
    p = len(features)
    inner, right = r[1 : p + 1, 1 : p + 1], r[1 : p + 1, -1]
    kept = independent_columns(inner, np.sqrt((r[:, 1 : p + 1] ** 2).sum(axis=0)))
    size = np.sqrt((inner * inner).sum(axis=0))
    if len(kept) == p:
        # Columns of unit length, so that units do not matter.
        weights = np.linalg.lstsq(inner / size, right, rcond=None)[0] / size if p else np.zeros(0)
    else:
        weights = np.linalg.lstsq(inner, right, rcond=1e-11)[0]
    means = r[0, 1:] / r[0, 0]
    left = right - inner @ weights
    model = LinearModel(tuple(features), tuple(map(float, weights)), float(means[-1] - weights @ means[:-1]))
    dependent = tuple(name for i, name in enumerate(features) if i not in kept)
    return LeastSquares(model, round(float(r[0, 0]) ** 2), float(left @ left + r[-1, -1] ** 2), dependent)


def mean_absolute_errors(
    df: DataFrame, models: dict[str, LinearModel], target: str = VALUE
) -> dict[str, float]:
    """MAE of all models from one scoring pass."""
    y = F.col(target).cast("double")
    names = list(models)
    row = df.agg(
        *[F.avg(F.abs(y - models[n].prediction())).alias(f"_e{i}") for i, n in enumerate(names)]
    ).first()
    return {n: row[f"_e{i}"] for i, n in enumerate(names)}


def part_moments(df: DataFrame, features: list[str], target: str = VALUE) -> dict[str, Moments]:
    return moments(df, features, target, F.col(PART))


def total(parts: list[Moments]) -> Moments:
    if not parts:
        raise ValueError("no complete rows to fit on")
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out


def coefficient_table(spark: SparkSession, models: dict[str, LinearModel]) -> DataFrame:
    """Rows of (model_id, feature, weight); the intercept is a row of its own."""
    rows = [
        (model_id, name, weight)
        for model_id, m in models.items()
        for name, weight in [("intercept", m.intercept), *zip(m.features, m.weights)]
    ]
    return spark.createDataFrame(rows, "model_id string, feature string, weight double")


def model_from_table(table: DataFrame, model_id: str) -> LinearModel:
    rows = {
        r["feature"]: r["weight"]
        for r in table.where(F.col("model_id") == model_id).collect()
    }
    if "intercept" not in rows:
        raise KeyError(f"no coefficients of {model_id!r}")
    intercept = rows.pop("intercept")
    names = sorted(rows)  # a stored table has no order
    return LinearModel(tuple(names), tuple(rows[n] for n in names), intercept)


def _significant(value: float, digits: int) -> float:
    return float(f"{value:.{digits}g}")


def _ranked_rows(rows: list[dict], metric: str = "rmse", digits: int = 9) -> list[dict]:
    """Ascending by the metric; metrics equal in ``digits`` significant digits keep their order of entry.

    Significant digits do not depend on the unit; what lies beyond them is the order of summation.
    """
    ordered = sorted(
        enumerate(rows), key=lambda item: (_significant(item[1][metric], digits), item[0])
    )
    return [{**row, "rank": place} for place, (_, row) in enumerate(ordered, start=1)]


def fit_strategies(train: Moments, strategies: dict[str, list[str]], alpha: float = 0.0) -> dict[str, LinearModel]:
    """A model of each feature set, from the moments of all features."""
    return {name: train.fit(alpha, names) for name, names in strategies.items()}


def alpha_grid(
    df: DataFrame,
    features: list[str],
    alphas: list[float],
    standardize: tuple[bool, ...] = (False,),
    target: str = VALUE,
) -> list[dict]:
    """Validation scores of a ridge model per penalty (and scaling), best first."""
    stats = part_moments(df, features, target)
    models = {
        (scaled, alpha): stats["train"].fit(alpha, standardize=scaled)
        for scaled in standardize
        for alpha in alphas
    }
    rows = [
        {"alpha": alpha, "standardize": scaled, **stats["validation"].score(model), "model": model}
        for (scaled, alpha), model in models.items()
    ]
    mae = _validation_mae(df, {str(i): row["model"] for i, row in enumerate(rows)}, features, target)
    return _ranked_rows([{**row, "mae": mae[str(i)]} for i, row in enumerate(rows)])


def _validation_mae(df, models, features, target):
    rows = df.where(F.col(PART) == "validation").na.drop(subset=[*features, target])
    return mean_absolute_errors(rows, models, target)


def strategy_sweep(
    df: DataFrame,
    strategies: dict[str, list[str]],
    splits: dict[str, Column] | None = None,
    target: str = VALUE,
    alpha: float = 0.0,
) -> list[dict]:
    """Every feature set on every split, all fitted on the same complete rows, best first.

    ``splits`` maps a name to the expression of a row's part. One pass gives the moments of
    all splits and feature sets, a second one the absolute errors of all models.
    """
    splits = splits or {"split": F.col(PART)}
    every = list(dict.fromkeys(name for names in strategies.values() for name in names))
    # A row's parts under all splits at once; each split then adds up the groups it needs.
    parts = F.concat_ws("|", *[F.coalesce(part, F.lit("")) for part in splits.values()])
    stats = moments(df, every, target, parts)
    models, rows = {}, []
    for place, split in enumerate(splits):

        def of(part: str) -> Moments:
            return total([m for key, m in stats.items() if key.split("|")[place] == part])

        train, validation = of("train"), of("validation")
        for name, names in strategies.items():
            model = train.fit(alpha, names)
            models[(split, name)] = model
            rows.append(
                {"strategy": name, "split": split, **validation.score(model), "model": model}
            )
    y = F.col(target).cast("double")
    errors = (
        df.na.drop(subset=[*every, target])
        .agg(
            *[
                F.avg(F.when(splits[split] == "validation", F.abs(y - m.prediction()))).alias(f"_e{i}")
                for i, ((split, _), m) in enumerate(models.items())
            ]
        )
        .first()
    )
    return _ranked_rows([{**row, "mae": errors[f"_e{i}"]} for i, row in enumerate(rows)])


def regularisation_curve(
    df: DataFrame, features: list[str], alphas: list[float], target: str = VALUE
) -> list[dict]:
    """Train and test RMSE per penalty from the two moment matrices alone."""
    stats = part_moments(df, features, target)
    out = []
    for alpha in alphas:
        model = stats["train"].fit(alpha)
        out.append(
            {
                "alpha": alpha,
                "train_rmse": stats["train"].score(model)["rmse"],
                "test_rmse": stats["test"].score(model)["rmse"],
            }
        )
    return out


def refit_and_test(
    df: DataFrame, features: list[str], alpha: float, target: str = VALUE
) -> tuple[LinearModel, dict]:
    """Fit on train and validation together and score the test part once."""
    stats = part_moments(df, features, target)
    model = (stats["train"] + stats["validation"]).fit(alpha)
    test = df.where(F.col(PART) == "test").na.drop(subset=[*features, target])
    mae = mean_absolute_errors(test, {"m": model}, target)["m"]
    return model, {**stats["test"].score(model), "mae": mae}


def fold_moments(
    df: DataFrame, folds: list[Fold], features: list[str], target: str = VALUE
) -> dict[int, tuple[Moments, Moments]]:
    """Training and validation moments of every fold from one pass over the panel."""
    segment, train, validation = fold_segment(folds)
    pieces = moments(df, features, target, segment)
    out = {}
    for fold in folds:
        sides = []
        for wanted in (train[fold.fold], validation[fold.fold]):
            found = [pieces[s] for s in wanted if s in pieces]
            if not found:
                raise ValueError(f"fold {fold.fold} has no complete rows")
            sides.append(total(found))
        out[fold.fold] = (sides[0], sides[1])
    return out


def alpha_cv(
    df: DataFrame, folds: list[Fold], features: list[str], alphas: list[float], target: str = VALUE
) -> tuple[float, list[dict]]:
    """Mean RMSE over the folds per penalty, and the best penalty."""
    sides = fold_moments(df, folds, features, target)
    rows = [
        {
            "alpha": alpha,
            "rmse": float(np.mean([v.score(t.fit(alpha))["rmse"] for t, v in sides.values()])),
        }
        for alpha in alphas
    ]
    ranked = _ranked_rows(rows)
    return ranked[0]["alpha"], ranked


# The candidates compared by cross-validation; None is the mean of the target.
CANDIDATES: dict[str, float | None] = {
    "dummy_mean": None,
    "linear_regression": 0.0,
    "ridge_1": 1.0,
    "ridge_10": 10.0,
}


def model_cv(
    df: DataFrame,
    folds: list[Fold],
    features: list[str],
    candidates: dict[str, float | None] | None = None,
    target: str = VALUE,
) -> list[dict]:
    """Mean RMSE, MAE and R² over the folds per candidate, best first."""
    candidates = candidates or CANDIDATES
    sides = fold_moments(df, folds, features, target)
    models = {
        (fold, name): (t.fit(features=[]) if alpha is None else t.fit(alpha))
        for fold, (t, _) in sides.items()
        for name, alpha in candidates.items()
    }
    mae = fold_absolute_errors(df, folds, models, features, target)
    rows = []
    for name in candidates:
        scores = [v.score(models[(fold, name)]) for fold, (_, v) in sides.items()]
        r2 = [s["r2"] for s in scores]
        rows.append(
            {
                "name": name,
                "rmse": float(np.mean([s["rmse"] for s in scores])),
                "mae": float(np.mean([mae[(fold, name)] for fold in sides])),
                "r2": float(np.mean(r2)) if None not in r2 else None,
            }
        )
    return _ranked_rows(rows)


def fold_absolute_errors(df, folds, models, features, target) -> dict:
    """MAE of each fold's models on its validation rows, all from one pass."""
    by_fold = {f.fold: in_validation(f) for f in folds}
    y = F.col(target).cast("double")
    row = (
        df.na.drop(subset=[*features, target])
        .agg(
            *[
                F.avg(F.when(by_fold[fold], F.abs(y - m.prediction()))).alias(f"_e{i}")
                for i, ((fold, _), m) in enumerate(models.items())
            ]
        )
        .first()
    )
    return {key: row[f"_e{i}"] for i, key in enumerate(models)}


def results_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table of results; only the columns of ``schema`` are kept."""
    names = [part.split()[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], schema)
