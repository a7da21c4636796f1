"""Classifiers: three learners and their soft vote, tuning, scoring and validation."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.constants import TARGET
from pulsemark.operators.evaluate import evaluate, training_composition
from pulsemark.operators.scaling import Scaler
from pulsemark.operators.splits import with_folds
from pulsemark.session import cut

MAX_DEPTH = 30  # the deepest tree MLlib builds; stands for "no limit"

# --- fixed values: default parameters and search grids ---------------------------------------
DEFAULTS: dict[str, dict] = {
    "lr_l1": {"C": 1.0, "penalty": "l1", "max_iter": 5000},
    "rf": {
        "n_estimators": 500, "max_depth": None, "min_samples_leaf": 5, "min_samples_split": 2,
        "max_features": "sqrt",
    },
    "gbt": {
        "n_estimators": 500, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8,
        "colsample": 0.8, "min_child_weight": 5, "gamma": 0,
    },
}
GRIDS: dict[str, dict[str, list]] = {
    "lr_l1": {
        "C": [0.001, 0.01, 0.1, 0.5, 1.0, 5.0, 10.0, 100.0],
        "penalty": ["l1"],
        "max_iter": [2000, 5000],
    },
    "rf": {
        "n_estimators": [100, 200, 300, 500],
        "max_depth": [None, 5, 10, 20, 30],
        "min_samples_leaf": [1, 2, 5, 10],
        "min_samples_split": [2, 5, 10],
        "max_features": ["sqrt", "log2", None],
    },
    "gbt": {
        "n_estimators": [100, 200, 300, 500],
        "max_depth": [3, 4, 5, 6, 8],
        "learning_rate": [0.01, 0.05, 0.1, 0.2],
        "subsample": [0.6, 0.7, 0.8, 1.0],
        "colsample": [0.6, 0.7, 0.8, 1.0],
        "min_child_weight": [1, 3, 5, 10],
        "gamma": [0, 0.1, 0.3, 0.5],
    },
}
# Parameters without a default of their own.
EXTRA: dict[str, set[str]] = {"lr_l1": {"l1_ratio"}, "rf": set(), "gbt": {"max_bin"}}
STRATEGIES = ("random", "halving", "grid")
VOTE_WEIGHTS = {"rf": 1.0, "gbt": 2.0}
TOP_FEATURES = 20


def make(kind: str, params: Mapping, rows: int, seed: int = 42) -> Estimator:
    """M4-M6: a learner from its parameters. ``rows`` turns C into MLlib's per-row penalty."""
    if kind not in DEFAULTS:
        raise ValueError(f"unknown model type {kind!r}; choose from {sorted(DEFAULTS)}")
    unknown = sorted(set(params) - set(DEFAULTS[kind]) - EXTRA[kind])
    if unknown:
        raise ValueError(f"{kind} has no parameter {', '.join(unknown)}")
    p = {**DEFAULTS[kind], **params}
    common = {"featuresCol": "features", "labelCol": TARGET}
    if kind == "lr_l1":
        mixing = {"l1": 1.0, "l2": 0.0}.get(p["penalty"], p.get("l1_ratio", 1.0))
        return LogisticRegression(
            regParam=1.0 / (p["C"] * max(rows, 1)), elasticNetParam=mixing, maxIter=p["max_iter"],
            standardization=False, **common,
        )
    if kind == "rf":
        return RandomForestClassifier(
            numTrees=p["n_estimators"], maxDepth=min(p["max_depth"] or MAX_DEPTH, MAX_DEPTH),
            minInstancesPerNode=max(p["min_samples_leaf"], p["min_samples_split"] // 2),
            featureSubsetStrategy=p["max_features"] or "all", seed=seed, **common,
        )
    if kind == "gbt":
        return GBTClassifier(
            maxIter=p["n_estimators"], maxDepth=p["max_depth"], stepSize=p["learning_rate"],
            subsamplingRate=p["subsample"], featureSubsetStrategy=str(p["colsample"]),
            minInstancesPerNode=p["min_child_weight"], minInfoGain=float(p["gamma"]), seed=seed,
            maxBins=p.get("max_bin", 32), **common,
        )
    raise ValueError(f"unknown model type {kind!r}")


def assemble(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """Feature columns as one vector; columns in ``keep`` stay beside it."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features")
    return vectors.transform(df).select(*keep, "features")


def score(model: Model, df: DataFrame, name: str = "score") -> DataFrame:
    """Add the probability of the positive class and the predicted class."""
    out = model.transform(df)
    return out.withColumn(name, vector_to_array("probability")[1]).select(
        *df.columns, name, F.col("prediction").cast("int").alias("prediction")
    )


@dataclass
class Entry:
    """A fitted model with what it needs to score raw feature columns."""

    kind: str
    members: dict[str, Model]
    columns: list[str]
    scaler: Scaler | None = None
    result: dict = field(default_factory=dict)
    training: dict = field(default_factory=dict)
    params: dict = field(default_factory=dict)

    def predict(self, vectors: DataFrame) -> DataFrame:
        """M7: one model's score, or the weighted mean of the members' scores; no join is needed."""
        if len(self.members) == 1:
            return score(next(iter(self.members.values())), vectors)
        total = sum(VOTE_WEIGHTS[m] for m in self.members)
        out = vectors
        for name, model in self.members.items():
            out = score(model, out, f"_{name}").drop("prediction")
        mean = sum(F.col(f"_{m}") * VOTE_WEIGHTS[m] for m in self.members) / total
        return out.withColumn("score", mean).withColumn(
            "prediction", (F.col("score") > 0.5).cast("int")
        ).drop(*[f"_{m}" for m in self.members])

    def importances(self, top: int | None = TOP_FEATURES) -> list[dict]:
        """Features by absolute weight; a vote has none. The list is one entry per column."""
        if len(self.members) > 1:
            return []
        model = next(iter(self.members.values()))
        linear = hasattr(model, "coefficients")
        weights = (model.coefficients if linear else model.featureImportances).toArray()
        name = "coefficient" if linear else "importance"
        ranked = sorted(zip(self.columns, weights), key=lambda pair: -abs(pair[1]))
        return [{"feature": f, name: round(float(w), 6)} for f, w in ranked[:top]]

    def zeroed(self) -> list[str]:
        """Features a linear model gave no weight."""
        return [w["feature"] for w in self.importances(None) if w.get("coefficient") == 0]


def train(
    train_rows: DataFrame,
    test_rows: DataFrame,
    columns: Sequence[str],
    params: Mapping[str, Mapping] | None = None,
    seed: int = 42,
    kinds: Sequence[str] = ("lr_l1", "rf", "gbt", "ensemble"),
) -> dict[str, Entry]:
    """Fit on train, evaluate on test. The scaler is fitted on real train rows only.

    The vector table is written once; every learner and boosting round reads it. Each entry keeps
    the make-up of its training rows (A27).
    """
    columns, params = list(columns), params or {}
    scaler = Scaler().fit(real_rows(train_rows), columns)
    about = about_training(train_rows, test_rows)
    fit_on = cut(assemble(scaler.transform(train_rows), columns, TARGET))
    test_on = cut(assemble(scaler.transform(test_rows), columns, TARGET))
    rows = fit_on.count()
    single = {
        kind: make(kind, params.get(kind, {}), rows, seed).fit(fit_on)
        for kind in ("lr_l1", "rf", "gbt")
        if kind in kinds or ("ensemble" in kinds and kind in VOTE_WEIGHTS)
    }
    entries = {}
    for kind in kinds:
        members = {m: single[m] for m in VOTE_WEIGHTS} if kind == "ensemble" else {kind: single[kind]}
        entry = Entry(kind, members, columns, scaler, params=dict(params.get(kind, DEFAULTS.get(kind, {}))))
        entry.result = evaluate(entry.predict(test_on))
        entry.result["top_features"] = entry.importances()
        entry.training = dict(about)
        entries[kind] = entry
    return entries


def real_rows(rows: DataFrame) -> DataFrame:
    """The rows that are not synthetic, all where there is no flag."""
    flag = "contains_synthetic_data"
    return rows.where(~F.coalesce(F.col(flag), F.lit(False))) if flag in rows.columns else rows


def about_training(train_rows: DataFrame, test_rows: DataFrame) -> dict:
    """A27 for the record of a model: sizes, the synthetic share and the balance of the target."""
    def part(rows: DataFrame, name: str) -> DataFrame:
        flag = F.col("contains_synthetic_data") if "contains_synthetic_data" in rows.columns else F.lit(False)
        return rows.select(F.lit(name).alias("split"), TARGET, flag.alias("contains_synthetic_data"))

    row = training_composition(part(train_rows, "train").unionByName(part(test_rows, "test"))).first().asDict()
    return {
        **{k: row[k] for k in ("real_train_rows", "synthetic_train_rows", "total_train_rows",
                               "test_rows", "synthetic_pct")},
        "target_balance_train": {"0": row["train_0"], "1": row["train_1"]},
        "target_balance_test": {"0": row["test_0"], "1": row["test_1"]},
    }


def prepare(entry: Entry, rows: DataFrame) -> DataFrame:
    """A frame as one model expects it. A missing feature takes the training mean, which scales
    to 0, or 0.0 for a model fitted unscaled."""
    absent = [c for c in entry.columns if c not in rows.columns]
    means = entry.scaler.means if entry.scaler else {}
    filled = rows.withColumns({c: F.lit(float(means.get(c, 0.0))) for c in absent}) if absent else rows
    scaled = entry.scaler.transform(filled) if entry.scaler else filled
    return assemble(scaled, entry.columns, TARGET)


def validate(entries: Mapping[str, Entry], rows: DataFrame) -> dict[str, dict]:
    """Every model on the same unscaled rows, each with its own scaler and features."""
    if not entries:
        raise RuntimeError("no models to validate")
    results = {}
    for name, entry in entries.items():
        results[name] = evaluate(entry.predict(prepare(entry, rows)))
        results[name]["top_features"] = entry.importances()
    return results


def grid_for(kind: str) -> dict[str, list]:
    if kind not in GRIDS:
        raise ValueError(f"no grid for {kind!r}; choose from {sorted(GRIDS)} or pass one")
    return dict(GRIDS[kind])


def combinations(grid: Mapping[str, Sequence]) -> list[dict]:
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*grid.values())]


def _cross_validate(
    kind: str, trials: list[dict], rows: DataFrame, n: int, cv: int, seed: int, parallelism: int
) -> list[float]:
    """Mean area under ROC of each trial over the same folds."""
    base = make(kind, {}, n, seed)
    maps = []
    for trial in trials:
        wanted = make(kind, trial, n, seed)
        maps.append({base.getParam(p.name): wanted.getOrDefault(p) for p in wanted.params
                     if wanted.isSet(p) and p.name not in ("featuresCol", "labelCol")})
    search = CrossValidator(
        estimator=base, estimatorParamMaps=maps, numFolds=cv, foldCol="fold", parallelism=parallelism,
        evaluator=BinaryClassificationEvaluator(labelCol=TARGET, metricName="areaUnderROC"),
    )
    return list(search.fit(rows).avgMetrics)


def tune(
    kind: str,
    train_rows: DataFrame,
    columns: Sequence[str],
    grid: Mapping[str, Sequence] | None = None,
    strategy: str = "random",
    cv: int = 5,
    n_iter: int = 50,
    seed: int = 42,
    parallelism: int = 4,
) -> dict:
    """M8: search a grid by cross-validated area under ROC.

    ``random`` tries ``n_iter`` seeded combinations, ``grid`` all of them, and ``halving`` all of them on
    few rows, then the best third on three times as many, until one round sees every row. Folds are stratified on the target. Columns are
    scaled first, as in training, so that a penalty means the same in both.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; choose from {list(STRATEGIES)}")
    trials = combinations(grid or grid_for(kind))
    hashed = F.pmod(F.xxhash64("video_id", F.lit(seed)), F.lit(1 << 30))
    scaled = Scaler().fit(real_rows(train_rows), columns).transform(train_rows)
    rows = assemble(scaled, columns, "video_id", TARGET).select(
        "video_id", TARGET, "features", (hashed / float(1 << 30)).alias("place"),
    )
    rows = cut(with_folds(cut(rows), cv, seed + 1).drop("video_id"))
    n = rows.count()
    history: list[tuple[dict, float]] = []
    if strategy == "halving":
        rounds = max(1, math.ceil(math.log(len(trials), 3))) if len(trials) > 1 else 1
        for step in range(rounds):
            share = 3.0 ** (step + 1 - rounds)
            part = rows.where(F.col("place") < share)
            scores = _cross_validate(kind, trials, part, max(int(n * share), 1), cv, seed, parallelism)
            history = sorted(zip(trials, scores), key=lambda pair: -pair[1])
            if step + 1 < rounds:
                trials = [t for t, _ in history[: max(1, math.ceil(len(history) / 3))]]
    else:
        if strategy == "random" and n_iter < len(trials):
            trials = random.Random(seed).sample(trials, n_iter)
        scores = _cross_validate(kind, trials, rows, n, cv, seed, parallelism)
        history = sorted(zip(trials, scores), key=lambda pair: -pair[1])
    best, value = history[0]
    return {
        "best_params": best, "best_score": value, "trials": history,
        "model_type": kind, "strategy": strategy,
    }
