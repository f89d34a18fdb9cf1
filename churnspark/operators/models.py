"""Distributed classifier training, search, ensembles and batch scoring.

Logistic regression and forests are Spark ML's, boosted trees are
:mod:`.booster`; all are stored and scored as tables (:mod:`.model_tables`).
Features are the prepared integer/double columns; the vector is assembled only
at Spark ML's training boundary.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.scalar import risk_band, threshold_predict
from churnspark.operators import booster as B, metrics as M, model_tables as MT
from churnspark.operators.forest import MOST_ROWS, TASK_ROWS, HistogramForest
from churnspark.profile import Profile
from churnspark.session import materialize

# --- Fixed values: default hyper-parameters of the original learners --------
LOGREG = dict(C=1.0, max_iter=1000, tol=1e-4)
BOOSTED = dict(trees=300, depth=6, eta=0.05, subsample=0.8, colsample=0.8, pos_weight=3.0)
FOREST = dict(trees=300, depth=8)
SEED = 42
PROB_DIGITS = 4
# -----------------------------------------------------------------------------


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def positive_probability(df: DataFrame, col: str = "probability", out: str = "p1") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col(col))[1])


def train_logreg(train: DataFrame, features: Sequence[str], label: str, C: float = LOGREG["C"],
                 max_iter: int = LOGREG["max_iter"], balanced: bool = True,
                 tol: float = LOGREG["tol"]) -> PipelineModel:
    """L2 logistic regression.  sklearn's ``C`` maps to
    ``regParam = 1 / (C * n)`` (Spark averages the loss over the total weight,
    sklearn sums it; balanced weights sum to the number of rows n)."""
    data = M.with_class_weight(train, label, "__w") if balanced else train.withColumn("__w", F.lit(1.0))
    n = train.where(F.col(label).isNotNull()).count()
    if not n:
        raise ValueError("no labelled training rows")
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="__w", maxIter=max_iter,
                            regParam=1.0 / (C * n), elasticNetParam=0.0, standardization=False, tol=tol)
    return Pipeline(stages=[assembler(features), lr]).fit(data)


def train_boosted(train: DataFrame, features: Sequence[str], label: str, trees: int = BOOSTED["trees"],
                  depth: int = BOOSTED["depth"], eta: float = BOOSTED["eta"],
                  subsample: float = BOOSTED["subsample"], colsample: float = BOOSTED["colsample"],
                  pos_weight: float = BOOSTED["pos_weight"], seed: int = SEED) -> B.BoostedModel:
    """Second-order boosted trees; positives weighted ``pos_weight``.  Zero or
    None overrides keep the defaults (the original ignores falsy values)."""
    settings = B.Settings(trees=trees or BOOSTED["trees"], depth=depth or BOOSTED["depth"], eta=eta or BOOSTED["eta"],
                          subsample=subsample, colsample=colsample, seed=seed)
    return B.train(M.with_pos_weight(train, label, "__w", pos_weight), features, label, settings, weight="__w")


def eval_curve(model, val: DataFrame, label: str) -> DataFrame:
    """Per-round validation log-loss of a boosted model: ``(round, loss)``; the
    loss is unweighted (weights belong to the training objective)."""
    return MT.losses(MT.to_tables(val.sparkSession, model), val, label)


def _spread(data: DataFrame, name: str) -> DataFrame:
    """The rows as a written table, dealt out to all cores where there are more
    than ``TASK_ROWS`` for each (small tables are read back by a task or two)."""
    data = materialize(data, name)
    n, cores = data.count(), data.sparkSession.sparkContext.defaultParallelism
    return data.repartition(max(1, min(cores, math.ceil(n / TASK_ROWS)), math.ceil(n / MOST_ROWS)))


def train_forest(train: DataFrame, features: Sequence[str], label: str, trees: int = FOREST["trees"],
                 depth: int = FOREST["depth"], balanced: bool = True, seed: int = SEED) -> PipelineModel:
    """Spark ML's forest, grown by :mod:`.forest` on as many tasks as there are
    cores, not as there are files."""
    data = M.with_class_weight(train, label, "__w") if balanced else train.withColumn("__w", F.lit(1.0))
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="__w", numTrees=trees,
                                maxDepth=depth, seed=seed)
    return Pipeline(stages=[assembler(features), HistogramForest(rf, features)]).fit(_spread(data, "forest_rows"))


def predict(model, df: DataFrame, out: str = "probability_1") -> DataFrame:
    """Model probability of the positive class as a double column."""
    if isinstance(model, (B.BoostedModel, MT.TableModel)):
        return MT.predict(MT.to_tables(df.sparkSession, model), df, out)
    keep = df.columns
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias(out))


def top_feature_importance(model: PipelineModel, features: Sequence[str], k: int = 10) -> DataFrame:
    """``(feature, importance)`` -- the k most important features (tree models)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return s.createDataFrame(rows, "feature string, importance double") \
        .orderBy(F.desc("importance"), "feature").limit(k)


# ------------------------------------------------- permutation importance
def permuted(df: DataFrame, features: Sequence[str], key: str, seed: int = SEED) -> DataFrame:
    """Every row once as it is (``permuted`` null) and once per feature with that
    feature's value taken from another row: the values, in the order of a hash
    of their row's key, are handed on to the next row of the order, the last one
    to the first.

    The order has two levels -- hash buckets, then rows inside a bucket -- so no
    window holds more than a bucket; what a bucket hands on to the next is one
    row per bucket.
    """
    out = df.withColumn("permuted", F.lit(None).cast("string"))
    for f in features:
        order = F.md5(F.concat(F.lit(f"{seed}:{f}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
        rows = df.withColumn("__s", F.struct(order, F.col(key))).withColumn("__b", F.substring(order, 1, 3))
        inside = Window.partitionBy("__b").orderBy("__s")
        kept = rows.withColumn("__v", F.lag(F.struct(F.col(f).alias("v"))).over(inside))
        # the last value of every bucket, handed on to the next bucket that has rows
        ends = rows.groupBy("__b").agg(F.max_by(F.struct(F.col(f).alias("v")), "__s").alias("__end"))
        ring, whole = Window.orderBy("__b"), Window.partitionBy()
        handed = ends.select(F.col("__b").alias("__nb"), F.coalesce(F.lag("__end").over(ring), F.max_by("__end", "__b").over(whole)).alias("__from"))
        met = kept.join(handed, kept["__b"] == handed["__nb"])
        value = F.coalesce("__v", "__from")["v"]
        out = out.unionByName(met.select(*[value.alias(c) if c == f else F.col(c) for c in df.columns], F.lit(f).alias("permuted")))
    return out


def permutation_importance(df: DataFrame, score, features: Sequence[str], label: str, key: str, seed: int = SEED) -> DataFrame:
    """``(feature, base_auc, auc, importance)``: the exact AUC that is lost when
    a feature's values are permuted.  ``score`` maps rows to rows with a column
    ``score``; all features are scored and ranked in one job."""
    scored = score(permuted(df, features, key, seed)).select(label, "score", F.coalesce("permuted", F.lit("")).alias("permuted"))
    auc = M.roc_auc(scored, label, "score", group_cols=["permuted"])
    base = auc.where("permuted = ''").select(F.col("roc_auc").alias("base_auc"))
    return (auc.where("permuted <> ''").withColumn("base_auc", base.scalar())
            .select(F.col("permuted").alias("feature"), "base_auc", F.col("roc_auc").alias("auc"),
                    (F.col("base_auc") - F.col("roc_auc")).alias("importance")))


def monitored(report: DataFrame, importance: DataFrame, k: int = 10) -> DataFrame:
    """Rows of a drift or quality report for the ``k`` most important features."""
    top = importance.orderBy(F.desc("importance"), "feature").limit(k).select("feature")
    return report.join(top, "feature", "left_semi")


# ----------------------------------------------------------------- search
@dataclass
class Trial:
    run_id: str
    algorithm: str
    params: dict
    auc_weighted: float | None = None
    rung: int = -1
    status: str = "waiting"
    model: object = field(default=None, repr=False)


#: Every learner with its defaults, and weaker settings of each.
DEFAULT_SPACE = (
    ("logreg", {}), ("logreg", {"C": 0.1}), ("forest", {}), ("forest", {"trees": 100, "depth": 5}),
    ("boosted", {}), ("boosted", {"trees": 100, "eta": 0.1}),
)
#: Part of the trials that goes on to the next rung, and rungs.
HALVING, RUNGS = 3, 2


def _fit(alg: str, train: DataFrame, features, label, params):
    if alg == "logreg":
        return train_logreg(train, features, label, **params)
    if alg == "forest":
        return train_forest(train, features, label, **params)
    if alg == "boosted":
        return train_boosted(train, features, label, **params)
    raise ValueError(alg)


def model_search(train: DataFrame, val: DataFrame, features: Sequence[str], label: str,
                 space=DEFAULT_SPACE, max_trials: int = 20, parallelism: int = 4, experiment: str = "churn",
                 halving: int = HALVING, rungs: int = RUNGS) -> tuple[DataFrame, list[Trial]]:
    """Successive halving: all (algorithm, params) are fitted on a hash share of
    ``train`` and scored by the exact AUC on the given ``val`` split; the best
    ``1 / halving`` of them go on to ``halving`` times the rows, the last rung
    to all rows.  A trial that doesn't is ``stopped``, those of the last rung
    are ``finished``.  No clock decides anything, so reruns agree.

    ``parallelism`` trials run at once, each in a scheduler pool of its own (fair
    shares where the session schedules fairly).  More than ``max_trials`` trials
    are an error.

    Returns the ``runs(run_id, experiment, algorithm, params, auc_weighted,
    rung, status)`` table and the trials.
    """
    if len(space) > max_trials:
        raise ValueError(f"{len(space)} trials, at most {max_trials} are allowed")
    spark = train.sparkSession
    trials = [Trial(f"{experiment}-{i:03d}", a, dict(p)) for i, (a, p) in enumerate(space)]
    draw = F.pmod(F.xxhash64(*features), F.lit(1_000_000))

    def run(t: Trial, rows: DataFrame, rung: int) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", t.run_id)
        t.model, t.rung = _fit(t.algorithm, rows, features, label, t.params), rung
        t.auc_weighted = M.auc_weighted(predict(t.model, val), label, "probability_1").first()[0]

    alive = trials
    for rung in range(rungs):
        share = float(halving) ** (rung - rungs + 1)
        rows = train if share >= 1 else train.where(draw < F.lit(int(1_000_000 * share)))
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            list(ex.map(lambda t, rows=rows, rung=rung: run(t, rows, rung), alive))
        order = sorted(alive, key=lambda t: (t.auc_weighted is None, -(t.auc_weighted or 0.0), t.run_id))
        alive = order if rung == rungs - 1 else order[:math.ceil(len(order) / halving)]
        for t in trials:
            if t.rung == rung:
                t.status = "finished" if rung == rungs - 1 else "waiting" if t in alive else "stopped"
    schema = "run_id string, experiment string, algorithm string, params map<string,string>, auc_weighted double, rung int, status string"
    return spark.createDataFrame([(t.run_id, experiment, t.algorithm, {k: str(v) for k, v in t.params.items()}, t.auc_weighted, t.rung, t.status)
                                  for t in trials], schema), trials


# -------------------------------------------------------------- ensembles
def ensemble_vote(models: Sequence[PipelineModel], df: DataFrame, out: str = "probability_1") -> DataFrame:
    """Soft vote: mean of the models' positive probabilities."""
    cur = df
    cols = []
    for i, m in enumerate(models):
        cur = predict(m, cur, f"__p{i}")
        cols.append(F.col(f"__p{i}"))
    return cur.withColumn(out, sum(cols) / float(len(cols))).drop(*[f"__p{i}" for i in range(len(models))])


def fold_of(key: str, k: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(k)).cast("int")


def ensemble_stack(train: DataFrame, features: Sequence[str], label: str, key: str,
                   base: Sequence[tuple[str, dict]], folds: int = 3) -> tuple[list[PipelineModel], PipelineModel]:
    """Stacking: base learners produce OUT-OF-FOLD probabilities (hash fold
    on the key, reproducible) that train a logistic meta-learner; the base
    learners are then refit on all rows."""
    t = train.withColumn("__fold", fold_of(key, folds))
    oof = None
    for f in range(folds):
        fit_part, hold = t.where(F.col("__fold") != f), t.where(F.col("__fold") == f)
        cur = hold
        for i, (alg, params) in enumerate(base):
            # by the models' tables, which score as the models do
            cur = predict(MT.to_tables(train.sparkSession, _fit(alg, fit_part, features, label, dict(params))), cur, f"m{i}")
        oof = cur if oof is None else oof.unionByName(cur)
    meta = train_logreg(materialize(oof, "out_of_fold"), [f"m{i}" for i in range(len(base))], label)
    full = [_fit(alg, train, features, label, dict(params)) for alg, params in base]
    return full, meta


def stack_predict(base: Sequence[PipelineModel], meta: PipelineModel, df: DataFrame,
                  out: str = "probability_1") -> DataFrame:
    cur = df
    for i, m in enumerate(base):
        cur = predict(m, cur, f"m{i}")
    return predict(meta, cur, out).drop(*[f"m{i}" for i in range(len(base))])


# ---------------------------------------------------------------- profile
#: An integer column of at most so many different values is a category; a text
#: or integer column with more than this share of different values is an id.
MAX_LEVELS, ID_SHARE = 5, 0.9


def column_kinds(df: DataFrame, target: str, exclude: Sequence[str] = (), max_levels: int = MAX_LEVELS,
                 id_share: float = ID_SHARE) -> DataFrame:
    """``(feature, kind, n_distinct)`` with kind categorical, numeric or
    identifier, from one scan: distinct counts come from mergeable sketches
    (``approx_count_distinct``), so a task keeps a few kilobytes per column.

    Text and booleans are categories unless nearly every value is different
    (identifier); fractional numbers are numeric; integers are categories with
    3 to ``max_levels`` different values, identifiers if nearly every value is
    different, else numeric (two values stay numeric, like the original's 0/1
    column)."""
    cols = [f for f in df.schema.fields if f.name != target and f.name not in exclude
            and isinstance(f.dataType, (T.StringType, T.BooleanType, T.NumericType))]
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, kind string, n_distinct long")
    wide = df.agg(*[x for i, f in enumerate(cols) for x in (F.approx_count_distinct(f"`{f.name}`", 0.01).alias(f"d{i}"),
                                                            F.count(f"`{f.name}`").alias(f"n{i}"))])
    kind = {f.name: "text" if isinstance(f.dataType, (T.StringType, T.BooleanType)) else
            "integer" if isinstance(f.dataType, T.IntegralType) else "fraction" for f in cols}
    rows = F.explode(F.array(*[F.struct(F.lit(f.name).alias("feature"), F.lit(kind[f.name]).alias("type"), F.col(f"d{i}").alias("n_distinct"),
                                        F.col(f"n{i}").alias("n")) for i, f in enumerate(cols)])).alias("e")
    many = (F.col("n") > max_levels) & (F.col("n_distinct") > id_share * F.col("n"))
    judged = (F.when(F.col("type") == "fraction", F.lit("numeric")).when(many, F.lit("identifier"))
              .when(F.col("type") == "text", F.lit("categorical"))
              .when((F.col("n_distinct") > 2) & (F.col("n_distinct") <= max_levels), F.lit("categorical")).otherwise(F.lit("numeric")))
    return wide.select(rows).select("e.*").select("feature", judged.alias("kind"), "n_distinct")


def auto_featurize(df: DataFrame, target: str, exclude: Sequence[str] = (), max_levels: int = MAX_LEVELS) -> Profile:
    """The profile found by :func:`column_kinds`; identifiers are dropped.  Fit
    and apply it like any other (``features.fit_all``, ``apply_all``)."""
    kinds = {r["feature"]: r["kind"] for r in column_kinds(df, target, exclude, max_levels).collect()}  # one row per column
    of = lambda kind: tuple(c for c in df.columns if kinds.get(c) == kind)
    return Profile(target=target, key=None, categorical=of("categorical"), numeric=of("numeric"), drop=(*exclude, *of("identifier")))


# ------------------------------------------------------------ batch score
def batch_score(df: DataFrame, models: dict[str, PipelineModel], key: str | None = None,
                threshold: float = 0.5) -> DataFrame:
    """Prepared rows -> one long row per (input, model) with probability
    (rounded to 4), prediction (``>= threshold``) and risk level."""
    out = None
    keep = [key] if key else []
    for name, m in models.items():
        p = predict(m, df, "__p")
        r = p.select(*keep, F.lit(name).alias("model"), F.round("__p", PROB_DIGITS).alias("probability"),
                     threshold_predict("__p", threshold).alias("prediction"),
                     risk_band("__p").alias("risk_level"))
        out = r if out is None else out.unionByName(r)
    return out
