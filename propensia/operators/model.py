"""Propensity model on Spark ML (M4-M8).

Training, scoring and importances stay distributed: ``VectorAssembler`` +
``GBTClassifier`` fit on the executors, scoring is ``PipelineModel.transform``
(JVM side, no Python UDF), and only the model and per-feature numbers (one
value per feature) reach the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import QuantileDiscretizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from ..functions.ranking import with_row_number
from ..session import scratch_path, stage
from ..sources.commits import commit, commits

# The classifier's hyper-parameters (100 trees, rate 0.1,
# depth 6, row and column sampling 0.8, seed 42).
GBT_PARAMS = dict(maxIter=100, stepSize=0.1, maxDepth=6, subsamplingRate=0.8,
                  featureSubsetStrategy="0.8", seed=42)


#: Rows up to which a frame stays in the partitions it has: a pass over so few is shorter than the start of its tasks.
FIT_ROWS = 16_384


def _even(df: DataFrame, rows: int) -> DataFrame:
    """``df`` dealt evenly over the cores if it has, or will come to, more than ``FIT_ROWS`` rows."""
    return df if rows <= FIT_ROWS else df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def train_gbt(train: DataFrame, feature_cols: Sequence[str], label_col: str,
              weight_col: str | None = None, rows: int = 0, **overrides) -> PipelineModel:
    """M5: gradient-boosted trees on the assembled feature vector.

    The fit passes over the frame once for every level of every tree, and each pass is as long
    as its largest task. So a frame of many ``rows`` (their number or a bound of it) is written once
    in parts of one size, one per core; the passes then have no part of its plan to make again."""
    params = dict(GBT_PARAMS)
    params.update(overrides)
    gbt = GBTClassifier(featuresCol="features", labelCol=label_col, **params)
    if weight_col:
        gbt.setWeightCol(weight_col)
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="keep")
    data = train.withColumn(label_col, F.col(label_col).cast("double"))
    if rows > FIT_ROWS:
        kept = [*feature_cols, label_col, *([weight_col] if weight_col else [])]
        data = stage(_even(data.select(*kept), rows), "fit-rows")
    return Pipeline(stages=[assembler, gbt]).fit(data)


#: Bins of a feature in a frame shared by several fits, as many as the trees tell apart.
FEATURE_BINS = 32


def class_weight(label_col: str, negatives: int, positives: int) -> F.Column:
    """Weight of a row that makes both classes weigh the same; 1 where a class is missing."""
    ratio = negatives / positives if negatives and positives else 1.0
    return F.when(F.col(label_col) == 1, F.lit(ratio)).otherwise(F.lit(1.0))


def train_targets(frame: DataFrame, feature_cols: Sequence[str], target_cols: Sequence[str],
                  bins: int = FEATURE_BINS, **overrides) -> dict[str, PipelineModel]:
    """M5 for several 0/1 targets of one frame, both classes of a target weighted alike (M4's ``weightCol``).

    The features are cut at their quantiles (one pass, mergeable sketches), assembled and
    written once, in even parts; each target's fit reads that table, and the fits run as concurrent jobs.
    Each model is whole: bins, vector, trees. A target with one class gives a constant model."""
    binned = [f"_bin_{c}" for c in feature_cols]
    cut = QuantileDiscretizer(inputCols=list(feature_cols), outputCols=binned, numBuckets=bins, relativeError=0.001, handleInvalid="keep")
    # bins are in the order of the feature, not categories, as the column's metadata would tell the trees
    ordered = SQLTransformer(statement=f"SELECT *, {', '.join(f'{c} + 0D AS _at{c}' for c in binned)} FROM __THIS__")
    prepared = Pipeline(stages=[cut, ordered, VectorAssembler(inputCols=[f"_at{c}" for c in binned], outputCol="features")]).fit(frame)
    n = frame.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(t).cast("long")).alias(t) for t in target_cols]).first()
    ready = prepared.transform(frame).select("features", *[F.col(t).cast("double").alias(t) for t in target_cols],
                                             *[class_weight(t, n["n"] - (n[t] or 0), n[t] or 0).alias(f"_weight_{t}") for t in target_cols])
    ready = stage(_even(ready, n["n"]), "binned")

    @inheritable_thread_target(frame.sparkSession)
    def fit(target: str) -> PipelineModel:
        gbt = GBTClassifier(featuresCol="features", labelCol=target, weightCol=f"_weight_{target}", **(GBT_PARAMS | overrides))
        return PipelineModel([*prepared.stages, gbt.fit(ready)])

    with ThreadPoolExecutor(len(target_cols)) as pool:   # each fit is a run of Spark jobs; Spark shares the executors among them
        return dict(zip(target_cols, pool.map(fit, target_cols)))


def score(model: PipelineModel, df: DataFrame, proba_col: str = "y_proba") -> DataFrame:
    """M6: positive-class probability per row, JVM side."""
    out = model.transform(df)
    return (out.withColumn(proba_col, vector_to_array("probability")[1])
               .drop("features", "rawPrediction", "probability", "prediction"))


def feature_importance(model: PipelineModel, feature_cols: Sequence[str]) -> list[tuple[str, float]]:
    """M7: normalised total gain per feature, 0 for unused ones, descending."""
    imp = model.stages[-1].featureImportances.toArray()
    pairs = [(c, float(imp[i]) if i < len(imp) else 0.0) for i, c in enumerate(feature_cols)]
    return sorted(pairs, key=lambda p: (-p[1], p[0]))


def split_gains(spark: SparkSession, model: PipelineModel, feature_cols: Sequence[str]) -> DataFrame:
    """M7 by split: for each feature the number of its splits in all trees, their
    average gain (0 for an unused feature), and its share of the total gain weighted by
    the rows of the split's node, which is the model's own importance.

    Read from the node table of the saved model, one row per tree node."""
    path = scratch_path(spark, "model-nodes")
    model.save(path)
    last = model.stages[-1]
    nodes = spark.read.parquet(f"{path}/stages/*_{last.uid}/data").select("nodeData.*").where("leftChild >= 0")
    rows = F.col("impurityStats")[0]   # of a regression tree's node: rows, sum, sum of squares
    used = nodes.groupBy(F.col("split.featureIndex").alias("_i")).agg(
        F.count(F.lit(1)).alias("n_splits"), F.avg("gain").alias("gain"), F.sum(F.col("gain") * rows).alias("_total"))
    names = spark.createDataFrame(list(enumerate(feature_cols)), "_i int, feature string")   # one row per feature
    whole = used.agg(F.sum("_total")).first()[0] or 1.0
    return names.join(used, "_i", "left").select(
        "feature", F.coalesce("n_splits", F.lit(0)).alias("n_splits"), F.coalesce("gain", F.lit(0.0)).alias("gain"),
        F.coalesce(F.col("_total") / F.lit(whole), F.lit(0.0)).alias("importance"))


# ---------------------------------------------------------------------------- M4


# Orders of a row set in which neighbours are sought, random directions that make up the head of an order, and rows of a bucket.
SEARCH_ORDERS, HEAD_BITS, BUCKET_ROWS = 16, 6, 512


def _z_scores(df: DataFrame, feats: Sequence[str]) -> F.Column:
    """The features as one array, each with mean 0 and deviation 1; a constant one is 0."""
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(feats)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(feats)]).first()
    return F.array(*[(F.coalesce(F.col(c).cast("double"), F.lit(stats[f"m{i}"] or 0.0)) - F.lit(stats[f"m{i}"] or 0.0)) / F.lit(stats[f"s{i}"] or 1.0)
                     for i, c in enumerate(feats)])


def nearest_rows(rows: DataFrame, id_col: str, vector_col: str, k: int = 5, seed: int = 42,
                 orders: int = SEARCH_ORDERS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """For each row of ``rows`` (unique long id, array of doubles of one length) up to ``k``
    near ones by Euclidean distance: id, neighbour, distance, rank from 1; ties to the smaller id.

    The rows are put into several orders, each by the signs of a few seeded random
    projections and then by one more projection, so that near rows mostly come
    close together in some of them. Each order is cut into buckets of
    ``bucket_rows`` rows by a distributed row number, whatever the values are: no
    bucket is larger, not even where a third of all rows are equal, and no row is left
    out. Inside a bucket all true distances are taken at once; the best of all orders stay.
    Up to ``bucket_rows`` rows the result is exact; else ``orders`` sets the recall."""
    dim = (rows.select(F.max(F.size(vector_col))).first()[0]) or 0
    rng = np.random.default_rng(seed)
    rows = stage(rows.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v")), "near-rows")

    heads, ats = rng.normal(size=(orders, HEAD_BITS, dim)), rng.normal(size=(orders, dim))

    def project(batches):
        for pdf in batches:
            if len(pdf):
                ids, v = pdf["_id"].to_numpy(), np.stack(pdf["_v"].to_numpy())
                for order in range(orders):
                    head = ((v @ heads[order].T > 0) << np.arange(HEAD_BITS)).sum(1)
                    # as a place on a Gray code: neighbours in this order differ in few signs
                    for shift in (1, 2, 4):
                        head = head ^ (head >> shift)
                    yield pd.DataFrame({"_o": np.int32(order), "_id": ids, "_head": head.astype(np.int32), "_at": v @ ats[order]})

    keyed = rows.mapInPandas(project, "_o int, _id long, _head int, _at double")
    placed = with_row_number(keyed, ["_o"], [("_head", True), ("_at", True), ("_id", True)], "_rn", "_n")
    buckets = placed.select("_o", "_id", F.floor((F.col("_rn") - 1) / bucket_rows).alias("_b")).join(rows, "_id")

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_id")
        ids, v = pdf["_id"].to_numpy(), np.stack(pdf["_v"].to_numpy())
        norm = (v * v).sum(1)
        square = np.maximum(norm[:, None] + norm[None, :] - 2 * v @ v.T, 0)
        np.fill_diagonal(square, np.inf)
        many = min(k, len(ids) - 1)
        at = np.argsort(square, axis=1, kind="stable")[:, :many].ravel()
        own = np.repeat(np.arange(len(ids)), many)
        return pd.DataFrame({"id": ids[own], "neighbour": ids[at], "distance": np.sqrt(((v[own] - v[at]) ** 2).sum(1))})

    found = buckets.groupBy("_o", "_b").applyInPandas(best, "id long, neighbour long, distance double")
    found = found.groupBy("id", "neighbour").agg(F.min("distance").alias("distance"))
    near = Window.partitionBy("id").orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)


def _u01(*cols) -> F.Column:
    """Seeded uniform in [0, 1) from a hash of the given columns."""
    h = F.xxhash64(*cols)
    return (F.pmod(h, F.lit(1 << 30)).cast("double") / float(1 << 30))


def oversample_minority(df: DataFrame, feature_cols: Sequence[str], label_col: str,
                        k: int = 5, seed: int = 42, key_cols: Sequence[str] = ("CUST_NUM", "YEAR", "MONTH"),
                        synthetic_col: str = "SYNTHETIC") -> DataFrame:
    """M4: SMOTE-style minority oversampling up to class balance.

    The neighbours of each minority row are its ``k`` nearest minority rows by z-scored
    features (``nearest_rows``); each synthetic row lies between a row and one of
    them, chosen and weighted by a seeded hash. Every minority row gets
    floor or ceil of (majority - minority) / minority synthetic rows, made where it
    lies; so where many are to come, the few minority rows are dealt over the cores first.
    """
    feats = list(feature_cols)
    df = stage(df)  # counted, profiled, ordered and unioned
    counts = {r[0]: r[1] for r in df.groupBy(label_col).count().collect()}  # two rows
    n_min, n_maj = counts.get(1, 0), counts.get(0, 0)
    marked = df.withColumn(synthetic_col, F.lit(0))
    need = n_maj - n_min
    if n_min < 2 or need <= 0:
        return marked
    minority = df.where(F.col(label_col) == 1)
    ordered = stage(with_row_number(minority.withColumn("_g", F.lit(0)), ["_g"],
                                    [(c, True) for c in key_cols] + [(c, True) for c in feats], "_rn", "_n").drop("_g"), "minority")
    near = nearest_rows(ordered.select("_rn", _z_scores(ordered, feats).alias("_v")), "_rn", "_v", k, seed)
    base, extra = divmod(need, n_min)
    reps = F.lit(base) + F.when(F.col("_rn") <= F.lit(extra), 1).otherwise(0)
    seeds = _even(ordered, need).select("_rn", *feats, F.explode(F.sequence(F.lit(1), F.greatest(reps, F.lit(1)))).alias("_j"),
                           reps.alias("_reps")).where(F.col("_j") <= F.col("_reps"))
    step = F.pmod(F.xxhash64(F.col("_rn"), F.col("_j"), F.lit(seed)), F.lit(min(k, n_min - 1))) + 1
    seeds = seeds.withColumn("_rank", step.cast("int"))
    near = near.select(F.col("id").alias("_rn"), F.col("rank").alias("_rank"), F.col("neighbour").alias("_nb"))
    nb = ordered.select(F.col("_rn").alias("_nb"), *[F.col(c).alias(f"_nb_{c}") for c in feats])
    u = _u01(F.col("_rn"), F.col("_j"), F.lit(seed + 1))
    synth = seeds.join(near, ["_rn", "_rank"]).join(nb, on="_nb", how="inner").select(
        *[(F.col(c) + u * (F.col(f"_nb_{c}") - F.col(c))).alias(c) for c in feats])
    fill = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns if c not in feats]
    synth = synth.select(*fill, *feats).withColumn(label_col, F.lit(1).cast(df.schema[label_col].dataType))
    synth = synth.select(*df.columns).withColumn(synthetic_col, F.lit(1))
    return marked.unionByName(synth)


# ---------------------------------------------------------------------------- M8


REGISTRY_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("version", T.LongType()),
    T.StructField("path", T.StringType())])


def latest_versions(registry: DataFrame) -> DataFrame:
    """M8: per model the highest version and its path, tagged with alias 'last'."""
    return (registry.groupBy("model_name")
            .agg(F.max("version").alias("version"), F.max_by("path", "version").alias("path"))
            .withColumn("alias", F.lit("last")))


def registry(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The registered versions of a model; a few rows for each training run."""
    found = commits(spark, f"{root.rstrip('/')}/_registry/{name}")
    return spark.createDataFrame([(name, n, c["path"]) for n, c in sorted(found.items())], REGISTRY_SCHEMA)


def register_model(spark: SparkSession, model: PipelineModel, root: str, name: str) -> int:
    """M8: save ``model`` under ``root/name`` and commit it as the next version. Of two
    writers at once each gets a version of its own; a writer that fails before the commit leaves none."""
    path = f"{root.rstrip('/')}/{name}/{model.uid}-{scratch_path(spark, 'v').rsplit('-', 1)[-1]}"
    model.save(path)
    return commit(spark, f"{root.rstrip('/')}/_registry/{name}", {"path": path})


def load_latest(spark: SparkSession, root: str, name: str) -> PipelineModel:
    row = latest_versions(registry(spark, root, name)).first()
    if row is None:
        raise LookupError(f"no registered version of {name}")
    return PipelineModel.load(row["path"])
