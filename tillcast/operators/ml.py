"""Encoding, splitting, gradient-boosted regression, scoring, reports.

Everything here is data-parallel: the label encoder ranks distinct values
with a range-partitioned sort (no label list is collected to the driver),
the split is a hash predicate, and training/scoring are ``pyspark.ml``.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.functions import metrics as M
from tillcast.functions import scalar as S
from tillcast.operators import leafwise
from tillcast.session import checkpoint_dir, materialize, remember_written

ALGORITHMS: dict[str, dict] = {
    "gbt": {"maxDepth": 5, "stepSize": 0.1, "maxBins": 32, "minInstancesPerNode": 1},
    "xgboost": {"maxDepth": 6, "stepSize": 0.3, "maxBins": 256, "minInstancesPerNode": 1},
    "lightgbm": {"maxDepth": 5, "stepSize": 0.1, "maxBins": 255, "minInstancesPerNode": 20},
}
MAX_BROADCAST_CODES = 500_000  # a column's codes are sent to all tasks up to this number
_PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the partition index above bit 33


# --------------------------------------------------------------------------- M2
def hash_split(
    df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """M2: add ``is_test`` from a hash of the row key (no shuffle, retry-safe)."""
    return df.withColumn("is_test", S.hash_fraction_below(list(keys), seed, test_fraction))


def require_target(df: DataFrame, target: str = "target") -> None:
    if target not in df.columns:
        raise ValueError(f"frame has no {target!r} column")


# --------------------------------------------------------------------------- M1
def fit_label_encoder(df: DataFrame, columns: Sequence[str], name: str = "labels") -> DataFrame:
    """M1 fit: (column, value, code) with codes 0..n-1 in sorted value order.

    Distinct values are range-partitioned and sorted; each value's code is
    its position inside its partition plus the number of values of the same
    column in earlier partitions.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), S.category_text(c).alias("value")) for c in columns]
    )
    values = df.select(F.explode(pairs).alias("kv")).select("kv.*").distinct()
    ranked = with_rank(values, ["column"], ["value"], f"{name}-ranked")
    return ranked.select("column", "value", F.col("rank").cast("int").alias("code"))


def with_rank(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Adds ``rank``: 0, 1, ... in ``order`` within each of ``groups``, without
    gathering a group in one task.

    Rows are range-partitioned and sorted; a row's rank is its position in its
    partition plus the number of rows of its group in earlier partitions (a
    table of one row per partition and group). The sorted rows are written
    once, so a lost executor cannot renumber them.
    """
    groups = list(groups)
    ranked = df.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order)
    ranked = materialize(ranked.withColumn("_id", F.monotonically_increasing_id()), name)
    ranked = ranked.withColumn("_pid", F.shiftright("_id", _PARTITION_SHIFT))
    counts = ranked.groupBy("_pid", *groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = ranked.join(offsets, on=["_pid", *groups])
    return joined.withColumn("rank", F.col("_offset") + F.col("_id") - F.col("_first")).drop("_pid", "_id", "_offset", "_first")


def apply_label_encoder(
    df: DataFrame,
    encoder: DataFrame,
    columns: Sequence[str],
    suffix: str = "_idx",
    unseen: int = -1,
) -> DataFrame:
    """M1 transform: add ``{col}{suffix}``; values not seen at fit get ``unseen``.

    Codes that are few go to the rows: dealt by value, a column of three values
    would put a third or more of all rows into one task.
    """
    out = df
    sizes = {r["column"]: r["count"] for r in encoder.groupBy("column").count().collect()}  # one row a column
    for c in columns:
        codes = encoder.where(F.col("column") == c).select(
            F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"{c}{suffix}")
        )
        if sizes.get(c, 0) <= MAX_BROADCAST_CODES:
            codes = F.broadcast(codes)
        out = (
            out.withColumn(f"__v_{c}", S.category_text(c))
            .join(codes, on=f"__v_{c}", how="left")
            .drop(f"__v_{c}")
            .withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(unseen)))
        )
    return out


# --------------------------------------------------------------------------- M3
def gbt_pipeline(
    features: Sequence[str],
    target: str = "target",
    algorithm: str = "gbt",
    n_trees: int = 100,
    seed: int = 42,
    **learner,
) -> Pipeline:
    """M3: assembler + gradient-boosted trees with squared loss.

    ``algorithm`` sets tree depth, step size, bins and smallest leaf to the
    published defaults of the library of that name (``ALGORITHMS``); the
    trees themselves are Spark's. Anything else is an error. ``learner`` sets
    further parameters of the regressor, or those settings anew.
    """
    if algorithm not in ALGORITHMS:
        raise ValueError(f"algorithm must be one of {tuple(ALGORITHMS)}, got {algorithm!r}")
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
            GBTRegressor(
                featuresCol="features",
                labelCol=target,
                maxIter=n_trees,
                **{**ALGORITHMS[algorithm], **learner},
                lossType="squared",
                seed=seed,
                checkpointInterval=10,
            ),
        ]
    )


def gbt_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> dict[str, list[float]]:
    """The bins' lower edges of each feature, from all rows.

    A feature with up to ``max_bins`` values has a bin for each, parted half-way
    between neighbours; one with more has bins near equal counts.
    """
    number = lambda f: F.col(f).cast("double")
    counted = df.agg(*[F.approx_count_distinct(f).alias(f) for f in features]).first()
    few = [f for f in features if counted[f] <= 2 * max_bins]  # as the count is approximate
    seen = df.agg(F.lit(0).alias("_"), *[F.sort_array(F.collect_set(number(f))).alias(f) for f in few]).first()
    edges, many = {}, [f for f in features if f not in few]
    for f in few:
        values = [v for v in seen[f] if not math.isnan(v)]
        halves = [low / 2 + high / 2 for low, high in zip(values, values[1:])]
        if len(values) > max_bins:
            many.append(f)
        else:
            edges[f] = sorted({math.nextafter(v, math.inf) for v in halves})
    edges |= leafwise.bin_edges(df, many, max_bins) if many else {}
    return {f: [v for v in edges[f] if math.isfinite(v)] or [0.0] for f in features}  # a bucketizer wants an edge


def train_gbt(
    train: DataFrame,
    features: Sequence[str],
    target: str = "target",
    algorithm: str = "gbt",
    n_trees: int = 100,
    seed: int = 42,
) -> PipelineModel:
    """M3: the model's first stage bins the features, its trees split bins.

    Rows that agree in all bins take the same way in every tree. They are
    trained on as one cell that weighs as many rows and has their mean target:
    the spread within a cell is the same on both sides of every gain, so the
    trees are those of the rows, and an iteration costs as much as there are
    cells, at most the product of the bins. A null target is an error.
    """
    require_target(train, target)
    if algorithm not in ALGORITHMS:
        raise ValueError(f"algorithm must be one of {tuple(ALGORITHMS)}, got {algorithm!r}")
    settings = ALGORITHMS[algorithm]
    edges = gbt_edges(train, features, settings["maxBins"])
    label = F.coalesce(F.col(target).cast("double"), F.raise_error(F.lit(f"{target} must not be null")).cast("double"))
    named = train.select(*features, label.alias("_label"))
    parts = train.sparkSession.sparkContext.defaultParallelism
    cells = materialize(leafwise.cells(named, features, edges, "_label").repartition(parts), "gbt-cells")
    told = cells.agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("rows")).first()
    if not told.cells:
        raise ValueError("no training rows")
    bins = [f"{f}_bin" for f in features]
    cells = cells.select(
        *[F.col(f"b{i}").cast("double").alias(b) for i, b in enumerate(bins)], (F.col("y") / F.col("n")).alias(target), F.col("n").cast("double").alias("_rows")
    )
    learner = {"weightCol": "_rows", "minInstancesPerNode": 1}
    least = settings["minInstancesPerNode"]
    if least > 1:  # in rows, so a share of all weight
        learner |= {"maxDepth": 0} if told.rows < 2 * least else {"minWeightFractionPerNode": (least - 0.5) / told.rows}
    # The learner looks for split points in a sample of max(maxBins^2, 10000) cells: let that be all.
    # Bins that do not occur take no room.
    learner["maxBins"] = max(settings["maxBins"] + 1, math.isqrt(told.cells) + 1)
    pipeline = gbt_pipeline(bins, target, algorithm, n_trees, seed, **learner)
    bucketizer = Bucketizer(
        inputCols=list(features), outputCols=bins, splitsArray=[[-math.inf, *edges[f], math.inf] for f in features], handleInvalid="keep"
    )
    return PipelineModel(stages=[bucketizer, *pipeline.fit(cells).stages])


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """M4: one prediction per input row."""
    return model.transform(df).select(*keep, "prediction")


def regression_scores(pred: DataFrame, target: str = "target", group: str | None = None) -> DataFrame:
    """R^2 (and friends) of a prediction frame, optionally per group."""
    y, p = F.col(target), F.col("prediction")
    aggs = [
        F.count(F.lit(1)).alias("n"),
        M.r2(y, p).alias("r2"),
        M.rmse(y, p).alias("rmse"),
        M.mae(y, p).alias("mae"),
    ]
    return pred.groupBy(group).agg(*aggs) if group else pred.agg(*aggs)


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """M6: impurity-based importance per feature as a small table."""
    spark = SparkSession.getActiveSession()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, importance double")


def permutation_importance(
    model: PipelineModel,
    data: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    target: str = "target",
    seed: int = 42,
) -> DataFrame:
    """M6: increase in RMSE when one feature's values are permuted.

    Rows are ranked by a hash of their key and each takes the values of the
    next rank (the last those of the first): every value moves to another
    row whatever the size of the table, and rows that tie in key and values
    are interchangeable. One row per feature and one unchanged are scored by
    one transform and summed by one aggregate.
    """
    order = F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))
    columns = list(dict.fromkeys([*features, target]))
    rows = data.select(*keys, *columns).withColumns({"_all": F.lit(0), "_order": order})
    ranked = with_rank(rows, ["_all"], ["_order", *keys, *columns], "permuted").drop("_all", "_order")
    ranked = materialize(ranked, "permuted-ranked")
    total = F.lit(ranked.count())
    donors = ranked.select(
        F.pmod(F.col("rank") - 1, total).alias("rank"), *[F.col(c).alias(f"__perm_{c}") for c in features]
    )
    paired = ranked.join(donors, on="rank")
    names = F.array(F.lit(""), *[F.lit(c) for c in features])
    each = paired.withColumn("feature", F.explode(names))
    swapped = each.select(
        "feature",
        target,
        *[F.when(F.col("feature") == c, F.col(f"__perm_{c}")).otherwise(F.col(c)).alias(c) for c in features if c != target],
    )
    scored = model.transform(swapped).groupBy("feature").agg(M.rmse(F.col(target), F.col("prediction")).alias("rmse"))
    base = F.max(F.when(F.col("feature") == "", F.col("rmse"))).over(Window.partitionBy(F.lit(0)))
    out = scored.withColumn("rmse_increase", F.col("rmse") - base)  # one row a feature
    return out.where(F.col("feature") != "").select("feature", "rmse_increase")


# --------------------------------------------------------------------------- A12
def regression_report(
    df: DataFrame,
    target: str,
    prediction: str,
    dataset: str = "dataset",
    digits: int = 6,
) -> DataFrame:
    """Quality of ``prediction`` per dataset (e.g. reference vs current).

    The frame is written once; one aggregate gives the moments, and the error
    quantiles (p05, p50, p95) come from ``exact_quantiles``.
    ``error_histogram`` gives the full distribution.
    """
    y, p = F.col(target), F.col(prediction)
    df = materialize(df.where(y.isNotNull() & p.isNotNull()).select(dataset, target, prediction), "report")
    out = df.groupBy(dataset).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(p - y).alias("mean_error"),
        M.mae(y, p).alias("mae"),
        M.mape(y, p, percent=False).alias("mape"),
        M.rmse(y, p).alias("rmse"),
        M.r2(y, p).alias("r2"),
    )
    probs = {"p05": 0.05, "p50": 0.5, "p95": 0.95}
    errors = df.select(dataset, (p - y).alias("_err"))
    q = exact_quantiles(errors, "_err", dataset, list(probs.values()), name="report-errors")
    wide = q.groupBy(dataset).agg(
        *[F.first(F.when(F.col("p") == v, F.col("quantile")), ignorenulls=True).alias(k) for k, v in probs.items()]
    )
    out = out.join(wide, on=dataset, how="left")
    rounded = out.withColumns(
        {c: F.round(c, digits) for c in ("mean_error", "mae", "rmse", "r2", *probs)}
    )
    return rounded.withColumn("mape", F.col("mape").cast("float").cast("double"))


def exact_quantiles(
    df: DataFrame, value: str, group: str, probs: Sequence[float], name: str = "quantiles"
) -> DataFrame:
    """Exact linear-interpolation quantiles of ``value`` per ``group``.

    Values are counted first, so a value that most rows share is one row.
    The distinct values are range-partitioned and sorted; running counts
    within a partition plus the totals of the earlier partitions give each
    value's range of ranks, and one pass picks the values at the ranks around
    every quantile. Returns (group, p, quantile).
    """
    counted = (
        df.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"))
        .where(F.col("_v").isNotNull())
        .groupBy("_g", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counted = counted.repartitionByRange("_g", "_v").withColumn("_pid", F.spark_partition_id())
    counted = materialize(counted, f"{name}-counts")
    parts = counted.groupBy("_pid", "_g").agg(F.sum("_n").alias("_in"))
    before = Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumns(
        {"_offset": F.coalesce(F.sum("_in").over(before), F.lit(0)), "_total": F.sum("_in").over(Window.partitionBy("_g"))}
    ).select(F.col("_pid").alias("_op"), F.col("_g").alias("_og"), "_offset", "_total")
    inside = Window.partitionBy("_pid", "_g").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = counted.withColumn("_upto", F.sum("_n").over(inside)).join(
        offsets, (F.col("_pid") == F.col("_op")) & F.col("_g").eqNullSafe(F.col("_og"))
    )
    first = F.col("_offset") + F.col("_upto") - F.col("_n")  # rank of the value's first row
    after = F.col("_offset") + F.col("_upto")
    position = (F.col("_total") - 1) * F.col("p")
    asked = ranged.withColumns({"_first": first, "_after": after}).withColumn(
        "p", F.explode(F.array(*[F.lit(float(q)) for q in probs]))
    )
    asked = asked.withColumns({"_lo": F.floor(position), "_hi": F.ceil(position), "_frac": position - F.floor(position)})
    holds = lambda rank: (F.col("_first") <= F.col(rank)) & (F.col(rank) < F.col("_after"))
    around = asked.where(holds("_lo") | holds("_hi"))
    picked = around.groupBy("_g", "p").agg(
        F.max(F.when(holds("_lo"), F.col("_v"))).alias("_vlo"),
        F.max(F.when(holds("_hi"), F.col("_v"))).alias("_vhi"),
        F.max("_frac").alias("_frac"),
    )
    return picked.select(
        F.col("_g").alias(group), "p", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias("quantile")
    )


def error_histogram(
    df: DataFrame,
    target: str,
    prediction: str,
    lo: float,
    hi: float,
    n_bins: int,
    dataset: str = "dataset",
) -> DataFrame:
    """Counts of ``prediction - target`` in equal bins; bin 0 is below
    ``lo`` and bin ``n_bins + 1`` at or above ``hi``."""
    width = (hi - lo) / n_bins
    e = F.col(prediction) - F.col(target)
    raw = F.floor((e - F.lit(lo)) / F.lit(width)) + 1
    b = F.when(e < lo, 0).when(e >= hi, n_bins + 1).otherwise(raw).cast("int")
    return (
        df.where(F.col(target).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(dataset, b.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns(
            {
                "bin_lo": F.when(F.col("bin") > 0, F.lit(lo) + (F.col("bin") - 1) * width),
                "bin_hi": F.when(F.col("bin") <= n_bins, F.lit(lo) + F.col("bin") * width),
            }
        )
    )


# --------------------------------------------------------------------------- M7
# A version is a folder v=N. It is written under _staging, moved into place, and
# counts only once its marker _published/v=N exists; a number is taken by
# creating _claims/v=N, which one saver alone can do. A version that is still
# being written, or whose saver died, is therefore never loaded.
def save_version(model, root: str) -> str:
    """M7: publish ``model`` (anything with ``write().save``) as the next version; returns its folder."""
    root = root.rstrip("/")
    staging = f"{root}/_staging/{uuid.uuid4().hex}"
    model.write().save(staging)
    number = max([*_versions(root, "_claims"), -1]) + 1
    while not _create_new(f"{root}/_claims/v={number}"):
        number += 1
    path = f"{root}/v={number}"
    fs, hadoop_path = _fs(path)
    if not fs.rename(_fs(staging)[1], hadoop_path):
        raise OSError(f"could not move {staging} to {path}")
    if not _create_new(f"{root}/_published/v={number}"):
        raise OSError(f"{path} was published by another saver")
    return path


def _fs(path: str):
    sc = SparkSession.active().sparkContext
    hadoop_path = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(sc._jsc.hadoopConfiguration()), hadoop_path


def _create_new(path: str) -> bool:
    """Create an empty file; false if it exists. One caller alone gets true."""
    fs, hadoop_path = _fs(path)
    fs.mkdirs(hadoop_path.getParent())
    if fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then
        jvm = SparkSession.active().sparkContext._jvm
        return jvm.java.io.File(hadoop_path.toUri().getPath()).createNewFile()
    try:
        fs.create(hadoop_path, False).close()
        return True
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def _versions(root: str, folder: str) -> list[int]:
    fs, path = _fs(f"{root.rstrip('/')}/{folder}")
    names = [st.getPath().getName() for st in fs.listStatus(path)] if fs.exists(path) else []
    return [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()]


def latest_version(root: str) -> int | None:
    """The largest published version (None if there is none)."""
    return max(_versions(root, "_published"), default=None)


def load_latest(root: str) -> PipelineModel:
    v = latest_version(root)
    if v is None:
        raise FileNotFoundError(f"no published model version under {root}")
    return PipelineModel.load(f"{root.rstrip('/')}/v={v}")


def fitted_once(name: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
    """The latest version under the checkpoint folder's ``models/name``, fitted and published
    if there is none. ``name`` must tell the inputs and parameters apart (``fingerprint``)."""
    root = f"{checkpoint_dir(SparkSession.active()).rstrip('/')}/models/{name}"
    if latest_version(root) is None:
        remember_written(SparkSession.active(), root)
        save_version(fit(), root)
    return load_latest(root)


def fingerprint(inputs: Sequence[DataFrame], *parameters) -> str:
    """A hash of the inputs' files (path, size, time of change) and of the parameters."""
    told = [repr(parameters)]
    for folder in sorted({f.rsplit("/", 1)[0] for df in inputs for f in df.inputFiles()}):
        fs, path = _fs(folder)
        told += sorted(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in fs.listStatus(path))
    return hashlib.sha256("\n".join(told).encode()).hexdigest()[:32]


# --------------------------------------------------------------------------- M8
def vector_input(df: DataFrame, column: str, width: int) -> DataFrame:
    """Rows whose array is not ``width`` long fail the job with a clear error
    (the batch form of a request-body check); others become ML vectors."""
    arr = F.col(column).cast("array<double>")
    checked = F.when(F.size(arr) == width, arr).otherwise(
        F.raise_error(F.concat(F.lit(f"{column} must have {width} values, got "), F.size(arr).cast("string")))
    )
    return df.withColumn("features", array_to_vector(checked))


def train_classifier(
    df: DataFrame, column: str, width: int, label: str = "label", max_iter: int = 50
) -> PipelineModel:
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, family="multinomial")
    fitted = PipelineModel(stages=[lr.fit(vector_input(df, column, width))])
    return without_summary(fitted)


def without_summary(model: PipelineModel) -> PipelineModel:
    """The same model, saved to the checkpoint folder and loaded back.

    A freshly fitted classifier keeps its training summary, which holds the
    session; the scoring closure would carry it into every task (and fails
    to serialize once the session has used observations). A loaded model
    has no summary. ``drop_materialized`` removes the folder.
    """
    root = model_root(SparkSession.getActiveSession(), uuid.uuid4().hex)
    save_version(model, root)
    return load_latest(root)


def model_root(spark: SparkSession, name: str) -> str:
    """A folder for saved versions under the checkpoint folder."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/models/{name}"
    remember_written(spark, root)
    return root


def batch_score(model: PipelineModel, df: DataFrame, column: str, width: int, keys: Sequence[str]) -> DataFrame:
    """M8: float vectors in, one integer class per row out, keyed by ``keys``."""
    scored = model.transform(vector_input(df, column, width))
    return scored.select(*keys, F.col("prediction").cast("int").alias("prediction"))


def score_latest(root: str, df: DataFrame, column: str, width: int, keys: Sequence[str]) -> DataFrame:
    """M7, M8: load the latest saved version, then score with it."""
    return batch_score(load_latest(root), df, column, width, keys)


def linear_classes(df: DataFrame, column: str, weights: Sequence[Sequence[float]], keys: Sequence[str]) -> DataFrame:
    """M8 with given weights: the class whose weights have the largest product
    with the vector (the smallest class on ties); a null vector has none."""
    x = F.col(column).cast("array<double>")
    scores = F.array(
        *[
            F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in w]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
            for w in weights
        ]
    )
    best = F.array_position("_scores", F.array_max("_scores")) - 1
    return df.withColumn("_scores", scores).select(*keys, best.cast("int").alias("prediction"))
