"""Feature preparation and the regression model.

The job's forests are grown by `terroir.operators.forests`, all fits together;
`forest` is MLlib's estimator, for a model that is to be kept and applied later.
Training frames are written out once (lineage cut in the shared checkpoint
folder), so a lost executor only costs a re-read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.operators import forests
from terroir.operators.stats import exact_order_statistics
from terroir.session import ensure_checkpoint_dir

FEATURES = "features"


def fit_partitions(df: DataFrame, keys: Sequence[str], partitions: int = 32, max_rows: int | None = None) -> DataFrame:
    """The frame a model is fitted on: dealt to a fixed number of partitions by
    its keys and sorted in each, since the forest draws its samples by
    partition and position; the same rows give the same model however they
    came. `max_rows` bounds the rows that are fitted (about; chosen by a hash of
    the keys): what makes deep forests affordable on large tables."""
    if max_rows is not None:
        n = df.count()
        if n > max_rows:
            df = df.filter(F.pmod(F.xxhash64(*keys, F.lit(7)), F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))
    rest = [c for c in df.columns if c not in keys and not isinstance(df.schema[c].dataType, VectorUDT)]
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys, *rest)


def hash_bucket(keys: Sequence[str], seed: int = 42, modulus: int = 1000) -> Column:
    """Stable bucket in [0, modulus) from the key columns; independent of the
    partitioning, so a split is reproducible on any cluster."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(modulus))


def hash_split(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 42,
               bucket: Column | None = None, modulus: int = 1000, name: str = "split") -> DataFrame:
    """Label each row 'test' (bucket < fraction * modulus) or 'train'."""
    b = bucket if bucket is not None else hash_bucket(keys, seed, modulus)
    return df.withColumn(name, F.when(b < F.lit(int(round(test_fraction * modulus))), "test")
                         .otherwise("train"))


HASH_BITS = 52


def split_hash(keys: Sequence[str], seed: int = 42) -> Column:
    """52 bits of the MD5 of the keys' texts and the seed: any engine has it, and a double holds it."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def exact_split(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 42, name: str = "split") -> DataFrame:
    """G2 with the original's exact size: ceil(fraction * n) rows are 'test',
    those of the least key hashes. The threshold is found by the distributed rank
    search; no row is sorted or moved. Rows that share the threshold's hash
    (repeated keys) are ranked by their keys and columns among themselves."""
    mark = "_hash" + "_" * sum(c.startswith("_hash") for c in df.columns)
    hashed = df.withColumn(mark, split_hash(keys, seed))
    n = df.count()
    k = min(n, math.ceil(test_fraction * n))
    if k == 0:
        return df.withColumn(name, F.lit("train"))
    h = F.col(mark)
    # hashes are uniform: the threshold is within a few deviations of its share, where the search is among few rows
    share, slack = (k - 0.5) / n, 6 * math.sqrt(0.25 / n)
    low, high = (int(min(max(s, 0.0), 1.0) * (1 << HASH_BITS)) for s in (share - slack, share + slack))
    ensure_checkpoint_dir(df.sparkSession)
    near = hashed.filter((h >= low) & (h < high)).select(mark).checkpoint(eager=True)
    under, inside = hashed.filter(h < low).count(), near.count()
    if not under < k <= under + inside:  # repeated keys make hashes lumpy
        near, under = hashed.select(mark), 0
    edge = int(exact_order_statistics(near, {mark: [k - 1 - under]})[mark, k - 1 - under])
    below, on = near.agg(F.count_if(h < edge) + under, F.count_if(h == edge)).first()
    side = F.when(h <= edge, "test").otherwise("train")
    if below + on == k:
        return hashed.withColumn(name, side).drop(mark)
    order = [*keys, *[f.name for f in df.schema.fields if f.name not in keys and not isinstance(f.dataType, (T.MapType, VectorUDT))]]
    rank = F.row_number().over(Window.orderBy(*[F.col(f"`{c}`") for c in order]))
    tied = hashed.filter(h == edge).withColumn(name, F.when(rank <= k - below, "test").otherwise("train"))
    return hashed.filter(h != edge).withColumn(name, side).unionByName(tied).drop(mark)


def assemble(df: DataFrame, features: Sequence[str], output: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output,
                           handleInvalid="keep").transform(df)


def forest(label: str, num_trees: int = 100, max_depth: int = 30, seed: int = 42,
           feature_subset: str = "all", max_bins: int = 32) -> RandomForestRegressor:
    """G3 as MLlib's estimator (binned thresholds, depth of at most 30, a few jobs
    per level), whose model can be saved."""
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=label, numTrees=num_trees,
                                 maxDepth=max_depth, seed=seed,
                                 featureSubsetStrategy=feature_subset,
                                 minInstancesPerNode=1, maxBins=max_bins)


def grown_importance(grown: forests.Grown, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of a grown forest, sorted by importance descending."""
    return grown.importance.select(F.get(F.lit(list(features)), F.col("feature")).alias("feature"), "importance").orderBy(
        F.desc("importance"), F.asc("feature"))


def feature_importance(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """(feature, importance) sorted by importance descending."""
    imp = model.featureImportances.toArray().tolist()
    schema = T.StructType([T.StructField("feature", T.StringType()),
                           T.StructField("importance", T.DoubleType())])
    df = spark.createDataFrame(list(zip(features, [float(x) for x in imp])), schema)
    return df.orderBy(F.desc("importance"), F.asc("feature"))


def predictions(model, df: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Real vs predicted."""
    return model.transform(df).select(*keys, F.col(label).alias("actual"),
                                      F.col("prediction").alias("predicted"))


def curve_fits(keys: Sequence[str], fractions: Sequence[float], folds: int, seed: int = 42) -> Column:
    """The fits of a learning curve that a row belongs to, as `forests.grow`
    takes them: fit i * folds + k trains on the i-th fraction of the rows outside
    fold k and scores that fold. Folds and fractions are hashes of the keys."""
    fold = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed + 1)), F.lit(folds)).cast("int")
    sub = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed + 2)), F.lit(1000)).cast("int")
    ends = F.lit([int(round(f * 1000)) for f in fractions])
    every = F.sequence(F.lit(0), F.lit(len(fractions) * folds - 1))
    mine = F.filter(every, lambda j: (j % folds == fold) | (sub < F.get(ends, (j / folds).cast("int"))))
    return F.transform(mine, lambda j: F.struct(j.cast("int").alias("fit"), (j % folds != fold).alias("train")))


def learning_curve(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
                   fractions: Sequence[float] = tuple(i / 10 for i in range(1, 11)),
                   folds: int = 5, num_trees: int = 100, max_depth: int = 30, seed: int = 42) -> list[tuple[float, float, float]]:
    """For each training fraction, the mean train and validation R2 over
    `folds` hash folds. All fits are grown together (`forests.grow`) on all
    their rows, and every row of a fold is scored. One line a fit reaches the driver."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(F.monotonically_increasing_id().alias("row"), forests.key_hash(keys, seed).alias("h"),
                     F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).alias("y"),
                     curve_fits(keys, fractions, folds, seed).alias("fits")).checkpoint(eager=True)
    scored = forests.grow(rows, len(features), num_trees, max_depth, seed).predictions
    # R2 = 1 - SSE / (n * variance) per fit and side
    e = F.col("predicted") - F.col("y")
    got = scored.groupBy("fit", "train").agg(F.sum(e * e).alias("sse"), (F.count("y") * F.var_pop("y")).alias("sst")).collect()
    r2 = {(r["fit"], r["train"]): 1.0 - r["sse"] / r["sst"] if r["sst"] and r["sse"] is not None else float("nan") for r in got}
    mean = lambda i, side: sum(r2.get((i * folds + k, side), float("nan")) for k in range(folds)) / folds
    return [(float(f), mean(i, True), mean(i, False)) for i, f in enumerate(fractions)]


__all__ = ["FEATURES", "fit_partitions", "hash_bucket", "hash_split", "split_hash", "exact_split", "assemble", "forest",
           "feature_importance", "grown_importance", "predictions", "curve_fits", "learning_curve"]
