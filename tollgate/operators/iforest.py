"""Isolation forest trained and applied as Spark jobs (Liu, Ting and Zhou, 2008).

Training: every row decides from a hash of its id which trees it may join, so samples do
not depend on partitioning; each tree then grows in its own group of at most
`sample_size` rows. The node table has at most trees x (2 x sample - 1) rows and is the
only thing scoring broadcasts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tollgate.config import DEFAULT, FEATURE_NAMES, Config
from tollgate.functions import clip01

NODE_SCHEMA = (
    "tree_id int, node_id int, feature int, threshold double, left int, right int, size int, depth int"
)


def normalize(raw: Column) -> Column:
    """Decision value (negative = anomalous) to an anomaly score in [0, 1]."""
    return clip01(F.lit(0.5) - raw)


def average_path(n: np.ndarray | int) -> np.ndarray:
    """Expected path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    nodes: DataFrame
    sample_size: int
    offset: float
    version: str


def _unit(*parts: Column) -> Column:
    """Uniform number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / float(1 << 53)


def draw_samples(features: DataFrame, rows: int, cfg: Config, key: str = "transaction_id") -> DataFrame:
    """(tree_id, key, features): up to `sample_size` rows for each tree."""
    size = min(cfg.sample_size, rows)
    # enough candidates per tree that falling short of `size` is a six-sigma event
    rate = min(1.0, (size + 6.0 * math.sqrt(size)) / rows)
    seed = F.lit(cfg.seed)
    picked = features.select(key, *[F.col(f).cast("double").alias(f) for f in FEATURE_NAMES])
    # the first tree a row joins comes from one hash, as the gap before the first of independent draws of chance `rate`;
    # a row whose gap passes the last tree joins none and goes no further. Trees after the first are drawn one by one.
    gap = F.when(F.lit(rate) >= 1.0, F.lit(0.0)).otherwise(F.floor(F.log(1.0 - _unit(F.col(key), seed)) / math.log1p(-min(rate, 1 - 1e-12))))
    joined = picked.withColumn("_first", gap.cast("double")).filter(F.col("_first") < cfg.n_trees).withColumn("_first", F.col("_first").cast("int"))
    picked = joined.withColumn("tree_id", F.explode(F.sequence("_first", F.lit(cfg.n_trees - 1)))).filter(
        (F.col("tree_id") == F.col("_first")) | (_unit(F.col(key), F.col("tree_id"), seed) < rate)
    ).drop("_first")
    order = Window.partitionBy("tree_id").orderBy(F.xxhash64(F.lit("rank"), F.col(key), F.col("tree_id"), seed), key)
    return picked.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= size)


def _grow(sample: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Nodes of one tree; splits are uniform over the varying features and their range."""
    tree = int(sample["tree_id"].iloc[0])
    points = sample.sort_values("_rank")[list(FEATURE_NAMES)].to_numpy(dtype=float)
    rng = np.random.default_rng([seed, tree])
    limit = math.ceil(math.log2(max(len(points), 2)))
    nodes: list[list] = []
    todo = [(np.arange(len(points)), 0, -1, 0)]
    while todo:
        members, depth, parent, side = todo.pop()
        node = len(nodes)
        if parent >= 0:
            nodes[parent][4 + side] = node
        here = points[members]
        low, high = here.min(axis=0), here.max(axis=0)
        varying = np.flatnonzero(high > low)
        nodes.append([tree, node, -1, 0.0, -1, -1, len(members), depth])
        if depth >= limit or len(members) < 2 or len(varying) == 0:
            continue
        feature = int(rng.choice(varying))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = here[:, feature] <= cut
        nodes[node][2:4] = [feature, cut]
        todo.append((members[~goes_left], depth + 1, node, 1))
        todo.append((members[goes_left], depth + 1, node, 0))
    names = ["tree_id", "node_id", "feature", "threshold", "left", "right", "size", "depth"]
    return pd.DataFrame(nodes, columns=names)


def grow_forest(features: DataFrame, cfg: Config = DEFAULT, rows: int | None = None) -> DataFrame:
    """The node table."""
    rows = features.count() if rows is None else rows
    seed = cfg.seed
    samples = draw_samples(features, rows, cfg)
    return samples.groupBy("tree_id").applyInPandas(lambda sample: _grow(sample, seed), NODE_SCHEMA)


def score_samples(features: DataFrame, nodes: DataFrame, sample_size: int) -> Column:
    """Column with the (negative) anomaly value of each row of `features`."""
    table = nodes.toPandas().sort_values(["tree_id", "node_id"], ignore_index=True)
    first = table.groupby("tree_id")["node_id"].transform("idxmin").to_numpy()
    at = np.arange(len(table))
    leaf = (table["feature"] < 0).to_numpy()
    arrays = {
        "roots": np.unique(first).astype(np.int32),
        "feature": np.where(leaf, 0, table["feature"]).astype(np.int32),
        "threshold": np.where(leaf, np.inf, table["threshold"]),
        # a leaf leads to itself, so every row can take the same number of steps
        "left": np.where(leaf, at, first + table["left"]).astype(np.int32),
        "right": np.where(leaf, at, first + table["right"]).astype(np.int32),
        "length": table["depth"].to_numpy() + average_path(table["size"].to_numpy()),
    }
    steps = int(table["depth"].max())
    scale = float(average_path(sample_size)) or 1.0
    shared = features.sparkSession.sparkContext.broadcast(arrays)

    def walk(*columns: pd.Series) -> pd.Series:
        forest = shared.value
        values = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        width = values.shape[1]
        out = np.empty(len(values))
        for start in range(0, len(values), 2048):  # keeps the row x tree block in cache
            block = values[start : start + 2048].ravel()
            base = (np.arange(len(block) // width, dtype=np.int32) * width)[:, None]
            node = np.broadcast_to(forest["roots"], (len(base), len(forest["roots"])))
            for _ in range(steps):
                goes_left = block[base + forest["feature"][node]] <= forest["threshold"][node]
                node = np.where(goes_left, forest["left"][node], forest["right"][node])
            out[start : start + len(base)] = forest["length"][node].mean(axis=1)
        return pd.Series(-np.power(2.0, -out / scale))

    return F.pandas_udf(walk, DoubleType())(*[F.col(f).cast("double") for f in FEATURE_NAMES])


def train(features: DataFrame, cfg: Config = DEFAULT, version: str = "iforest_v1.0.0") -> Forest:
    """Grow the trees and set the offset at the contamination quantile of the training scores."""
    rows = features.count()
    if rows == 0:
        raise ValueError("no rows to train on")
    nodes = grow_forest(features, cfg, rows).persist()
    # what the trees really hold; below the wanted size only if a draw fell short
    size = round(nodes.filter("depth = 0").agg(F.avg("size")).first()[0])
    values = features.select(score_samples(features, nodes, size).alias("v")).persist()
    try:
        offset = exact_quantile(values, "v", cfg.contamination)
    finally:
        values.unpersist()
    return Forest(nodes, size, offset, version)


def order_statistic(values: DataFrame, column: str, rank: int, bins: int = 65_536, few: int = 65_536) -> float:
    """The value with `rank` smaller or earlier ones, exactly, at any size.

    Each pass counts the values in bins of equal width and goes on inside the bin that holds the rank, until the bin
    is small or has one value. At most `bins` counts or `few` values reach the driver.
    """
    inside = values.filter(F.col(column).isNotNull())
    while True:
        low, high, n = inside.agg(F.min(column), F.max(column), F.count("*")).first()
        if low == high:
            return float(low)
        if n <= few:
            return float(inside.orderBy(column).offset(rank).first()[0])
        width = (high - low) / bins
        place = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        before = 0
        for number, count in sorted(map(tuple, inside.groupBy(place.alias("bin")).count().collect())):
            if before + count > rank:
                inside, rank = inside.filter(place == number), rank - before
                break
            before += count


def exact_quantile(values: DataFrame, column: str, q: float) -> float:
    """Quantile with linear interpolation between the two nearest values."""
    n = values.filter(F.col(column).isNotNull()).count()
    place = (n - 1) * q
    low = order_statistic(values, column, math.floor(place))
    high = order_statistic(values, column, math.ceil(place))
    return low + (high - low) * (place - math.floor(place))


def with_anomaly_score(features: DataFrame, forest: Forest) -> DataFrame:
    """Add `raw_decision` and the unrounded `anomaly_score`."""
    raw = score_samples(features, forest.nodes, forest.sample_size) - F.lit(forest.offset)
    # the model runs once per row; both columns derive from its result
    decided = features.withColumn("raw_decision", raw)
    return decided.withColumn("anomaly_score", normalize(F.col("raw_decision")))


def save(forest: Forest, path: str) -> None:
    forest.nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    spark = forest.nodes.sparkSession
    meta = spark.range(1).select(
        F.lit(forest.version).alias("version"), F.lit(forest.sample_size).alias("sample_size"),
        F.lit(forest.offset).alias("offset"), F.array(*[F.lit(f) for f in FEATURE_NAMES]).alias("feature_names"),
    )
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load(spark: SparkSession, path: str) -> Forest:
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/meta/_SUCCESS")
    if not marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker):
        raise FileNotFoundError(f"no saved forest at {path}")
    meta = spark.read.parquet(f"{path}/meta").first()
    if list(meta["feature_names"]) != list(FEATURE_NAMES):
        raise ValueError(f"forest at {path} was trained on other features")
    return Forest(spark.read.parquet(f"{path}/nodes"), meta["sample_size"], meta["offset"], meta["version"])
