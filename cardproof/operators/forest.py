"""Isolation forest trained and scored on the executors.

After Liu, Ting and Zhou, "Isolation Forest", ICDM 2008. SHA-256 over row key, features and seed decides which rows a
tree sees, and SHA-256 over seed, tree and node how it splits them. The forest so depends neither on the partitioning
nor on how often a task runs, and SQL can repeat it. The features travel as one array column: sampling, hashing and
splitting take it whole, so the plan is as small for 64 features as for two. Each tree is built from at most 256 rows in
its own task; the fitted forest is a table of at most ``trees * 511`` nodes, which bounds what is broadcast for scoring.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardproof.functions.schema import MODEL_FEATURES
from cardproof.operators.quantile import exact_quantile
from cardproof.sources.durable import durable

# Parameters of the model.
TREES = 200
CONTAMINATION = 0.002
SEED = 42
MAX_SAMPLES = 256
EULER_GAMMA = 0.5772156649

# the functions that run in tasks travel with them, so executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# candidates drawn per tree, as a multiple of the sample size
_OVERSAMPLING = 1.5
_NODES = "tree int, node int, feature int, threshold double, size int, depth int"
# path lengths are multiples of this, so their sums are exact in any order
_PATH_UNIT = 2.0**-32
_DRAW_DIGITS = 12


def vector(features: Sequence[str]) -> Column:
    """The features as one array of doubles."""
    return F.array(*[F.col(c).cast("double") for c in features]).cast("array<double>")


def usable(features: Sequence[str]) -> Column:
    """True where every feature is a finite number."""
    return _finite(vector(features))


def _finite(x: Column) -> Column:
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf))
    return F.forall(x, finite)


def _number(digest: Column, start: int, digits: int) -> Column:
    """Hexadecimal digits of a digest, counted from 1, as a number."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def draw_samples(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    rows: int,
    trees: int = TREES,
    seed: int = SEED,
    max_samples: int = MAX_SAMPLES,
    oversampling: float = _OVERSAMPLING,
) -> DataFrame:
    """At most ``max_samples`` rows per tree: ``tree``, ``key`` and the features as ``f0``, ``f1`` and so on.

    One rule for every table size. With ``p`` picks per row wanted, a row takes floor(p) trees, one more by
    chance frac(p), and never more than there are. Its trees follow from a hashed start in hashed steps that visit
    every tree, so they differ. All three come from the digits of one SHA-256 over key, features and seed: rows of one
    key are drawn independently, and a key with a third of the rows has about a third of every sample. A second one
    orders the candidates of a tree. The cut by rank runs before the shuffle as well (Spark's group limit, up to 1,000
    rows), so what is sent stays near 1.5 samples per tree. A null key counts as an empty text.
    """
    size = min(max_samples, rows)
    wanted = min(float(trees), oversampling * trees * size / max(rows, 1))
    strides = [n for n in range(1, trees + 1) if math.gcd(n, trees) == 1]
    as_text = F.array_join(F.transform("x", lambda v: v.cast("string")), ",")
    digest = F.sha2(F.concat_ws("|", F.coalesce("key", F.lit("")), as_text, F.lit(str(seed))), 256)
    chance = int((wanted - math.floor(wanted)) * 16**_DRAW_DIGITS)
    extra = _number(F.col("_digest"), 1, _DRAW_DIGITS) < F.lit(chance)
    stride = F.element_at(F.lit(strides), (_number(F.col("_digest"), 13, 8) % len(strides) + 1).cast("int"))
    drawn = (
        df.select(F.col(key).cast("string").alias("key"), vector(features).alias("x"))
        .filter(_finite(F.col("x")))
        .withColumn("_digest", digest)
        .withColumn("_picks", F.lit(math.floor(wanted)) + extra.cast("int"))
        .filter("_picks > 0")
        .withColumns({"_start": _number(F.col("_digest"), 21, 8), "_stride": stride})
        .withColumn("_turn", F.explode(F.sequence(F.lit(0), F.col("_picks") - 1)))
        .withColumn("tree", ((F.col("_start") + F.col("_turn") * F.col("_stride")) % trees).cast("int"))
    )
    order = Window.partitionBy("tree").orderBy(F.sha2(F.concat_ws(":", "_digest", "tree"), 256), "key", "x")
    ranked = drawn.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= size)
    return ranked.select("tree", "key", *[F.get("x", F.lit(i)).alias(f"f{i}") for i in range(len(features))])


def fit_forest(
    df: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    key: str = "row_key",
    trees: int = TREES,
    seed: int = SEED,
    max_samples: int = MAX_SAMPLES,
) -> DataFrame:
    """Fit and return the stored node table. Node ``i`` has children ``2i+1`` and ``2i+2``; a leaf has
    feature -1.

    The chance to be drawn comes from the number of all rows, which costs no scan of the features. If a
    tree came out short, for whatever reason, the usable rows are counted and more are drawn.
    """
    rows = df.count()
    for attempt, oversampling in enumerate((_OVERSAMPLING, 2 * _OVERSAMPLING, 8 * _OVERSAMPLING)):
        if attempt == 1:
            rows = df.filter(usable(features)).count()
        nodes = durable(_fit(df, features, key, rows, trees, seed, max_samples, oversampling))
        full = nodes.filter((F.col("node") == 0) & (F.col("size") == min(max_samples, rows))).count()
        if full == trees or rows == 0:
            break
    return nodes


def _fit(df, features, key, rows, trees, seed, max_samples, oversampling) -> DataFrame:
    samples = draw_samples(df, features, key, rows, trees, seed, max_samples, oversampling)
    height = math.ceil(math.log2(max(2, min(max_samples, rows))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        nodes = _grow_tree(pdf.drop(columns=["tree", "key"]).to_numpy(), f"{seed}:{tree}", height)
        return pd.DataFrame(
            [(tree, *node) for node in nodes],
            columns=["tree", "node", "feature", "threshold", "size", "depth"],
        )

    return samples.groupBy("tree").applyInPandas(grow, _NODES)


def _grow_tree(points: np.ndarray, seed: str, height: int) -> list[tuple]:
    """Split by chance until a node is isolated, constant or at the height limit.

    The first 8 digits of SHA-256 over seed and node choose among the features that vary, the next 12 the threshold
    between their extremes. The outcome does not depend on the order of the points.
    """
    nodes, open_nodes = [], [(0, 0, points)]
    while open_nodes:
        node, depth, inside = open_nodes.pop()
        low, high = inside.min(axis=0), inside.max(axis=0)
        varying = np.flatnonzero(low < high)
        if depth == height or len(varying) == 0:
            nodes.append((node, -1, None, len(inside), depth))
            continue
        digest = hashlib.sha256(f"{seed}:{node}".encode()).hexdigest()
        feature = int(varying[int(digest[:8], 16) % len(varying)])
        least, most = float(low[feature]), float(high[feature])
        threshold = least + int(digest[8:20], 16) / 16**12 * (most - least)
        if not threshold < most:
            threshold = least
        nodes.append((node, feature, threshold, len(inside), depth))
        left = inside[:, feature] <= threshold
        open_nodes.append((2 * node + 2, depth + 1, inside[~left]))
        open_nodes.append((2 * node + 1, depth + 1, inside[left]))
    return nodes


def average_path(size) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``size`` points, to a multiple of 2^-32."""
    n = np.maximum(np.asarray(size, dtype=float), 2)
    length = 2 * (np.log(np.maximum(n - 1, 1)) + EULER_GAMMA) - 2 * (n - 1) / n
    length = np.floor(length / _PATH_UNIT + 0.5) * _PATH_UNIT
    return np.where(np.asarray(size) <= 1, 0.0, np.where(np.asarray(size) == 2, 1.0, length))


def with_raw_score(
    df: DataFrame, nodes: DataFrame, features: Sequence[str] = MODEL_FEATURES, name: str = "raw_score"
) -> DataFrame:
    """Add the raw score ``-2^(-mean path / c)``: closer to -1 is more anomalous, null without features.

    Only the features travel to Python, in Arrow batches; the other columns stay in the JVM.
    """
    forest = nodes.toPandas()
    if forest.empty:
        return df.withColumn(name, F.lit(None).cast("double"))
    packed = df.sparkSession.sparkContext.broadcast(_pack(forest))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            points = np.column_stack([column.to_numpy(dtype=float) for column in batch])
            yield pd.Series(_scores(points, *packed.value))

    columns = [F.col(c).cast("double") for c in features]
    return df.withColumn(name, F.when(usable(features), score(*columns)))


def with_raw_score_jvm(
    df: DataFrame, nodes: DataFrame, features: Sequence[str] = MODEL_FEATURES, name: str = "raw_score"
) -> DataFrame:
    """The score of ``with_raw_score`` without Python workers, for clusters that run none.

    The forest is packed into three arrays, which every row walks: an ``aggregate`` over the levels inside one over the
    trees. They reach the tasks as the single value of a subquery. Spark interprets such functions, so this
    is slower than Arrow batches (README, "Measured").
    """
    forest = nodes.toPandas()
    if forest.empty:
        return df.withColumn(name, F.lit(None).cast("double"))
    feature, threshold, bottom, height, norm = _pack(forest)
    inner = feature.shape[1]
    arrays = {"feature": feature.astype(np.int32), "threshold": threshold, "bottom": bottom}
    table = df.sparkSession.createDataFrame(pa.table({n: pa.array([a.ravel()]) for n, a in arrays.items()}))
    packed = F.col("_forest")

    def path(tree: Column, x: Column) -> Column:
        def down(at: Column, _: Column) -> Column:
            place = tree * inner + at
            right = F.get(x, F.get(packed["feature"], place)) > F.get(packed["threshold"], place)
            return at * 2 + 1 + right.cast("int")

        at = F.aggregate(F.sequence(F.lit(1), F.lit(height)), F.lit(0), down) if height else F.lit(0)
        return F.get(packed["bottom"], tree * 2**height + at - (2**height - 1))

    total = lambda x: F.aggregate(
        F.sequence(F.lit(0), F.lit(len(feature) - 1)), F.lit(0.0), lambda found, tree: found + path(tree, x)
    )
    scored = df.withColumns({"_x": vector(features), "_forest": table.select(F.struct("*")).scalar()})
    score = -F.pow(F.lit(2.0), -total(F.col("_x")) / F.lit(float(len(feature))) / F.lit(norm))
    return scored.withColumn(name, F.when(_finite(F.col("_x")), score)).drop("_x", "_forest")


def _pack(forest: pd.DataFrame) -> tuple:
    """Forest as arrays over complete trees: feature, threshold, path length at the bottom, norm."""
    height = int(forest["depth"].max())
    index = forest["tree"].rank(method="dense").astype(int).to_numpy() - 1
    trees, inner = index.max() + 1, 2**height - 1
    feature = np.zeros((trees, max(inner, 1)), dtype=np.int64)
    threshold = np.full((trees, max(inner, 1)), np.inf)
    bottom = np.zeros((trees, 2**height))
    split = (forest["feature"] >= 0).to_numpy()
    node = forest["node"].to_numpy()
    feature[index[split], node[split]] = forest["feature"].to_numpy()[split]
    threshold[index[split], node[split]] = forest["threshold"].to_numpy()[split]
    # below a leaf every comparison goes left, so the leaf's value sits at its leftmost bottom position
    levels = height - forest["depth"].to_numpy()[~split]
    leftmost = (node[~split] + 1) * 2**levels - 2**height
    size = forest["size"].to_numpy()[~split]
    bottom[index[~split], leftmost] = forest["depth"].to_numpy()[~split] + average_path(size)
    sample = int(forest.loc[forest["node"] == 0, "size"].max())
    return feature, threshold, bottom, height, float(max(average_path(sample), 1e-12))


def _scores(points, feature, threshold, bottom, height, norm) -> np.ndarray:
    """Walk all points through one tree at a time; a step is three lookups per point."""
    count, inner = len(points), 2**height - 1
    by_feature = np.ascontiguousarray(points.T).ravel()
    rows = np.arange(count)
    paths = np.zeros(count)
    for tree in range(len(feature)):
        starts = feature[tree] * count
        at = np.zeros(count, dtype=np.int64)
        for _ in range(height):
            value = by_feature.take(starts.take(at) + rows)
            at = 2 * at + 1 + (value > threshold[tree].take(at))
        paths += bottom[tree].take(at - inner)
    return -np.exp2(-paths / len(feature) / norm)


def fraud_signals(
    silver: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    key: str = "row_key",
    label: str = "is_fraud",
    contamination: float = CONTAMINATION,
    trees: int = TREES,
    seed: int = SEED,
) -> DataFrame:
    """Fit, score and flag every row: key, score, prediction and label.

    The score is the raw score less its quantile at ``contamination``; below 0 is an anomaly. Rows with
    a missing feature take no part in the fit and get a null score and no flag. Raw scores are
    stored once, because the quantile needs all of them before the first row can be flagged.
    """
    nodes = fit_forest(silver, features, key, trees, seed)
    scored = durable(
        with_raw_score(silver.select(key, label, *dict.fromkeys(features)), nodes, features).select(
            key, "raw_score", label
        )
    )
    offset = exact_quantile(scored, "raw_score", contamination)
    score = F.col("raw_score") - F.lit(offset).cast("double")
    return scored.select(
        key,
        score.alias("anomaly_score"),
        F.coalesce(score < 0, F.lit(False)).alias("is_predicted_fraud"),
        F.col(label).alias("is_actual_fraud"),
    )
