import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardproof.functions.schema import MODEL_FEATURES
from cardproof.operators import forest
from cardproof.operators.evaluation import evaluation
from cardproof.operators.quantile import exact_quantile

NAMES = [f"x{i}" for i in range(6)]


def points(normal=300, fraud=10, features=len(NAMES)):
    rng = np.random.default_rng(0)
    values = np.vstack([rng.standard_normal((normal, features)), rng.standard_normal((fraud, features)) * 3 + 5])
    return values, np.arange(normal + fraud) >= normal


def as_frame(spark, values, fraud):
    schema = "row_key string, is_fraud boolean, " + ", ".join(f"{n} double" for n in NAMES)
    rows = [(f"k{i}", bool(f), *map(float, v)) for i, (v, f) in enumerate(zip(values, fraud))]
    return spark.createDataFrame(rows, schema)


def scores(df, **options):
    options = {"trees": 50, "contamination": 0.03} | options
    return {r.row_key: r for r in forest.fraud_signals(df, NAMES, **options).collect()}


# --- quantile ----------------------------------------------------------------------------------


@pytest.mark.parametrize("accuracy", [10_000, 100])
@pytest.mark.parametrize("fraction", [0, 0.002, 0.5, 1])
@pytest.mark.parametrize("shape", ["normal", "ties", "one", "same", "wide"])
def test_quantile_equals_numpy(spark, shape, fraction, accuracy):
    rng = np.random.default_rng(1)
    values = {
        "normal": -rng.random(997),
        "ties": rng.integers(0, 5, 400).astype(float),
        "one": np.array([3.5]),
        "same": np.full(50, -0.25),
        "wide": np.concatenate([rng.standard_normal(300) * 1e-9, [1e12, -1e12]]),
    }[shape]
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    got = exact_quantile(frame, "v", fraction, accuracy)
    assert got == pytest.approx(np.quantile(values, fraction), rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_quantile_with_infinities(spark, accuracy):
    values = [float("-inf")] * 30 + [float(i) for i in range(900)] + [float("inf")] * 70
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for fraction in (0, 0.01, 0.3, 0.5, 0.95, 1):
        assert exact_quantile(frame, "v", fraction, accuracy) == np.sort(values)[round(fraction * 999)] or (
            exact_quantile(frame, "v", fraction, accuracy) == pytest.approx(np.quantile(values, fraction))
        )


def test_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "v double"), "v", 0.5) is None


# --- evaluation --------------------------------------------------------------------------------


def test_evaluation_counts_and_ratios(spark):
    rows = [(True, True)] * 3 + [(True, False)] * 2 + [(False, True)] * 5 + [(False, False)] * 10
    got = evaluation(spark.createDataFrame(rows, "p boolean, a boolean"), "p", "a").first()
    assert tuple(got)[:4] == (20, 5, 8, 3)
    assert (got.precision, got.recall, got.f1) == (0.6, 0.375, round(6 / 13, 3))


def test_evaluation_is_zero_where_undefined(spark):
    for rows in ([], [(False, False)]):
        got = evaluation(spark.createDataFrame(rows, "p boolean, a boolean"), "p", "a").first()
        assert (got.precision, got.recall, got.f1) == (0.0, 0.0, 0.0)


# --- forest ------------------------------------------------------------------------------------


def test_model_features():
    assert len(MODEL_FEATURES) == 29 and MODEL_FEATURES[-1] == "Amount"
    assert forest.CONTAMINATION > 492 / 284_807


def test_average_path_values():
    assert forest.average_path([0, 1, 2]).tolist() == [0, 0, 1]
    assert forest.average_path([256])[0] == pytest.approx(2 * (math.log(255) + 0.5772156649) - 2 * 255 / 256)


def test_scoring_equals_a_walk_down_each_tree(spark):
    values, fraud = points(400, 20)
    df = as_frame(spark, values, fraud)
    nodes = forest.fit_forest(df, NAMES, trees=20)
    trees = {}
    for n in nodes.collect():
        trees.setdefault(n.tree, {})[n.node] = n
    assert len(trees) == 20 and all(t[0].size == 256 for t in trees.values())
    got = {r.row_key: r.raw_score for r in forest.with_raw_score(df, nodes, NAMES).collect()}
    for i, point in enumerate(values):
        paths = []
        for tree in trees.values():
            node = tree[0]
            while node.feature >= 0:
                node = tree[2 * node.node + (1 if point[node.feature] <= node.threshold else 2)]
            paths.append(node.depth + forest.average_path([node.size])[0])
        assert got[f"k{i}"] == pytest.approx(-(2 ** (-np.mean(paths) / forest.average_path([256])[0])), rel=1e-12)


def test_scores_of_the_jvm_equal_those_of_python(spark):
    values, fraud = points(400, 20)
    df = as_frame(spark, values, fraud).withColumn("x2", F.when(F.col("row_key") != "k4", F.col("x2")))
    nodes = forest.fit_forest(df, NAMES, trees=7)
    python = {r.row_key: r.raw_score for r in forest.with_raw_score(df, nodes, NAMES).collect()}
    jvm = {r.row_key: r.raw_score for r in forest.with_raw_score_jvm(df, nodes, NAMES).collect()}
    assert python.pop("k4") is None and jvm.pop("k4") is None
    assert jvm == pytest.approx(python, rel=1e-12)
    assert forest.with_raw_score_jvm(df, nodes.limit(0), NAMES).filter("raw_score is not null").isEmpty()


def test_scores_of_the_jvm_on_constant_data(spark):
    df = as_frame(spark, np.ones((300, len(NAMES))), np.zeros(300))
    nodes = forest.fit_forest(df, NAMES, trees=3)
    python, jvm = (
        {r.raw_score for r in f(df, nodes, NAMES).collect()} for f in (forest.with_raw_score, forest.with_raw_score_jvm)
    )
    assert len(jvm) == 1 and jvm.pop() == pytest.approx(python.pop(), rel=1e-12)


def test_wide_rows_are_planned_fast(spark):
    names = [f"x{i}" for i in range(64)]
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("row_key"), *[F.sin(F.col("id") * (i + 1)).alias(n) for i, n in enumerate(names)]
    )
    start = time.perf_counter()
    drawn = forest.draw_samples(df, names, "row_key", 1000, trees=5)
    drawn._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < 10
    assert drawn.count() == 5 * 256


def test_samples_hold_a_row_once_per_tree(spark):
    df = as_frame(spark, *points(2000, 20)).withColumn("row_key", F.when(F.col("row_key") != "k4", F.col("row_key")))
    drawn = forest.draw_samples(df, NAMES, "row_key", 2020, trees=6)
    assert drawn.groupBy("tree", "key").count().filter("count > 1").isEmpty()
    assert drawn.columns == ["tree", "key", *[f"f{i}" for i in range(6)]]


def test_trees_are_well_formed(spark):
    values, fraud = points(600, 20)
    nodes = forest.fit_forest(as_frame(spark, values, fraud), NAMES, trees=10).collect()
    by_id = {(n.tree, n.node): n for n in nodes}
    for n in nodes:
        assert n.depth <= 8
        if n.feature >= 0:
            left, right = by_id[n.tree, 2 * n.node + 1], by_id[n.tree, 2 * n.node + 2]
            assert left.size + right.size == n.size and left.size and right.size


def test_obvious_outliers_are_flagged(spark):
    values, fraud = points()
    got = scores(as_frame(spark, values, fraud), contamination=10 / 310)
    flagged = [r for r in got.values() if r.is_predicted_fraud]
    assert sum(r.is_actual_fraud for r in flagged) / 10 >= 0.7
    assert all(np.isfinite(r.anomaly_score) for r in got.values())
    mean = {f: np.mean([r.anomaly_score for r in got.values() if r.is_actual_fraud == f]) for f in (True, False)}
    assert mean[True] < mean[False]
    assert len(flagged) == math.ceil(10 / 310 * 309) and all(r.anomaly_score < 0 for r in flagged)


@pytest.mark.parametrize("size", [(120, 5), (900, 20), (4000, 40)], ids=["all", "repeated", "once"])
def test_scores_do_not_depend_on_partitioning(spark, size):
    df = as_frame(spark, *points(*size))
    options = {"trees": 8} if size[0] > 2000 else {}
    one, seven, many = (scores(df.repartition(n), **options) for n in (1, 7, 64))
    assert one == seven == many and len(one) == sum(size)


def test_seed_changes_the_forest(spark):
    df = as_frame(spark, *points())
    assert scores(df) != scores(df, seed=7)


def test_rows_without_a_feature_stay_unscored(spark):
    df = as_frame(spark, *points())
    broken = df.withColumn("x2", F.when(F.col("row_key") == "k3", float("nan")).when(F.col("row_key") != "k4", F.col("x2")))
    got = scores(broken)
    assert len(got) == 310
    assert got["k3"].anomaly_score is None and got["k4"].anomaly_score is None and not got["k3"].is_predicted_fraud
    assert got["k5"].anomaly_score is not None


def test_mostly_broken_rows_still_fill_the_trees(spark):
    values, fraud = points(3000, 30)
    df = as_frame(spark, values, fraud).withColumn("x0", F.when(F.col("row_key").rlike("[0-2]$"), F.col("x0")))
    roots = forest.fit_forest(df, NAMES, trees=8).filter("node = 0").collect()
    assert len(roots) == 8 and all(r.size == 256 for r in roots)


def test_hot_key_has_its_share_of_every_sample(spark):
    """A third of the rows share one key and hold about a third of each sample, at any table size."""
    for rows, trees in ((2000, 8), (20_000, 4)):
        df = spark.range(rows).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("row_key"),
            *[((F.col("id") % 3 == 0).cast("double") if i == 0 else F.rand(i)).alias(n) for i, n in enumerate(NAMES)],
        ).persist()
        drawn = forest.draw_samples(df, NAMES, "row_key", rows, trees=trees)
        found = drawn.groupBy("tree").agg(F.count("*").alias("n"), F.avg("f0").alias("hot")).collect()
        assert len(found) == trees and all(r.n == 256 and 0.2 < r.hot < 0.47 for r in found)
        df.unpersist()


def test_infinite_features_are_not_usable(spark):
    df = as_frame(spark, *points())
    endless = F.when(F.col("row_key") == "k3", float("inf")).otherwise(F.col("x2"))
    got = scores(df.withColumn("x2", endless))
    assert got["k3"].anomaly_score is None and got["k5"].anomaly_score is not None


def test_constant_and_empty_data(spark):
    values = np.ones((300, len(NAMES)))
    got = scores(as_frame(spark, values, np.zeros(300)))
    assert len({r.anomaly_score for r in got.values()}) == 1 and not any(r.is_predicted_fraud for r in got.values())
    assert scores(as_frame(spark, values, np.zeros(300)).limit(0)) == {}
