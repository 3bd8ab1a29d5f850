import pytest
from pyspark.sql import functions as F

from riskpanel.operators import impurity, weights

LABELS = [0, 0, 0, 1, 1, 2]


@pytest.fixture(scope="module")
def rows(spark):
    data = [("n", y, x, 0) for y, x in zip(LABELS, [0, 0, 0, 1, 1, 1])]
    return spark.createDataFrame(data, "node string, label int, a int, b int")


def test_class_weights_by_hand(rows):
    got = {r["label"]: r["weight"] for r in weights.class_weights(rows).collect()}
    assert got == pytest.approx({0: 6 / 9, 1: 1.0, 2: 2.0})
    half = {r["label"]: r["weight"] for r in weights.class_weights(rows, power=0.5).collect()}
    assert half == pytest.approx({0: (6 / 9) ** 0.5, 1: 1.0, 2: 2.0**0.5})


def test_absent_class_weighs_nothing(rows):
    got = {r["label"]: r["weight"] for r in weights.class_weights(rows.filter("label < 2")).collect()}
    assert got[2] == 0.0


def test_gini_of_balanced_classes_is_two_thirds(rows):
    weighted = weights.with_row_weights(rows, weights.class_weights(rows))
    assert impurity.gini_by_group(weighted, ["node"]).first()["impurity"] == pytest.approx(2 / 3)


def test_best_split_by_hand(rows):
    weighted = weights.with_row_weights(rows, weights.class_weights(rows))
    best = impurity.best_split(weighted, ["a", "b"], min_leaf=1).collect()
    assert [(r["feature"], r["bin"]) for r in best] == [("a", 0)]
    assert best[0]["gain"] == pytest.approx(2.0)
    by_node = impurity.best_split(weighted, ["b", "a"], ["node"], min_leaf=1).collect()
    assert [(r["node"], r["feature"], r["bin"]) for r in by_node] == [("n", "a", 0)]


def test_min_leaf_counts_rows_not_weights(rows):
    weighted = weights.with_row_weights(rows, weights.class_weights(rows))
    assert impurity.best_split(weighted, ["a"], min_leaf=4).count() == 0


def test_pure_node_has_no_split(rows):
    pure = rows.withColumn("label", F.lit(1)).withColumn("weight", F.lit(1.0))
    assert impurity.best_split(pure, ["a", "b"], min_leaf=1).count() == 0
    assert impurity.gini_by_group(pure, ["node"]).first()["impurity"] == 0.0


def test_ties_go_to_the_first_feature(spark):
    data = [(y, y, y) for y in (0, 0, 1, 1)]
    df = spark.createDataFrame(data, "label int, a int, b int").withColumn("weight", F.lit(1.0))
    assert impurity.best_split(df, ["b", "a"], min_leaf=1).first()["feature"] == "b"
