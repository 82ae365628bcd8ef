import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from anagrove.operators.forest_proof import forest_nodes, node_counts, split_gains


@pytest.fixture(scope="module")
def rows(spark):
    frame = spark.range(600).select(
        (F.pmod(F.col("id") * 37, F.lit(101)) / 7).alias("a"),
        F.pmod(F.col("id") * 53, F.lit(17)).cast("double").alias("b"),
    )
    label = ((F.col("a") > 6) != (F.col("b") > 9)).cast("double")
    return frame.select("a", "b", label.alias("label"), (F.lit(1.0) + F.pmod("b", F.lit(2.0))).alias("w"), array_to_vector(F.array("a", "b")).alias("features"))


def fitted(rows, **more):
    forest = RandomForestClassifier(numTrees=3, maxDepth=3, maxBins=128, bootstrap=False, weightCol="w", seed=2, **more)
    return forest.fit(rows)


def test_gains_equal_those_of_the_fit_and_are_never_negative(spark, rows):
    found = split_gains(rows, forest_nodes(spark, fitted(rows)), 3, "w").collect()
    assert len(found) > 3
    for row in found:
        assert row.gain == pytest.approx(row.fitted_gain, abs=1e-9)
        assert row.gain >= -1e-12


def test_a_resampled_forest_is_told_apart(spark, rows):
    model = RandomForestClassifier(numTrees=3, maxDepth=3, maxBins=128, subsamplingRate=0.3, weightCol="w", seed=2).fit(rows)
    found = split_gains(rows, forest_nodes(spark, model), 3, "w").collect()
    assert max(abs(r.gain - r.fitted_gain) for r in found) > 1e-4


def test_counts_add_up_and_leaves_give_the_forest_s_chances(spark, rows):
    model = fitted(rows)
    nodes = forest_nodes(spark, model)
    counts = {(r.tree, r.node): r for r in node_counts(rows, nodes, 3, "w").collect()}
    below = {(r.tree, r.node): r for r in nodes.collect()}
    for key, row in counts.items():
        if below[key].left >= 0:
            parts = [counts[(key[0], c)] for c in (below[key].left, below[key].right) if (key[0], c) in counts]
            assert row.n == sum(p.n for p in parts)
            assert row.w1 == pytest.approx(sum(p.w1 for p in parts))
    for seen in model.transform(rows.limit(20)).collect():
        chances = []
        for tree in range(3):
            node = 0
            while below[(tree, node)].left >= 0:
                split = below[(tree, node)]
                node = split.left if seen.features[split.feature] <= split.threshold else split.right
            leaf = counts[(tree, node)]
            chances.append(leaf.w1 / (leaf.w0 + leaf.w1))
        assert seen.probability[1] == pytest.approx(np.mean(chances))


def test_nulls_take_no_part_and_a_single_leaf_has_no_split(spark, rows):
    nodes = forest_nodes(spark, fitted(rows))
    odd = rows.unionByName(rows.limit(3).withColumn("label", F.lit(None).cast("double")))
    assert split_gains(odd, nodes, 3, "w").filter("node = 0").first().n == 600
    one_class = rows.withColumn("label", F.lit(1.0))
    assert split_gains(one_class, forest_nodes(spark, fitted(one_class)), 3, "w").isEmpty()
