"""The forest grown from packed rows, against its own rows and against MLlib's trees."""

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from aval import config as c
from aval.operators import forest as fo
from aval.operators import models as md
from aval.session import discard


@pytest.fixture(scope="module")
def rows(spark):
    """3 000 rows, three variables and one constant; the label is a rule with a tenth of noise."""
    x, y, z = (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(n)).cast("double") for i, n in enumerate((1_000, 40, 7)))
    noise = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(10)) == 0
    label = ((x > 600) & (y < 25)) | ((z == 3) & (x < 100))
    return spark.range(3_000).repartition(3).select(
        array_to_vector(F.array(x, y, z, F.lit(1.0))).alias("features"), (label != noise).cast("int").alias(c.TARGET)
    ).persist()


def _forest(**params):
    return md.random_forest(3_000, c.TrainingConfig(**params))


def test_a_fit_takes_no_job_per_level(spark, rows):
    """MLlib needs two jobs for each of the levels, here over twenty."""
    spark.sparkContext.setJobGroup("packed-forest", "fit")
    try:
        model = _forest(trees=4).fit(rows)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("packed-forest")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(t.depth for t in model.trees) > 12 and len(jobs) < 25


@pytest.mark.parametrize("local_rows", [60, 10**9])
@pytest.mark.parametrize("least, depth", [(1, 30), (20, 4)])
def test_every_node_is_right(rows, local_rows, least, depth):
    """Counts, stops and cuts of all nodes, from the weighted rows that reach them; with all variables
    tried, no cut lowers the impurity more than the one taken."""
    data = rows.select(F.expr("features"), c.TARGET)
    data = data.select(fo.vector_to_array("features").alias("x"), F.col(c.TARGET).alias("y"))
    cuts = fo._learned_cuts(data, 3_000, 4, 32, 1)
    assert [len(v) for v in cuts] == [31, 31, 6, 0]
    blocks = fo._packed(data, cuts)
    packed = blocks.collect()
    trees = fo._grown_forest(blocks, 3_000, cuts, 2, 3, 4, depth, least, 5, local_rows)
    discard(blocks)
    values = [np.frombuffer(b["rows"], np.uint8).reshape(5, -1) for b in packed]
    assert sum(v.shape[1] for v in values) == 3_000 and len(values) == 3
    for tree in range(3):
        weights = np.concatenate([fo._weights(5, b["block"], tree, v.shape[1]) for b, v in zip(packed, values)])
        reached = [(tree, np.concatenate(values, 1), weights.astype(float), 0)]
        while reached:
            node, v, w, level = reached.pop()
            counts = np.bincount(v[-1], w, 2)
            assert (trees.counts[node] == counts).all() and trees.tree[node] == tree and level <= depth
            n = counts.sum()
            best = 0.0
            for f, b in ((f, b) for f in range(4) for b in range(len(cuts[f]))):
                below = np.bincount(v[-1], w * (v[f] <= b), 2)
                small, large = below.sum(), n - below.sum()
                if min(small, large) >= least:
                    best = max(best, (below**2).sum() / small / n + ((counts - below) ** 2).sum() / large / n
                               - (counts**2).sum() / n**2)
            left = trees.left[node]
            if left < 0:
                assert level == depth or best < 1e-12
                continue
            assert abs(trees.gain[node] - best) < 1e-12
            goes = v[trees.feature[node]] > trees.cut[node]
            reached += [(left, v[:, ~goes], w[~goes], level + 1), (left + 1, v[:, goes], w[goes], level + 1)]


def test_few_classes_below_a_node_are_merged():
    """As in MLlib: leaves with one prediction become their parent, which keeps its counts."""
    counts = np.array([[9, 4], [9, 1], [0, 3], [5, 0], [4, 1]], float)
    nodes = fo._Nodes(np.zeros(5, np.int32), np.array([0, 1, -1, -1, -1]), np.zeros(5, np.int32),
                      np.array([1, 3, -1, -1, -1]), np.full(5, 0.1), counts)
    kept = nodes.finished()
    assert kept.left.tolist() == [1, -1, -1] and kept.counts.tolist() == counts[:3].tolist()


def test_the_model_is_mllibs(rows, tmp_path):
    model = _forest(trees=30, tree_depth=8, min_instances_per_node=15).fit(rows)
    assert type(model) is RandomForestClassificationModel
    assert (model.getNumTrees, model.numFeatures, model.numClasses) == (30, 4, 2)
    assert max(t.depth for t in model.trees) <= 8 and abs(sum(model.featureImportances) - 1) < 1e-9
    assert model.featureImportances[3] == 0
    model.write().overwrite().save(str(tmp_path / "forest"))
    again = RandomForestClassificationModel.load(str(tmp_path / "forest"))
    assert again.toDebugString.split("\n", 1)[1] == model.toDebugString.split("\n", 1)[1]
    assert _forest(trees=30, tree_depth=8, min_instances_per_node=15).fit(rows).toDebugString.split(
        "\n", 1)[1] == model.toDebugString.split("\n", 1)[1]


def test_trees_are_like_mllibs(rows):
    """Size, importances and hits are those of MLlib's forest but for the draws."""
    mine = _forest(trees=300, tree_depth=10)
    theirs = RandomForestClassifier(**{p.name: v for p, v in mine._paramMap.items()}).fit(rows)
    mine = mine.fit(rows)
    assert abs(mine.totalNumNodes / theirs.totalNumNodes - 1) < 0.1
    assert np.abs(mine.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 0.05
    hits = [m.transform(rows).where(F.col("prediction") == F.col(c.TARGET)).count() for m in (mine, theirs)]
    assert abs(hits[0] - hits[1]) < 45


def test_weights_are_poisson():
    weights = np.concatenate([fo._weights(42, block, tree, 10_000) for block in range(3) for tree in range(3)])
    shares = np.bincount(weights, minlength=9)[:4] / len(weights)
    assert np.allclose(shares, np.exp(-1) / np.array([1, 1, 2, 6]), atol=0.006) and abs(weights.mean() - 1) < 0.01
    assert (fo._weights(42, 0, 1, 100) == fo._weights(42, 0, 1, 100)).all()


def test_growing_is_sent_by_value():
    sent = cloudpickle.dumps(fo._subtree), cloudpickle.dumps(fo._placed_rows)
    assert all(b"_histograms" in x or b"_POISSON" in x for x in sent)
