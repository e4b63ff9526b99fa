import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from aval import config as c
from aval.errors import EvaluationError, InvalidTrainingDataError
from aval.operators import segments as sg


def brute(points, labels, squared):
    x = np.array(points)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    d = d ** 2 if squared else d
    result = []
    for i, s in enumerate(labels):
        same = [j for j, t in enumerate(labels) if t == s]
        if len(same) == 1:
            result.append(0.0)
            continue
        a = d[i, same].sum() / (len(same) - 1)
        b = min(d[i, [j for j, t in enumerate(labels) if t == o]].mean() for o in set(labels) - {s})
        result.append(0.0 if max(a, b) == 0 else (b - a) / max(a, b))
    return result


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(1)
    points = np.round(rng.normal(size=(60, 3)), 3).tolist()
    # One cluster holds most rows, one has a single member.
    labels = [2 if i == 0 else (0 if i % 3 else 1) for i in range(60)]
    df = spark.createDataFrame([(i, s, p) for i, (s, p) in enumerate(zip(labels, points))],
                               "id int, segmento int, v array<double>").repartition(5)
    return df, points, labels


@pytest.mark.parametrize("block", [7, 25, 1000])
def test_euclidean_silhouette_equals_brute_force(cloud, block):
    df, points, labels = cloud
    found = {r["id"]: r["silueta"] for r in
             sg.silhouette_euclidean(df, "v", "segmento", "id", block).collect()}
    assert len(found) == 60
    for i, value in enumerate(brute(points, labels, False)):
        assert math.isclose(found[i], value, abs_tol=1e-12)


def test_squared_silhouette_equals_brute_force(cloud):
    df, points, labels = cloud
    found = {r["id"]: r["silueta"] for r in sg.silhouette_squared(df, "v", "segmento", "id").collect()}
    for i, value in enumerate(brute(points, labels, True)):
        assert math.isclose(found[i], value, abs_tol=1e-9)
    with pytest.raises(EvaluationError):
        sg.silhouette_squared(df.filter("segmento = 0"), "v", "segmento", "id")


@pytest.fixture(scope="module")
def groups(spark):
    return spark.range(90).selectExpr(
        "id", "(id % 3) * 10.0D + (id % 7) * 0.1D as x", "(id % 3) * -5.0D + (id % 5) * 0.1D as y").persist()


def test_segments_recover_groups_and_assign_the_nearest(spark, groups, tmp_path):
    model = sg.fit_segments(groups, ["x", "y"], 3, starts=3)
    assert model.centres == sorted(model.centres) and model.k == 3
    assigned = model.assign(groups)
    assert assigned.filter("segmento != id % 3").count() == 0
    for r in assigned.collect():
        near = min(range(3), key=lambda i: (r["x"] - model.centres[i][0]) ** 2 + (r["y"] - model.centres[i][1]) ** 2)
        assert near == r["segmento"]
    assert {r["n_clientes"] for r in sg.segment_sizes(assigned, 4).collect()} == {30, 0}
    model.save(spark, str(tmp_path / "m"))
    assert sg.SegmentModel.load(spark, str(tmp_path / "m")) == model
    arrays = groups.select("id", F.array("x", "y").alias("v"))
    other = sg.nearest_centre(arrays, "v", list(enumerate(model.centres)))
    assert other.join(assigned, "id").filter(other["segmento"] != assigned["segmento"]).count() == 0
    with pytest.raises(InvalidTrainingDataError):
        sg.fit_segments(groups.limit(2), ["x", "y"], 3, starts=1)


def test_silhouette_by_k_marks_model_and_suggestion(groups):
    config = c.EvaluationConfig(segment_counts=(2, 3, 90), silhouette_block=40,
                                silhouette_metric="euclidean")
    training = c.TrainingConfig(segment_starts=2)
    rows = {r["k"]: r for r in sg.silhouette_by_k(groups, ["x", "y"], "id", config, training).collect()}
    assert set(rows) == {2, 3}  # k must stay below the number of rows
    assert rows[3]["sugerido"] and rows[3]["es_el_modelo"] and not rows[2]["sugerido"]
    assert rows[3]["estructura"] == "fuerte" and rows[3]["metrica"] == "euclidean"


def test_suggestion_takes_the_smallest_k_on_a_tie(spark):
    plain = spark.createDataFrame([(2, 0.3), (3, 0.5), (4, 0.5), (5, 0.1)], "k int, silueta double")
    squared = sg.with_suggestion(plain.selectExpr("*", "'squaredEuclidean' AS metrica")).collect()
    assert {r["estructura"] for r in squared} == {None}  # the limits are Euclidean
    table = plain.selectExpr("*", "'euclidean' AS metrica")
    rows = {r["k"]: r for r in sg.with_suggestion(table).collect()}
    assert [k for k, r in rows.items() if r["sugerido"]] == [3]
    assert [rows[k]["estructura"] for k in (2, 3, 5)] == ["moderada", "fuerte", "débil"]


def test_profiles_undo_scaling(spark):
    df = spark.createDataFrame([(0, -1.0, 1.0, 1), (0, 1.0, 0.0, 0), (1, 3.0, 0.0, 0)],
                               "segmento int, x double, flag double, credito_aprobado int")
    rows = {r["segmento"]: r for r in sg.segment_profiles(df, ["x", "flag"], {"x": (10.0, 2.0)}).collect()}
    assert (rows[0]["n_clientes"], rows[0]["x"], rows[0]["flag"], rows[0]["tasa_aprobacion"]) == (2, 10.0, 0.5, 0.5)
    assert rows[1]["x"] == 16.0


def test_plane_equals_the_eigen_decomposition(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4)) + 5
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double, d double")
    plane = sg.fit_plane(df, ["a", "b", "c", "d"])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    order = values.argsort()[::-1]
    assert np.allclose(plane.explained, values[order][:2] / values.sum())
    scores = plane.project(df).orderBy("id").select("c1", "c2").toPandas().to_numpy()
    assert np.allclose(scores.mean(axis=0), 0)
    for j in range(2):
        expected = (x - x.mean(axis=0)) @ vectors[:, order[j]]
        assert np.allclose(np.abs(scores[:, j]), np.abs(expected))
        assert max(plane.components[j], key=abs) > 0


@pytest.mark.parametrize("measure", [sg.silhouette_euclidean, sg.silhouette_squared])
def test_silhouette_edge_cases(spark, measure):
    rows = [(1, 0, [0.0]), (1, 0, [1.0]), (None, 1, [9.0]), (1, 1, [8.0])]
    df = spark.createDataFrame(rows, "id long, segmento int, v array<double>")
    assert measure(df, "v", "segmento", "id").count() == 4  # repeated ids stay rows
    with pytest.raises(EvaluationError):
        measure(df.filter("segmento = 0"), "v", "segmento", "id")
    with pytest.raises(EvaluationError):
        measure(df, "v", "segmento", "id", max_segments=1)
    broken = df.union(spark.createDataFrame([(5, 1, None)], df.schema))
    with pytest.raises(Exception, match="complete vector"):
        measure(broken, "v", "segmento", "id").collect()


def test_anchors_estimate_the_euclidean_silhouette_and_its_error(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    centres = np.array([[0.0, 0.0], [4.0, 0.0], [0.0, 5.0]])
    s = rng.choice(3, 900, p=[0.6, 0.3, 0.1])
    points = centres[s] + rng.normal(size=(900, 2)) + 1e5  # far from the origin
    rows = [(i, int(g), p.tolist()) for i, (g, p) in enumerate(zip(s, points))]
    rows += [(900, 3, [1e5 + 50.0, 1e5])]  # a lone member
    df = spark.createDataFrame(rows, "id long, segmento int, v array<double>").repartition(5)
    exact = sg.mean_silhouette(sg.silhouette_euclidean(df, "v", "segmento", "id", 200)).first()["silueta"]
    whole = sg.silhouette_by_anchors(df, "v", "segmento", "id")
    assert abs(whole.value - exact) < 1e-9 and whole.error == 0 and whole.rows == 901
    few = [sg.silhouette_by_anchors(df, "v", "segmento", "id", n) for n in (20, 60)]
    assert all(0 < f.error and abs(f.value - exact) < 4 * f.error for f in few)
    assert few[1].error < few[0].error < 0.1
    again = sg.silhouette_by_anchors(df.repartition(3), "v", "segmento", "id", 20)
    assert abs(again.value - few[0].value) < 1e-12


def test_strength_follows_from_the_interval(spark):
    table = spark.createDataFrame(
        [(2, 0.52, 0.02, "euclidean"), (3, 0.6, 0.02, "euclidean"), (4, 0.1, 0.01, "euclidean"), (5, 0.9, 0.0, "squaredEuclidean")],
        "k int, silueta double, error_estandar double, metrica string")
    got = {r["k"]: (r["estructura"], r["estructura_segura"]) for r in sg.with_suggestion(table).collect()}
    assert got == {2: ("fuerte", False), 3: ("fuerte", True), 4: ("débil", True), 5: (None, None)}


@pytest.mark.parametrize("block, group_rows", [(7, 7), (7, 20), (25, 1)])
def test_euclidean_silhouette_over_many_groups(cloud, block, group_rows):
    df, points, labels = cloud
    far = df.withColumn("v", F.transform("v", lambda x: x + 1e5))  # squares of a far cloud lose digits
    for rows, tolerance in ((df, 1e-12), (far, 1e-8)):
        found = {r["id"]: r["silueta"] for r in sg.silhouette_euclidean(
            rows, "v", "segmento", "id", block, group_rows=group_rows).collect()}
        assert len(found) == 60
        for i, value in enumerate(brute(points, labels, False)):
            assert math.isclose(found[i], value, abs_tol=tolerance)


def test_pairs_are_measured_like_differences():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(50, 4)), rng.normal(size=(40, 4))
    y[:10] = x[:10] + 1e-9
    y[10] = x[10]
    y[11, 0] = np.inf
    with np.errstate(all="ignore"):
        straight = np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(-1))
    assert np.allclose(sg._distances(x, y), straight, rtol=1e-12, atol=0)


def test_all_starts_of_all_k_share_the_scans(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame(np.round(rng.normal(size=(900, 3)), 3).tolist(), "x double, `y.z` double, w double")
    rows = rows.repartition(4).persist()
    names, calls, whole = ["x", "y.z", "w"], [], sg._centre_sums
    monkeypatch.setattr(sg, "_centre_sums", lambda c, m: calls.append(len(c)) or whole(c, m))
    found = sg.fit_segments_by_k(rows, names, [4, 2], starts=3, iterations=100, checked=True)
    assert calls[0] == 6 and len(calls) <= 100 and calls == sorted(calls, reverse=True)
    data = sg.assemble(rows, names).select("features").persist()
    for k, model in found.items():
        best = min((sg.KMeans(k=k, maxIter=100, seed=42 + start, initSteps=2, tol=1e-4).fit(data)
                    for start in range(3)), key=lambda m: m.summary.trainingCost)
        assert math.isclose(model.cost, best.summary.trainingCost, rel_tol=1e-9)
        assert np.allclose(model.centres, sorted(map(list, best.clusterCenters())), atol=1e-9)


def test_the_fitted_models_silhouette_is_not_measured_again(groups, monkeypatch):
    config, training = c.EvaluationConfig(segment_counts=(2, 3)), c.TrainingConfig(segment_starts=2)
    model = sg.fit_segments(groups, ["x", "y"], 3, starts=2)
    own, counts, measure = sg.model_silhouette(groups, model, "id"), [], sg.model_silhouette
    monkeypatch.setattr(sg, "model_silhouette", lambda d, m, *a: counts.append(m.k) or measure(d, m, *a))
    rows = {r["k"]: r["silueta"] for r in sg.silhouette_by_k(
        groups, ["x", "y"], "id", config, training, None, model, own).collect()}
    assert counts == [2] and rows[3] == own.value


def test_anchor_cells_may_be_empty_and_few(spark):
    rng = np.random.default_rng(6)
    points, labels = rng.normal(size=(40, 2)).tolist(), [0] * 3 + [7] * 37
    df = spark.createDataFrame([(i, s, p) for i, (s, p) in enumerate(zip(labels, points))],
                               "id int, segmento int, v array<double>")
    found = sg.silhouette_by_anchors(df, "v", "segmento", "id")
    assert math.isclose(found.value, float(np.mean(brute(points, labels, False))), abs_tol=1e-12)
    assert found.error == 0.0 and found.rows == 40


def test_groupings_share_the_distances(cloud, monkeypatch):
    df, points, labels = cloud
    other = [None if i % 11 == 5 else -1 if i % 2 else 4 for i in range(60)]
    both = df.withColumn("otra", F.when(F.col("id") % 11 != 5, F.when(F.col("id") % 2 == 1, -1).otherwise(4)))
    calls, pairs = [], sg._pair_sums
    monkeypatch.setattr(sg, "_pair_sums", lambda groupings: calls.append(groupings) or pairs(groupings))
    found = {(r["agrupacion"], r["id"]): (r["segmento"], r["silueta"]) for r in sg.silhouettes_euclidean(
        both, "v", ["segmento", "otra"], "id", 7, group_rows=20).collect()}
    assert calls == [[[0, 1, 2], [-1, 4]]]
    kept = [i for i in range(60) if other[i] is not None]
    second = brute([points[i] for i in kept], [other[i] for i in kept], False)
    wanted = {("segmento", i): (labels[i], v) for i, v in enumerate(brute(points, labels, False))}
    wanted |= {("otra", i): (other[i], v) for i, v in zip(kept, second)}
    assert found.keys() == wanted.keys()
    for at, (label, value) in wanted.items():
        assert found[at][0] == label and math.isclose(found[at][1], value, abs_tol=1e-12)


def test_packing_and_moving_are_sent_by_value():
    for function in (sg._as_blocks(), sg._centre_sums([np.zeros((2, 3))], np.zeros(3))):
        assert "<locals>" in function.__qualname__  # workers need not import this package


def test_the_seeding_scans_do_not_choose_a_solver(groups, monkeypatch):
    made, kmeans = [], sg.KMeans
    monkeypatch.setattr(sg, "KMeans", lambda **o: made.append(o) or kmeans(**o))
    sg.fit_segments(groups, ["x", "y"], 3, starts=2)
    assert [o.pop("solver") for o in made] == ["block"] * 2
    data = sg.assemble(groups, ["x", "y"]).select("features").persist()
    for options in made:
        chosen, block = (np.array(kmeans(**options, solver=s).fit(data).clusterCenters()) for s in ("row", "block"))
        assert np.array_equal(chosen, block)
