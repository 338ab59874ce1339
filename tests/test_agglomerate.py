"""Clustering in rounds against clustering in one task, and cuts against following the tree."""

import numpy as np
import pytest

from tomeworks.operators import agglomerate, keywords


def partition(labels):
    out = {}
    for i, c in labels.items():
        out.setdefault(c, set()).add(i)
    return {frozenset(v) for v in out.values()}


def vectors(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, 6))
    return centres[rng.integers(0, 9, n)] + rng.normal(0, 0.4, (n, 6))


def table(spark, x, extra=()):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame([*rows, *extra], "id long, v array<double>")


@pytest.mark.parametrize("last,cell,side", [(0, 30, 25), (30, 1024, 2048)])
def test_distance(spark, monkeypatch, last, cell, side):
    for name, value in (("LAST", last), ("CELL", cell), ("SIDE", side)):
        monkeypatch.setattr(agglomerate, name, value)
    x = vectors(120)
    df = table(spark, x, [(None, [1.0] * 6), (900, None)])
    tree = agglomerate.dendrogram(df, "id", "v", distance=0.15)
    got = agglomerate.clusters_below(spark.range(120).toDF("item"), tree).collect()
    want = keywords.average_linkage(x, distance=0.15)
    assert 9 < len(set(want)) < 110
    assert partition({r["item"]: r["cluster"] for r in got}) == partition(dict(enumerate(want)))
    assert all(r["cluster"] <= r["item"] for r in got)


@pytest.mark.parametrize("last,stages", [(0, (0.05, 0.4, 2.1)), (50, (0.1, 0.8, 2.1)), (4096, agglomerate.STAGES)])
def test_number_and_heights(spark, monkeypatch, last, stages):
    for name, value in (("LAST", last), ("STAGES", stages), ("CELL", 40)):
        monkeypatch.setattr(agglomerate, name, value)
    x = vectors(90, 3)
    tree = agglomerate.dendrogram(table(spark, x), "id", "v")
    heights = sorted(r["height"] for r in tree.collect())
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert np.allclose(heights, [m[0] for m in keywords.merge_order(1 - unit @ unit.T, np.ones(90))])
    ks = [1, 4, 30, 89, 90, 200]
    got = agglomerate.cuts(spark.range(90).toDF("item"), tree, ks).collect()
    for k in ks:
        assert partition({r["item"]: r["cluster"] for r in got if r["k"] == k}) == partition(dict(enumerate(keywords.average_linkage(x, clusters=k))))


def test_equal_and_zero_vectors(spark):
    rows = [(5, [1.0, 0.0]), (3, [2.0, 0.0]), (9, [0.5, 0.0]), (1, [0.0, 0.0]), (2, [0.0, 0.0]), (7, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    tree = sorted((r["item"], r["parent"], r["height"]) for r in agglomerate.dendrogram(df, "id", "v", distance=0.5).collect())
    assert tree == [(2, 1, 0.0), (5, 3, 0.0), (9, 3, 0.0)]
    assert agglomerate.dendrogram(df, "id", "v", distance=0.0).count() == 0
    assert agglomerate.dendrogram(df.where("false"), "id", "v", distance=0.5).count() == 0
    names = spark.createDataFrame([("b", [1.0, 0.1]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0])], "id string, v array<float>")
    assert [tuple(r)[:2] for r in agglomerate.dendrogram(names, "id", "v", distance=0.5).collect()] == [("b", "a")]


def test_near_pairs(spark, monkeypatch):
    """Every pair once in each direction, whatever the cells and sides."""
    x = vectors(150, 5)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    nodes = agglomerate._units(table(spark, x), "id", "v")
    d = 1 - unit @ unit.T
    for cell, side in ((1024, 2048), (10, 20)):
        monkeypatch.setattr(agglomerate, "CELL", cell)
        monkeypatch.setattr(agglomerate, "SIDE", side)
        for limit in (0.02, 0.3):
            got = sorted((r["a"], r["b"]) for r in agglomerate.near_pairs(nodes, limit).collect())
            assert got == [(int(a), int(b)) for a, b in np.argwhere(d < limit) if a != b]


def by_matrix(x, k):
    """The cluster of each row, by the tree that merge_order gives from all distances."""
    return partition(dict(enumerate(keywords.average_linkage(x, clusters=k))))


@pytest.mark.parametrize("searches", [8, 1])
def test_merges_without_distances(monkeypatch, searches):
    monkeypatch.setattr(agglomerate, "SEARCHES", searches)
    monkeypatch.setattr(agglomerate, "AT_ONCE", 1000)
    hub = np.eye(60) + np.linspace(0, 0.5, 60)[:, None]  # one and the same is nearest to many
    for x in (vectors(300), vectors(2), vectors(1), hub):
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        h, a, b = agglomerate.merge_sums(unit, np.ones(len(x)))
        want = keywords.merge_order(1 - unit @ unit.T, np.ones(len(x)))
        assert np.allclose(np.sort(h), [m[0] for m in want]) and len(h) == len(x) - 1
        assert (a < b).all() and len(set(b)) == len(b)
        for k in (1, 7, len(x)):
            assert partition(dict(enumerate(agglomerate.cut_vectors(x, k)))) == by_matrix(x, k)


@pytest.mark.parametrize("whole,tile,numbers", [(16384, 16384, 0), (100, 16384, 1 << 22), (60, 25, 0)])
def test_label_clusters(spark, monkeypatch, whole, tile, numbers):
    """Labels of one task and labels in rounds, of any sizes, at once; copies, zero vectors and broken ones."""
    monkeypatch.setattr(agglomerate, "WHOLE", whole)
    monkeypatch.setattr(agglomerate, "TILE", tile)
    monkeypatch.setattr(agglomerate, "NUMBERS", numbers)
    x = {"a": vectors(180, 1), "b": vectors(130, 2), "c": vectors(30, 3)}
    x["b"] = np.concatenate([x["b"], x["b"][:20], np.zeros((3, 6))])
    x["d"] = np.random.default_rng(6).normal(size=(110, 9))  # of another length
    rows = [(i, [float(v) for v in r], label) for label, part in x.items() for i, r in enumerate(part)]
    rows += [(900, None, "a"), (None, [1.0] * 6, "a"), (901, [1.0] * 6, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label string")
    for k in (8,) if whole < 100 else (1, 8):
        got = agglomerate.label_clusters(df, "label", "id", "v", k).collect()
        assert len(got) == len(rows) - 3
        for label, part in x.items():
            own = {r["id"]: r["cluster_id"] for r in got if r["label"] == label}
            assert partition(own) == by_matrix(part, k)
            firsts = [min(i for i in own if own[i] == c) for c in range(len(set(own.values())))]
            assert firsts == sorted(firsts)
    odd = spark.createDataFrame([(1, [float("nan"), 1.0], 0), (2, [None, 1.0], 0), (3, [1.0, 0.0], 0), (4, [2.0, 0.0], 0)], "id long, v array<double>, label int")
    got = {r["id"]: r["cluster_id"] for r in agglomerate.label_clusters(odd, "label", "id", "v", 3).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: 2}


def test_large_labels_share_rounds(spark, tmp_path, monkeypatch):
    """Six labels beyond one task take about as many Spark jobs as one of them."""
    from tomeworks.plans import normalise

    monkeypatch.setattr(agglomerate, "WHOLE", 60, raising=False)
    jobs = []
    for labels in (1, 6):
        rows = [(i, [float(v) for v in r], n) for n in range(labels) for i, r in enumerate(vectors(90, 7))]
        df = spark.createDataFrame(rows, "id long, v array<double>, label int")
        spark.sparkContext.setJobGroup(f"labels-{labels}", "")
        got = normalise.clusters_of_labels(df, "label", "id", "v", 8, 60)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"labels-{labels}")))
        assert got.select("block", "cluster_id").distinct().count() == 8 * labels
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] < 1.3 * jobs[0]
