"""Hard negatives and centroid clustering: trees against full scans, queries against their SQL, awkward rows."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from aislewatch.llm.centroids import Clustering, VantageTree, cluster, oracle_sql
from aislewatch.llm.negatives import CoverTree, Mining, Wanted, mine_negatives, search

KINDS = "vec_id bigint, label int, embedding array<float>, cluster string, kind string, v string"


def groups(seed, rows, width=8, spread=6):
    """Vectors around a few centres, with repeated ones."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(-300, 300, (5, width))
    points = centres[rng.integers(0, 5, rows)] + rng.integers(-spread, spread + 1, (rows, width))
    points[rows // 2 : rows // 2 + rows // 8] = points[0]
    return points.astype(np.int64)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("count", [1, 2, 3, 16, 60])
def test_vantage_tree_finds_the_nearest_and_smallest(seed, count):
    points, vectors = groups(seed, count), groups(seed + 9, 200)
    vectors[:20] = points[0]
    number, square = VantageTree(points).nearest(vectors)
    all_squares = ((vectors[:, None] - points[None]) ** 2).sum(axis=2)
    assert (square == all_squares.min(axis=1)).all() and (number == all_squares.argmin(axis=1)).all()


def brute_best(vectors, ids, labels, anchor, label, name, low, high, k, same):
    scores = vectors @ anchor
    fits = (labels == label) & (ids != name) if same else labels != label
    fits &= (scores >= (-(1 << 60) if low is None else low)) & (scores <= ((1 << 60) if high is None else high))
    return sorted((-s, i) for s, i in zip(scores[fits].tolist(), ids[fits].tolist(), strict=True))[:k]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("spread", [0, 2, 400])
def test_cover_trees_find_what_a_scan_finds(seed, spread):
    vectors = groups(seed, 600, spread=spread)
    vectors[-3:] = 0
    ids, labels = np.random.default_rng(seed).permutation(600), np.arange(600) % 3
    trees = [CoverTree(vectors[k : k + 200], ids[k : k + 200], labels[k : k + 200]) for k in (0, 200, 400)]
    for tree in trees:  # every vector stands in one bucket, within the radius of its node
        held = np.concatenate(tree.bucket)
        assert sorted(held) == list(range(len(tree.ids)))
        for node, members in enumerate(tree.bucket):
            far = np.linalg.norm(tree.lifted[members] - tree.lifted[tree.centre[node]], axis=1)
            assert (far <= tree.radius[node] + 1e-6 * tree.top).all()
    anchors = vectors[::29]
    limits = [t.bounds(anchors) for t in trees]
    for at, anchor in enumerate(anchors):
        top = int(anchor @ anchor)
        for same in (True, False):
            windows = [(None, None), (top // 2, top * 95 // 100), (0, 0), (-top, -1)]
            wanted = [Wanted((0, 0), low, high, 3) for low, high in windows]
            own = {"v": anchor, "label": labels[at * 29], "vec_id": ids[at * 29]}
            search(trees, limits, at, own, wanted, same)
            for w, (low, high) in zip(wanted, windows, strict=True):
                want = brute_best(vectors, ids, labels, anchor, own["label"], own["vec_id"], low, high, 3, same)
                assert list(zip((-w.scores).tolist(), w.ids.tolist(), strict=True)) == want


def test_cover_tree_leaves_most_of_a_grouped_set_out():
    vectors = groups(1, 2000, width=64)
    tree = CoverTree(vectors, np.arange(2000), np.arange(2000) % 2)
    low, high = tree.bounds(vectors[:1])
    best = np.sort(vectors @ vectors[0])[-5]
    outside = sum(len(b) for b, h in zip(tree.bucket, high[0], strict=True) if h < best)
    assert outside > 1000


@pytest.fixture(scope="module")
def awkward_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(k, int(k % 4), [float(x) for x in rng.normal(size=4)]) for k in range(120)]
    rows += [(k + 1000, 1, rows[0][2]) for k in range(40)]  # a large group of equal vectors
    rows += [rows[50], rows[50], (50, 0, [9.0, 9.0, 9.0, 9.0])]  # repeated rows, and one id with two vectors
    rows += [
        (2000, None, rows[1][2]), (2001, 2, None), (2002, 2, [1.0, None, 2.0, 3.0]), (2003, 2, [1.0, math.nan, 2.0, 3.0]),
        (2004, 2, [math.inf, 0.0, 0.0, 0.0]), (None, 2, rows[2][2]), (2050, 2, []), (2051, 2, []), (2052, 2, [1.0, 2.0]),
        (2100, 2, [1.0, 2.0]), (2054, 3, [1.0, 1.5]), (2150, 3, [0.0, 0.0, 0.0, 0.0]), (-50, 1, rows[3][2]),
    ]
    return spark.createDataFrame([(*r, "c", "k", "v") for r in rows], KINDS).cache()


def oracle(sql, rows, columns):
    con = duckdb.connect()
    con.execute("create table embeddings (vec_id bigint, label int, embedding float[])")
    for r in rows:
        con.execute("insert into embeddings values (?, ?, ?)", [r.vec_id, r.label, r.embedding])
    found = con.sql(sql)
    return sorted((tuple(dict(zip(found.columns, r, strict=True))[c] for c in columns) for r in found.fetchall()), key=repr)


def test_hard_negatives_of_awkward_rows(awkward_vectors):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = mine_negatives(awkward_vectors, label, F.col("vec_id") % 50 == 0)
    want = oracle(entry_module.oracle_sql()["op11_hard_negatives"], awkward_vectors.collect(), found.columns)
    assert len(want) > 10 and sorted(map(tuple, found.collect()), key=repr) == want


def test_clusters_of_awkward_rows(awkward_vectors):
    plan = Clustering(width=4, count=5)
    found = cluster(awkward_vectors, plan)
    want = oracle(oracle_sql(plan), awkward_vectors.collect(), found.columns)
    assert len(want) == 167 and sorted(map(tuple, found.collect()), key=repr) == want


def test_clusters_of_few_or_no_rows(spark, awkward_vectors):
    few = awkward_vectors.filter("vec_id in (1, 2)")
    rows = cluster(few, Clustering(width=4)).collect()
    assert [r.distance for r in rows] == [0, 0] and len({r.cluster for r in rows}) == 2
    first = min((1, 2), key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())
    assert next(r.cluster for r in rows if r.vec_id == first) == 0
    for plan in (Clustering(), Clustering(width=4)):
        assert cluster(awkward_vectors.limit(0), plan).collect() == []
    assert cluster(awkward_vectors, Clustering(width=7)).collect() == []
    with pytest.raises(ValueError):
        cluster(few, Clustering(count=1 << 24))


def test_hard_negatives_of_few_or_no_rows(awkward_vectors):
    always = F.lit(True)
    assert mine_negatives(awkward_vectors.limit(0), F.col("label"), always).collect() == []
    assert mine_negatives(awkward_vectors.filter("vec_id = 1"), F.col("label"), always, Mining()).collect() == []


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_centroids"])
def test_queries_against_their_sql(spark, folder, name):
    found = entry_module.queries()[name](spark, folder)
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    want = oracle(entry_module.oracle_sql()[name], rows, found.columns)
    assert len(want) > 50 and sorted(map(tuple, found.collect()), key=repr) == want
