"""Exactness of the list, neighbour and assignment operators against plain sequential rules."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aislewatch.operators import assignment, images, neighbours
from aislewatch.plans import matching


def _brute(queries, items, k, threshold=None):
    out = set()
    for qid, q in queries:
        scored = sorted((-round(float(np.dot(q, v)), 6), i) for i, v in items)[:k]
        out |= {(qid, i, -s) for s, i in scored if threshold is None or -s >= threshold}
    return out


@pytest.fixture(scope="module")
def skewed(spark):
    """Vectors in clusters; a third of both sides are copies of one vector."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 8))

    def side(n, seed):
        r = np.random.default_rng(seed)
        rows = []
        for i in range(n):
            v = centres[0] if i % 3 == 0 else centres[i % 6] + 0.3 * r.normal(size=8)
            rows.append((i, (v / np.linalg.norm(v)).tolist()))
        return rows

    queries, items = side(90, 1), side(120, 2)
    q = spark.createDataFrame(queries, "q long, v array<double>")
    i = spark.createDataFrame(items, "i long, v array<double>")
    return queries, items, q, i


@pytest.mark.parametrize("threshold", [None, 0.7, 0.95])
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_nearest_equals_brute_force(skewed, threshold, limit):
    queries, items, q, i = skewed
    got = neighbours.nearest(q, i, "q", "i", "v", 4, threshold=threshold, broadcast_bytes=limit, block_rows=16)
    rows = [(r["q"], r["i"], round(r["score"], 6)) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == _brute(queries, items, 4, threshold)


def test_nearest_within_scopes(skewed):
    queries, items, q, i = skewed
    scope = lambda c: F.when(F.col(c) % 2 == 0, 0).otherwise(F.col(c) % 7)
    got = neighbours.nearest(
        q.withColumn("s", scope("q")), i.withColumn("s", scope("i")), "q", "i", "v", 3, threshold=0.6, scope=["s"], block_rows=8
    )
    key = lambda n: 0 if n % 2 == 0 else n % 7
    want = set()
    for s in {key(n) for n, _ in queries}:
        want |= _brute([x for x in queries if key(x[0]) == s], [x for x in items if key(x[0]) == s], 3, 0.6)
    assert {(r["q"], r["i"], round(r["score"], 6)) for r in got.collect()} == want


def test_nearest_without_items(skewed):
    _, _, q, i = skewed
    none = i.filter("i < 0")
    assert neighbours.nearest(q, none, "q", "i", "v", 3).count() == 0
    assert neighbours.nearest(q, none, "q", "i", "v", 3, threshold=0.7, broadcast_bytes=0).count() == 0


def _serial(edges):
    used, out = set(), {}
    for d in sorted({e[0] for e in edges}):
        for _, s in sorted((r, s) for dd, s, r in edges if dd == d):
            if s not in used:
                used.add(s)
                out[d] = s
                break
    return out


@pytest.mark.parametrize("seed", range(6))
def test_serial_assignment(spark, seed):
    rnd = random.Random(seed)
    edges = []
    for d in range(14):
        sites = rnd.sample(range(10), rnd.randint(0, 6))
        edges += [(d, s, r) for r, s in enumerate(sites)]
    df = spark.createDataFrame(edges, "db_id long, site_id long, rank int")
    got = {r["db_id"]: r["site_id"] for r in assignment.serial_assignment(df).collect()}
    assert got == _serial(edges)


def _sequential_match(cands):
    """Best candidate per db in rank order, then greedy by (similarity, inliers, db order)."""
    need = lambda s: next((n for low, n in ((0.95, 8), (0.9, 12), (0.8, 15), (0.7, 20)) if s >= low), 15)
    best = []
    for d in sorted({c[0] for c in cands}):
        top = None
        for _, s, sim, inl in sorted((c for c in cands if c[0] == d), key=lambda c: (-c[2], c[1])):
            inl = 999 if sim >= 0.94 else inl
            ok = inl >= need(sim)
            if top is None or (ok and not top[4]) or (ok == top[4] and (inl, sim) > (top[3], top[2])):
                top = (d, s, sim, inl, ok)
        best.append(top)
    best.sort(key=lambda b: (-b[2], -b[3]))
    used, out = set(), {}
    for d, s, _, _, ok in best:
        if s not in used and ok:
            used.add(s)
            out[d] = s
    return out


@pytest.mark.parametrize("seed", range(4))
def test_embedding_choice_equals_sequential_rule(spark, seed):
    rnd = random.Random(seed)
    cands = [
        (d, s, rnd.choice([0.7, 0.75, 0.8, 0.85, 0.9, 0.94, 0.97]), rnd.randint(0, 25))
        for d in range(25)
        for s in rnd.sample(range(12), 4)
    ]
    df = spark.createDataFrame(cands, "db_id long, site_id long, sim double, inliers int")
    best = assignment.best_candidate(assignment.judge(df))
    out = assignment.split_matches(df.select("db_id").distinct(), best).collect()
    matched = {r["db_id"]: r["site_id"] for r in out if r["status"] == "match"}
    assert matched == _sequential_match(cands)
    assert len(set(matched.values())) == len(matched)
    assert len(out) == 25


def test_without_exclusion_a_site_may_repeat(spark):
    df = spark.createDataFrame([(1, 5, 0.96, 0), (2, 5, 0.97, 0)], "db_id long, site_id long, sim double, inliers int")
    best = assignment.best_candidate(assignment.judge(df))
    rows = assignment.split_matches(df.select("db_id"), best, exclusive=False).collect()
    assert [r["status"] for r in rows] == ["match", "match"]


def test_unknown_algorithm(spark):
    with pytest.raises(ValueError):
        matching.match_images("other", None, None)


def test_hash_shortlist_fills_up_with_unreadable(spark):
    db = spark.createDataFrame([(1, [0, 0, 0, 0]), (2, None)], "db_id long, phash array<long>")
    site = spark.createDataFrame([(10, None), (11, [1, 0, 0, 0]), (12, None), (13, [3, 0, 0, -1])], "site_id long, phash array<long>")
    rows = matching.hash_shortlist(db, site, top_k=3).collect()
    got = {(r["db_id"], r["rank"]): (r["site_id"], r["distance"]) for r in rows}
    assert got == {
        (1, 1): (11, 1), (1, 2): (13, 66), (1, 3): (10, 999999),
        (2, 1): (10, 999999), (2, 2): (11, 999999), (2, 3): (12, 999999),
    }


def _leader_pass(rows, most):
    kept, hashes = [], []
    for pos, h in sorted(rows):
        if h is None:
            kept.append(pos)
        elif not any(bin((h ^ g) & (2**64 - 1)).count("1") <= most for g in hashes):
            hashes.append(h)
            kept.append(pos)
    return kept


@pytest.mark.parametrize("seed, most", [(0, 4), (1, 4), (2, 1), (3, 0)])
def test_near_duplicates(spark, seed, most):
    rnd = random.Random(seed)
    base = [rnd.getrandbits(63) for _ in range(4)]
    rows = []
    for pos in range(80):
        h = base[0] if pos % 3 == 0 else rnd.choice(base)
        if pos % 3:
            for _ in range(rnd.randint(0, 6)):
                h ^= 1 << rnd.randint(0, 62)
        rows.append((pos % 2, pos, None if pos % 17 == 5 else h))
    df = spark.createDataFrame(rows, "p int, pos int, h long")
    got = sorted(r["pos"] for r in images.drop_near_duplicates(df, "p", "pos", "h", most).collect())
    want = sorted(sum((_leader_pass([(x[1], x[2]) for x in rows if x[0] == p], most) for p in (0, 1)), []))
    assert got == want


def test_distinct_first_is_idempotent(spark):
    rows = [(1, "b", 3), (1, "a", 1), (1, "b", 2), (2, "a", 9), (1, "a", 7)]
    df = spark.createDataFrame(rows, "page int, key string, pos int")
    once = images.distinct_first(df, "page", "key", "pos")
    twice = images.distinct_first(once, "page", "key", "pos")
    want = [(1, "a", 1), (1, "b", 2), (2, "a", 9)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == want


def test_ratio_test_needs_enough_descriptors(spark):
    rows = [(1, n, [float(n), 0.0]) for n in range(6)] + [(2, 100 + n, [n + 0.01, 0.0]) for n in range(6)] + [(3, 200, [1.0, 1.0])]
    descriptors = spark.createDataFrame(rows, "image_id long, descriptor_no long, descriptor array<double>")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a_id long, b_id long")
    got = {(r["a_id"], r["b_id"]): r["good_matches"] for r in neighbours.ratio_test(pairs, descriptors).collect()}
    assert got == {(1, 2): 6, (1, 3): 0}
    floored = neighbours.ratio_test(pairs, descriptors, floor_zero=True).collect()
    assert {r["good_matches"] for r in floored} == {0}
