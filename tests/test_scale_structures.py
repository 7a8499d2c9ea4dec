"""Index structures, assignment, near duplicates, keys and node joins against plain rules, on hot and dense inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aislewatch.operators import assignment, hashing, html, images, neighbours, structure
from aislewatch.operators.hashing import Buckets, nearest_hashes, substrings
from aislewatch.operators.inverted import InvertedFile
from aislewatch.operators.selectors import Elements
from aislewatch.sources import sinks


def unit(vectors):
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def grouped(spark):
    rng = np.random.default_rng(5)
    centres = unit(rng.normal(size=(25, 16)))
    items = unit(centres[rng.integers(0, 25, 1500)] + 0.06 * rng.normal(size=(1500, 16)))
    queries = unit(centres[rng.integers(0, 25, 120)] + 0.06 * rng.normal(size=(120, 16)))
    i = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(items)], "_item long, _v array<double>")
    q = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(queries)], "_query long, _v array<double>")
    scores = np.round(queries @ items.T, 6)
    best = {(n, i) for n in range(120) for _, i in sorted((-s, i) for i, s in enumerate(scores[n]))[:5]}
    return q, i, best


def test_inverted_file_is_exact_and_scores_few_pairs(grouped):
    q, i, best = grouped
    index = InvertedFile(i, neighbours.cosine_frames, block_rows=200)
    rows = index.search(q, 5, exact=True).collect()
    assert {(r["_query"], r["_item"]) for r in rows} == best
    scored = sum({r["_query"]: r["_scored"] for r in rows}.values())
    assert scored < 0.5 * 120 * 1500, scored


def test_inverted_file_recall_of_the_first_visit(grouped):
    q, i, best = grouped
    index = InvertedFile(i, neighbours.cosine_frames)
    rows = index.search(q, 5, first_cells=6, exact=False).collect()
    found = {(r["_query"], r["_item"]) for r in rows}
    scored = sum({r["_query"]: r["_scored"] for r in rows}.values())
    assert len(found & best) / len(best) >= 0.9 and scored < 0.3 * 120 * 1500


def test_inverted_file_with_a_threshold_and_without_items(grouped):
    q, i, best = grouped
    rows = InvertedFile(i, neighbours.cosine_frames).search(q, 5, threshold=0.9).collect()
    assert {(r["_query"], r["_item"]) for r in rows} <= best and all(r["_score"] >= 0.9 for r in rows)
    assert neighbours.nearest(q, i.filter("_item < 0"), "_query", "_item", "_v", 5, broadcast_bytes=0).collect() == []


def words_of(rng, count, near):
    """256-bit hashes around a few, each a few bits away."""
    base = rng.integers(0, 2, (4, 256))
    bits = base[rng.integers(0, 4, count)] ^ (rng.random((count, 256)) < near)
    return np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view(np.int64), bits


@pytest.mark.parametrize("near", [0.01, 0.3])
@pytest.mark.parametrize("scan", [False, True])
def test_multi_index_equals_a_scan(spark, near, scan):
    rng = np.random.default_rng(11)
    (items, item_bits), (queries, query_bits) = words_of(rng, 300, near), words_of(rng, 40, near)
    i = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(items)], "_item long, _v array<bigint>")
    q = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(queries)], "_query long, _v array<bigint>")
    scans = []

    def by_blocks(some, all_items):
        scans.append(1)
        return neighbours._pairs_of_blocks(
            some, all_items, "_query bigint, _item bigint, _score double", 7, "hamming", None, [], 64
        ).select("_query", "_item", (-F.col("_score")).cast("int").alias("_distance"))

    found = nearest_hashes(q, i, 7, by_blocks if scan else None, 0.2 if scan else None)
    got = {(r["_query"], r["_item"], r["_distance"]) for r in found.collect()}
    far = (query_bits[:, None] != item_bits[None]).sum(axis=2)
    assert got == {(n, i, d) for n in range(40) for d, i in sorted((int(d), i) for i, d in enumerate(far[n]))[:7]}
    assert len(scans) == scan


@pytest.mark.parametrize("width", [8, 11, 16])
def test_buckets_within_a_distance_hold_every_near_item(width):
    rng = np.random.default_rng(width)
    items, bits = words_of(rng, 200, 0.1)
    parts = substrings(items, width)
    counts = {}
    for own in parts:
        for part, value in enumerate(own.tolist()):
            counts[part, value] = counts.get((part, value), 0) + 1
    buckets = Buckets([(*key, n) for key, n in counts.items()], parts.shape[1])
    for n in range(0, 200, 20):
        for distance in (0, 5, 23, 60):
            held = {(int(buckets.part[k]), int(buckets.value[k])) for k in buckets.within(parts[n], distance)}
            near = np.flatnonzero((bits != bits[n]).sum(axis=1) <= distance)
            assert all(any((p, int(v)) in held for p, v in enumerate(parts[m])) for m in near)
        enough = buckets.nearest(parts[n], 30)
        assert buckets.items[enough].sum() >= 30


@pytest.mark.parametrize("width", [9, 16])
def test_buckets_are_found_without_a_look_at_all_of_them(width, monkeypatch):
    """Once for each query, that look took the time of the multi-index on large tables."""
    rng = np.random.default_rng(width)
    items, _ = words_of(rng, 3000, 0.2)
    parts = substrings(items, width)
    counts = {}
    for own in parts:
        for part, value in enumerate(own.tolist()):
            counts[part, value] = counts.get((part, value), 0) + 1
    buckets = Buckets([(*key, n) for key, n in counts.items()], parts.shape[1])
    queries, far = np.concatenate((parts[:30], parts[:30] ^ 5)), np.arange(60) * 4
    assert buckets.held(queries, far).tolist() == [buckets.met(own, int(f)) for own, f in zip(queries, far, strict=True)]
    chosen = [buckets._nearest_of_all(own, 50, 0, [], 0) for own in queries]
    monkeypatch.setattr(Buckets, "distances", lambda *_: pytest.fail("all buckets were looked at"))
    assert all(np.array_equal(buckets.nearest(own, 50), c) for own, c in zip(queries, chosen, strict=True))


def test_a_crowded_bucket_gives_the_first_look_few_items(spark, monkeypatch):
    """All items share half of their substrings; a query meets few of them for its first distance, and the result is exact."""
    rng = np.random.default_rng(29)
    items, queries = (rng.integers(-(2**62), 2**62, (n, 2)) for n in (1500, 20))
    items[:, 0] = queries[:, 0] = 77
    i = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(items)], "_item long, _v array<bigint>")
    q = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(queries)], "_query long, _v array<bigint>")
    met, top = [], hashing._top
    monkeypatch.setattr(hashing, "_top", lambda found, k: met.append(found.count()) or top(found, k))
    got = {(r["_query"], r["_item"], r["_distance"]) for r in nearest_hashes(q, i, 3).collect()}
    far = np.bitwise_count((items[None] ^ queries[:, None]).view(np.uint64)).sum(axis=2)
    assert got == {(n, i, d) for n in range(20) for d, i in sorted((int(d), i) for i, d in enumerate(far[n]))[:3]}
    assert met[0] <= 20 * 2 * hashing.FIRST_ITEMS * 3


def serial(edges):
    used, out = set(), {}
    for d in sorted({e[0] for e in edges}):
        for _, s in sorted((r, s) for dd, s, r in edges if dd == d):
            if s not in used:
                used.add(s)
                out[d] = s
                break
    return out


def chain(length):
    """Every db image wants the site that the one before it wants too, and gets its second choice."""
    return [(d, s, r) for d in range(length) for r, s in enumerate((d, d + 1)) if d or r] + [(0, 1, 0)]


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    out = run()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, jobs


@pytest.mark.parametrize("length, settled, others", [(1000, 200_000, 0), (1000, 2_200, 300), (120, 50, 0)])
def test_a_chain_of_refusals_takes_few_jobs(spark, length, settled, others):
    edges = chain(length) + [(5000 + k, 5000 + k, 0) for k in range(others)]
    df = spark.createDataFrame(edges, "db_id long, site_id long, rank int")
    rows, jobs = jobs_of(spark, f"chain-{length}-{settled}", lambda: assignment.serial_assignment(df, settled).collect())
    assert {r["db_id"]: r["site_id"] for r in rows} == serial(edges)
    assert jobs < (20 if settled > len(edges) else 300), jobs


@pytest.mark.parametrize("seed, settled", [(0, 25)])
def test_components_and_rounds_equal_the_serial_rule(spark, seed, settled):
    rnd = random.Random(seed)
    edges = [(d, s, r) for d in range(30) for r, s in enumerate(rnd.sample(range(22), rnd.randint(0, 3)))]
    df = spark.createDataFrame(edges, "db_id long, site_id long, rank int")
    assert {r["db_id"]: r["site_id"] for r in assignment.serial_assignment(df, settled).collect()} == serial(edges)


def leader_pass(rows, most):
    kept, hashes = [], []
    for pos, h in sorted(rows):
        if not any(bin((h ^ g) & (2**64 - 1)).count("1") <= most for g in hashes):
            hashes.append(h)
            kept.append(pos)
    return kept


@pytest.mark.parametrize("settled", [20_000, 50])
def test_dense_near_copies(spark, settled):
    rnd = random.Random(4)
    base = rnd.getrandbits(63)
    near = [(pos, base ^ sum(1 << b for b in rnd.sample(range(63), rnd.randint(0, 3)))) for pos in range(5000)]
    others = [(5000 + n, rnd.getrandbits(63)) for n in range(100)]
    rows = [(1, *r) for r in near + others] + [(2, 9000 + n, h) for n, (_, h) in enumerate(others)]
    df = spark.createDataFrame(rows, "p int, pos int, h long")
    got = images.drop_near_duplicates(df, "p", "pos", "h", 4, settled_hashes=settled).collect()
    want = [(p, pos) for p in (1, 2) for pos in leader_pass([r[1:] for r in rows if r[0] == p], 4)]
    assert sorted((r.p, r.pos) for r in got) == sorted(want)


def longest_run(numbers):
    return max((sum(1 for _ in iter(lambda it=iter(range(n, 2000)): next(it) in numbers, False)) for n in numbers), default=0)


def test_runs_of_numbers_across_planes(spark):
    rnd = random.Random(2)
    sets = [set(), {0}, {63, 64, 65}, set(range(50, 140)), {999}, set(range(0, 1000)), {1, 3, 5}, {127, 128, 500}]
    sets += [{rnd.randint(0, 999) for _ in range(rnd.randint(1, 400))} for _ in range(20)]
    rows = [(k, n) for k, s in enumerate(sets) for n in (s or [None])]
    df = spark.createDataFrame(rows, "k int, n int").repartition(3)
    planes = images._planes(F.col("n"))
    held = df.groupBy("k").agg(*[v.alias(name) for name, v in planes.items()])
    got = {r.k: r.run for r in held.select("k", images._longest_run([F.col(p) for p in planes]).alias("run")).collect()}
    assert got == {k: longest_run(s) for k, s in enumerate(sets)}


def claimed(rows, taken):
    given, used, counts, out = {k for _, k in rows}, set(taken), {}, {}
    for at, key in sorted(rows):
        if key not in used and key not in out.values():
            out[at] = key
            continue
        n = counts.get(key, 0)
        while True:
            n += 1
            made = f"{key}_{n:02d}"
            if made not in used and made not in given:
                break
        counts[key], out[at] = n, made
    return out


@pytest.mark.parametrize("seed, width", [(0, 1_000_000), (1, 5), (2, 3)])
def test_keys_are_unique_within_and_across_batches(spark, tmp_path, seed, width):
    rnd = random.Random(seed)
    names = ["x", "x_01", "x_02", "x_1", "y", "x_01_01", "x_10", "x_11", "hot"]
    first = [(n, "hot" if n % 3 == 0 else rnd.choice(names)) for n in range(90)]
    second = [(n, "hot" if n % 3 == 0 else rnd.choice(names)) for n in range(90)]
    path = f"{tmp_path}/taken"
    assert sinks.taken_keys(spark, "key", path).collect() == []
    kinds = "at long, key string"
    one = sinks.unique_keys(spark.createDataFrame(first, kinds), "key", "at", sinks.taken_keys(spark, "key", path), width)
    got = {r["at"]: r["key"] for r in one.collect()}
    assert got == claimed(first, set()) and len(set(got.values())) == 90
    sinks.record_keys(spark.createDataFrame(list(got.items()), kinds), "key", path)
    two = sinks.unique_keys(spark.createDataFrame(second, kinds), "key", "at", sinks.taken_keys(spark, "key", path), width)
    again = {r["at"]: r["key"] for r in two.collect()}
    assert again == claimed(second, set(got.values())) and len({*again.values(), *got.values()}) == 180


def test_the_generated_key_that_a_row_has_is_passed_over(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x_01")], "at long, key string")
    assert {r["at"]: r["key"] for r in sinks.unique_keys(df, "key", "at").collect()} == {1: "x", 2: "x_02", 3: "x_01"}


def page_of(rnd, depth=0):
    out = []
    for _ in range(rnd.randint(0, 4)):
        tag = rnd.choice(["div", "p", "span", "ul"])
        cls = rnd.choice(["", ' class="a"', ' class="b c"', ' id="x"', ' data-k="one two"'])
        inner = page_of(rnd, depth + 1) if depth < 5 else ""
        out.append(f"<{tag}{cls}>{rnd.choice(['', 'word '])}{inner}</{tag}>{rnd.choice(['', ' tail'])}")
    return "".join(out)


SELECTORS = ["div", ".a", "div p", "div > p", ".a ~ p", "p + span", "div .b > span", "#x, .c", "[data-k*='two'] div", "ul div ~ p span", "* > *"]


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(8)
    pages = [(k, page_of(rnd)) for k in range(25)] + [(99, "<div class=a>" + "<p>x<span class=b>y</span></p>" * 4000 + "</div>"), (100, "")]
    parsed = html.parse_pages(spark.createDataFrame(pages, "k int, html string")).cache()
    return pages, html.node_table(parsed, "k").cache(), html.text_table(parsed, "k").cache()


@pytest.mark.parametrize("selector", SELECTORS)
def test_selectors_over_rows(tables, selector):
    pages, nodes, _ = tables
    got = sorted((r.k, r.node) for r in structure.select_rows(nodes, "k", selector).collect())
    want = sorted((k, n) for k, page in pages for n in Elements(html._parse(page)["nodes"]).select(selector))
    assert got == want


def test_texts_over_rows(tables):
    pages, nodes, texts = tables
    got = {(r.k, r.node): r.text for r in structure.text_of_rows(nodes, texts, "k").collect()}
    want = {}
    for k, page in pages:
        tree = html._parse(page)
        want |= {(k, n["node"]): " ".join(tree["texts"][n["t_from"] : n["t_to"]]) for n in tree["nodes"]}
    assert got == want


def test_contained_pairs_nest(spark):
    outer = spark.createDataFrame([(1, 0, 9000), (1, 10, 20), (1, 12, 12), (1, 4000, 4200), (2, 5, 6), (None, 1, 9)], "k int, lo int, hi int")
    inner = spark.createDataFrame([(1, 12), (1, 4100), (1, 9001), (1, 8999), (2, 4), (2, 6), (1, None)], "k int, x int")
    got = {(r.k, r.lo, r.x) for r in structure.contained(outer, inner, "k", "lo", "hi", "x").collect()}
    assert got == {(1, 0, 12), (1, 10, 12), (1, 12, 12), (1, 0, 4100), (1, 4000, 4100), (1, 0, 8999), (2, 5, 6)}
    best = {(r.k, r.lo, r.x) for r in structure.contained(outer, inner, "k", "lo", "hi", "x", nearest=True).collect()}
    assert best == {(1, 12, 12), (1, 4000, 4100), (1, 0, 8999), (2, 5, 6)}
