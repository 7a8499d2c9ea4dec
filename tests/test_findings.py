"""Findings on larger or odd tables, each by a small input that shows it."""

import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from aislewatch import session
from aislewatch.operators import enrich, images, neighbours
from aislewatch.operators.hashing import Block, substrings
from aislewatch.plans import matching


def _both(spark, folder, name, *tables):
    """Rows of a query and of its SQL over the parquet files of a folder."""
    df = entry_module.queries()[name](spark, folder)
    con = duckdb.connect()
    for table in tables:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    theirs = con.execute(f"SELECT {', '.join(df.columns)} FROM ({entry_module.oracle_sql()[name]})").fetchall()
    return sorted(tuple(r) for r in df.collect()), sorted(theirs)


def test_names_with_letters_outside_the_table(spark, tmp_path):
    titles = ["ASCIÓNAS Ñ É", "Łódź – å æ œ", "Größe ÄÖ ñç", "Ó"]
    pages = [(n, f"u{n}", f"<title>{t}</title>") for n, t in enumerate(titles)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    ours, theirs = _both(spark, str(tmp_path), "U15_safe_name", "pages")
    assert ours == theirs


def test_hashes_that_no_bucket_rules_out_meet_in_blocks():
    """The second look of the multi-index: through a block's buckets and beside them, against all distances."""
    rng = np.random.default_rng(5)
    items = rng.integers(-(2**62), 2**62, (700, 4))
    items[350:] = items[:350] ^ rng.integers(0, 2, (350, 4))
    block = Block(items, 10)
    for own in (*items[:20], *rng.integers(-(2**62), 2**62, (20, 4))):
        far = np.bitwise_count((items ^ own).view(np.uint64)).sum(axis=1)
        order = np.argsort(far, kind="stable")[:12]
        for most in (256, int(far[order[-1]])):
            for parts in (None, substrings(own[None, :], 10)[0]):
                rows, distances = block.nearest(own, parts, most, 12)
                assert rows.tolist() == order.tolist() and distances.tolist() == far[order].tolist()


@pytest.mark.parametrize("metric, threshold", [("cosine", None), ("cosine", 0.3), ("hamming", None), ("l2", None)])
def test_best_of_many_tiles_are_those_of_all_pairs(monkeypatch, metric, threshold):
    monkeypatch.setattr(neighbours, "_TILE", 16)
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(30, 8)), np.repeat(rng.normal(size=(60, 8)), 2, axis=0)
    x, y = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (x, y))
    if metric == "hamming":
        x, y = np.sign(x).astype(np.float32), np.sign(y).astype(np.float32)
    rows, cols, scores = neighbours._best(x, y, 5, metric, threshold)
    for n in range(len(x)):
        if metric == "cosine":
            all_scores = np.round(y @ x[n], 6)
        elif metric == "hamming":
            all_scores = -(x[n] != y).sum(axis=1).astype(float)
        else:
            all_scores = -np.round(np.linalg.norm(y - x[n], axis=1), 6)
        order = [c for c in np.argsort(-all_scores, kind="stable")[:5] if threshold is None or all_scores[c] >= threshold]
        assert cols[rows == n].tolist() == order
        assert np.allclose(scores[rows == n], all_scores[order])


def test_images_are_parted_by_key_before_they_are_sorted(spark):
    """No sort of a whole reader's rows: the first exchange stands below the first aggregate."""
    rows = spark.createDataFrame([(1, "a", 2, "x"), (1, "a", 1, "y"), (2, "b", 0, "z")], "page long, key string, pos int, url string")
    found = images.distinct_first(rows, "page", "key", "pos")
    assert sorted(tuple(r) for r in found.collect()) == [(1, "a", 1, "y"), (2, "b", 0, "z")]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("REPARTITION_BY_COL") > plan.rindex("Aggregate")


@pytest.mark.parametrize("metric", ["cosine", "hamming"])
def test_tiles_are_scored_in_little_room(metric):
    """One tile's products and marks are held at a time, in single precision; before, two copies of them and more."""
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(1024, 64)), rng.normal(size=(9000, 64))
    x, y = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (x, y))
    if metric == "hamming":
        x, y = np.sign(x).astype(np.float32), np.sign(y).astype(np.float32)
    tracemalloc.start()
    neighbours._best(x, y, 5, metric, None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6, peak


@pytest.mark.parametrize("size", [1.0, 1e-4, 1e12])
def test_single_precision_loses_no_near_tie(size):
    """Items whose products differ by less than single precision can tell."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(20, 64))
    y = (x[rng.integers(0, 20, 3000)] + 2e-7 * rng.normal(size=(3000, 64))) * size
    rows, cols, scores = neighbours._best(x, y, 7, "cosine", None)
    best = np.round(np.einsum("ik,jk->ij", x, y), neighbours.DECIMALS)
    for n in range(20):
        assert scores[rows == n] == pytest.approx(np.sort(best[n])[::-1][:7], rel=1e-12, abs=1.1e-6)


def test_hashes_are_formed_once_and_block_pairs_get_tasks_of_their_own(spark):
    formed = spark.sparkContext.accumulator(0)

    @F.udf("array<bigint>")
    def phash(n):
        formed.add(1)
        return [n * 7919 + k for k in range(4)]

    db, site = (spark.range(40).select(F.col("id").alias(c), phash("id").alias("phash")) for c in ("db_id", "site_id"))
    found = matching.hash_shortlist(db, site, 3, broadcast_bytes=0, block_rows=10)
    assert found.filter("rank = 1 AND db_id = site_id AND distance = 0").count() == 40
    assert formed.value == 80
    meet = neighbours._pairs_of_blocks(
        db.select(F.col("db_id").alias("_query"), F.col("phash").alias("_v")), site.select(F.col("site_id").alias("_item"), F.col("phash").alias("_v")),
        "_query bigint, _item bigint, _score double", 3, "hamming", None, [], 10,
    )
    assert meet._jdf.queryExecution().sparkPlan().toString().count("REPARTITION_BY_NUM") == 2


def test_groups_are_parted_by_number_of_rows(spark, monkeypatch):
    """Bytes as sent say little of rows that are alike, so families and variants are parted by their number."""
    monkeypatch.setattr(session, "PART_ROWS", 4)
    urls = [(1, n, f"https://x.example/a_{n}.jpg") for n in range(6)] + [(1, 9, "https://x.example/b_1.jpg"), (2, 1, "https://x.example/b_7.jpg")]
    found = images.dominant_family(spark.createDataFrame(urls, "page long, pos long, url string"), "page", "url", "pos")
    assert sorted((r.page, r.pos, r.family) for r in found.collect()) == [*((1, n, "a") for n in range(6)), (2, 1, "b")]
    variants = spark.createDataFrame([(p, n, f"V{n % 3}", f"u{n}", n != 1) for p in (1, 2) for n in range(4)], "p long, pos long, name string, url string, available boolean")
    wishes = spark.createDataFrame([(1, " v0"), (2, "V1"), (2, "no"), (3, "v0"), (1, "")], "p long, wanted string")
    chosen = enrich.choose_variant(wishes, variants, "p", "wanted", "pos")
    assert {(r.p, r.wanted): (r.variant, r.variant_url, r.color_error) for r in chosen.collect()} == {
        (1, " v0"): ("V0", "u0", None),
        (2, "V1"): ("V1", "u1", "Color 'V1' is out of stock"),
        (2, "no"): (None, None, "Color 'no' not found. Available colors: V0, V1, V2"),
        (3, "v0"): (None, None, "No color variants found on this product page"),
        (1, ""): (None, None, None),
    }
    for df in (found, chosen):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "REPARTITION_BY_NUM" in plan and plan.rindex("REPARTITION_BY_NUM") > plan.rindex("Aggregate")


def test_a_page_is_read_once_for_both_error_phrases(spark):
    df = entry_module.queries()["V1_error_phrase"](spark, "/root/testdata/sf0.001")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


@pytest.mark.parametrize("name", ["V1_error_phrase", "U10_size_variants"])
def test_a_table_in_one_small_file_is_spread(spark, name):
    df = entry_module.queries()[name](spark, "/root/testdata/sf0.001")
    assert "Repartition" in df._jdf.queryExecution().optimizedPlan().toString()
