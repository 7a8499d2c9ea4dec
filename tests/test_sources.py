"""Files in and out."""

import datetime

from pyspark.sql import functions as F

from aislewatch.operators import enrich
from aislewatch.sources import captures, logs, sinks


def test_observations_by_retailer(spark, tmp_path):
    df = spark.createDataFrame([("argos", 1, None), ("boots", 2, "x")], "retailer string, id int, name string")
    sinks.write_observations(df, str(tmp_path / "out"))
    sinks.write_observations(df.filter("id = 1"), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert back.count() == 3 and back.filter("retailer = 'argos'").count() == 2


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")
    sinks.write_archive(pages, str(tmp_path / "pages"))
    back = captures.read_pages(spark, str(tmp_path / "pages"))
    assert back.columns == ["page_id", "url", "html"] and back.first()["html"] == "<p>x</p>"


def test_image_files(spark, tmp_path):
    for name in ("b.JPG", "a.webp", "notes.txt", "c.jpg.bak"):
        (tmp_path / name).write_bytes(b"\xff\xd8\xff" + b"0" * 2000)
    paths = [r["path"].rsplit("/", 1)[-1] for r in captures.list_images(spark, str(tmp_path)).select("path").collect()]
    assert paths == ["a.webp", "b.JPG"]


def test_log_round_trip(spark, tmp_path):
    at = datetime.datetime(2026, 1, 2, 3, 4, 5)
    df = spark.createDataFrame([(at, "ab-12", "FAILED", 429, 0, "s", "https://u.example")], "at timestamp, j string, st string, h int, r int, s string, u string")
    line = logs.format_line(F.col("at"), F.col("j"), F.col("st"), F.col("h"), F.col("r"), F.col("s"), F.col("u"))
    logs.append_log(df.select(line.alias("value")), str(tmp_path / "log"))
    logs.append_log(spark.createDataFrame([("free text",)], "value string"), str(tmp_path / "log"))
    rows = {r["value"]: r for r in logs.read_log(spark, str(tmp_path / "log")).collect()}
    assert len(rows) == 2 and rows["free text"]["job_id"] is None
    parsed = next(r for v, r in rows.items() if v != "free text")
    assert (parsed["job_id"], parsed["http_status"], parsed["logged_at"], parsed["url"]) == ("ab-12", 429, at, "https://u.example")


def test_no_failures_give_one_empty_row(spark):
    log = spark.createDataFrame([("x", None, 1)], "value string, job_id string, n int")
    row = logs.failed_ids(logs.recent_failures(log, "n"), "n").first()
    assert (row["job_ids"], row["n"]) == ("", 0)


def test_unique_keys_number_a_hot_key(spark):
    df = spark.range(250).withColumn("key", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")))
    numbered = sinks.number_within(df, "key", "id", "no", width=7)
    hot = [r["no"] for r in numbered.filter("key = 'hot'").orderBy("id").collect()]
    assert hot == list(range(84))
    keys = [r["key"] for r in sinks.unique_keys(df, "key", "id").collect()]
    assert len(set(keys)) == 250 and "hot" in keys and "hot_01" in keys


def test_split_errors(spark):
    rows = spark.createDataFrame([(1, "u", "5"), (2, "v", "x"), (3, " ", "7"), (4, None, "7")], "id int, url string, price string")
    checked = captures.with_errors(rows, "url", {"no price": F.col("price").try_cast("int").isNull()})
    good, bad = captures.split_errors(checked)
    assert [r["id"] for r in good.collect()] == [1]
    assert [(r["id"], r["error"]) for r in bad.collect()] == [(2, "no price")]


def test_capture_images_prefer_the_earlier_capture(spark):
    rows = [(1, 0, "a", 1), (1, 1, "a", 0), (1, 1, "b", 1), (1, 2, "c", 0), (1, 3, "b", 0), (1, 4, "d", 2)]
    df = spark.createDataFrame(rows, "page int, capture_no int, key string, pos int")
    got = captures.union_capture_images(df, "page", "capture_no", "key", "pos").orderBy("key").collect()
    assert [(r["key"], r["source_no"], r["pos"]) for r in got] == [("a", 0, 1), ("b", 1, 1), ("c", 2, 0), ("d", 4, 2)]


def test_variant_messages(spark):
    variants = spark.createDataFrame(
        [(1, 0, "Red", "u0", True), (1, 1, "Blue", "u1", False)], "product int, pos int, name string, url string, available boolean"
    )
    wishes = spark.createDataFrame([(1, " red"), (1, "BLUE"), (1, "Green"), (2, "Red"), (1, "")], "product int, wanted string")
    got = {(r["product"], r["wanted"]): (r["variant_url"], r["color_error"]) for r in enrich.choose_variant(wishes, variants, "product", "wanted", "pos").collect()}
    assert got[(1, " red")] == ("u0", None)
    assert got[(1, "BLUE")] == ("u1", "Color 'BLUE' is out of stock")
    assert got[(1, "Green")] == (None, "Color 'Green' not found. Available colors: Red, Blue")
    assert got[(2, "Red")] == (None, "No color variants found on this product page")
    assert got[(1, "")] == (None, None)
