"""S1-S10, L1-L2 and the whole observation job."""

from pyspark.sql import functions as F

from aislewatch.catalogue.feeds import IMAGE_LIST, RETAIL_PAGE
from aislewatch.catalogue.registry import register, with_feed
from aislewatch.functions import urls
from aislewatch.plans.observe import observe_products
from aislewatch.sources import captures, logs, sinks


@register("S1_read_pages", "SELECT page_id, length(html) AS n FROM pages")
def s1(t):
    pages = captures.read_pages(t.spark, f"{t.folder}/pages.parquet", ("page_id", "html"))
    return pages.select("page_id", F.length("html").cast("bigint").alias("n"))


RESULT_FEED = """
SELECT user_id AS request_id, event_id AS pos, 'https://x.example/' || event_type AS url, 'https://x.example/purchase' AS requested,
  CAST(CASE WHEN event_id % 7 = 0 THEN 500 ELSE 200 END AS INT) AS http_status, CASE WHEN event_id % 5 <> 0 THEN props END AS content FROM events
"""


@register(
    "S2_choose_result",
    with_feed(
        RESULT_FEED,
        """SELECT request_id, pos, CASE WHEN http_status <> 200 THEN 'bad response: ' || http_status WHEN content IS NULL THEN 'missing content' END AS error
           FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY url = requested DESC, pos) AS r FROM feed) WHERE r = 1""",
    ),
)
def s2(t):
    return captures.choose_result(t.feed(RESULT_FEED), "request_id", "url", "requested", "pos").select("request_id", "pos", "error")


@register("S3_unwrap_envelope", "SELECT page_id, html FROM pages")
def s3(t):
    coded = F.base64(F.encode("html", "UTF-8"))
    url_coded = F.replace(F.url_encode("html"), F.lit("+"), F.lit("%20"))
    kind = F.col("page_id") % 4
    first = F.when(kind == 0, F.col("html")).when(kind == 1, "")
    second = (
        F.when(kind == 1, F.concat(F.lit("data:text/html;base64,"), coded))
        .when(kind == 2, F.concat(F.lit("data:text/html;charset=utf-8,"), url_coded))
        .when(kind == 3, F.regexp_replace(coded, r"\s", ""))
    )
    return t.pages.select("page_id", captures.unwrap_envelope([first, second]).alias("html"))


CAPTURE_FEED = "SELECT user_id AS page_id, event_id AS capture_no, CAST(floor(value) AS BIGINT) % 5 AS n_images, repeat('x', CAST(value AS INT)) AS description FROM events"


@register(
    "S4_choose_capture",
    with_feed(
        CAPTURE_FEED.replace("CAST(value AS INT)", "CAST(floor(value) AS INT)"),
        """, o AS (SELECT *, n_images >= 2 AND length(description) >= 20 AS ok FROM feed)
        SELECT page_id, capture_no FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY ok DESC, CASE WHEN ok THEN capture_no ELSE -capture_no END) AS r FROM o) WHERE r = 1""",
    ),
)
def s4(t):
    feed = t.feed(CAPTURE_FEED.replace("CAST(value AS INT)", "CAST(floor(value) AS INT)"))
    chosen = captures.choose_capture(feed, "page_id", "capture_no", F.col("n_images"), F.col("description"), least_text=20)
    return chosen.select("page_id", "capture_no")


@register(
    "S5_image_paths",
    with_feed(IMAGE_LIST, "SELECT page_id, pos FROM feed WHERE page_id % 4 = 0 OR n <> 2"),
)
def s5(t):
    path = F.regexp_replace(F.regexp_replace("url", r"\?.*$", ""), r"_2\.jpg$", "_2.txt")
    return t.feed(IMAGE_LIST).filter(captures.is_image_path(path)).select("page_id", "pos")


@register(
    "S6_documents",
    """SELECT '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '"' || CASE WHEN p_partkey % 2 = 0 THEN ',"p_brand":"' || p_brand || '"' ELSE '' END || '}' AS document FROM part""",
)
def s6(t):
    rows = t.part.select("p_partkey", "p_name", F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("p_brand"))
    return sinks.as_documents(rows)


@register("S7_archive_rows", "SELECT page_id, sha1(html) AS content_hash FROM pages")
def s7(t):
    return sinks.archive_rows(t.pages).select("page_id", "content_hash")


LOG_FEED = """
SELECT event_id AS line_no, '[2026-01-02 03:04:' || lpad(CAST(event_id % 60 AS STRING), 2, '0') || '] Job ID: ' || lpad(lower(hex(CAST(floor(event_id / 2) AS BIGINT))), 8, '0')
  || ' | Status: ' || CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'BLOCKED' ELSE 'OK' END || ' | HTTP: ' || CASE event_type WHEN 'error' THEN '429' ELSE '200' END
  || ' | Result: ' || CAST(user_id AS STRING) || ' | Strategy: s' || CAST(user_id % 3 AS STRING) || ' | URL: https://x.example/' || event_type AS value, event_type, user_id FROM events
"""


@register(
    "S8_parse_log",
    with_feed(
        LOG_FEED,
        """SELECT line_no, 'second ' || (line_no % 60) AS logged, lpad(lower(hex(line_no // 2)), 8, '0') AS job_id, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'BLOCKED' ELSE 'OK' END AS status,
           CASE event_type WHEN 'error' THEN 429 ELSE 200 END::BIGINT AS http_status, user_id AS result_code, 's' || (user_id % 3) AS strategy, 'https://x.example/' || event_type AS url FROM feed""",
    ),
)
def s8(t):
    return logs.parse_log(t.feed(LOG_FEED)).select(
        "line_no", F.concat(F.lit("second "), F.second("logged_at")).alias("logged"), "job_id", "status",
        F.col("http_status").cast("bigint").alias("http_status"), F.col("result_code").cast("bigint").alias("result_code"), "strategy", "url",
    )


@register(
    "S9_with_errors",
    r"""SELECT page_id, CASE WHEN NOT url LIKE 'https:%' THEN 'insecure' WHEN page_id % 5 = 1 THEN 'no code' END AS error FROM pages WHERE page_id % 7 <> 0""",
)
def s9(t):
    asked = t.pages.select("page_id", F.when(F.col("page_id") % 7 == 0, " ").otherwise(F.col("url")).alias("url"))
    code = F.when(F.col("page_id") % 5 != 1, F.lit("1")).try_cast("int")
    return captures.with_errors(asked, "url", {"insecure": ~F.col("url").startswith("https:"), "no code": code.isNull()}).select("page_id", "error")


KEY_FEED = "SELECT p_partkey, p_name, 'https://www.' || lower(p_type) || '.example/x' AS url, p_brand FROM part"


@register(
    "S10_unique_keys",
    with_feed(
        KEY_FEED,
        """, k AS (SELECT p_partkey, regexp_extract(url, 'www\\.([a-z]+)', 1) || '_' || replace(p_name, ' ', '_') || '_' || p_brand AS key FROM feed),
        n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY p_partkey) - 1 AS no FROM k)
        SELECT p_partkey, key || CASE WHEN no = 0 THEN '' WHEN no < 100 THEN '_' || lpad(CAST(no AS VARCHAR), 2, '0') ELSE '_' || no END AS key FROM n""",
    ),
)
def s10(t):
    keyed = t.feed(KEY_FEED).select("p_partkey", sinks.output_key("url", "p_name", "p_brand").alias("key"))
    return sinks.unique_keys(keyed, "key", "p_partkey").select("p_partkey", "key")


# Keys of a second batch: some given ones look like generated ones, and the first batch has used some.
CLAIM_FEED = """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'k' || CAST(p_size AS STRING) || '_0' || CAST(1 + p_partkey % 3 AS STRING) WHEN 4 THEN 'k7' ELSE 'k' || CAST(p_size AS STRING) END AS key FROM part"""
TAKEN_FEED = """SELECT DISTINCT 'k' || CAST(p_size AS STRING) || CASE WHEN p_partkey % 2 = 0 THEN '_0' || CAST(1 + p_partkey % 9 AS STRING) ELSE '' END AS key FROM part WHERE p_partkey % 10 = 3 OR p_partkey % 10 = 8"""


@register(
    "S10_keys_after_a_batch",
    f"""WITH feed AS ({CLAIM_FEED}), taken AS ({TAKEN_FEED}), used AS (SELECT key FROM feed UNION SELECT key FROM taken),
        r AS (SELECT p_partkey, f.key, row_number() OVER (PARTITION BY f.key ORDER BY p_partkey) - 1 + CASE WHEN t.key IS NULL THEN 0 ELSE 1 END AS r FROM feed f LEFT JOIN taken t ON t.key = f.key),
        n AS (SELECT key, max(r) AS m FROM r GROUP BY 1),
        c AS (SELECT key, unnest(range(1, m + 1 + (SELECT count(*) FROM used))) AS i FROM n WHERE m > 0),
        g AS (SELECT key, i, key || '_' || lpad(CAST(i AS VARCHAR), CAST(greatest(2, length(CAST(i AS VARCHAR))) AS INT), '0') AS made FROM c),
        free AS (SELECT key, made, row_number() OVER (PARTITION BY key ORDER BY i) AS r FROM g WHERE made NOT IN (SELECT key FROM used))
        SELECT p_partkey, coalesce(made, r.key) AS key FROM r LEFT JOIN free ON free.key = r.key AND free.r = r.r""",
)
def s10_after(t):
    """Keys of a batch beside those that an earlier one has used."""
    return sinks.unique_keys(t.feed(CLAIM_FEED), "key", "p_partkey", t.feed(TAKEN_FEED)).select("p_partkey", "key")


@register(
    "L1_recent_job_ids",
    with_feed(LOG_FEED, "SELECT lpad(lower(hex(line_no // 2)), 8, '0') AS job_id, max(line_no) AS last_line FROM feed GROUP BY 1 ORDER BY 2 DESC LIMIT 10"),
)
def l1(t):
    return logs.recent_job_ids(logs.parse_log(t.feed(LOG_FEED)), "line_no")


@register(
    "L2_failed_job_ids",
    with_feed(
        LOG_FEED,
        "SELECT string_agg(job, ', ' ORDER BY line_no) AS job_ids, count(*) AS n FROM (SELECT line_no, lpad(lower(hex(line_no // 2)), 8, '0') AS job FROM feed WHERE event_type IN ('error', 'click') ORDER BY line_no DESC LIMIT 20)",
    ),
)
def l2(t):
    return logs.failed_ids(logs.recent_failures(logs.parse_log(t.feed(LOG_FEED)), "line_no"), "line_no")


@register(
    "observe_products",
    with_feed(
        RETAIL_PAGE,
        """SELECT page_id, 'shop' AS retailer, regexp_extract(url, '([^/]*)$', 1) AS product_id, TRUE AS is_valid,
           CASE WHEN page_id % 6 <> 1 THEN p_name || ' ' || p_brand WHEN page_id % 3 = 0 THEN p_name || ' ld' WHEN page_id % 4 <> 1 THEN p_name || ' og' ELSE p_name END AS name,
           CASE WHEN page_id % 2 = 0 OR page_id % 3 = 0 OR page_id % 5 = 0 THEN CAST(cents AS DOUBLE) / 100 END AS price,
           CASE WHEN page_id % 2 = 0 THEN 'dom' WHEN page_id % 3 = 0 THEN 'jsonld' WHEN page_id % 5 = 0 THEN 'meta' END AS price_source,
           page_id % 7 <> 0 AS in_stock, 'About ' || p_name AS description, 6::BIGINT AS image_count FROM feed""",
    ),
)
def observe(t):
    pages = t.feed(RETAIL_PAGE).select(
        "page_id", "url", F.lit(None).cast("string").alias("final_url"), F.lit(200).alias("http_status"), "html"
    )
    return observe_products(pages).select(
        "page_id", "retailer", "product_id", "is_valid", "name", F.col("price_amount").cast("double").alias("price"),
        "price_source", "in_stock", "description", F.col("image_count").cast("bigint").alias("image_count"),
    )
