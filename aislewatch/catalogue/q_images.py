"""I1-I19 on image addresses made from products and order lines, and on embeddings as 8x8 grids."""

from pyspark.sql import functions as F

from aislewatch.catalogue.feeds import IMAGE_LIST, ORDER_IMAGES
from aislewatch.catalogue.registry import register, with_feed
from aislewatch.operators import images

ROW_ID = "page_id, part_id, n, pos"
TIERED = f"SELECT *, CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS tier FROM ({ORDER_IMAGES})"


@register(
    "I1_first_tier",
    with_feed(TIERED, "SELECT page_id, part_id, pos, CAST(tier AS BIGINT) AS tier FROM (SELECT *, min(tier) OVER (PARTITION BY page_id) AS m FROM feed) WHERE tier = m"),
)
def i1(t):
    return images.first_tier(t.feed(TIERED), "page_id", "tier").select(
        "page_id", "part_id", "pos", F.col("tier").cast("bigint").alias("tier")
    )


@register(
    "I2_product_images",
    with_feed(IMAGE_LIST, "SELECT page_id, pos, url FROM feed WHERE regexp_matches(url, '/(400x400|700x700)/') AND NOT regexp_matches(url, '(?i)360|Brand1[0-9]_')"),
)
def i2(t):
    ok = images.is_product_image("url", r"/(?:400x400|700x700)/", images.DENY + r"|Brand1[0-9]_")
    return t.feed(IMAGE_LIST).filter(ok).select("page_id", "pos", "url")


@register(
    "I3_image_key",
    with_feed(
        IMAGE_LIST,
        r"""SELECT page_id, pos, url AS exact, regexp_replace(url, '\?.*', '') AS no_query, lower(regexp_extract(url, 'https://[^/]*(/[^?]*)', 1)) AS path,
            regexp_replace(lower(regexp_extract(url, 'https://[^/]*(/[^?]*)', 1)), '\.[a-z]+$', '') AS path_without_extension,
            lower(regexp_extract(url, '([^/]*)\?', 1)) AS filename, 'cdn.example' || lower('/p/' || page_id || '/' || regexp_extract(url, '([^/]*)\?', 1)) AS size_removed,
            ':' || regexp_replace(lower(regexp_extract(url, '([^/]*)\.(jpg|PNG)\?', 1)), '_\d$', '') AS guid, lower(regexp_extract(url, '([^/]*)\.(jpg|PNG)\?', 1)) AS uuid FROM feed""",
    ),
)
def i3(t):
    rules = ["exact", "no_query", "path", "path_without_extension", "filename", "size_removed", "guid", "uuid"]
    return t.feed(IMAGE_LIST).select("page_id", "pos", *[images.image_key("url", r).alias(r) for r in rules])


@register(
    "I4_distinct_first",
    with_feed(IMAGE_LIST, "SELECT page_id, lower(regexp_extract(url, '([^/]*)\\?', 1)) AS key, min(pos) AS pos, min_by(url, pos) AS url FROM feed GROUP BY 1, 2"),
)
def i4(t):
    keyed = t.feed(IMAGE_LIST).select("page_id", "pos", "url", images.image_key("url", "filename").alias("key"))
    return images.distinct_first(keyed, "page_id", "key", "pos").select("page_id", "key", "pos", "url")


@register(
    "I5_natural_order",
    with_feed(ORDER_IMAGES, "SELECT page_id, pos, CAST(NULL AS BIGINT) IS NOT NULL AS unnumbered, n AS number, lower(url) AS name FROM feed"),
)
def i5(t):
    key = images.natural_order("url")
    return t.feed(ORDER_IMAGES).select("page_id", "pos", key["unnumbered"].alias("unnumbered"), key["number"].alias("number"), key["name"].alias("name"))


@register(
    "I6_cap_images",
    with_feed(ORDER_IMAGES, "SELECT page_id, pos, url FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY n, pos) AS r FROM feed) WHERE r <= 3"),
)
def i6(t):
    return images.cap_images(t.feed(ORDER_IMAGES), "page_id", ["n", "pos"], 3).select("page_id", "pos", "url")


@register(
    "I7_dominant_family",
    with_feed(
        ORDER_IMAGES,
        """, d AS (SELECT page_id, lower(family) AS family, n, min(pos) AS p FROM feed GROUP BY 1, 2, 3),
        i AS (SELECT *, n - row_number() OVER (PARTITION BY page_id, family ORDER BY n) AS island FROM d),
        r AS (SELECT page_id, family, max(c) AS run FROM (SELECT page_id, family, island, count(*) AS c FROM i GROUP BY 1, 2, 3) GROUP BY 1, 2),
        s AS (SELECT page_id, lower(family) AS family, count(*) AS size, min(pos) AS p FROM feed GROUP BY 1, 2),
        b AS (SELECT s.page_id, s.family, row_number() OVER (PARTITION BY s.page_id ORDER BY size DESC, run DESC, p) AS k FROM s JOIN r ON r.page_id = s.page_id AND r.family = s.family)
        SELECT f.page_id, f.pos, f.url, b.family FROM feed f JOIN b ON b.page_id = f.page_id AND b.family = lower(f.family) AND k = 1""",
    ),
)
def i7(t):
    return images.dominant_family(t.feed(ORDER_IMAGES).drop("family"), "page_id", "url", "pos").select("page_id", "pos", "url", "family")


CLUSTERED = f"SELECT *, l_returnflag || l_linestatus AS cluster FROM ({ORDER_IMAGES})"


@register(
    "I8_largest_cluster",
    with_feed(
        CLUSTERED,
        """, s AS (SELECT page_id, cluster, count(*) AS n, min(pos) AS p FROM feed GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY n DESC, p) AS k FROM s)
        SELECT f.page_id, f.pos, f.url FROM feed f JOIN b ON b.page_id = f.page_id AND k = 1 WHERE b.n <= 2 OR b.cluster = f.cluster""",
    ),
)
def i8(t):
    return images.largest_cluster(t.feed(CLUSTERED), "page_id", "cluster", "pos").select("page_id", "pos", "url")


@register(
    "I9_keep_identity",
    with_feed(
        ORDER_IMAGES,
        "SELECT page_id, pos, url FROM (SELECT *, count(*) FILTER (l_returnflag = 'R') OVER (PARTITION BY page_id) AS hits FROM feed) WHERE hits < 2 OR l_returnflag = 'R'",
    ),
)
def i9(t):
    return images.keep_identity(t.feed(ORDER_IMAGES), "page_id", F.col("l_returnflag") == "R").select("page_id", "pos", "url")


@register(
    "I10_most_common",
    with_feed(
        ORDER_IMAGES,
        "SELECT page_id, family AS variant FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY c DESC, p) AS k FROM (SELECT page_id, family, count(*) AS c, min(pos) AS p FROM feed GROUP BY 1, 2)) WHERE k = 1",
    ),
)
def i10(t):
    return images.most_common(t.feed(ORDER_IMAGES).withColumnRenamed("family", "variant"), "page_id", "variant", "pos")


@register(
    "I11_widest_code",
    with_feed(
        CLUSTERED,
        "SELECT page_id, cluster AS code, c AS n_numbers FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY c DESC, p) AS k FROM (SELECT page_id, cluster, count(DISTINCT n) AS c, min(pos) AS p FROM feed GROUP BY 1, 2) WHERE c >= 2) WHERE k = 1",
    ),
)
def i11(t):
    return images.widest_code(t.feed(CLUSTERED).withColumnRenamed("cluster", "code"), "page_id", "code", "n", "pos")


@register(
    "I12_union_sources",
    with_feed(
        ORDER_IMAGES,
        """SELECT page_id, url, CAST(min(CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END) AS BIGINT) AS source_no,
                  CAST(min(pos) FILTER (l_linestatus = 'O') AS BIGINT) AS o_pos FROM feed GROUP BY 1, 2""",
    ),
)
def i12(t):
    everything = t.feed(ORDER_IMAGES).select("page_id", "pos", "url", "l_linestatus")
    merged = images.union_sources(
        [everything.filter("l_linestatus = 'O'"), everything.filter("l_linestatus <> 'O'")], "page_id", "url", "pos"
    )
    return merged.select(
        "page_id", "url", F.col("source_no").cast("bigint").alias("source_no"), F.when(F.col("source_no") == 0, F.col("pos")).alias("o_pos")
    )


MINI = f"""SELECT page_id, pos, family, n, l_returnflag, CASE WHEN l_returnflag = 'R' THEN 'https://i.example/prod/miniatyrbild-' || CAST(n AS STRING) || '-av-7-' || family || '.jpg?x=1'
   ELSE 'https://i.example/t_800x800/' || family || '.jpg' END AS url FROM ({ORDER_IMAGES})"""


@register(
    "I13_drop_thumbnails",
    with_feed(
        MINI,
        "SELECT page_id, pos, url FROM feed f WHERE l_returnflag <> 'R' OR NOT EXISTS (SELECT 1 FROM feed g WHERE g.page_id = f.page_id AND g.family = f.family AND g.l_returnflag <> 'R')",
    ),
)
def i13(t):
    return images.drop_thumbnails(t.feed(MINI), "page_id", "url").select("page_id", "pos", "url")


EXPECTED = f"SELECT *, CAST(page_id % 5 AS BIGINT) AS expected FROM ({TIERED})"


@register(
    "I14_fill_to_expected",
    with_feed(
        EXPECTED,
        """SELECT page_id, pos, CAST(tier AS BIGINT) AS tier FROM (SELECT *, count(*) FILTER (tier = 0) OVER (PARTITION BY page_id) AS held, row_number() OVER (PARTITION BY page_id ORDER BY tier, pos) AS r FROM feed)
           WHERE r <= greatest(held, expected)""",
    ),
)
def i14(t):
    return images.fill_to_expected(t.feed(EXPECTED), "page_id", "tier", "pos", "expected").select(
        "page_id", "pos", F.col("tier").cast("bigint").alias("tier")
    )


@register(
    "I15_until_first_gap",
    with_feed(
        ORDER_IMAGES,
        """, d AS (SELECT DISTINCT page_id, n FROM feed), g AS (SELECT page_id, n, n - row_number() OVER (PARTITION BY page_id ORDER BY n) AS island FROM d),
        m AS (SELECT page_id, min(island) AS island FROM g GROUP BY 1), k AS (SELECT g.page_id, g.n FROM g JOIN m ON m.page_id = g.page_id AND m.island = g.island)
        SELECT f.page_id, f.pos FROM feed f JOIN k ON k.page_id = f.page_id AND k.n = f.n""",
    ),
)
def i15(t):
    return images.until_first_gap(t.feed(ORDER_IMAGES), "page_id", "n").select("page_id", "pos")


SIZED = f"SELECT page_id, n, max(quantity) AS size FROM ({ORDER_IMAGES}) GROUP BY page_id, n"


@register(
    "I15_until_two_small",
    with_feed(
        SIZED,
        """, s AS (SELECT a.page_id, min(a.n) AS stop FROM feed a JOIN feed b ON b.page_id = a.page_id AND b.n = a.n - 1 WHERE a.size < 25 AND b.size < 25 GROUP BY 1)
        SELECT f.page_id, f.n, f.size FROM feed f LEFT JOIN s ON s.page_id = f.page_id WHERE f.size >= 25 AND (stop IS NULL OR f.n < stop)""",
    ),
)
def i15_small(t):
    return images.until_two_small(t.feed(SIZED), "page_id", "n", "size", 25).select("page_id", "n", "size")


@register(
    "I16_real_images",
    "SELECT doc_id, n_chars FROM documents WHERE n_chars + 12 >= 1000 AND doc_id % 3 <> 2",
)
def i16(t):
    head = F.when(F.col("doc_id") % 3 == 0, "FFD8FFE0FFD8FFE0FFD8FFE0").when(F.col("doc_id") % 3 == 1, "52494646AAAAAAAA57454250").otherwise("00" * 12)
    body = F.concat(F.unhex(head), F.unhex(F.repeat(F.lit("41"), F.length("text"))))
    return t.documents.filter(images.is_real_image(body, 1000)).select("doc_id", "n_chars")


@register(
    "I17_average_hash",
    """SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN CAST(x AS DOUBLE) >= list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE))) / 64 THEN '1' ELSE '0' END), '') AS bits FROM embeddings""",
)
def i17(t):
    h = images.average_hash("embedding")
    return t.embeddings.select("vec_id", F.lpad(F.bin(h), 64, "0").alias("bits"))


# Near copies: every vector, and a slightly shifted copy of it under the next position.
COPIES = """
SELECT label AS product_id, vec_id * 10 AS pos, embedding AS v FROM embeddings
UNION ALL
SELECT label, vec_id * 10 + CASE WHEN vec_id % 2 = 0 THEN 5 ELSE -5 END, transform(embedding, x -> CAST(x AS DOUBLE) + CASE WHEN x > 0 AND x < 0.012 THEN -0.02 ELSE 0 END) FROM embeddings
UNION ALL
SELECT label, 100000000 + vec_id, CASE WHEN vec_id % 3 = 0 THEN NULL ELSE embedding END FROM embeddings
"""
_COPIES_ORACLE = COPIES.replace(
    "transform(embedding, x -> CAST(x AS DOUBLE) + CASE WHEN x > 0 AND x < 0.012 THEN -0.02 ELSE 0 END)",
    "list_transform(embedding, lambda x: CAST(x AS DOUBLE) + CASE WHEN x > 0 AND x < CAST(0.012 AS DOUBLE) THEN -0.02 ELSE 0 END)",
)


@register(
    "I18_drop_near_duplicates",
    f"""WITH RECURSIVE raw AS ({_COPIES_ORACLE}),
    h AS (SELECT product_id, pos, row_number() OVER (PARTITION BY product_id ORDER BY pos) AS k, CASE WHEN v IS NULL THEN NULL ELSE list_transform(v, lambda x: CAST(x AS DOUBLE) >= list_sum(list_transform(v, lambda y: CAST(y AS DOUBLE))) / 64) END AS bits FROM raw),
    walk AS (
      SELECT product_id, CAST(0 AS BIGINT) AS k, CAST([] AS BOOLEAN[][]) AS kept, CAST(NULL AS BIGINT) AS pos, TRUE AS keep FROM (SELECT DISTINCT product_id FROM h)
      UNION ALL
      SELECT product_id, k, CASE WHEN bits IS NOT NULL AND keep THEN list_append(kept, bits) ELSE kept END, pos, keep FROM (
        SELECT h.product_id, h.k, w.kept, h.bits, h.pos,
          CASE WHEN h.bits IS NULL THEN TRUE ELSE len(list_filter(w.kept, lambda q: len(list_filter(list_zip(q, h.bits), lambda z: z[1] <> z[2])) <= 4)) = 0 END AS keep
        FROM walk w JOIN h ON h.product_id = w.product_id AND h.k = w.k + 1))
    SELECT CAST(product_id AS BIGINT) AS product_id, CAST(pos AS BIGINT) AS pos FROM walk WHERE keep AND pos IS NOT NULL""",
)
def i18(t):
    hashed = t.feed(COPIES).select(F.col("product_id").cast("bigint").alias("product_id"), "pos", images.average_hash("v").alias("h"))
    return images.drop_near_duplicates(hashed, "product_id", "pos", "h").select("product_id", "pos")


ITEM = f"""SELECT page_id, part_id, pos, n, 'https://h.example' || CASE l_returnflag WHEN 'R' THEN '/orig/' WHEN 'A' THEN '/rocs1200/' ELSE '/small/' END || CAST(pos AS STRING) || '.jpg' AS url,
   CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS prio FROM ({ORDER_IMAGES})"""


@register("I19_best_per_item", with_feed(ITEM, "SELECT page_id, n, arg_min(url, prio * 100000000000000 + pos) AS url FROM feed GROUP BY 1, 2"))
def i19(t):
    return images.best_per_item(t.feed(ITEM), ["page_id", "n"], "url", images.quality_rank("url"), "pos")
