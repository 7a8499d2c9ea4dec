"""E1-E3 on products, order lines and orders."""

from pyspark.sql import functions as F

from aislewatch.catalogue.q_stock import VARIANT_FEED
from aislewatch.catalogue.registry import register, with_feed
from aislewatch.operators import enrich

PAGE_FEED = """
SELECT p_partkey AS code, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS name, CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS stock_text, p_partkey % 5 <> 0 AS is_valid FROM part
"""
EXTRA_FEED = "SELECT l_partkey AS code, 'lines ' || CAST(count(*) AS STRING) AS name, 'max ' || CAST(CAST(max(l_quantity) AS BIGINT) AS STRING) AS stock_text FROM lineitem GROUP BY l_partkey"


@register(
    "E1_fill_missing",
    f"""WITH p AS ({PAGE_FEED}), x AS ({EXTRA_FEED}) SELECT p.code, CASE WHEN is_valid THEN coalesce(p.name, x.name) ELSE p.name END AS name,
        CASE WHEN is_valid THEN coalesce(p.stock_text, x.stock_text) ELSE p.stock_text END AS stock_text FROM p LEFT JOIN x ON x.code = p.code""",
)
def e1(t):
    filled = enrich.fill_missing(t.feed(PAGE_FEED), t.feed(EXTRA_FEED), "code", ["name", "stock_text"], "is_valid")
    return filled.select("code", "name", "stock_text")


WISH_FEED = """
SELECT o_orderkey AS product_id, CASE o_orderkey % 4 WHEN 0 THEN ' ao ' WHEN 1 THEN 'Rf' WHEN 2 THEN 'NO' ELSE '' END AS wanted FROM orders
"""
_VARIANTS = VARIANT_FEED.replace("AS available", "AS available, 'https://x.example/' || l_returnflag || CAST(l_partkey AS STRING) AS url")


@register(
    "E2_choose_variant",
    f"""WITH r AS ({WISH_FEED}), v AS ({_VARIANTS}),
      b AS (SELECT product_id, lower(name) AS k, min_by(name, pos) AS name, min_by(url, pos) AS url, min_by(available, pos) AS available, min(pos) AS p FROM v GROUP BY 1, 2),
      n AS (SELECT product_id, string_agg(name, ', ' ORDER BY p) AS names FROM b GROUP BY 1)
      SELECT r.product_id, r.wanted, CASE WHEN wanted <> '' THEN b.name END AS variant, CASE WHEN wanted <> '' THEN b.url END AS variant_url,
        CASE WHEN wanted = '' THEN NULL WHEN n.names IS NULL THEN 'No color variants found on this product page' WHEN b.name IS NULL THEN 'Color ' || chr(39) || wanted || chr(39) || ' not found. Available colors: ' || names
             WHEN NOT b.available THEN 'Color ' || chr(39) || wanted || chr(39) || ' is out of stock' END AS color_error
      FROM r LEFT JOIN b ON b.product_id = r.product_id AND b.k = lower(trim(wanted)) LEFT JOIN n ON n.product_id = r.product_id""",
)
def e2(t):
    return enrich.choose_variant(t.feed(WISH_FEED), t.feed(_VARIANTS), "product_id", "wanted", "pos")


@register(
    "E3_still_to_do",
    "SELECT r.k AS l_orderkey FROM range((SELECT min(l_orderkey) FROM lineitem), (SELECT max(l_orderkey) + 1 FROM lineitem)) r(k) WHERE r.k NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10)",
)
def e3(t):
    wanted = enrich.index_range(t.lineitem, "l_orderkey")
    saved = t.lineitem.filter("l_quantity > 10").select(F.col("l_orderkey"))
    return enrich.still_to_do(wanted, saved, "l_orderkey")
