"""J1-J13 on product pages, on JSON made from products and orders, and on event properties."""

from pyspark.sql import functions as F

from aislewatch.catalogue.feeds import PRODUCT, RETAIL_PAGE
from aislewatch.catalogue.registry import register, with_feed
from aislewatch.operators import blobs

LD_BODY = """'{"@type":"Product","name":"' || p_name || ' ld","sku":"' || p_partkey || '","offers":{"@type":"Offer","price":"' || whole || '.' || frac
  || '","priceCurrency":"USD","availability":"https://schema.org/' || CASE WHEN p_partkey % 2 = 0 THEN 'InStock' ELSE 'OutOfStock' END || '"}}'"""


@register(
    "J1_jsonld_texts",
    with_feed(PRODUCT, f"SELECT p_partkey AS page_id, 0::BIGINT AS blob_no, {LD_BODY} || CASE WHEN p_partkey % 6 = 0 THEN ',' ELSE '' END AS blob FROM feed WHERE p_partkey % 3 = 0"),
)
def j1(t):
    return t.feed(RETAIL_PAGE).select("page_id", F.posexplode(blobs.jsonld_texts("html")).alias("blob_no", "blob")).withColumn(
        "blob_no", F.col("blob_no").cast("bigint")
    )


BLOB_FEED = """
SELECT p_partkey, p_name, p_brand, CASE p_partkey % 5 WHEN 0 THEN '{"a":"earlier","a":"' || p_name || '"} , ' WHEN 1 THEN '{"a":"' || p_name || '"}' || chr(10) || '{"a":"' || p_brand || '"}'
   WHEN 2 THEN '{broken' WHEN 3 THEN '[{"a":1}]' ELSE '{"a":"x"}' || chr(10) || '{bad' END AS blob FROM part
"""


@register(
    "J2_tolerant_blobs",
    """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '{"a":"' || p_name || '"}' WHEN 1 THEN '{"a":"' || p_name || '"}|{"a":"' || p_brand || '"}'
         WHEN 2 THEN '' WHEN 3 THEN '[{"a":1}]' ELSE '{"a":"x"}' END AS parsed FROM part""",
)
def j2(t):
    parsed = F.transform(blobs.tolerant_blobs(F.array("blob")), lambda v: F.to_json(v))
    return t.feed(BLOB_FEED).select("p_partkey", F.array_join(parsed, "|").alias("parsed"))


GRAPH_FEED = """
SELECT p_partkey, p_name, p_brand, CASE p_partkey % 4
  WHEN 0 THEN '{"@type":"Product","name":"' || p_name || '"}'
  WHEN 1 THEN '[{"@type":"BreadcrumbList","name":"b"},{"@type":["Thing","Product"],"name":"' || p_name || '"},{"@type":"Offer","name":"o"}]'
  WHEN 2 THEN '{"@graph":[{"@type":"WebPage","name":"w"},{"@type":"Product","name":"' || p_name || '"},{"@type":"SomeProducts","name":"' || p_brand || '"}]}'
  ELSE '{"@type":"Organization","name":"o"}' END AS blob FROM part
"""


@register(
    "J3_objects",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || '|o' WHEN 2 THEN p_name || '|' || p_brand ELSE '' END AS names FROM part""",
)
def j3(t):
    found = blobs.objects(F.array(F.try_parse_json("blob")))
    names = F.transform(found, lambda o: F.try_variant_get(o, "$.name", "string"))
    return t.feed(GRAPH_FEED).select("p_partkey", F.array_join(names, "|").alias("names"))


STATE_FEED = """
SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_custkey AS STRING) AS cust,
  '{"props":{"zeta":{"description":"' || o_orderpriority || '","inStock":' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END || '},'
  || '"alpha":[{"@type":"Product","name":"p' || CAST(o_custkey AS STRING) || '","more":{"deep":{"@type":"Product","name":"inner","availability":"' || o_orderstatus || '"}}}]},'
  || '"deep":{"l1":{"l2":[{"l3":{"l4":{"l5":{"l6":{"l7":{"@type":"Product","sku":1,"sku":2,"name":"ninth"}}}}}}]}},"longDescription":"{not json","available":' || CASE WHEN o_orderkey % 3 = 0 THEN '"yes"' ELSE 'true' END || ',"Availability":"Last' || o_orderstatus || '"}' AS state FROM orders
"""


@register(
    "J4_products_at_any_depth",
    "SELECT o_orderkey, 'p' || o_custkey || '|inner|ninth' AS names FROM orders",
)
def j4(t):
    walked = blobs.walk(t.feed(STATE_FEED).select("o_orderkey", "state"), "state")
    names = F.transform(blobs.products_at_any_depth(F.col("walk"), "state"), lambda p: F.try_variant_get(p, "$.name", "string"))
    return walked.select("o_orderkey", F.array_join(names, "|").alias("names"))


@register(
    "J5_first_path",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text FROM events",
)
def j5(t):
    props = F.try_parse_json("props")
    return t.events.select(
        "event_id",
        blobs.first_path(props, ["$.key", "$.k"], "bigint").alias("k"),
        blobs.first_path(props, ["$.deep.key", "$.k"]).alias("k_text"),
    )


@register(
    "J6_first_of_keys",
    "SELECT o_orderkey, '{not json' AS description, o_orderpriority AS nested, 'p' || o_custkey AS name FROM orders",
)
def j6(t):
    searches = {
        "description": ["description", "longDescription"], "nested": ["description", "productOverview"], "name": ["title", "name"],
    }
    walked = blobs.walk(t.feed(STATE_FEED).select("o_orderkey", "state"), "state", searches=searches)
    return walked.select("o_orderkey", *[blobs.first_of_keys(F.col("walk"), name).alias(name) for name in searches])


@register(
    "J7_stock_flags",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS in_stock, CASE WHEN o_orderkey % 3 <> 0 THEN 'true' END AS purchasable,
              lower(o_orderstatus) AS availability FROM orders""",
)
def j7(t):
    walked = blobs.walk(t.feed(STATE_FEED).select("o_orderkey", "state"), "state")
    flags = blobs.stock_flags(F.col("walk"))
    return walked.select(
        "o_orderkey", flags["in_stock"].alias("in_stock"), flags["purchasable"].alias("purchasable"), flags["availability"].alias("availability")
    )


CACHE_FEED = """
SELECT p_partkey, p_name, p_brand, '{"ROOT_QUERY":{"basket":{"__ref":"Basket:1"}' || CASE WHEN p_partkey % 3 = 0 THEN ',"product({\\"id\\":1})":{"__ref":"ProductType:' || CAST(p_partkey AS STRING) || '"}' ELSE '' END
  || '},"ProductType:zz":{"__typename":"ProductType","title":"' || p_brand || '"},"ProductType:' || CAST(p_partkey AS STRING) || '":{"__typename":"ProductType","title":"' || p_name || '"},"Basket:1":{"__typename":"Basket"}}' AS cache FROM part
"""


@register("J8_resolve_reference", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_brand END AS title FROM part")
def j8(t):
    slash_quote = F.replace("cache", F.lit('({"id":1})'), F.lit("(1)"))
    entity = blobs.resolve_reference(F.col("text"), F.col("v"))
    return (
        t.feed(CACHE_FEED)
        .select("p_partkey", slash_quote.alias("text"))
        .withColumn("v", F.try_parse_json("text"))
        .select("p_partkey", F.try_variant_get(entity, "$.title", "string").alias("title"))
    )


SCRIPT_FEED = """
SELECT p_partkey, p_name, CASE p_partkey % 4 WHEN 0 THEN '<script id="__NEXT_DATA__" type="application/json">{"props":{"name":"' || p_name || '"}}</script>'
  WHEN 1 THEN '<script>window.__NEXT_DATA__ = {"props":{"name":"' || p_name || '"}};</script><p>x</p>' WHEN 2 THEN '<script>var __NEXT_DATA__ = {oops};</script>' ELSE '<p>none</p>' END AS html FROM part
"""


@register("J9_assigned_json", "SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 THEN p_name END AS name FROM part")
def j9(t):
    state = blobs.assigned_json(F.col("html"), "__NEXT_DATA__")
    return t.feed(SCRIPT_FEED).select("p_partkey", F.try_variant_get(state, "$.props.name", "string").alias("name"))


BRACE_FEED = """
SELECT doc_id, 'x } {"a":{"b":1}} y {"t":"' || replace(replace(text, '{', ''), '}', '') || '","c":{"d":{}}} {' AS body, length(replace(replace(text, '{', ''), '}', '')) AS n,
       '{"t":"' || replace(replace(text, '{', ''), '}', '') || '","c":{"d":{}}}' AS expected FROM documents
"""


@register("J10_largest_object", with_feed(BRACE_FEED, "SELECT doc_id, CASE WHEN length(expected) > 80 THEN expected END AS largest FROM feed"))
def j10(t):
    return t.feed(BRACE_FEED).select("doc_id", blobs.largest_object("body").alias("largest"))


OFFER_FEED = f"""
SELECT p_partkey, cents, CASE p_partkey % 4 WHEN 0 THEN '{{"offers":{{"price":"' || CAST(whole AS STRING) || '.' || frac || '","availability":"InStock"}}}}'
  WHEN 1 THEN '{{"offers":[{{"availability":"SoldOut"}},{{"lowPrice":' || CAST(whole AS STRING) || '.' || frac || '}},{{"price":"7.00","availability":"InStock"}}]}}'
  WHEN 2 THEN '{{"offers":[]}}' ELSE '{{"name":"x"}}' END AS product FROM ({PRODUCT})
"""


@register(
    "J11_offers",
    with_feed(
        OFFER_FEED,
        """SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 THEN CAST(cents AS DOUBLE) / 100 END AS first_price, CASE p_partkey % 4 WHEN 0 THEN CAST(cents AS DOUBLE) / 100 WHEN 1 THEN 7.0::DOUBLE END AS last_price,
           CASE p_partkey % 4 WHEN 0 THEN 'InStock' WHEN 1 THEN 'SoldOut' END AS first_availability, CASE WHEN p_partkey % 4 < 2 THEN 'InStock' END AS last_availability FROM feed""",
    ),
)
def j11(t):
    listed = blobs.offers(F.try_parse_json("product"))
    price = lambda policy: blobs.pick_offer(listed, "price", policy).cast("decimal(12,2)").cast("double")
    return t.feed(OFFER_FEED).select(
        "p_partkey",
        price("first").alias("first_price"),
        price("last").alias("last_price"),
        blobs.pick_offer(listed, "availability").alias("first_availability"),
        blobs.pick_offer(listed, "availability", "last").alias("last_availability"),
    )


KEYED_FEED = f"""
SELECT p_partkey, cents, CASE p_partkey % 4 WHEN 0 THEN 'var a={{"salePrice" : ' || CAST(whole AS STRING) || '.' || frac || ', "price":"1.00"}}'
  WHEN 1 THEN 'q={{"price":"' || CAST(whole AS STRING) || '.' || frac || '"}}' WHEN 2 THEN 'z={{"minorUnits":' || CAST(cents AS STRING) || '}}' ELSE 'nothing' END AS script FROM ({PRODUCT})
"""


@register(
    "J12_keyed_value",
    with_feed(KEYED_FEED, "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CAST(cents AS DOUBLE) / 100 WHEN 1 THEN CAST(cents AS DOUBLE) / 100 WHEN 2 THEN CAST(cents AS DOUBLE) END AS amount FROM feed"),
)
def j12(t):
    value = blobs.keyed_value(F.col("script"), ["salePrice", "price", "minorUnits"])
    return t.feed(KEYED_FEED).select("p_partkey", value.cast("decimal(12,2)").cast("double").alias("amount"))


@register(
    "J13_text_window",
    """SELECT doc_id, CASE WHEN p > 0 THEN substr(text, greatest(1, p - 20), p - greatest(1, p - 20) + 3 + 50) END AS around
       FROM (SELECT doc_id, text, position('. ' || upper(lang[1]) IN text) AS p FROM documents)""",
)
def j13(t):
    anchor = F.concat(F.lit(". "), F.upper(F.substring("lang", 1, 1)))
    return t.documents.select("doc_id", blobs.text_window(F.col("text"), anchor, 20, 50).alias("around"))
