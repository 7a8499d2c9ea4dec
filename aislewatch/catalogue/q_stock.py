"""K1-K10 on order statuses, rendered as buttons, phrases and codes."""

from pyspark.sql import functions as F

from aislewatch.catalogue.registry import register, with_feed
from aislewatch.functions import stock
from aislewatch.operators.variants import available_names, roll_up_variants

OFFER_FEED = """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'https://schema.org/InStock' WHEN 'F' THEN 'http://schema.org/' || CASE o_orderkey % 4 WHEN 0 THEN 'OutOfStock' WHEN 1 THEN 'SoldOut' WHEN 2 THEN 'Discontinued' ELSE 'oos' END ELSE 'PreOrder' END AS availability FROM orders
"""


@register(
    "K1_availability",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN TRUE WHEN 'F' THEN FALSE END AS in_stock,
              o_orderstatus = 'O' AS strict_stock FROM orders""",
)
def k1(t):
    return t.feed(OFFER_FEED).select(
        "o_orderkey",
        stock.first_known(F.array(F.lit(None).cast("boolean"), stock.availability("availability"))).alias("in_stock"),
        stock.availability("availability", preorder_is_sold_out=True).alias("strict_stock"),
    )


BUTTON_FEED = """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Add to Basket' WHEN 1 THEN 'ADD  TO BAG' WHEN 2 THEN 'Notify me' WHEN 3 THEN 'Add to cart' ELSE 'Read more' END AS button_text,
  o_orderstatus = 'F' AS disabled, CASE WHEN o_orderkey % 7 = 0 THEN 'true' END AS aria_disabled, CASE WHEN o_orderkey % 11 = 0 THEN 'btn disabled' ELSE 'btn' END AS classes FROM orders
"""


@register(
    "K2_button",
    with_feed(
        BUTTON_FEED,
        """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 2 THEN FALSE WHEN o_orderkey % 5 IN (0, 1, 3) THEN NOT (disabled OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0) END AS in_stock FROM feed""",
    ),
)
def k2(t):
    state = stock.button("button_text", F.col("disabled"), F.col("aria_disabled"), F.col("classes"))
    return t.feed(BUTTON_FEED).select("o_orderkey", state.alias("in_stock"))


PHRASE_FEED = """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Tillfälligt slut' WHEN 1 THEN '' ELSE NULL END AS container,
  CASE o_orderkey % 6 WHEN 0 THEN 'Now In stock.' WHEN 1 THEN 'This was sold  out, add to cart' WHEN 2 THEN 'leider nicht verfügbar' WHEN 3 THEN 'availablex unavailabley' WHEN 4 THEN 'produkt niedostępny' ELSE o_orderpriority END AS body FROM orders
"""


@register(
    "K3_phrase_state",
    with_feed(
        PHRASE_FEED,
        """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN FALSE WHEN o_orderkey % 6 = 0 THEN TRUE WHEN o_orderkey % 6 IN (1, 2, 4) THEN FALSE END AS in_stock,
           CASE WHEN o_orderkey % 4 = 0 THEN 'tillfälligt slut' WHEN o_orderkey % 6 = 0 THEN 'in stock' WHEN o_orderkey % 6 = 1 THEN 'sold out' WHEN o_orderkey % 6 = 2 THEN 'nicht verfügbar' WHEN o_orderkey % 6 = 4 THEN 'niedostępny' END AS stock_text FROM feed""",
    ),
)
def k3(t):
    found = stock.with_phrase_state(t.feed(PHRASE_FEED), "container", "body", F.lit(stock.ANY_LANGUAGE))
    return found.select("o_orderkey", F.col("spoken.state").alias("in_stock"), F.col("spoken.text").alias("stock_text"))


SIGNAL_FEED = """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'ao' WHEN 1 THEN 'bandq' WHEN 2 THEN 'allegro' WHEN 3 THEN 'currys' ELSE 'other' END AS retailer,
  CASE WHEN o_orderkey % 3 = 0 THEN FALSE END AS negative, CASE o_orderstatus WHEN 'O' THEN TRUE WHEN 'F' THEN FALSE END AS button,
  CASE WHEN o_orderkey % 7 < 3 THEN TRUE WHEN o_orderkey % 7 < 5 THEN FALSE END AS jsonld FROM orders
"""
_CHOSEN = """SELECT o_orderkey, retailer, CASE
   WHEN retailer = 'ao' THEN CASE WHEN negative IS NOT NULL THEN 'negative' WHEN button IS NOT NULL THEN 'button' WHEN jsonld IS NOT NULL THEN 'jsonld' END
   WHEN retailer IN ('bandq', 'currys') THEN CASE WHEN button IS NOT NULL THEN 'button' WHEN negative IS NOT NULL THEN 'negative' WHEN jsonld IS NOT NULL THEN 'jsonld' END
   WHEN retailer = 'allegro' THEN CASE WHEN jsonld IS NOT NULL THEN 'jsonld' WHEN button IS NOT NULL THEN 'button' WHEN negative IS NOT NULL THEN 'negative' END
   ELSE CASE WHEN button IS NOT NULL THEN 'button' WHEN jsonld IS NOT NULL THEN 'jsonld' WHEN negative IS NOT NULL THEN 'negative' END END AS source, negative, button, jsonld FROM feed"""


def _signals():
    def signal(name):
        return F.struct(F.col(name).alias("state"), F.concat(F.lit(name), F.lit(": "), F.col(name).cast("string")).alias("text"))

    return {n: signal(n) for n in ("negative", "button", "jsonld")}


@register(
    "K4_stock_by_precedence",
    with_feed(
        SIGNAL_FEED,
        f"SELECT o_orderkey, source, CASE source WHEN 'negative' THEN negative WHEN 'button' THEN button WHEN 'jsonld' THEN jsonld END AS in_stock FROM ({_CHOSEN})",
    ),
)
def k4(t):
    best = stock.by_precedence("retailer", _signals())
    return t.feed(SIGNAL_FEED).select("o_orderkey", best["source"].alias("source"), best["state"].alias("in_stock"))


VOTE_FEED = """
SELECT o_orderkey, repeat('Currently unavailable. ', CAST(o_orderkey % 4 AS INT)) || repeat('In stock here. ', CAST(o_orderkey % 3 AS INT)) || o_orderpriority AS body FROM orders
"""


@register(
    "K5_count_vote",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 AND o_orderkey % 4 >= o_orderkey % 3 THEN FALSE WHEN o_orderkey % 3 > o_orderkey % 4 THEN TRUE END AS in_stock FROM orders",
)
def k5(t):
    return t.feed(VOTE_FEED).select("o_orderkey", stock.count_vote("body").alias("in_stock"))


QUANTITY_FEED = """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Only ' || CAST(o_custkey AS STRING) || ' left in stock' WHEN 1 THEN CAST(o_custkey AS STRING) || '+ in stock'
   WHEN 2 THEN 'In stock (' || CAST(o_custkey AS STRING) || ')' ELSE 'In stock' END AS body FROM orders
"""


@register(
    "K6_quantity_left",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN o_custkey END AS quantity FROM orders",
)
def k6(t):
    return t.feed(QUANTITY_FEED).select("o_orderkey", stock.quantity_left("body").cast("bigint").alias("quantity"))


VARIANT_FEED = """
SELECT l_orderkey AS product_id, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 10000 + l_suppkey AS pos, l_returnflag || l_linestatus AS name,
       l_orderkey % 2 = 0 AND l_linenumber = 1 AS selected, l_quantity > 40 AS available FROM lineitem
"""


@register(
    "K7_roll_up_variants",
    with_feed(
        VARIANT_FEED,
        """, n AS (SELECT product_id, name, min(pos) FILTER (available) AS fp FROM feed GROUP BY 1, 2),
           s AS (SELECT product_id, min_by(name, pos) AS sn, min_by(available, pos) AS sa FROM feed WHERE selected GROUP BY 1),
           a AS (SELECT product_id, string_agg(name, ', ' ORDER BY fp) FILTER (fp IS NOT NULL) AS names, bool_or(fp IS NOT NULL) AS any_av FROM n GROUP BY 1)
           SELECT a.product_id, coalesce(sa, any_av) AS in_stock, CASE WHEN sn IS NOT NULL THEN sn || CASE WHEN sa THEN ' - In stock' ELSE ' - Out of stock' END
             WHEN any_av THEN 'Available in: ' || names ELSE 'All variants out of stock' END AS stock_text
           FROM a LEFT JOIN s ON s.product_id = a.product_id""",
    ),
)
def k7(t):
    return roll_up_variants(t.feed(VARIANT_FEED))


@register(
    "K7_available_names",
    with_feed(VARIANT_FEED, "SELECT product_id, name, min(pos) AS first_pos FROM feed WHERE available GROUP BY 1, 2"),
)
def k7_names(t):
    return available_names(t.feed(VARIANT_FEED))


CODE_FEED = "SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'IN_STOCK' WHEN 1 THEN 'available' WHEN 2 THEN 'OUT_OF_STOCK' WHEN 3 THEN 'NOT_AVAILABLE' WHEN 4 THEN ' online ' WHEN 5 THEN 'OUT' ELSE o_orderstatus END AS code FROM orders"


@register(
    "K8_status_code",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 1, 4) THEN TRUE WHEN o_orderkey % 7 IN (2, 3, 5) THEN FALSE END AS in_stock FROM orders",
)
def k8(t):
    return t.feed(CODE_FEED).select("o_orderkey", stock.status_code("code").alias("in_stock"))


@register(
    "K9_default_state",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN TRUE WHEN o_orderkey % 3 = 0 THEN FALSE WHEN o_orderkey % 3 = 1 THEN o_orderstatus = 'F' END AS in_stock FROM orders""",
)
def k9(t):
    retailer = F.when(F.col("o_orderkey") % 3 == 0, "currys").when(F.col("o_orderkey") % 3 == 1, "tesco").otherwise("argos")
    state = F.when(F.col("o_orderstatus") == "O", True)
    return t.orders.select("o_orderkey", stock.default_state(retailer, state, F.col("o_orderstatus") == "F").alias("in_stock"))


@register(
    "K10_stock_text",
    with_feed(
        SIGNAL_FEED,
        f"SELECT o_orderkey, CASE source WHEN 'negative' THEN 'negative: ' || CAST(negative AS VARCHAR) WHEN 'button' THEN 'button: ' || CAST(button AS VARCHAR) WHEN 'jsonld' THEN 'jsonld: ' || CAST(jsonld AS VARCHAR) END AS stock_text FROM ({_CHOSEN})",
    ),
)
def k10(t):
    best = stock.by_precedence("retailer", _signals())
    return t.feed(SIGNAL_FEED).select("o_orderkey", best["text"].alias("stock_text"))


COUNTRY_FEED = """
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'SE' WHEN 1 THEN 'PL' WHEN 2 THEN 'DE' WHEN 3 THEN 'FR' WHEN 4 THEN 'GB' END AS country,
  p_name || CASE p_partkey % 12 WHEN 0 THEN ' Slut i lager' WHEN 1 THEN ' Dodaj do koszyka' WHEN 2 THEN ' Ausverkauft' WHEN 3 THEN ' Ajouter au panier' WHEN 4 THEN ' Sold out'
    WHEN 5 THEN ' Ausverkauft' WHEN 6 THEN ' lägg i varukorg' WHEN 7 THEN ' wyprzedane' WHEN 8 THEN ' in den Warenkorb' WHEN 9 THEN ' Rupture de stock' WHEN 10 THEN ' in stock' ELSE '' END AS body
FROM part
"""


@register(
    "K3_stock_by_country",
    with_feed(
        COUNTRY_FEED,
        """SELECT p_partkey, CASE WHEN p_partkey % 12 IN (0, 2, 4, 7, 9) THEN FALSE WHEN p_partkey % 12 IN (1, 3, 6, 8, 10) THEN TRUE END AS state,
             CASE p_partkey % 12 WHEN 0 THEN 'slut i lager' WHEN 1 THEN 'dodaj do koszyka' WHEN 2 THEN 'ausverkauft' WHEN 3 THEN 'ajouter au panier' WHEN 4 THEN 'sold out'
               WHEN 6 THEN 'lägg i varukorg' WHEN 7 THEN 'wyprzedane' WHEN 8 THEN 'in den warenkorb' WHEN 9 THEN 'rupture de stock' WHEN 10 THEN 'in stock' END AS text FROM feed""",
    ),
)
def k3_by_country(t):
    found = stock.with_phrase_state(t.feed(COUNTRY_FEED), F.lit(None).cast("string"), "body", "country")
    return found.select("p_partkey", F.col("spoken.state").alias("state"), F.col("spoken.text").alias("text"))
