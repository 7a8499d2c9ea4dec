"""P1-P15 on product prices rendered as text and on order lines."""

from pyspark.sql import functions as F

from aislewatch.catalogue.feeds import PRICE_TEXT, PRODUCT
from aislewatch.catalogue.registry import register, with_feed
from aislewatch.functions import money
from aislewatch.operators import html, prices


def _amounts(**columns: str) -> str:
    """What a parser makes of each of the eight renderings, as SQL by column. All parsers see the whole table."""
    return with_feed(PRICE_TEXT, f"SELECT p_partkey, {', '.join(f'CASE {sql} END AS {name}' for name, sql in columns.items())} FROM feed")


_AMOUNT = "CAST(cents AS DOUBLE) / 100"
#: A parser that reads no decimal comma takes grouped thousands for the whole, or the comma for a group.
_WHOLE_ONLY = "CASE WHEN whole >= 1000 THEN CAST(whole // 1000 AS DOUBLE) ELSE CAST(cents AS DOUBLE) END"


def _parse(t, **parsed):
    return t.feed(PRICE_TEXT).select("p_partkey", *[value.cast("double").alias(name) for name, value in parsed.items()])


@register(
    "P1_dollars",
    _amounts(
        amount=f"""WHEN p_partkey % 8 IN (0, 1, 3) THEN {_AMOUNT}
          WHEN p_partkey % 8 = 2 THEN CASE WHEN whole >= 1000 THEN whole // 1000 + CAST(whole % 1000 // 10 AS DOUBLE) / 100 ELSE CAST(cents AS DOUBLE) END
          WHEN p_partkey % 8 = 4 THEN {_WHOLE_ONLY} WHEN p_partkey % 8 = 5 THEN CAST(whole AS DOUBLE) WHEN p_partkey % 8 = 6 THEN CAST(cents AS DOUBLE)"""
    ),
)
def p1(t):
    return _parse(t, amount=money.dollars("price_text"))


@register(
    "P2_pounds",
    _amounts(
        strict_amount=f"WHEN p_partkey % 8 = 1 THEN {_AMOUNT}",
        bare_amount=f"""WHEN p_partkey % 8 IN (0, 1, 3) THEN {_AMOUNT} WHEN p_partkey % 8 IN (2, 4) THEN {_WHOLE_ONLY}
          WHEN p_partkey % 8 = 5 THEN CAST(whole AS DOUBLE) WHEN p_partkey % 8 = 6 THEN CAST(cents AS DOUBLE)""",
    ),
)
def p2(t):
    return _parse(t, strict_amount=money.pounds("price_text"), bare_amount=money.pounds("price_text", bare=True))


@register("P3_euros", _amounts(amount=f"WHEN p_partkey % 8 IN (0, 1, 2, 3, 4) THEN {_AMOUNT}"))
def p3(t):
    return _parse(t, amount=money.euros("price_text"))


@register("P4_kronor", _amounts(amount=f"WHEN p_partkey % 8 = 4 THEN {_AMOUNT}"))
def p4(t):
    return _parse(t, amount=money.kronor("price_text"))


ZLOTY_FEED = f"SELECT p_partkey, cents, CASE WHEN p_partkey % 3 = 0 THEN 'raty ' || CAST(whole AS STRING) || ',' || frac || ' zł w maju' ELSE 'cena ' || CAST(whole AS STRING) || ', ' || frac || ' zł' END AS price_text FROM ({PRODUCT})"


@register(
    "P5_zloty",
    with_feed(ZLOTY_FEED, "SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN CAST(cents AS DOUBLE) / 100 END AS amount FROM feed"),
)
def p5(t):
    return t.feed(ZLOTY_FEED).select("p_partkey", money.zloty("price_text").cast("double").alias("amount"))


WHOLE_ZLOTY_FEED = f"""SELECT p_partkey, cents, whole, CASE p_partkey % 5 WHEN 0 THEN 'cena ' || CAST(whole AS STRING) || ' zł' WHEN 1 THEN CAST(whole AS STRING) || ', ' || frac || ' zł'
   WHEN 2 THEN CAST(whole AS STRING) || ' zł raty' WHEN 3 THEN 'zł' ELSE '1234567 zł' END AS price_text FROM ({PRODUCT})"""


@register(
    "P5_whole_zloty",
    with_feed(
        WHOLE_ZLOTY_FEED,
        "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN CAST(whole AS DOUBLE) WHEN 1 THEN CAST(cents AS DOUBLE) / 100 END AS amount, CASE WHEN p_partkey % 5 = 1 THEN CAST(cents AS DOUBLE) / 100 END AS strict_amount FROM feed",
    ),
)
def p5_whole(t):
    return t.feed(WHOLE_ZLOTY_FEED).select(
        "p_partkey",
        money.zloty("price_text", whole=True).cast("double").alias("amount"),
        money.zloty("price_text").cast("double").alias("strict_amount"),
    )


AUD_FEED = f"""SELECT p_partkey, cents, CASE p_partkey % 3 WHEN 0 THEN 'US $1.00 now A$ ' || CAST(whole AS STRING) || '.' || frac
   WHEN 1 THEN '9 left $' || CAST(whole AS STRING) || '.' || frac ELSE 'now ' || CAST(whole AS STRING) || '.' || frac END AS price_text FROM ({PRODUCT})"""


@register("P6_australian_dollars", with_feed(AUD_FEED, "SELECT p_partkey, CAST(cents AS DOUBLE) / 100 AS amount FROM feed"))
def p6(t):
    return t.feed(AUD_FEED).select("p_partkey", money.australian_dollars("price_text").cast("double").alias("amount"))


@register(
    "P7_any_currency",
    with_feed(
        PRICE_TEXT,
        """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN '$' WHEN 1 THEN '£' WHEN 3 THEN '€' END AS symbol,
           CASE WHEN p_partkey % 8 IN (0, 1, 3) THEN CAST(cents AS DOUBLE) / 100 END AS amount,
           CASE p_partkey % 3 WHEN 0 THEN '$' WHEN 1 THEN '£' ELSE '' END || CAST(whole AS VARCHAR) AS labelled FROM feed""",
    ),
)
def p7(t):
    code = F.when(F.col("p_partkey") % 3 == 0, "usd").when(F.col("p_partkey") % 3 == 1, "GBP").otherwise("XXX")
    found = money.any_currency("price_text")
    return t.feed(PRICE_TEXT).select(
        "p_partkey",
        found["symbol"].alias("symbol"),
        found["amount"].cast("double").alias("amount"),
        money.with_symbol(F.col("whole").cast("string"), code).alias("labelled"),
    )


@register("P8_minor_units", _amounts(amount=f"WHEN p_partkey % 8 = 6 THEN {_AMOUNT}"))
def p8(t):
    return t.feed(PRICE_TEXT).select("p_partkey", money.minor_units("price_text").cast("double").alias("amount"))


@register(
    "P9_split_nodes",
    with_feed(
        PRODUCT,
        "SELECT p_partkey, CAST(cents AS DOUBLE) / 100 AS amount, CAST(cents AS DOUBLE) / 100 AS label_amount, 'AUD' AS label_currency FROM feed",
    ),
)
def p9(t):
    label = F.concat(F.lit("Amount: $"), F.col("whole"), F.lit("."), F.col("frac"), F.lit(" Currency: aud"))
    both = money.labelled(label)
    return t.feed(PRODUCT).select(
        "p_partkey",
        money.split_nodes(F.concat(F.lit("£"), F.col("whole"), F.lit(".")), "frac").cast("double").alias("amount"),
        both["amount"].cast("double").alias("label_amount"),
        both["currency"].alias("label_currency"),
    )


@register(
    "P10_format_money",
    with_feed(PRODUCT, "SELECT p_partkey, whole || '.' || frac || ' GBP' AS suffixed, '$' || whole || '.' || frac AS prefixed FROM feed"),
)
def p10(t):
    amount = (F.col("cents").cast("decimal(14,0)") / 100).cast(money.MONEY)
    return t.feed(PRODUCT).select(
        "p_partkey",
        money.format_money(amount, F.lit("GBP")).alias("suffixed"),
        money.format_symbol(amount, "$").alias("prefixed"),
    )


CANDIDATE_FEED = f"""
SELECT p_partkey, cents, CASE WHEN p_partkey % 2 = 0 THEN '$' || CAST(whole AS STRING) || '.' || frac END AS dom_text,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(whole + 1 AS STRING) || '.' || frac END AS jsonld_price,
  CASE WHEN p_partkey % 5 = 0 THEN CAST(cents + 200 AS STRING) END AS pennies,
  CASE WHEN p_partkey % 7 = 0 THEN '£' || CAST(whole + 3 AS STRING) || '.' || frac END AS body_text
FROM ({PRODUCT})
"""


@register(
    "P11_price_with_source",
    with_feed(
        CANDIDATE_FEED,
        """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN cents WHEN p_partkey % 3 = 0 THEN cents + 100 WHEN p_partkey % 5 = 0 THEN cents + 200
              WHEN p_partkey % 7 = 0 THEN cents + 300 END / CAST(100 AS DOUBLE) AS amount,
           CASE WHEN p_partkey % 2 = 0 THEN 'dom' WHEN p_partkey % 3 = 0 THEN 'jsonld' WHEN p_partkey % 5 = 0 THEN 'script'
              WHEN p_partkey % 7 = 0 THEN 'body' ELSE 'none' END AS price_source FROM feed""",
    ),
)
def p11(t):
    best = money.first_with_source(
        [
            (money.dollars("dom_text"), "dom"),
            (money.dollars("jsonld_price"), "jsonld"),
            (money.minor_units("pennies"), "script"),
            (money.pounds("body_text"), "body"),
        ]
    )
    return t.feed(CANDIDATE_FEED).select(
        "p_partkey",
        best["value"].cast("double").alias("amount"),
        F.coalesce(best["source"], F.lit("none")).alias("price_source"),
    )


SAVING_FEED = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey, l_suppkey,
  CASE WHEN l_linenumber % 4 <> 3 THEN CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT) END AS cur,
  CASE WHEN l_linenumber % 3 <> 1 THEN CAST(round(l_extendedprice * 100) AS BIGINT) END AS orig,
  CASE WHEN l_linenumber % 3 = 1 THEN CAST(round(l_extendedprice * l_discount * 100) AS BIGINT) END AS sav
FROM lineitem
"""


@register(
    "P12_saving_fields",
    with_feed(
        SAVING_FEED,
        """SELECT l_orderkey, line_no, l_partkey, l_suppkey, cur, CAST(full_c AS DOUBLE) / 100 AS price_original,
             CAST(coalesce(sav, greatest(0, full_c - cur)) AS DOUBLE) / 100 AS price_saving,
             CASE WHEN full_c > 0 AND cur IS NOT NULL THEN CAST(round(CAST(CAST(full_c - cur AS DECIMAL(38, 12)) / full_c * 100 AS DECIMAL(38, 10)), 2) AS DOUBLE) END AS price_saving_pct
           FROM (SELECT *, coalesce(orig, cur + sav) AS full_c FROM feed)""".replace(
            "coalesce(sav, greatest(0, full_c - cur))",
            "coalesce(sav, CASE WHEN cur IS NOT NULL AND full_c IS NOT NULL THEN greatest(0, full_c - cur) END)",
        ),
    ),
)
def p12(t):
    cents = lambda c: (F.col(c).cast("decimal(14,0)") / 100).cast(money.MONEY)
    fields = money.saving_fields(cents("cur"), cents("orig"), cents("sav"))
    return t.feed(SAVING_FEED).select(
        "l_orderkey", "line_no", "l_partkey", "l_suppkey", "cur", *[v.cast("double").alias(k) for k, v in fields.items()]
    )


STOCKED_FEED = "SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CASE o_orderstatus WHEN 'F' THEN FALSE WHEN 'O' THEN TRUE END AS in_stock FROM orders"


@register(
    "P13_unless_sold_out",
    with_feed(STOCKED_FEED, "SELECT o_orderkey, CASE WHEN in_stock IS DISTINCT FROM FALSE THEN cents END AS cents FROM feed"),
)
def p13(t):
    return t.feed(STOCKED_FEED).select("o_orderkey", money.unless_sold_out(F.col("cents"), F.col("in_stock")).alias("cents"))


@register(
    "P14_plausible",
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS line_no, CASE WHEN q >= 5 THEN CAST(q AS DOUBLE) END AS weak, CASE WHEN e > 1000 AND e < 50000 THEN CAST(e AS DOUBLE) END AS bounded
       FROM (SELECT *, CAST(l_quantity AS DECIMAL(12, 2)) AS q, CAST(l_extendedprice AS DECIMAL(12, 2)) AS e FROM lineitem)""",
)
def p14(t):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("bigint").alias("line_no"),
        money.at_least(F.col("l_quantity").cast(money.MONEY), 5).cast("double").alias("weak"),
        money.plausible(F.col("l_extendedprice").cast(money.MONEY), "1000", "50000").cast("double").alias("bounded"),
    )


@register(
    "P15_source_label",
    """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'onsite' WHEN p_partkey % 3 = 0 THEN 'mixed' ELSE 'jsonld' END AS price_source FROM part""",
)
def p15(t):
    onsite_price, other_onsite = F.col("p_partkey") % 2 == 0, F.col("p_partkey") % 3 == 0
    return t.part.select("p_partkey", money.source_label(onsite_price | other_onsite, ~onsite_price).alias("price_source"))


# Pages of several retailers, each with its price in one of that retailer's own places.
RETAILER_PAGE = f"""
SELECT p_partkey AS page_id, p_partkey % 10 AS kind, cents,
  CASE p_partkey % 10 WHEN 0 THEN 'macys' WHEN 1 THEN 'target' WHEN 2 THEN 'frasers' WHEN 3 THEN 'allegro' WHEN 4 THEN 'kaufland' WHEN 5 THEN 'cdon' WHEN 6 THEN 'target' WHEN 7 THEN 'wilko' WHEN 8 THEN 'harveynorman' ELSE 'shop' END AS retailer,
  '<html><body><i>7 left</i>' || CASE p_partkey % 10
    WHEN 0 THEN '<div class="price-wrapper"><b>was</b> $' || CAST(whole AS STRING) || '.' || frac || '</div>'
    WHEN 1 THEN '<script>x = "formatted_current_price": "$' || CAST(whole AS STRING) || '.' || frac || '"</script>'
    WHEN 2 THEN '<p data-testid="price" data-testvalue="' || CAST(cents AS STRING) || '">£1.00</p>'
    WHEN 3 THEN '<div class="a _7030e_b">raty 1,00 zł</div><div data-box-name="price"><span>cena</span> <span>' || CAST(whole AS STRING) || ',</span><span>' || frac || '</span><span>zł</span></div>'
    WHEN 4 THEN '<span data-testid="product-price">€' || CAST(whole AS STRING) || '.' || frac || '</span>'
    WHEN 5 THEN '<b>' || CAST(whole AS STRING) || ',' || frac || ' SEK</b>'
    WHEN 6 THEN '<script>"current_retail": 3.00, "price": "' || CAST(whole AS STRING) || '.' || frac || '"</script>'
    WHEN 7 THEN '<em class="x pdp-price--now">£' || CAST(whole AS STRING) || '.' || frac || '</em>'
    WHEN 8 THEN '<span aria-label="Amount: ' || CAST(whole AS STRING) || '.' || frac || '"></span>'
    ELSE '<p>no price</p>' END || '</body></html>' AS html
FROM ({PRODUCT})
"""


def _priced(t, feed):
    retailer = F.col("retailer")
    pages = t.feed(feed).select("page_id", "retailer", "html").withColumn("scripts", prices.script_finds(F.col("html"), retailer))
    placed = html.parse_pages(pages).withColumn(
        "places", prices.place_texts(F.col("dom"), retailer, F.lit(None).cast("string"), F.col("scripts"))
    )
    priced = placed.drop("dom").withColumn("price", prices.price_at(F.col("places")))
    return priced.select(
        "page_id", F.col("price.value").cast("double").alias("amount"), F.col("price.source").alias("price_source")
    )


@register(
    "P11_price_by_retailer",
    with_feed(
        RETAILER_PAGE,
        """SELECT page_id, CASE WHEN kind < 9 THEN CAST(cents AS DOUBLE) / 100 END AS amount, CASE kind WHEN 0 THEN 'macys-price-wrapper' WHEN 1 THEN 'tgt-data-formatted-alt' WHEN 2 THEN 'price-testid-attr' WHEN 3 THEN 'dom'
             WHEN 4 THEN 'onsite' WHEN 5 THEN 'onsite' WHEN 6 THEN 'regex-jsonld-price' WHEN 7 THEN 'onsite' WHEN 8 THEN 'price-display aria-label' END AS price_source FROM feed""",
    ),
)
def p11_by_retailer(t):
    return _priced(t, RETAILER_PAGE)


_SUM = "CAST(whole AS STRING) || '.' || frac"
MORE_RETAILER_PAGE = f"""
SELECT p_partkey AS page_id, p_partkey % 8 AS kind, cents,
  CASE p_partkey % 8 WHEN 0 THEN 'tesco' WHEN 1 THEN 'hsn' WHEN 2 THEN 'studio' WHEN 3 THEN 'ao' WHEN 4 THEN 'freemans' WHEN 5 THEN 'currys' WHEN 6 THEN 'laredoute' ELSE 'tesco' END AS retailer,
  '<html><body><i>7 left</i>' || CASE p_partkey % 8
    WHEN 0 THEN '<script>{{"ProductType:1":{{"price":{{"unit":"9.00","actual":' || {_SUM} || '}}}}}}</script><p class="priceText__x">£1.00</p>'
    WHEN 1 THEN '<div class="product-price"><span itemprop="price" content="' || {_SUM} || '">x</span></div>'
    WHEN 2 THEN '<b>£1.00</b><span id="lblSellingPrice">£' || {_SUM} || '</span>'
    WHEN 3 THEN '<div data-testid="standard-price-pod">Now £' || {_SUM} || '</div>'
    WHEN 4 THEN '<p>Only £' || {_SUM} || ' today</p>'
    WHEN 5 THEN '<div data-component="product-price"><h2>£' || {_SUM} || '</h2></div>'
    WHEN 6 THEN '<span class="price__value">£' || {_SUM} || '</span>'
    ELSE '<p class="a priceText">£' || {_SUM} || '</p>' END || '</body></html>' AS html
FROM ({PRODUCT})
"""


@register(
    "P11_price_of_more_retailers",
    with_feed(
        MORE_RETAILER_PAGE,
        """SELECT page_id, CAST(cents AS DOUBLE) / 100 AS amount,
             CASE kind WHEN 0 THEN 'apollo' WHEN 1 THEN 'itemprop' WHEN 4 THEN 'body' WHEN 7 THEN 'dom' ELSE 'onsite' END AS price_source FROM feed""",
    ),
)
def p11_more(t):
    return _priced(t, MORE_RETAILER_PAGE)
