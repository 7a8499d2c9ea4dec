"""V1-V17 on the captured pages and on captures in eight conditions."""

from pyspark.sql import functions as F

from aislewatch.catalogue.feeds import CAPTURE
from aislewatch.catalogue.registry import register, with_feed
from aislewatch.catalogue.verdict_cases import CASES
from aislewatch.functions import text
from aislewatch.functions.phrases import all_phrases
from aislewatch.operators import html, validity
from aislewatch.rules import validity as rules


def nodes():
    return F.col("dom.nodes")


@register(
    "V1_error_phrase",
    with_feed(
        CAPTURE,
        """SELECT page_id, CASE WHEN kind = 5 THEN 'error_message:page not found' WHEN kind = 0 THEN 'error_message:404' END AS guarded, CASE WHEN kind IN (5, 6) THEN 'error_message:page not found' WHEN kind = 0 THEN 'error_message:404' END AS plain FROM feed""",
    ),
)
def v1(t):
    body = text.body_text("html")
    pages = t.feed(CAPTURE).select("page_id", "html")
    judged = validity.with_error_phrases(pages, body, F.lit("very"), {"guarded": True, "plain": False})
    return judged.select("page_id", "guarded", "plain")


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


def _choice(key, values):
    """SQL that picks a value by a key, meaning the same in Spark and in the oracle."""
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {n} THEN {_quoted(v)}" for n, v in enumerate(values)) + " END"


# Every document, with one phrase of all lists set into it, judged by one shop's list.
PHRASE_FEED = f"""SELECT doc_id, {_choice("doc_id", list(rules.ERROR_PHRASES))} AS shop,
  text || ' ' || {_choice("doc_id", [p.capitalize() for p in all_phrases()])} || '. ' || text AS body FROM documents"""


def _first_contained(shop, phrases):
    found = " ".join(f"WHEN contains(lower(body), {_quoted(p)}) THEN {_quoted('error_message:' + p[:rules.LABEL_CUTS.get(shop, 30)])}" for p in phrases)
    return f"WHEN {_quoted(shop)} THEN CASE {found} END"


@register(
    "V1_phrases_of_all_shops",
    with_feed(
        PHRASE_FEED,
        f"SELECT doc_id, CASE shop {' '.join(_first_contained(s, p) for s, p in rules.ERROR_PHRASES.items())} END AS error FROM feed",
    ),
)
def v1_all(t):
    """Lists of all shops over whole texts, read once by one automaton."""
    return validity.with_error_phrase(t.feed(PHRASE_FEED), F.col("body"), "shop").select("doc_id", "error")


def _parsed(t):
    return html.parse_pages(t.feed(CAPTURE).select("page_id", "kind", "url", "html"))


@register("V2_error_element", "SELECT p_partkey AS page_id, p_partkey % 8 = 4 AS has_error FROM part")
def v2(t):
    return _parsed(t).select("page_id", validity.error_element(nodes()).alias("has_error"))


@register(
    "V3_card_listing",
    "SELECT p_partkey AS page_id, CASE p_partkey % 8 WHEN 2 THEN 2::BIGINT WHEN 3 THEN 4::BIGINT ELSE 0::BIGINT END AS cards, p_partkey % 8 = 3 AS is_listing FROM part",
)
def v3(t):
    return _parsed(t).select(
        "page_id",
        validity.card_count(nodes()).cast("bigint").alias("cards"),
        validity.is_card_listing(nodes(), F.lit("tesco")).alias("is_listing"),
    )


@register("V4_page_links", "SELECT p_partkey AS page_id, CASE p_partkey % 8 WHEN 2 THEN 3::BIGINT ELSE 0::BIGINT END AS links FROM part")
def v4(t):
    return _parsed(t).select("page_id", validity.page_links(nodes()).cast("bigint").alias("links"))


@register(
    "V5_indicator_score",
    r"""SELECT page_id, CAST(s AS BIGINT) AS score, s >= 3 AS accepted FROM (SELECT page_id, CAST(html LIKE '%<article>%' AS INT) + CAST(html LIKE '%<h1>%' AS INT) + CAST(length(html) > 2000 AS INT)
          + CAST(html LIKE '%class="ad"%' AS INT) AS s FROM pages)""",
)
def v5(t):
    parsed = html.parse_pages(t.pages.select("page_id", F.length("html").alias("size"), "html"))
    score = validity.indicator_score(
        [
            F.size(html.select(nodes(), tag="article")) > 0,
            F.size(html.select(nodes(), tag="h1")) > 0,
            F.col("size") > 2000,
            F.size(html.select(nodes(), tag="div", cls="ad")) > 0,
        ]
    )
    return parsed.select(
        "page_id", score.cast("bigint").alias("score"), validity.accepted(score, F.lit("laredoute")).alias("accepted")
    )


@register(
    "V6_layered_verdict",
    with_feed(
        CAPTURE,
        """SELECT page_id, CASE WHEN http_status = 404 THEN TRUE WHEN kind IN (1, 2, 3, 4, 5) THEN TRUE WHEN kind = 7 AND final_url IS NOT NULL THEN TRUE ELSE FALSE END AS is_invalid,
           CASE WHEN http_status = 404 THEN 'HTTP 404 response' WHEN kind = 0 THEN 'Valid product page' WHEN kind = 1 THEN '404 page detected (H1 contains error message)'
             WHEN kind = 2 THEN 'Category page detected (cat=5, prod=0)' WHEN kind = 3 THEN 'Redirected to category page (cat=2)' WHEN kind = 4 THEN 'JSON-LD type indicates listing: ItemList'
             WHEN kind = 5 THEN '404 page detected (pattern: hittade du till en sida som in...)' WHEN kind = 7 AND final_url IS NOT NULL THEN 'Redirected with no product indicators'
             ELSE 'No clear signals, defaulting to valid' END AS reason FROM feed""",
    ),
)
def v6(t):
    return validity.layered_verdict(t.feed(CAPTURE)).select("page_id", "is_invalid", "reason")


@register(
    "V6_structural_verdict",
    with_feed(
        CAPTURE,
        """SELECT page_id, kind IN (2, 3) AS is_invalid, CASE kind WHEN 0 THEN 'Valid: has JSON-LD Product schema' WHEN 2 THEN 'Invalid: pagination with 3 pages (category page)' WHEN 3 THEN 'Invalid: 4 product cards (category page)' ELSE 'Uncertain: defaulting to valid' END AS reason FROM feed""",
    ),
)
def v6_structural(t):
    pages = t.feed(CAPTURE).select(
        "page_id", "url", (validity.jsonld_page_type(F.col("html")) == "Product").alias("jsonld_product"), "html"
    )
    judged = validity.structural_verdict(html.parse_pages(pages))
    return judged.select("page_id", "is_invalid", "reason")


_CASE_PARTS = {name: [getattr(c, name) for c in CASES] for name in ("retailer", "url", "html", "reason")}
VERDICT_FEED = f"""SELECT p_partkey AS page_id, CAST(CASE WHEN p_partkey % 17 = 0 THEN 404 ELSE 200 END AS INT) AS http_status, p_name,
  {_choice("p_partkey", _CASE_PARTS["retailer"])} AS retailer, {_choice("p_partkey", _CASE_PARTS["url"])} AS url,
  '<html><head><title>Shop</title></head><body>' || replace({_choice("p_partkey", _CASE_PARTS["html"])}, 'NAME', p_name) || '</body></html>' AS html FROM part"""


@register(
    "V6_verdict_by_retailer",
    with_feed(
        VERDICT_FEED,
        f"""SELECT page_id, http_status = 404 OR page_id % {len(CASES)} IN ({", ".join(str(n) for n, c in enumerate(CASES) if not c.valid)}) AS is_invalid,
            CASE WHEN http_status = 404 THEN 'HTTP 404 response' ELSE replace({_choice("page_id", _CASE_PARTS["reason"])}, 'NAME', p_name) END AS reason FROM feed""",
    ),
)
def v6_by_retailer(t):
    """Valid and invalid pages of every shop with rules of its own."""
    parsed = html.parse_pages(t.feed(VERDICT_FEED).drop("p_name"), probes=[validity.shop_probe()])
    return validity.verdict_by_retailer(parsed).select("page_id", "is_invalid", "reason")


@register(
    "V7_listing_url",
    r"""SELECT page_id, regexp_matches(url, '^https?://[^/]+/(en|de)/\d') AND page_id % 2 = 0 AS is_listing FROM pages""",
)
def v7(t):
    moved = F.regexp_replace("url", r"^(https?://[^/]+)/(?:en|de)/(?=\d)", "$1/c/")
    return t.pages.select(
        "page_id",
        validity.is_listing_url(moved, F.when(F.col("page_id") % 2 == 0, "wilko").otherwise("ao")).alias("is_listing"),
    )


@register("V8_redirected", "SELECT p_partkey AS page_id, p_partkey % 8 = 3 OR (p_partkey % 8 = 7 AND p_partkey % 3 = 0) AS redirected FROM part")
def v8(t):
    return t.feed(CAPTURE).select("page_id", validity.redirected("url", "final_url").alias("redirected"))


CODE_FEED = """
SELECT p_partkey, lpad(CAST(p_partkey AS STRING), 6, 'A') AS expected,
  CASE p_partkey % 4 WHEN 0 THEN '<b data-product="' || lpad(CAST(p_partkey AS STRING), 6, 'a') || '">' WHEN 1 THEN '{"productCode":"ZZ9999"} <i data-product-id="QQ0000">' WHEN 2 THEN '<p>no code</p>' ELSE 'productCode: YY1234' END AS html,
  CASE p_partkey % 4 WHEN 0 THEN 'https://x.example/products/' || lpad(CAST(p_partkey AS STRING), 6, 'A') WHEN 1 THEN 'https://x.example/collections/all' WHEN 2 THEN NULL ELSE 'https://x.example/products/other' END AS canonical
FROM part
"""


@register(
    "V9_identity_mismatch",
    "SELECT p_partkey, p_partkey % 4 IN (1, 3) AS code_mismatch, p_partkey % 4 IN (1, 3) AS handle_mismatch FROM part",
)
def v9(t):
    return t.feed(CODE_FEED).select(
        "p_partkey",
        validity.code_mismatch("expected", F.col("html")).alias("code_mismatch"),
        validity.handle_mismatch("expected", "canonical").alias("handle_mismatch"),
    )


HEADING_FEED = """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'next' WHEN 1 THEN 'currys' WHEN 2 THEN 'wayfair_uk' ELSE 'argos' END AS retailer,
  CASE CAST(floor(p_partkey / 4) AS BIGINT) % 8 WHEN 0 THEN ' Kettles ' WHEN 1 THEN 'Rugs and more' WHEN 2 THEN 'Mixers & Blenders' WHEN 3 THEN 'Kettles of the very finest copper make'
    WHEN 4 THEN 'Women''s running trainers' WHEN 5 THEN 'Dishwashers' WHEN 6 THEN 'Garden hose 20m' ELSE 'Portable ' || p_name END AS heading,
  CASE WHEN p_partkey % 5 = 0 THEN 'showing 12 results' ELSE 'one thing' END AS body, p_partkey % 3 = 0 AS parts FROM part"""
_GENERIC = """CASE p_partkey % 4 WHEN 0 THEN p_partkey // 4 % 8 IN (0, 4, 6) WHEN 1 THEN p_partkey // 4 % 8 IN (0, 2, 5)
   WHEN 2 THEN p_partkey // 4 % 8 IN (0, 1, 2, 3, 5, 6) ELSE FALSE END"""


@register(
    "V10_generic_heading",
    f"""SELECT p_partkey, {_GENERIC} AS generic, {_GENERIC} AND CASE WHEN p_partkey % 4 = 2 THEN p_partkey % 5 = 0 ELSE p_partkey % 3 <> 0 END AS gated FROM part""",
)
def v10(t):
    return t.feed(HEADING_FEED).select(
        "p_partkey",
        validity.generic_heading("heading", "retailer").alias("generic"),
        validity.category_heading("heading", "retailer", "body", F.col("parts")).alias("gated"),
    )


STATE_FEED = """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '"currentSceneContext":{"a":"' || p_name || '","contentType":"SHOWCASE"}' WHEN 1 THEN '"pageType":"PRODUCTLISTER"'
  WHEN 2 THEN '"currentSceneContext":{"a":"' || repeat('x', 400) || '","contentType":"SHOWCASE"}' ELSE p_name END AS html FROM part
"""


@register("V11_listing_type", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'SHOWCASE' WHEN 1 THEN 'PRODUCTLISTER' END AS page_type, p_partkey % 4 < 2 AS is_listing FROM part")
def v11(t):
    kind = validity.page_state_type("html")
    return t.feed(STATE_FEED).select("p_partkey", kind.alias("page_type"), validity.listing_type(kind).alias("is_listing"))


@register(
    "V12_guarded_match",
    r"""SELECT doc_id, p > 0 AND NOT regexp_matches(substr(text, greatest(1, p - 500), p - greatest(1, p - 500) + length(m) + 500), '(?i)price|the (for|of)\b') AS counts
        FROM (SELECT doc_id, text, m, CASE WHEN m = '' THEN 0 ELSE position(m IN text) END AS p FROM (SELECT doc_id, text, regexp_extract(text, '(in the|le la|der die)', 1) AS m FROM documents))""",
)
def v12(t):
    return t.documents.select(
        "doc_id", validity.guarded_match(F.col("text"), "in the|le la|der die", r"(?i)price|the (for|of)\b").alias("counts")
    )


COUNT_FEED = "SELECT p_partkey, p_size, CASE p_partkey % 3 WHEN 0 THEN 'Showing 1,0' || lpad(CAST(p_size AS STRING), 2, '0') || ' Results' WHEN 1 THEN CAST(p_size AS STRING) || ' items' ELSE p_name || ' itemsets' END AS body FROM part"


@register("V13_result_count", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 1000 + CAST(p_size AS BIGINT) WHEN 1 THEN CAST(p_size AS BIGINT) END AS results FROM part")
def v13(t):
    return t.feed(COUNT_FEED).select("p_partkey", validity.result_count("body").alias("results"))


@register(
    "V14_nothing_extracted",
    r"SELECT page_id, NOT regexp_matches(html, '<h1>[^<]*(the|der)') AND NOT regexp_matches(url, '\?') AS empty FROM pages",
)
def v14(t):
    name = F.nullif(F.regexp_extract("html", "<h1>[^<]*(the|der)", 0), F.lit(""))
    query = F.nullif(F.regexp_extract("url", r"\?", 0), F.lit(""))
    return t.pages.select("page_id", validity.nothing_extracted([name, query]).alias("empty"))


@register(
    "V15_invalid_record",
    with_feed(
        CAPTURE,
        """SELECT page_id, CASE WHEN kind NOT IN (1, 5) THEN p_name END AS name, CASE kind WHEN 1 THEN 'not_found' WHEN 5 THEN 'unavailable' ELSE 'active' END AS listing_status FROM feed""",
    ),
)
def v15(t):
    judged = t.feed(CAPTURE).select(
        "page_id",
        F.col("p_name").alias("name"),
        (~F.col("kind").isin(1, 5)).alias("is_valid"),
        F.when(F.col("kind") == 1, "404 - Page not found").otherwise("Product unavailable").alias("reason"),
    )
    return validity.null_invalid(judged, "is_valid", "reason", ["name"]).select("page_id", "name", "listing_status")


@register("V16_blocked", "SELECT p_partkey AS page_id, p_partkey % 8 = 5 AS blocked FROM part")
def v16(t):
    return t.feed(CAPTURE).select("page_id", validity.is_blocked("html").alias("blocked"))


@register("V17_surely_product", "SELECT p_partkey AS page_id, p_partkey % 8 = 0 AS valid FROM part")
def v17(t):
    return t.feed(CAPTURE).select("page_id", validity.surely_product("html").alias("valid"))
