"""Is a capture a product page? (V). All tests are expressions over the page's own row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewatch.functions import text as tx
from aislewatch.functions import urls
from aislewatch.functions.phrases import PhraseBook, away_from, with_phrase_hits
from aislewatch.operators import blobs, html, signals
from aislewatch.rules import validity as rules
from aislewatch.session import spread


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _by_retailer(retailer: Column, table: Mapping[str, object], default: object) -> Column:
    out = None
    for name, value in table.items():
        out = F.when(retailer == name, value) if out is None else out.when(retailer == name, value)
    return out.otherwise(default)


# --- V12, V1, V2 ------------------------------------------------------------------------------


def guarded_match(text: Column, pattern: str, terms: str = rules.PRODUCT_TERMS, reach: int = rules.WINDOW) -> Column:
    """The pattern occurs, and no product term lies within ``reach`` characters of it."""
    found = F.regexp_extract(text, f"({pattern})", 1)
    at = F.position(found, text)
    start = F.greatest(F.lit(1), at - reach)
    window = F.substr(text, start, at - start + F.length(found) + reach)
    return F.when(found != "", ~window.rlike(terms)).otherwise(False)


def _label(phrase: Column, cut: Column | int = 30) -> Column:
    cut = F.lit(cut) if isinstance(cut, int) else cut
    return F.when(phrase.isNotNull(), F.concat(F.lit("error_message:"), F.substr(phrase, F.lit(1), cut)))


def phrase_away_from_product(text: Column, phrase: str, terms: str = rules.PRODUCT_TERMS, reach: int = rules.WINDOW) -> Column:
    """The phrase occurs, and the text around its first occurrence, itself left out, holds no product term."""
    at, size = F.position(F.lit(phrase), text), len(phrase)
    before = F.substr(text, F.greatest(F.lit(1), at - reach), F.least(at - 1, F.lit(reach)))
    after = F.substr(text, at + size, F.lit(reach))
    return F.when(at > 0, ~before.rlike(terms) & ~after.rlike(terms)).otherwise(False)


def error_phrase(body: Column | str, phrases: Sequence[str], guarded: bool = False) -> Column:
    """V1 for one short list: ``error_message:<phrase>`` for the first listed phrase found in lower-cased page text.

    With ``guarded`` a phrase counts only away from product terms. ``with_error_phrase`` reads a text once for
    the lists of all retailers.
    """
    body = _col(body)
    chain = None
    for phrase in phrases:
        test = phrase_away_from_product(body, phrase) if guarded else body.contains(phrase)
        chain = F.when(test, phrase) if chain is None else chain.when(test, phrase)
    return _label(chain)


def with_error_phrase(
    pages: DataFrame, body: Column, retailer: Column | str, out: str = "error", guarded: bool = False
) -> DataFrame:
    """V1 under each retailer's own list; NULL for a retailer without one."""
    return with_error_phrases(pages, body, retailer, {out: guarded})


def with_error_phrases(pages: DataFrame, body: Column, retailer: Column | str, outs: Mapping[str, bool]) -> DataFrame:
    """V1 by several rules: columns by name, each guarded or not.

    The body text is staged once and read once for the lists of all retailers and all columns. A small input, which its
    reader may give to one task, is spread first.
    """
    staged = with_phrase_hits(spread(pages).withColumn("_body", F.lower(body)), {"_hits": "_body"})
    book, retailer = PhraseBook(rules.ERROR_PHRASES), _col(retailer)
    away = away_from(F.col("_body"), rules.PRODUCT_TERMS, rules.WINDOW)
    cut = _by_retailer(retailer, rules.LABEL_CUTS, 30)
    labels = {
        out: _label(book.first_phrase(F.col("_hits"), retailer, keep=away if guarded else None), cut)
        for out, guarded in outs.items()
    }
    return staged.withColumns(labels).drop("_body", "_hits")


def error_element(nodes: Column) -> Column:
    """V2: an element whose id or class belongs to an error page."""
    return F.exists(
        nodes,
        lambda n: F.coalesce(n["attrs"]["id"].isin(*rules.ERROR_IDS), F.lit(False))
        | F.coalesce(n["attrs"]["class"].rlike(rules.ERROR_CLASS), F.lit(False)),
    )


# --- V3, V4, V5 -------------------------------------------------------------------------------


def card_count(nodes: Column) -> Column:
    """Product cards on a page."""
    return F.size(
        F.filter(
            nodes,
            lambda n: F.coalesce(n["attrs"]["data-testid"].rlike("product-?card"), F.lit(False))
            | F.coalesce(n["attrs"]["class"].rlike(r"product-card|ProductCard|product-tile"), F.lit(False)),
        )
    )


def is_card_listing(nodes: Column, retailer: Column | str, has_product_parts: Column | None = None) -> Column:
    """V3: at least as many cards as the retailer's limit, and no product parts if those are known."""
    many = card_count(nodes) >= _by_retailer(_col(retailer), rules.CARD_LIMITS, rules.DEFAULT_CARD_LIMIT)
    return many if has_product_parts is None else many & ~has_product_parts


def page_links(nodes: Column) -> Column:
    """V4: pagination links, by their label or inside a labelled pagination element."""
    label = lambda n: F.coalesce(n["attrs"]["aria-label"], F.lit(""))
    bars = F.filter(nodes, lambda n: (n["tag"] == "nav") & label(n).rlike("(?i)aginer|aginat"))
    inside = html.select(nodes, tag="a", within=bars)
    by_bar = F.size(F.filter(inside, lambda n: label(n).rlike("(?i)sida|page")))
    by_label = F.size(F.filter(nodes, lambda n: (n["tag"] == "a") & label(n).rlike("^(?:Gå till sida|Go to page)")))
    return F.greatest(by_bar, by_label)


def indicator_score(flags: Sequence[Column]) -> Column:
    """V5: how many indicators hold; an unknown one does not."""
    total = F.lit(0)
    for flag in flags:
        total = total + F.coalesce(flag, F.lit(False)).cast("int")
    return total


def accepted(score: Column, retailer: Column | str) -> Column:
    return score >= _by_retailer(_col(retailer), rules.INDICATOR_LIMITS, rules.DEFAULT_INDICATOR_LIMIT)


# --- V7-V11, V13 ------------------------------------------------------------------------------


def is_listing_url(url: Column | str, retailer: Column | str) -> Column:
    """V7: the path has the shape of a listing of that retailer."""
    retailer, path = _col(retailer), F.lower(urls.path_of(url))
    out = None
    for name, pattern in rules.LISTING_URLS.items():
        test = path.rlike(pattern)
        if name == "cdiscount":
            test = test & ~path.contains("/f-")
        out = F.when(retailer == name, test) if out is None else out.when(retailer == name, test)
    return out.otherwise(False)


def redirected(url: Column | str, final_url: Column | str, product_path: str = rules.PRODUCT_PATH) -> Column:
    """V8: a product URL that ended outside the product path."""
    before, after = F.lower(urls.path_of(url)), F.lower(urls.path_of(final_url))
    away = before.contains(product_path) & ~after.contains(product_path)
    return F.coalesce(away & _col(final_url).isNotNull(), F.lit(False))


def code_mismatch(expected: Column | str, page: Column | str) -> Column:
    """V9: the page names product codes, and the expected one is not among them."""
    pattern = r"""(?i)(?:data-product[^>]*?|productCode["\s:]+)([A-Z0-9]{5,8})"""
    codes = F.transform(F.regexp_extract_all(page, F.lit(pattern), F.lit(1)), lambda c: F.upper(c))
    return (F.size(codes) > 0) & ~F.array_contains(codes, F.upper(_col(expected)))


def handle_mismatch(expected: Column | str, page_url: Column | str) -> Column:
    """V9: the canonical URL names another product handle, outside the product path."""
    handle = urls.extract(_col(page_url), r"/products/([^/?#]+)")
    return F.coalesce(F.lower(handle) != F.lower(_col(expected)), ~_col(page_url).contains("/products/"), F.lit(False))


def generic_heading(heading: Column | str, retailer: Column | str) -> Column:
    """The heading names a category under the retailer's own list and rule; False for one without a list."""
    text = F.lower(tx.clean(heading))
    tests = {name: text.rlike(f"(?s){pattern}") for name, pattern in rules.HEADING_PATTERNS.items()}
    return _by_retailer(_col(retailer), tests, F.lit(False))


def category_heading(
    heading: Column | str, retailer: Column | str, body: Column | str, has_product_parts: Column | None = None
) -> Column:
    """V10 with the shop's gate: a generic heading counts beside a number of results (V13) for a shop that asks for
    it, and elsewhere only on a page without product parts, if those are known."""
    generic, retailer = generic_heading(heading, retailer), _col(retailer)
    gate = F.lit(True) if has_product_parts is None else ~has_product_parts
    counted = result_count(body).isNotNull()
    return generic & F.when(retailer.isin(*rules.HEADING_NEEDS_COUNT), counted).otherwise(gate)


def listing_type(page_type: Column) -> Column:
    """Type of the page's data is a listing."""
    return F.coalesce(page_type.isin(*rules.LISTING_TYPES, *rules.LISTING_STATES), F.lit(False))


def page_state_type(page: Column | str) -> Column:
    """Listing state of a page's own data, within 300 characters of the scene context."""
    flat = tx.unescape_script(page)
    window = F.regexp_extract(flat, r'(?s)("currentSceneContext":\{.{0,280})', 1)
    scene = urls.extract(window, r'"contentType":"(SHOWCASE|PRODUCTLISTER)"')
    return F.coalesce(scene, urls.extract(flat, r'"pageType":"(PRODUCTLISTER)"'))


def result_count(body: Column | str) -> Column:
    """The number in "1,234 items" or "results"."""
    found = F.regexp_extract(_col(body), r"(?i)(\d[\d,]*)\s*(?:items?|results?)\b", 1)
    return F.nullif(F.regexp_replace(found, ",", ""), F.lit("")).try_cast("bigint")


# --- V14-V17 ----------------------------------------------------------------------------------


def nothing_extracted(fields: Sequence[Column]) -> Column:
    out = F.lit(True)
    for field in fields:
        out = out & field.isNull()
    return out


def is_blocked(page: Column | str) -> Column:
    """The capture shows a block page; only flagged."""
    return F.coalesce(_col(page).rlike(rules.BLOCKED), F.lit(False))


def status_class(reason: Column) -> Column:
    """Class of a verdict's reason."""
    low = F.lower(reason)
    return (
        F.when(reason.isNull(), "active")
        .when(low.rlike("404|not found|not_found"), "not_found")
        .when(low.rlike("ended|completed"), "ended")
        .when(low.rlike("unavailable|no longer"), "unavailable")
        .otherwise("invalid")
    )


def null_invalid(df: DataFrame, valid: str, reason: str, fields: Sequence[str]) -> DataFrame:
    """Null the given fields on invalid rows and add the listing status."""
    masked = {f: F.when(F.col(valid), F.col(f)) for f in fields}
    return df.withColumns({**masked, "listing_status": status_class(F.when(~F.col(valid), F.col(reason)))})


def surely_product(page: Column | str) -> Column:
    """Product data or a buy button makes the page valid whatever follows."""
    page = _col(page)
    found = blobs.objects(blobs.tolerant_blobs(blobs.jsonld_texts(page)), ["Product"])
    button = page.rlike(
        r"""(?i)data-cy=["']pdp-add-to-cart["']|data-testid=["'](?:pdp-add-to-cart|add-to-cart-button)["']|<button[^>]*class=["'][^"']*add-to-cart"""
    )
    return F.coalesce((F.size(found) > 0) | button, F.lit(False))


# --- V6 ---------------------------------------------------------------------------------------


def jsonld_page_type(page: Column) -> Column:
    """Type of the page's data: Product if any block says so, else the first type given."""
    found = blobs.objects(blobs.tolerant_blobs(blobs.jsonld_texts(page)), None)
    types = F.filter(
        F.transform(found, lambda o: F.try_variant_get(o, '$["@type"]', "string")), lambda x: F.coalesce(x != "", F.lit(False))
    )
    return tx.bind(types, lambda ts: F.when(F.array_contains(ts, "Product"), "Product").otherwise(F.get(ts, F.lit(0))))


def _matches(page: Column, patterns: Sequence[str], flags: str = "(?iu)") -> Column:
    return indicator_score([page.rlike(flags + p) for p in patterns])


def layered_verdict(
    pages: DataFrame,
    page: str = "html",
    url: str = "url",
    final_url: str = "final_url",
    http_status: str = "http_status",
    balance: bool = True,
) -> DataFrame:
    """V6: add ``is_invalid``, ``reason`` and the score columns.

    Layers in order: status 404, missing-page text, redirect, type of the page's data, then category
    signs against product signs. One projection; every page is read once and never leaves its row,
    after a small input has been spread over the cores (``balance``).
    """
    pages = spread(pages) if balance else pages
    staged = pages.withColumn("_page", tx.unescape_script(page)).withColumns(
        {
            "category_score": _matches(F.col("_page"), rules.CATEGORY_SIGNS),
            "product_score": _matches(F.col("_page"), rules.PRODUCT_SIGNS),
            "json_ld_type": jsonld_page_type(F.col("_page")),
            "redirect_detected": redirected(url, final_url),
            "_not_missing": F.col("_page").rlike("(?isu)" + "|".join(rules.NOT_MISSING)),
            "_missing_heading": F.col("_page").rlike("(?isu)" + "|".join(rules.MISSING_HEADING)),
        }
    )
    text_404 = None
    for pattern in rules.MISSING_TEXT:
        test = guarded_match(F.col("_page"), "(?iu)" + pattern)
        label = f"404 page detected (pattern: {pattern[:30]}...)"
        text_404 = F.when(test, label) if text_404 is None else text_404.when(test, label)
    missing = F.when(
        ~F.col("_not_missing"),
        F.when(F.col("_missing_heading"), "404 page detected (H1 contains error message)").otherwise(text_404),
    )
    staged = staged.withColumn("_missing", missing)
    cat, prod, moved = F.col("category_score"), F.col("product_score"), F.col("redirect_detected")
    kind = F.col("json_ld_type")

    def verdict(invalid: bool, reason: Column | str) -> Column:
        return F.struct(F.lit(invalid).alias("is_invalid"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))

    chain = (
        F.when(F.col(http_status) == 404, verdict(True, "HTTP 404 response"))
        .when(F.col("_missing").isNotNull(), verdict(True, F.col("_missing")))
        .when(listing_type(kind), verdict(True, F.concat(F.lit("JSON-LD type indicates listing: "), kind)))
        .when(
            (cat >= 2) & (prod == 0),
            verdict(True, F.concat(F.lit("Category page detected (cat="), cat, F.lit(", prod="), prod, F.lit(")"))),
        )
        .when((cat >= 2) & moved, verdict(True, F.concat(F.lit("Redirected to category page (cat="), cat, F.lit(")"))))
        .when((cat >= 2) & (prod >= 2), verdict(False, "Ambiguous signals, defaulting to valid"))
        .when(prod >= 2, verdict(False, "Valid product page"))
        .when((cat == 0) & (prod == 0) & moved, verdict(True, "Redirected with no product indicators"))
        .when((cat == 0) & (prod == 0), verdict(False, "No clear signals, defaulting to valid"))
        .otherwise(verdict(False, "Passed all checks"))
    )
    return (
        staged.withColumn("_verdict", chain)
        .withColumns({"is_invalid": F.col("_verdict.is_invalid"), "reason": F.col("_verdict.reason")})
        .drop("_page", "_not_missing", "_missing_heading", "_missing", "_verdict")
    )


def structural_verdict(parsed: DataFrame, url: str = "url", product_path: str = rules.PRODUCT_PATH) -> DataFrame:
    """V6 for a retailer judged by its elements: positive signs first, then pagination, cards and path.

    ``parsed`` has ``dom`` and ``jsonld_product`` (the page's data names a Product).
    """
    nodes = F.col("dom.nodes")
    label = lambda n: F.coalesce(n["attrs"]["aria-label"], F.lit(""))
    any_of = lambda test: F.exists(nodes, lambda n: F.coalesce(test(n), F.lit(False)))
    panels = F.filter(
        nodes,
        lambda n: F.coalesce((n["attrs"]["role"] == "tablist"), F.lit(False))
        | F.coalesce((n["attrs"]["data-testid"] == "image-panel"), F.lit(False)),
    )
    staged = parsed.withColumns(
        {
            "has_button": any_of(lambda n: n["attrs"]["data-cy"] == "pdp-add-to-cart")
            | any_of(lambda n: n["attrs"]["data-testid"].isin("pdp-add-to-cart", "add-to-cart-button"))
            | any_of(lambda n: (n["tag"] == "button") & n["attrs"]["class"].contains("add-to-cart")),
            "has_gallery": F.size(html.select(nodes, tag="img", within=panels)) > 0,
            "has_pagination": any_of(lambda n: (n["tag"] == "nav") & label(n).rlike("aginer|aginat")),
            "pagination_pages": page_links(nodes),
            "product_cards": card_count(nodes),
            "url_has_path": F.lower(urls.path_of(url)).contains(product_path),
        }
    )
    c = F.col

    def verdict(invalid: bool, reason: Column | str) -> Column:
        return F.struct(F.lit(invalid).alias("is_invalid"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))

    chain = (
        F.when(c("jsonld_product"), verdict(False, "Valid: has JSON-LD Product schema"))
        .when(c("has_button"), verdict(False, "Valid: has add-to-cart button"))
        .when(c("has_gallery") & c("url_has_path") & ~c("has_pagination"), verdict(False, f"Valid: has gallery on {product_path} URL"))
        .when(
            c("has_pagination") & (c("pagination_pages") >= rules.PAGE_LINK_LIMIT),
            verdict(True, F.concat(F.lit("Invalid: pagination with "), c("pagination_pages"), F.lit(" pages (category page)"))),
        )
        .when(
            c("product_cards") >= rules.DEFAULT_CARD_LIMIT,
            verdict(True, F.concat(F.lit("Invalid: "), c("product_cards"), F.lit(" product cards (category page)"))),
        )
        .when(~c("url_has_path"), verdict(True, f"Invalid: URL doesn't contain {product_path}"))
        .otherwise(verdict(False, "Uncertain: defaulting to valid"))
    )
    return staged.withColumn("_v", chain).withColumns({"is_invalid": c("_v.is_invalid"), "reason": c("_v.reason")}).drop("_v")


def shop_probe() -> html.Probe:
    """Reads, while a page is parsed, its shop's signals and the phrases in its text and in its stock container."""
    return html.Probe("shop", signals.PROBE_TYPE, signals.PROBE_ARROW, ("url", "retailer"), signals.probe)


def verdict_by_retailer(parsed: DataFrame, retailer: str = "retailer", http_status: str | None = "http_status") -> DataFrame:
    """V6 by shop: ``is_invalid`` and ``reason`` under the rules of each page's shop; NULL for a shop without rules.

    ``parsed`` has ``dom`` and ``shop``, which ``parse_pages`` makes with ``shop_probe``. A page that is missing has
    no ``dom``.
    """
    status = F.col(http_status) if http_status else None
    told = signals.verdict(F.col(retailer), F.col("shop"), status, F.col("dom").isNotNull())
    staged = parsed.withColumn("_told", told)
    return staged.withColumns({"is_invalid": F.col("_told.is_invalid"), "reason": F.col("_told.reason")}).drop("_told")
