"""Verdicts by shop (V6): each shop's signals of a page, and its rules over them in order.

A signal is a test of one page; a rule names signals that must, or must not, hold, and the first rule that
fits gives verdict and reason. ``{}`` in a reason stands for the value of a signal, ``{score}`` for the
number of signals that hold among those counted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from aislewatch.rules.validity import ERROR_PHRASES, HEADING_PATTERNS


@dataclass(frozen=True)
class Signal:
    """A test of a page. ``kind`` says which, the other fields what it asks."""

    kind: str
    where: tuple[str, ...] = ()
    pattern: str = ""
    least: int = 1
    cut: int = 0
    lower: bool = False
    area: tuple[str, ...] = ()


def element(*where: str) -> Signal:
    """Any element; the value is the first listed selector that finds one."""
    return Signal("element", where)


def count(least: int, *where: str) -> Signal:
    """At least so many elements, added over the selectors; the value is their number."""
    return Signal("count", where, least=least)


def inner(least: int, outer: str, what: str) -> Signal:
    """At least so many elements inside the first ``outer``."""
    return Signal("inner", (outer, what), least=least)


def text(pattern: str, *where: str, lower: bool = False) -> Signal:
    """The first element of a listed selector has a text like the pattern; the value is its text."""
    return Signal("text", where, pattern, lower=lower)


def any_text(pattern: str, *where: str, area: tuple[str, ...] = ()) -> Signal:
    """Any element of the selectors has a text like the pattern, inside the first area that exists, if any."""
    return Signal("any_text", where, pattern, area=area)


def area_text(pattern: str, *area: str) -> Signal:
    """The first area that exists, or else the whole page, has a text like the pattern."""
    return Signal("area_text", area, pattern)


def said(shop: str, cut: int = 30) -> Signal:
    """A phrase of the shop's list stands in the page's text; the value is the phrase, cut."""
    return Signal("said", (shop,), cut=cut)


def says(pattern: str) -> Signal:
    """The page's text is like the pattern."""
    return Signal("says", pattern=pattern)


def number(pattern: str, least: int) -> Signal:
    """The first number that the pattern finds in the page's text is at least so large; the value is the number."""
    return Signal("number", pattern=pattern, least=least)


def source(pattern: str) -> Signal:
    """The raw page is like the pattern."""
    return Signal("source", pattern=pattern)


def address(pattern: str) -> Signal:
    """The URL is like the pattern; the value is its first group."""
    return Signal("address", pattern=pattern)


def path(pattern: str) -> Signal:
    """The lower-case path of the URL is like the pattern."""
    return Signal("path", pattern=pattern)


def product(key: str = "") -> Signal:
    """The page's data names a Product, with a value under ``key`` if one is given; the value is that value."""
    return Signal("product", pattern=key)


def lost_id(pattern: str) -> Signal:
    """The URL has an id that the raw page does not hold; the value is the id."""
    return Signal("lost_id", pattern=pattern)


def own(pattern: str, selector: str, attribute: str) -> Signal:
    """An element's attribute holds the id of the URL."""
    return Signal("own", (selector, attribute), pattern)


def other_code(pattern: str, *codes: str) -> Signal:
    """The URL has a code, the raw page names codes, and it is not among them; the value is the code."""
    return Signal("other_code", codes, pattern)


@dataclass(frozen=True)
class Rule:
    """The page is ``valid`` or not, with a reason, if ``need`` hold, one of ``one_of`` does, none of ``without``
    does, and between ``least`` and ``most`` of ``among`` do."""

    reason: str
    valid: bool = False
    need: tuple[str, ...] = ()
    one_of: tuple[str, ...] = ()
    without: tuple[str, ...] = ()
    among: tuple[str, ...] = ()
    least: int = 0
    most: int = 63
    value: str = ""


@dataclass(frozen=True)
class Shop:
    signals: dict[str, Signal]
    rules: tuple[Rule, ...] = field(default=())


def _rule(reason: str, *need: str, valid: bool = False, **more) -> Rule:
    return Rule(reason, valid, need, **more)


#: Rules of every shop, before its own.
STATUS_RULE = "HTTP 404 response"
EMPTY_RULE = "empty_response"

SHOPS: dict[str, Shop] = {}

# Fixed values from here on: selectors, patterns, limits and reasons of each shop, in the order they are tried.

SHOPS["next"] = Shop(
    {
        "listing": element(
            "[data-testid='plp-results-title-wrapper']", "[data-testid='plp-results-title-container']",
            "[data-testid='plp-product-title']", "[data-testid='plp-header-wrapper']", ".plp-1eroud2", "[class*='plp-']",
        ),
        "category": text(r"\S", "[data-testid='plp-product-title'] h1, #plp-seo-heading h1"),
        "counted": text(r"\(\d+\)", ".esi-count, [class*='product-count']"),
        "search_url": address(r"/search\?"),
        "search_text": says(r"search results"),
        "error": said("next"),
        "error_element": element(
            ".error-page", "#error-page", ".not-found", "#not-found", "[class*='ErrorPage']", "[class*='NotFound']", "[class*='404']"
        ),
        "named": element("[data-testid*='product-name'], [data-testid*='ProductName']"),
        "carousel": element("[data-testid='image-carousel-slide'], #pdp-image-carousel"),
        "bag": says(r"add to bag"),
        "grid": count(3, "[data-testid*='product-card'], [class*='ProductCard'], .product-tile"),
        "heading": text(HEADING_PATTERNS["next"], "h1", lower=True),
    },
    (
        _rule("category_page:{}", "listing", "category", value="category"),
        _rule("category_page:unknown", "listing"),
        _rule("product_listing:{}", "counted", value="counted"),
        _rule("search_results_page", one_of=("search_url", "search_text")),
        _rule("error_message:{}", "error", value="error"),
        _rule("error_element:{}", "error_element", value="error_element"),
        _rule("product_grid:{}_items", "grid", without=("named", "carousel"), value="grid"),
        _rule("category_title:{}", "heading", without=("bag", "carousel"), value="heading"),
        _rule("valid", valid=True),
    ),
)

SHOPS["frasers"] = Shop(
    {
        "error_element": element(
            "[data-testid='error-view']", "[data-testid='404-title']", ".ErrorView_container__", "[class*='ErrorView']",
            ".error-page", "#error-page", ".not-found", "#not-found",
        ),
        "error": said("frasers"),
        "listing": element(
            "[data-testid='plp-results']", "[data-testid='product-listing']", "[class*='ProductListing']", "[class*='CategoryPage']"
        ),
        "grid": count(3, "[data-testid*='product-card'], [class*='ProductCard'], .product-tile"),
        "purchase": element("button[data-testid='purchase-button']"),
        "gallery": element(".ImageGallery_thumbsContainer, [class*='ImageGallery']"),
        "search_url": address(r"/search\?"),
        "search_text": says(r"search results"),
        "named": element("h1, [data-testid='pdp-title'], [class*='ProductTitle']"),
        "price": element("[data-testid='price'], [itemprop='price']"),
    },
    (
        _rule("error_element:{}", "error_element", value="error_element"),
        _rule("error_message:{}", "error", value="error"),
        _rule("category_page:{}", "listing", value="listing"),
        _rule("product_grid:{}_items", "grid", without=("purchase", "gallery"), value="grid"),
        _rule("search_results_page", one_of=("search_url", "search_text")),
        _rule("no_product_content", without=("named", "price", "purchase", "gallery")),
        _rule("valid", valid=True),
    ),
)

SHOPS["jdwilliams"] = Shop(
    {
        "error": said("jdwilliams"),
        "error_element": element(
            ".error-page", "#error-page", ".not-found", "#not-found", "[class*='ErrorPage']", "[class*='NotFound']", "[class*='404']"
        ),
        "named": element("h1[data-testid='product-name'], h1"),
        "price": element("[data-cy='product-details-price'], [class*='price'], [class*='Price']"),
        "button": element("button[data-ga-tracking-id='addToBagButton']"),
        "cards": count(3, "[class*='ProductCard'], [class*='product-card'], .product-tile"),
        "search_source": source(r"/search\?"),
        "search_text": says(r"search results"),
    },
    (
        _rule("error_message:{}", "error", value="error"),
        _rule("error_element:{}", "error_element", value="error_element"),
        _rule("category_page:{}_products", "cards", without=("named", "price", "button"), value="cards"),
        _rule("no_product_content", without=("named", "price", "button")),
        _rule("redirected_to_search", one_of=("search_source", "search_text")),
        _rule("valid", valid=True),
    ),
)

_LAREDOUTE_SIGNS = ("title", "price", "basket", "carousel", "description", "data")
SHOPS["laredoute"] = Shop(
    {
        "title": element("h1.pdp-title, h2.pdp-title, [data-cerberus='txt_pdp_productName1']"),
        "price": element(".price .value, .price, [data-cerberus='txt_pdp_discountedPrice1'], span.price__value"),
        "basket": element("[data-cerberus='btn_pdp_addToBasket'], .add-to-cart, button[class*='addToCart'], .pdp-add-to-bag"),
        "carousel": element("[id^='prodCarousel_'], .pdp-carousel, .swipe, .pdp-images"),
        "description": element("div.pdp-description, #productDescription, [id^='productDescription_']"),
        "data": product(),
        "error": said("laredoute"),
        "error_element": element(
            ".error-page", "#error-page", ".page-404", "#page-404", "[class*='ErrorPage']", "[class*='NotFound']",
            ".error-content", "#error-content",
        ),
        "cards": count(4, ".product-card, .product-tile, [class*='ProductCard'], [class*='product-item']"),
        "links": inner(6, ".plp-content, .search-results, #searchResults, .category-products", "a[href*='/ppdp/prod-']"),
        "pages": element(".pagination, [class*='Pagination'], .pager, nav[aria-label*='page']"),
        "results": says(r"\d+\s+products?|\d+\s+results?|\d+\s+articles?"),
        "named": text(r"\S", "h1.pdp-title", "h2.pdp-title", "[data-cerberus='txt_pdp_productName1']", "h1", "h2"),
        "data_name": product("name"),
    },
    (
        _rule("valid", valid=True, among=_LAREDOUTE_SIGNS, least=3),
        _rule("error_message:{}", "error", value="error"),
        _rule("error_element:{}", "error_element", value="error_element"),
        _rule("listing_page:{}_cards", one_of=("cards", "links"), among=_LAREDOUTE_SIGNS, most=1, value="cards"),
        _rule("listing_page:pagination_found", "pages", "results", among=_LAREDOUTE_SIGNS, most=1),
        _rule("no_pdp_content:{score}_indicators", among=_LAREDOUTE_SIGNS, most=1),
        _rule("no_product_name", without=("named", "data_name")),
        _rule("valid", valid=True),
    ),
)

_VERY_SIGNS = ("brand", "title", "price", "basket", "description", "gallery", "pictures")
SHOPS["very"] = Shop(
    {
        "brand": element("[data-testid='product_brand']"),
        "title": element("[data-testid='product_title']"),
        "price": element("[data-testid='product-price__basic'], [data-testid='product-price']"),
        "basket": any_text(r"add\s*to\s*basket", "button, a"),
        "description": element("[data-testid='product_description_body']"),
        "gallery": element(".splide, [class*='ThumbnailCarousel'], [class*='ImageGallery']"),
        "pictures": source(r"media\.very\.co\.uk/i/very/[A-Z0-9]+_SQ\d+"),
        "error": said("very"),
        "error_element": element(
            ".error-page", "#error-page", ".page-404", "#page-404", "[class*='ErrorPage']", "[class*='NotFound']",
            "[data-testid='error-page']", "[data-testid='404']",
        ),
        "cards": count(
            4, "[data-testid='product-card'], .product-card, [class*='ProductCard']", ".product-tile, [class*='ProductTile']"
        ),
        "pages": element(".pagination, [class*='Pagination'], [data-testid='pagination']"),
        "results": says(r"\d+\s+products?|\d+\s+results?|\d+\s+items?"),
        "id_lost": lost_id(r"/(\d{8,})\.prd"),
        "named": text(r"\S", "[data-testid='product_brand']", "[data-testid='product_title']", "h1"),
    },
    (
        _rule("valid", valid=True, among=_VERY_SIGNS, least=4),
        _rule("error_message:{}", "error", value="error"),
        _rule("error_element:{}", "error_element", value="error_element"),
        _rule("listing_page:{}_products", "cards", among=_VERY_SIGNS, most=2, value="cards"),
        _rule("listing_page:pagination_found", "pages", "results", among=_VERY_SIGNS, most=2),
        _rule("no_pdp_content:{score}_indicators", among=_VERY_SIGNS, most=2),
        _rule("id_not_found:{}", "id_lost", among=_VERY_SIGNS, most=3, value="id_lost"),
        _rule("no_product_name", without=("named",)),
        _rule("valid", valid=True),
    ),
)

_LIGO_SIGNS = ("title", "price", "cart", "pictures", "form")
SHOPS["ligo"] = Shop(
    {
        "error": said("ligo"),
        "template": element(".template-404, #shopify-section-404, [class*='page-404']"),
        "cards": count(
            3, ".product-card, .product-item, [class*='ProductCard'], [class*='product-grid-item']", ".collection-product, .grid-product"
        ),
        "pages": element(".pagination, [class*='Pagination'], nav[aria-label*='page']"),
        "content": element(".product-single, .product__info, [class*='ProductForm']"),
        "title": element("h1.product-info-heading, h1.page-title, h1.product__title, .product-single__title"),
        "price": element("span.price-item, span.price, .price-box .price, .product__price"),
        "cart": element("button#product-addtocart-button, button.tocart, button[name='add'], form[action*='/cart/add']"),
        "pictures": element("media-gallery, .fotorama, .product-single__photos, .product__media"),
        "form": element("form.product-form, form[action*='/cart/add'], .product-single__form"),
        "search": element(".search-results, #search-results, [class*='SearchResults']"),
        "named": text(r"\S", "h1.product-info-heading", "h1.page-title > span", "h1.product__title", "h1"),
        "data_name": product("name"),
    },
    (
        _rule("error_message:{}", "error", value="error"),
        _rule("shopify_404_template", "template"),
        _rule("collection_page:{}_products", "cards", value="cards"),
        _rule("listing_page:pagination_found", "pages", without=("content",)),
        _rule("no_pdp_content:{score}_indicators", among=_LIGO_SIGNS, most=1),
        _rule("search_results_page", "search"),
        _rule("no_product_name", without=("named", "data_name")),
        _rule("valid", valid=True),
    ),
)

_STUDIO_SIGNS = ("named", "price", "stock", "description", "zoom", "pictures")
SHOPS["studio"] = Shop(
    {
        "error_page": text(r"could not be found|page not found|no longer exists", ".error-main, #error-main, .error-page"),
        "error": said("studio"),
        "named": element("#lblProductName"),
        "price": element("#lblSellingPrice"),
        "stock": element(".stock-level-container-wrapper"),
        "description": element(".productDescriptionInfoText"),
        "zoom": element("a.zoomMainImage[href]"),
        "pictures": element(".innerImageContainer"),
        "cards": count(4, ".product-card, .product-tile, [class*='ProductCard'], .product-item"),
        "links": count(6, "a[href*='/view-'][href$='.html'], a[href*='product']"),
        "pages": element(".pagination, [class*='Pagination'], .pager"),
        "name_text": text(r"\S", "#lblProductName"),
    },
    (
        _rule("error_page_not_found", "error_page"),
        _rule("error_message:{}", "error", value="error"),
        _rule("valid", valid=True, among=_STUDIO_SIGNS, least=3),
        _rule("listing_page:{}_products", one_of=("cards", "links"), among=_STUDIO_SIGNS, most=1, value="cards"),
        _rule("listing_page:pagination_found", "pages", among=_STUDIO_SIGNS, most=1),
        _rule("no_pdp_content:{score}_indicators", among=_STUDIO_SIGNS, most=1),
        _rule("no_product_name", without=("name_text",)),
        _rule("valid", valid=True),
    ),
)

SHOPS["boots"] = Shop(
    {
        "error_div": text(
            r"removed|no longer available|not found", "#WC_GenericError_5, #WC_GenericError_6, .genericError, #genericErrorPage"
        ),
        "error": said("boots", cut=40),
        "named": element("[itemprop='name'], #estore_product_title h1, .pdpTitle"),
        "heading": text(r".{4}", "h1"),
        "error_page": element(".errorPage, .error-page, #errorPage, .genericErrorPage, #WC_GenericError"),
        "price": element("#PDP_productPrice, [itemprop='price'], #schemaOrgPrice, .price, .productPrice"),
        "button": element("#add2CartBtn, [title*='Add to basket' i], button.add-to-basket"),
        "pictures": element(".productImage, #productMainImage, [itemprop='image'], .s7thumb"),
        "description": element("#product_long_description, .productDescription, #pdpDescription"),
        "content": source(r"product_long_description|scene7viewer|estore_product_title"),
        "pages": element(".pagination, .paging, #pagination, [class*='pagination']"),
        "lister": element("#productLister, .productLister, .searchResults, .categoryProducts"),
        "cards": count(3, ".productCard, .product-card, .productListItem, .product-list-item, [class*='productCard']"),
    },
    (
        _rule("product_removed_error_div", "error_div"),
        _rule("error_message:{}", "error", value="error"),
        _rule("error_page_no_product", "error_page", without=("named", "heading")),
        _rule("no_product_content", without=("price", "button", "pictures", "description", "content")),
        _rule("category_page:{}_products", "cards", one_of=("pages", "lister"), value="cards"),
        _rule("valid", valid=True),
    ),
)

_FREEMANS_SIGNS = ("title", "description", "price", "pictures", "bag")
SHOPS["freemans"] = Shop(
    {
        "error": said("freemans"),
        "tiles": count(3, ".productTile, .product-tile, [class*='ProductTile'], [class*='productCard']"),
        "links": count(3, "a.productLink, a[class*='productLink']"),
        "pages": element(".pagination, [class*='Pagination'], .paging, nav[aria-label*='page']"),
        "results": says(r"\d+\s+products?\s+found|\d+\s+results?"),
        "title": element("h1#prodShortDesc, h1.productShortDesc"),
        "description": element("div.productDescription, #prodDescription"),
        "price": element("span.productPriceInteger, .productPrice, [class*='productPrice']"),
        "pictures": element("ul.altProductImages"),
        "bag": element("button.bagButton, button.addToBasket"),
        "code": other_code(
            r"A-([A-Z0-9]+)", r"data-product[^>]*?([A-Z0-9]{5,8})", r"""productCode["\s:]+([A-Z0-9]{5,8})"""
        ),
        "search_source": source(r"searchresults"),
        "search_text": says(r"search results"),
        "search": element(".searchResults, #searchResults, [class*='SearchResults']"),
        "named": text(r"\S", "h1#prodShortDesc", "h1", ".productShortDesc", "[data-testid='pdp-title']"),
        "data_name": product("name"),
    },
    (
        _rule("error_message:{}", "error", value="error"),
        _rule("listing_page:{}_tiles", one_of=("tiles", "links"), value="tiles"),
        _rule("listing_page:pagination_found", one_of=("pages", "results")),
        _rule("no_pdp_content:{score}_indicators", among=_FREEMANS_SIGNS, most=1),
        _rule("code_mismatch:expected_{}", "code", value="code"),
        _rule("search_results_page", "search", one_of=("search_source", "search_text")),
        _rule("no_product_name", without=("named", "data_name")),
        _rule("valid", valid=True),
    ),
)

_NO_PRODUCT_PAGE = "URL is a category/listing page, not a product page"
_NO_STRUCTURE = "Product page structure not found - product may have been removed"
_NO_ELEMENTS = "Page does not contain expected product detail elements"
_WILKO_AREA = (".pdp-content", ".product-detail", "[class*='product-main']", "main", "#content")
_WILKO_MESSAGES = ".pdp-panel, .product-info, .product-message, .alert, .notification"
_WILKO_SIGNS = ("price", "gallery", "title", "basket", "widget")
SHOPS["wilko"] = Shop(
    {
        "listing_url": address(r"/c/\d+|/c/[a-zA-Z\-]+$"),
        "found": text(r"\d+\s*products?\s*found", ".pagination-bar-results"),
        "price": element("div.pdp-price, [class*='pdp-price']"),
        "gallery": element(".pdp-image-gallery, .pdp-image-gallery-thumbnails"),
        "main_gallery": element(".pdp-image-gallery"),
        "listing": element(".product-listing", ".product-grid", ".category-products", "[class*='product-list']"),
        "tiles": count(6, ".product-tile, .product-card"),
        "unavailable": text(
            r"\S", ".product-unavailable", ".product-discontinued", "[class*='not-available']", "[class*='unavailable-message']",
            ".out-of-stock-message",
        ),
        "not_available": any_text(r"this (product|item) is (no longer|not) available", _WILKO_MESSAGES, area=_WILKO_AREA),
        "discontinued": any_text(r"(product|item) has been discontinued", _WILKO_MESSAGES, area=_WILKO_AREA),
        "gone": any_text(r"(product|item) no longer (exists|available)", _WILKO_MESSAGES, area=_WILKO_AREA),
        "missing": text(r"page not found|404|not found", "title"),
        "error_page": element(".error-page", ".page-not-found", "#error-container"),
        "title": element("h1.name[itemprop='name'], .product-title h1"),
        "basket": element("[class*='add-to-basket'], [class*='add-to-cart']"),
        "widget": element(".product-widget, .pdp-panel"),
        "product_url": address(r"/p/\d+"),
    },
    (
        _rule(_NO_PRODUCT_PAGE, one_of=("listing_url", "found")),
        _rule(_NO_PRODUCT_PAGE, one_of=("listing", "tiles"), without=("price", "main_gallery")),
        _rule("{}", "unavailable", value="unavailable"),
        _rule("Product is no longer available", "not_available"),
        _rule("Product has been discontinued", "discontinued"),
        _rule("Product no longer exists", "gone"),
        _rule("Page not found (404)", "missing"),
        _rule("Error page detected", "error_page"),
        _rule("valid", valid=True, among=_WILKO_SIGNS, least=1),
        _rule(_NO_STRUCTURE, "product_url"),
        _rule(_NO_ELEMENTS),
    ),
)

_TESCO_SIGNS = ("title", "price", "picture")
SHOPS["tesco"] = Shop(
    {
        "error_box": text(
            r"not down this aisle|page is missing|page not found|can't find|cannot find",
            ".M90PRG_container, [class*='error'], [class*='Error']",
        ),
        "error_heading": text(r"not down this aisle|page not found|sorry|oops|error", "h1"),
        "error": says(
            r"not down this aisle|that page is missing|page (has been|was) (removed|deleted)|product (is )?no longer available"
            r"|item (is )?no longer available|we couldn'?t find (that|this) page"
            r"|sorry,?\s*(this|the) page (doesn'?t|does not) exist|404\s*-?\s*(page)?\s*not found"
        ),
        "tiles": count(4, "[data-auto='product-tile'], .product-list-item, .product-tile"),
        "title": element("[data-auto='pdp-product-title'], h1"),
        "price": element("p[class*='priceText'], [data-auto*='price']"),
        "button": element("[data-auto='ddsweb-quantity-controls-add-button']"),
        "picture": element("[data-auto='product-image'], img[class*='product']"),
        "state": source(r'"ProductType:|"apolloCache"'),
        "data": product(),
    },
    (
        _rule("error_page:tesco_not_found", "error_box"),
        _rule("error_page:h1_error", "error_heading"),
        _rule("error_page:pattern_match", "error"),
        _rule("listing_page:{}_product_tiles", "tiles", value="tiles"),
        _rule("valid", valid=True, one_of=("state", "data", "button")),
        _rule("missing_pdp_elements:score_{score}/3", among=_TESCO_SIGNS, most=1),
        _rule("valid", valid=True),
    ),
)

_QVC_SIGNS = ("named", "price", "pictures")
SHOPS["qvc_uk"] = Shop(
    {
        "error_section": text(
            r"can't find|cannot find|doesn't exist|no longer available|page not found|been moved|been removed",
            "section#error[data-module-type='error'], section.qModule[data-module-type='error'], section[data-module-feature-name='error']",
        ),
        "oops": text(r"^oops!$|page not found", "h1"),
        "not_found": text(r"can't find|cannot find|doesn't exist", "h2"),
        "error": says(
            r"this page (has been|was) (removed|deleted)|product (is )?no longer available|item (is )?no longer available"
            r"|we couldn'?t find (that|this) page|sorry,?\s*(this|the) page (doesn'?t|does not) exist"
            r"|404\s*-?\s*(page)?\s*not found"
        ),
        "cards": count(4, ".productItem, .product-tile, .searchProduct, .plpProduct"),
        "pages": count(3, ".pagination a, .paging a, .pageNumber"),
        "named": element("h1, meta[property='og:title']"),
        "price": element("span.pdpPrice, .price, [data-qvc-price]"),
        "button": element("#btnAddToCart, .btnAddToCart, button[id='btnAddToCart']"),
        "pictures": element("#imageThumbnails, .productImage, .pdpImage"),
        "data": product(),
        "product_url": address(r"\.product\.|/product/"),
        "listing_url": address(r"/category/|/search/|/browse/|/shop/"),
    },
    (
        _rule("error_page:qvc_error_section", "error_section"),
        _rule("error_page:oops_404", "oops", "not_found"),
        _rule("error_page:oops_header", "oops"),
        _rule("error_page:pattern_match", "error"),
        _rule("listing_page:{}_product_cards", "cards", value="cards"),
        _rule("listing_page:pagination_{}_pages", "pages", value="pages"),
        _rule("valid", valid=True, one_of=("data", "button")),
        _rule("missing_pdp_elements:score_{score}/3", among=_QVC_SIGNS, most=1),
        _rule("url_pattern:category_or_search", "listing_url", without=("product_url",)),
        _rule("valid", valid=True),
    ),
)

_AO_SIGNS = ("title", "price", "summary", "gallery", "basket")
SHOPS["ao"] = Shop(
    {
        "listing_url": path(r"/l/|/cat/|/search"),
        "results": says(
            r"\d[\d,]*\s*results?\b|showing\s+\d+\s*-\s*\d+\s+of\s+\d+|\d+\s+products?\s*found|we found \d+ products"
        ),
        "listing": element(
            "[data-testid='product-grid']", "[data-testid='product-list']", ".product-grid", ".product-list", ".search-results",
            ".category-products",
        ),
        "cards": count(4, "[data-testid='product-card'], .product-card, .product-tile"),
        "filters": element("[data-testid='filter-sidebar']", ".filter-panel", ".facet-list", "[class*='refinement']"),
        "unavailable": text(r"\S", "[data-testid='product-discontinued']", ".product-discontinued", ".product-removed"),
        "discontinued": area_text(
            r"this product (has been|is) discontinued|this product is no longer available|product (has been )?removed"
            r"|we no longer (stock|sell) this",
            "main, #content, .product-detail",
        ),
        "missing": text(r"page not found|404|not found", "title"),
        "title": element("h1#pageTitle[itemprop='name'], h1#pageTitle"),
        "price": element("[data-testid='standard-price-pod'], .price-pod, [class*='price']"),
        "summary": element("#product-summary-webshop, [data-testid='product-summary']"),
        "gallery": element("#galleryThumbs, .product-gallery, [data-testid='product-gallery']"),
        "basket": element(".addToBasket, .btn-add-to-basket, [data-testid='add-to-basket']"),
        "product_url": address(r"\.aspx"),
    },
    (
        _rule(_NO_PRODUCT_PAGE, one_of=("listing_url", "results", "listing", "cards", "filters")),
        _rule("{}", "unavailable", value="unavailable"),
        _rule("Product has been discontinued", "discontinued"),
        _rule("Page not found (404)", "missing"),
        _rule("valid", valid=True, among=_AO_SIGNS, least=1),
        _rule(_NO_STRUCTURE, "product_url"),
        _rule(_NO_ELEMENTS),
    ),
)

_CURRYS_PID = r"-([0-9]{8})\.html(?:$|\?)"
SHOPS["currys"] = Shop(
    {
        "data": product(),
        "data_name": product("name"),
        "detail": element("#js-product-detail, [data-component='product-detail'], [data-test='product-detail-page'], .pdp-container"),
        "pid": address(_CURRYS_PID),
        "pid_pictures": own(_CURRYS_PID, "img[src*='media.currys.biz']", "src"),
        "cards": count(
            3,
            "[data-component='product-card'], [data-test='product-card'], .product-card, .productCard, [class*='ProductCard'], .product-list-item",
        ),
        "pages": element("[data-component='pagination'], .pagination, [aria-label='Pagination'], nav[aria-label*='page']"),
        "heading": text(HEADING_PATTERNS["currys"], "h1"),
        "h1": text(r"", "h1"),
        "long_heading": text(r".{20}|\d", "h1"),
        "error": said("currys"),
        "filters": element("[data-component='filter'], [data-test='filter'], .filter-panel, .facet-navigation, [aria-label*='Filter']"),
        "button": element("button.add-to-cart, .addToCartActionButton button"),
    },
    (
        _rule("Product not found message detected", "error"),
        _rule("Category page detected (multiple products + pagination)", "cards", "pages"),
        _rule("Category page detected (multiple products + filters)", "cards", "filters"),
        _rule("Category page detected (H1='{}', no Product schema)", "heading", without=("data",), value="heading"),
        _rule("Category page detected (H1='{}', multiple product cards)", "heading", "cards", value="heading"),
        _rule("No product data found for PID {}", "pid", without=("pid_pictures", "data"), value="pid"),
        _rule("No product content found (H1='{}')", without=("long_heading", "detail", "data"), value="h1"),
        _rule("Valid: Product schema found", "data_name", valid=True),
        _rule("Valid: Product detail page with images", "detail", "pid_pictures", valid=True),
        _rule("Valid: Product page with add-to-cart", "button", "detail", valid=True),
        _rule("Uncertain: defaulting to valid", valid=True),
    ),
)

_CDISCOUNT_SIGNS = ("data", "title", "buybox", "viewer", "description", "heading")
SHOPS["cdiscount"] = Shop(
    {
        "scene": source(r'"currentSceneContext":\{.{0,240}?"contentType":"(SHOWCASE|PRODUCTLISTER)"'),
        "lister": source(r'"pageType":"(PRODUCTLISTER)"'),
        "product_url": path(r"/f-.*\.html$"),
        "listing_url": path(r"/l-\d+(-\d+)?\.html"),
        "category_url": path(r"/v-.*\.html$"),
        "data": product("offers"),
        "title": text(r"\S", "h1[itemprop='name']"),
        "buybox": element("div.c-buybox__price, [class*='buybox'], [data-qa='buybox'], #fpAddBsk, [data-qa='add-to-cart']"),
        "viewer": element(
            ".c-productViewer, [class*='productViewer'], [data-qa='product-gallery'], .fpImgZmCt, #fpImgZmCt, "
            "li.scroller-item button[aria-label*='slide']"
        ),
        "description": text(r".{51}", "#MarketingLongDescription, [itemprop='description'], .fpDescTb, #fpDescTb"),
        "any_heading": text(r".{6}", "h1"),
        "pages": inner(3, "nav[aria-label='Pagination'], nav.pagination-wrapper", "a[aria-label*='page'], a.button-item"),
        "page_links": count(3, "a[aria-label*='Aller à la page'], a[aria-label*='Go to page']"),
        "cards": count(
            4, "[data-testid='product-card'], article[class*='product'], .c-product, [class*='ProductCard'], div[data-productid]"
        ),
        "error": said("cdiscount"),
    },
    (
        _rule("page_type:{}", "scene", value="scene"),
        _rule("page_type:{}", "lister", value="lister"),
        _rule("listing_url", "listing_url", without=("product_url",)),
        _rule("category_url", "category_url", without=("product_url",)),
        _rule("valid", "product_url", valid=True, one_of=("data", "title", "buybox", "viewer", "description", "any_heading")),
        _rule("valid", valid=True, among=("data", "title", "buybox", "viewer", "description"), least=2),
        _rule("listing_page:{}_pages", "pages", value="pages"),
        _rule("listing_page:{}_pages", "page_links", value="page_links"),
        _rule("listing_page:{}_products", "cards", value="cards"),
        _rule("error_message:{}", "error", value="error"),
        _rule("valid", "product_url", valid=True),
        _rule("no_product_signs", without=("data", "title", "buybox", "viewer", "description")),
        _rule("valid", valid=True),
    ),
)

SHOPS["cdon"] = Shop(
    {
        "data": product(),
        "button": element(
            "[data-cy='pdp-add-to-cart'], [data-testid='pdp-add-to-cart'], button[class*='add-to-cart'], "
            "[data-testid='add-to-cart-button']"
        ),
        "gallery": element("[role='tablist'] img, [data-testid='image-panel'] img"),
        "pagination": element("nav[aria-label='Paginering'], nav[aria-label='Pagination'], nav[role='navigation'][aria-label*='aginering']"),
        "pages": inner(
            3,
            "nav[aria-label='Paginering'], nav[aria-label='Pagination'], nav[role='navigation'][aria-label*='aginering']",
            "a[aria-label*='sida'], a[aria-label*='page']",
        ),
        "cards": count(
            4, "[data-testid='product-card'], [class*='product-card'], [class*='ProductCard'], article[class*='product']"
        ),
        "product_url": path(r"/produkt/"),
        "error": said("cdon"),
    },
    (
        _rule("Valid: has JSON-LD Product schema", "data", valid=True),
        _rule("Valid: has add-to-cart button", "button", valid=True),
        _rule("Valid: has gallery on /produkt/ URL", "gallery", "product_url", valid=True, without=("pagination",)),
        _rule("Invalid: pagination with {} pages (category page)", "pages", value="pages"),
        _rule("Invalid: {} product cards (category page)", "cards", value="cards"),
        _rule("Invalid: URL doesn't contain /produkt/", without=("product_url",)),
        _rule("error_message:{}", "error", value="error"),
        _rule("Uncertain: defaulting to valid", valid=True),
    ),
)

SHOPS["allegro"] = Shop(
    {
        "missing": said("allegro"),
        "missing_picture": element("img[alt*='404'], img[alt*='illustration 404'], img[alt*='ilustracja 404']"),
        "home": element("a[href='/']"),
        "help": element("a[href='/pomoc']"),
        "heading": element("h1"),
        "nothing": text(r"nothing here", "h1"),
        "ended": said("ended"),
        "ended_label": element("[data-analytics-view-label='Ended']"),
        "stop_sign": element("img[src*='information-common-stop-sign']"),
        "ended_heading": any_text(r"zakończona|completed|ended", "h6"),
        "unavailable": said("unavailable"),
    },
    (
        _rule("404 - Page not found", "missing"),
        _rule("404 - Page not found (illustration detected)", "missing_picture"),
        _rule("404 - Page not found (navigation pattern)", "home", "help", without=("heading",)),
        _rule("404 - Page not found (navigation pattern)", "home", "help", "nothing"),
        _rule("Listing ended (Sprzedaż zakończona)", "ended"),
        _rule("Listing ended (data-analytics-view-label)", "ended_label"),
        _rule("Listing ended (stop sign icon)", "stop_sign"),
        _rule("Listing ended (h6 header)", "ended_heading"),
        _rule("Product unavailable", "unavailable"),
        _rule("valid", valid=True),
    ),
)

_WAYFAIR_SIGNS = ("price", "product_heading", "carousel", "specs", "button", "sku")
SHOPS["wayfair_uk"] = Shop(
    {
        "missing": text(r"page not found|404|not found", "title"),
        "error_element": element(".error-page", ".page-not-found", "[data-test-id='ErrorPage']", "[data-test-id='404Page']"),
        "removed": said("wayfair_uk"),
        "listing_url": path(r"/sb[012]/|-c\d{5,}\.html$"),
        "items": number(r"(\d[\d,]*)\s*items?\b", 2),
        "results": number(r"(\d[\d,]*)\s*results?\b", 2),
        "any_count": says(r"\d[\d,]*\s*(?:items?|results?)\b"),
        "heading": text(HEADING_PATTERNS["wayfair_uk"], "h1", lower=True),
        "grid": inner(
            3, "[data-test-id='ProductGrid'], [class*='ProductGrid'], [class*='product-grid']", "[data-test-id='ProductCard'], [class*='ProductCard']"
        ),
        "cards": count(11, "[data-test-id='ProductCard'], [class*='ProductCard']"),
        "some_cards": count(6, "[data-test-id='ProductCard'], [class*='ProductCard']"),
        "filters": element("[data-test-id='FilterSidebar'], [class*='FilterSidebar'], [class*='filter-sidebar']"),
        "sorting": element("[data-test-id='SortDropdown'], [class*='SortDropdown'], [class*='sort-dropdown']"),
        "price": element("[data-test-id='PriceDisplay'] [class*='SFPrice'], [data-test-id='ProductPrice']"),
        "product_heading": text(
            r"(?!\s*(?:mixers?|attachments?|kettles?|toasters?|blenders?)\s*(?:&|$))"
            r"(?:.{21}|.*\b(?:vq|laura ashley|morphy richards|russell hobbs|delonghi|breville|smeg|kitchenaid)\b|.*\b\d+[a-z]*\b"
            r"|.*\b(?:hand mixer|stand mixer|food processor|coffee maker|espresso|toaster oven)\b)",
            "h1",
        ),
        "carousel": element("[data-test-id='pdp-mt-thumbnails'], #MediaTrayCarouselWithThumbnailSidebar"),
        "specs": element("[data-test-id='ProductDetails'], [data-test-id='ProductSpecs']"),
        "button": element("[data-test-id='AddToCartButton'], button[class*='AddToCart']"),
        "sku": element("[data-test-id='ProductSku'], [class*='ProductSku']"),
        "product_url": address(r"/pdp/"),
    },
    (
        _rule("page_not_found_404", "missing"),
        _rule("error_element:{}", "error_element", value="error_element"),
        _rule("product_removed:{}", "removed", value="removed"),
        _rule("category_url_pattern", "listing_url"),
        _rule("listing_page:{}_items", "items", value="items"),
        _rule("search_results:{}_results", "results", value="results"),
        _rule("category_title:{}", "heading", "any_count", value="heading"),
        _rule("product_grid:{}_cards", "grid", value="grid"),
        _rule("multiple_product_cards:{}", "cards", value="cards"),
        _rule("filter_sort_with_listing", one_of=("any_count", "some_cards"), among=("filters", "sorting"), least=1),
        _rule("valid", valid=True, among=_WAYFAIR_SIGNS, least=3),
        _rule("valid", "product_url", valid=True, one_of=("carousel", "button")),
        _rule("pdp_url_redirected_to_category", "product_url"),
        _rule("valid", valid=True, one_of=("carousel", "button"), among=_WAYFAIR_SIGNS, least=2),
        _rule("insufficient_pdp_indicators:{score}", among=_WAYFAIR_SIGNS),
    ),
)

#: Every list that a signal may ask for, by its name.
PHRASE_LISTS = ERROR_PHRASES
