"""Price strategies by retailer (P11): where a price is looked for, in order, and what the find is called."""

from __future__ import annotations

from typing import Any, NamedTuple


class Strategy(NamedTuple):
    """One place to look.

    ``kind`` is ``node`` (element test in ``where``; ``attr`` names an attribute, else the element's
    text), ``meta`` (names in ``where``), ``jsonld``, ``script`` (pattern over the raw page in
    ``where``) or ``body`` (the page's whole text). ``floor`` drops implausibly small finds.
    """

    kind: str
    source: str
    where: Any = None
    parse: str = "dollars"
    attr: str | None = None
    floor: int | None = None


def _microdata(parse: str, source: str = "microdata") -> tuple[Strategy, ...]:
    test = {"attrs": {"itemprop": "price"}}
    return (Strategy("node", source, test, parse, "content"), Strategy("node", source, test, parse))


# One list per retailer, in the order the places are believed.
PRICE_STRATEGIES: dict[str, tuple[Strategy, ...]] = {
    "macys": (
        Strategy("node", "macys-aria", {"tag": "span", "contains": {"aria-label": "Current Price"}}, attr="aria-label"),
        Strategy("node", "macys-price-wrapper", {"tag": "div", "cls": "price-wrapper"}),
        Strategy("meta", "og:price", ("og:price:amount", "price")),
        *_microdata("dollars"),
        Strategy("jsonld", "jsonld"),
    ),
    "target": (
        Strategy("node", "target-price", {"attrs": {"data-test": "product-price"}}),
        Strategy("node", "target-price-container", {"attrs": {"data-test": "@web/Price/PriceFull"}}),
        Strategy("node", "price-module", {"attrs": {"data-module-type": "ProductDetailPrice"}}),
        Strategy("script", "regex-product-price", r'data-test="product-price"[^>]*>\s*\$?([\d,]+\.?\d*)'),
        Strategy("script", "tgt-data-formatted", r'formatted_current_price\\":\\"(\$[\d,.]+)\\"'),
        Strategy("script", "tgt-data-current-retail", r'current_retail\\":(\d+\.?\d*)', floor=5),
        Strategy("script", "tgt-data-reg-retail", r'reg_retail\\":(\d+\.?\d*)', floor=5),
        Strategy("script", "tgt-data-formatted-alt", r'"formatted_current_price"\s*:\s*"(\$[\d,.]+)"'),
        Strategy("script", "tgt-data-current-retail-alt", r'"current_retail"\s*:\s*([\d.]+)', floor=5),
        Strategy("jsonld", "jsonld"),
        Strategy("script", "regex-jsonld-price", r"""\"price\"\s*:\s*["']?(\d+\.?\d*)["']?""", floor=5),
        *_microdata("dollars"),
        Strategy("script", "regex-class-price", r'class="[^"]*[Pp]rice[^"]*"[^>]*>\s*\$(\d+\.?\d*)'),
        Strategy("script", "regex-nearby-price", r"(?i)price[^$]{0,50}\$(\d+\.\d{2})"),
    ),
    "overstock": (
        Strategy("node", "onsite", {"tag": "span", "attrs": {"data-testid": "product-price-amount"}}),
        Strategy("jsonld", "jsonld"),
        *_microdata("dollars"),
    ),
    "walmart": (
        Strategy("node", "hero-price", {"attrs": {"itemprop": "price", "data-seo-id": "hero-price"}}, "any"),
        Strategy("node", "itemprop", {"attrs": {"itemprop": "price"}}, "any"),
        Strategy("meta", "meta", ("product:price:amount",)),
    ),
    "homedepot": (
        Strategy("node", "onsite", {"attrs": {"data-testid": "price"}}),
        Strategy("node", "onsite", {"tag": "div", "cls": "price__numbers"}),
    ),
    "frasers": (
        Strategy("node", "price-testid-attr", {"tag": "p", "attrs": {"data-testid": "price"}}, "minor", "data-testvalue"),
        Strategy("node", "price-testid-text", {"tag": "p", "attrs": {"data-testid": "price"}}, "pounds"),
        *_microdata("bare_pounds", "itemprop"),
        Strategy("jsonld", "jsonld"),
        Strategy("body", "body", parse="pounds"),
    ),
    "argos": (*_microdata("bare_pounds", "dom"), Strategy("jsonld", "jsonld"), Strategy("body", "body", parse="pounds")),
    "wilko": (
        Strategy("node", "onsite", {"tag": "div", "cls": "pdp-price"}, "pounds"),
        Strategy("node", "onsite", {"contains": {"class": "pdp-price"}}, "pounds"),
        Strategy("node", "widget", {"cls": "product-widget__price"}, "pounds"),
        Strategy("node", "widget", {"attrs": {"itemprop": "price"}}, "pounds"),
    ),
    "very": (
        Strategy("node", "onsite", {"attrs": {"data-testid": "product-price__basic"}}, "pounds"),
        Strategy("body", "body", parse="pounds"),
    ),
    "jdwilliams": (
        Strategy("node", "price-block", {"tag": "div", "attrs": {"data-cy": "product-details-price"}}, "pounds"),
        Strategy("jsonld", "jsonld"),
        Strategy("body", "body", parse="pounds"),
    ),
    "allegro": (
        Strategy("node", "dom", {"contains": {"class": "_7030e_"}}, "zloty"),
        Strategy("node", "dom", {"attrs": {"data-box-name": "price"}}, "whole_zloty"),
        Strategy("node", "dom", {"contains": {"aria-label": "cena"}}, "whole_zloty"),
        Strategy("node", "dom", {"contains": {"aria-label": "price"}}, "whole_zloty"),
        Strategy("jsonld", "jsonld", parse="plain"),
        Strategy("script", "script", r'"(?:presentableValue|priceAmount|amount)"\s*:\s*"(\d{1,6}[.,]\d{2})"', "euros"),
        Strategy("script", "script", r'"minorUnits"\s*:\s*(\d{3,8})', "minor"),
        Strategy("meta", "meta", ("og:price:amount", "product:price:amount", "price"), "plain"),
    ),
    "cdiscount": (
        Strategy("jsonld", "jsonld", parse="plain"),
        Strategy("node", "itemprop", {"attrs": {"itemprop": "price"}}, "plain", "content"),
        Strategy("node", "data-e2e", {"attrs": {"data-e2e": "price"}}, "euros"),
        Strategy("node", "buybox", {"tag": "div", "cls": "c-buybox__price"}, "euros"),
    ),
    "cdon": (Strategy("jsonld", "jsonld", parse="plain"), Strategy("body", "onsite", parse="kronor")),
    "fyndiq": (Strategy("jsonld", "jsonld", parse="plain"), Strategy("body", "onsite", parse="kronor")),
    "kaufland": (
        Strategy("node", "onsite", {"attrs": {"data-testid": "product-price"}}, "euros"),
        Strategy("node", "onsite", {"cls": "rd-price-information__price"}, "euros", "aria-label"),
        Strategy("jsonld", "jsonld", parse="euros"),
    ),
    "harveynorman": (
        Strategy("node", "price-display aria-label", {"tag": "span", "starts": {"aria-label": "Amount:"}}, attr="aria-label"),
        Strategy("node", "price-display text", {"attrs": {"data-testid": "price-display"}}),
        Strategy("node", "PriceCard", {"tag": "div", "contains": {"class": "PriceCard_sf-price-card"}}),
        Strategy("meta", "meta[itemprop=price]", ("price",)),
        Strategy("script", "script JSON", r'"(?:price|salePrice)"\s*:\s*"?(\d+(?:\.\d{2})?)"?'),
    ),
    "tesco": (
        Strategy("script", "apollo", r'"price"\s*:\s*\{[^{}]*"actual"\s*:\s*([\d.]+)', "plain"),
        Strategy("node", "dom", {"tag": "p", "contains": {"class": "priceText"}}, "pounds"),
        Strategy("jsonld", "jsonld", parse="plain"),
        Strategy("body", "body", parse="pounds"),
    ),
    "hsn": (*_microdata("any", "itemprop"), Strategy("body", "body", parse="any")),
    "studio": (Strategy("node", "onsite", {"id": "lblSellingPrice"}, "pounds"),),
    "ao": (
        Strategy("node", "onsite", {"attrs": {"data-testid": "standard-price-pod"}}, "pounds"),
        Strategy("body", "onsite", parse="pounds"),
    ),
    "freemans": (Strategy("body", "body", parse="pounds"), Strategy("jsonld", "jsonld", parse="plain")),
    "currys": (
        Strategy("jsonld", "jsonld", parse="plain"),
        Strategy("node", "onsite", {"attrs": {"data-component": "product-price"}}, "pounds"),
        Strategy("node", "onsite", {"attrs": {"data-test": "product-price-primary"}}, "pounds"),
        Strategy("node", "onsite", {"cls": "pdp-price"}, "pounds"),
    ),
    "laredoute": (
        Strategy("jsonld", "jsonld", parse="plain"),
        Strategy("node", "onsite", {"cls": "price"}, "pounds"),
        Strategy("node", "onsite", {"attrs": {"data-cerberus": "txt_pdp_discountedPrice1"}}, "pounds"),
        Strategy("node", "onsite", {"tag": "span", "cls": "price__value"}, "pounds"),
        Strategy("node", "onsite", {"contains": {"class": "showSalePriceAfter_"}}, "pounds"),
        Strategy("node", "onsite", {"cls": "product-price"}, "pounds"),
    ),
}
DEFAULT_STRATEGIES: tuple[Strategy, ...] = (
    Strategy("node", "dom", {"attrs": {"data-testid": "price"}}, "signed"),
    Strategy("node", "dom", {"attrs": {"data-testid": "product-price"}}, "signed"),
    Strategy("jsonld", "jsonld", parse="plain"),
    Strategy("meta", "meta", ("og:price:amount", "product:price:amount"), "plain"),
    *_microdata("signed", "itemprop"),
)
