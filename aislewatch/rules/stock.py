"""Stock phrases and precedence by retailer (K)."""

from __future__ import annotations

# Phrases that mean "cannot be bought", by language, in the order they are tried.
NEGATIVE_PHRASES = {
    "en": [
        "back in stock soon", "currently unavailable", "temporarily unavailable", "out of stock", "sold out",
        "notify me when available", "email me when in stock", "email me when back in stock",
        "this one flew off the shelves", "temporarily out of stock", "temporarily out",
        "no longer available", "not available", "unavailable",
    ],
    "pl": ["brak w magazynie", "brak", "wyprzedane", "niedostępny"],
    "sv": ["slut i lager", "tillfälligt slut", "tillfalligt slut", "ej i lager", "inte tillgänglig", "inte tillganglig"],
    "de": [
        "not currently available", "currently not available", "nicht verfügbar", "ausverkauft", "nicht lieferbar",
        "leider nicht", "unfortunately not",
    ],
    "fr": ["rupture de stock", "rupture", "indisponible", "épuisé"],
}
# Phrases that mean "can be bought", by language.
POSITIVE_PHRASES = {
    "en": ["in stock", "add to basket", "add to cart", "add to bag", "add to trolley"],
    "pl": ["dodaj do koszyka"],
    "sv": ["lägg i varukorg", "i lager"],
    "de": ["in den warenkorb", "lieferbar", "verfügbar"],
    "fr": ["ajouter au panier", "en stock", "disponible"],
}
# Elements that tell the stock, by shop; their texts are read before the page's.
STOCK_CONTAINERS = {
    "ao": ".bg-ui-warning, [class*='stock-message'], [class*='availability'], [data-testid='stock-status'], [data-testid='availability']",
    "kaufland": ".rd-notification--error, .rd-notification--warning, .rd-sidebar-notification, "
    ".rd-sidebar-notification__out-of-stock--bold, [class*='out-of-stock']",
    "cdon": "[data-cy='pdp-add-to-cart'], [data-testid='pdp-add-to-cart']",
}
# Button texts.
BUY_TEXT = r"add\s*to\s*(?:basket|cart|bag|trolley)|lägg i varukorg|in den warenkorb|dodaj do koszyka|ajouter au panier"
NOT_YET_TEXT = r"notify me|pre-?order|coming soon|email me"

# Order in which signals are believed, and the answer when none speaks.
PRECEDENCE: dict[str, tuple[str, ...]] = {
    "ao": ("negative", "button", "jsonld"),
    "jdwilliams": ("negative", "button", "jsonld"),
    "macys": ("negative", "button", "jsonld"),
    "wayfair": ("negative", "button", "jsonld"),
    "wayfair_uk": ("negative", "button", "jsonld"),
    "bandq": ("button", "negative", "jsonld"),
    "qvc": ("button", "negative", "jsonld"),
    "qvc_uk": ("button", "negative", "jsonld"),
    "target": ("button", "negative", "jsonld"),
    "currys": ("button", "negative", "jsonld"),
    "allegro": ("jsonld", "button", "negative"),
    "overstock": ("jsonld", "button", "negative"),
    "laredoute": ("jsonld", "button", "negative"),
}
DEFAULT_PRECEDENCE = ("button", "jsonld", "negative")
UNKNOWN_IS_SOLD_OUT = ("currys",)
# Retailers for which a pre-order or discontinued offer counts as sold out.
PREORDER_IS_SOLD_OUT = ("wayfair_uk",)
