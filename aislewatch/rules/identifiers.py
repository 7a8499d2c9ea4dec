"""How each retailer numbers its products (U3) and keys or sizes its images."""

from __future__ import annotations

from typing import NamedTuple


class IdRule(NamedTuple):
    """Patterns tried in order on a part of the URL, then a fallback, then a hash or constant."""

    patterns: tuple[tuple[str, str], ...] = ()
    fallback: str = "none"  # segment, tail, raw, stem or none
    hash_length: int = 12
    constant: str = ""
    prefix: str = ""
    upper: bool = False
    keep_fragment: bool = False


# One row per retailer.
ID_RULES: dict[str, IdRule] = {
    "argos": IdRule(((r"/product/(\d{7})", "url"),), "segment"),
    "bandq": IdRule(((r"(\d{8,})", "url"),), hash_length=8),
    "boots": IdRule(((r"(\d{7,})", "url"),), hash_length=10),
    "currys": IdRule(((r"-([0-9]{8})\.html(?:$|\?)", "url"),)),
    "frasers": IdRule(((r"(\d{6,})", "url"),), constant="na"),
    "freemans": IdRule(((r"(?i)A-([A-Z0-9]+)", "url"), (r"(\d{6,})", "url")), constant="freemans"),
    "jdwilliams": IdRule(((r"/p/([a-zA-Z0-9]+)", "url"), (r"(\d{6,})", "url")), constant="jdw"),
    "laredoute": IdRule(((r"(?i)prod-(\d+)", "url"),), "segment"),
    "ligo": IdRule(((r"/products/([^/?#]+)", "url"),)),
    "range": IdRule(((r"#(\d{5,})\b", "url"), (r"(\d{7,})", "url")), hash_length=10, keep_fragment=True),
    "studio": IdRule(((r"-(\d{6,})(?:#|$|\?)", "url"),), keep_fragment=True),
    "tesco": IdRule(((r"(\d{8,})", "url"),), hash_length=8),
    "very": IdRule(((r"/(\d{8,})\.", "url"), (r"/products?/([A-Za-z0-9_-]{1,16})", "url")), hash_length=16),
    "wilko": IdRule(((r"/(\d{6,})(?:/|$)", "path"),), "segment"),
    "ao": IdRule((), "segment"),
    "allegro": IdRule(((r"(\d{10,12})$", "path"),), "tail"),
    "cdon": IdRule(((r"(?i).*/([^/]*[0-9a-f\-]{16,}[^/]*)", "path"),), "segment"),
    "fyndiq": IdRule(((r"(?i).*/([^/]*[0-9a-f\-]{16,}[^/]*)", "path"),), "segment"),
    "cdiscount": IdRule((), "segment"),
    "kaufland": IdRule((), "segment"),
    "homedepot": IdRule((), "raw"),
    "hsn": IdRule(((r"(\d{6,})", "url"),), constant="NA"),
    "jcpenney": IdRule((), "segment"),
    "macys": IdRule(((r"(?:^|&)ID=([^&]+)", "query"),), "raw", prefix="ID-"),
    "overstock": IdRule(((r"/(\d{6,})/product\.html$", "path"),)),
    "qvc": IdRule(((r"(?i)\b([A-Z]\d{5,})\b", "url"),), hash_length=8, upper=True),
    "target": IdRule(((r"(?i)/A-(\d+)", "path"),), prefix="A-"),
    "walmart": IdRule(((r"/ip/[^/]+/(\d+)", "path"), (r"/(\d{7,})\b", "path"))),
    "qvc_uk": IdRule(((r"(?i)\b([A-Z]\d{5,})\b", "url"),), hash_length=8, upper=True),
    "wayfair": IdRule(),
    "wayfair_uk": IdRule(hash_length=8),
    "zola": IdRule(((r"(?i)/product/([^/?#]+)", "path"),), "raw"),
    "binglee": IdRule((), "raw"),
    "harveynorman": IdRule((), "stem"),
    "kitchenware": IdRule((), "stem"),
    "nightingale": IdRule((), "stem"),
    "templeandwebster": IdRule((), "segment"),
    "woolworths": IdRule(((r"/productdetails/([^/]+)", "path"),), "stem"),
}
DEFAULT_ID_RULE = IdRule((), "segment")

# Size segments in image paths and the size to ask for (pattern, replacement).
SIZE_REWRITES: dict[str, tuple[str, str]] = {
    "cdiscount": (r"/\d+x\d+/", "/700x700/"),
    "kaufland": (r"/product-images/\d+x\d+/", "/product-images/1024x1024/"),
    "allegro": (r"/s\d+/", "/original/"),
    "homedepot": (r"(?i)_\d+(\.(?:jpg|jpeg|png|webp))$", "_1000$1"),
    "wayfair_uk": (r"/resize-h\d+-w\d+(?:%5E|\^)compr-r\d+/", "/resize-h1600-w1600%5Ecompr-r85/"),
    "wayfair": (r"/resize-h\d+-w\d+(?:%5E|\^)compr-r\d+/", "/resize-h1600-w1600%5Ecompr-r85/"),
    "kitchenware": (r"w_\d+", "w_2000"),
}

# Sizes offered by two image hosts, largest first.
SIZES = {
    "kaufland": ("1024x1024", "800x800", "600x600", "400x400", "300x300", "200x200", "100x100"),
    "fyndiq": ("1000x1000", "800x800", "712x712", "640x640", "480x480", "360x360", "120x120"),
}
