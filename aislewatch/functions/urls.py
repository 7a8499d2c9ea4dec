"""URL and identifier expressions (U)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewatch.functions.text import bind
from aislewatch.rules.identifiers import IdRule
from aislewatch.rules.retailers import RETAILERS

_ID_CHARS = r"[^\w\-]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` with NULL, not an empty string, where nothing matches."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


# --- U1, U2, U6, U7 ---------------------------------------------------------------------------


def drop_query(url: Column | str) -> Column:
    return F.regexp_replace(_col(url), r"[?#].*$", "")


def path_of(url: Column | str) -> Column:
    """Path with its leading slash, empty when the URL has none."""
    return F.regexp_extract(drop_query(url), r"^(?:[A-Za-z][\w+.\-]*:)?//[^/]*(/.*)$", 1)


def query_of(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), r"^[^?#]*\?([^#]*)", 1)


def host_of(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(_col(url), r"^(?:[A-Za-z][\w+.\-]*:)?//([^/?#:]+)", 1))


def host_slug(url: Column | str) -> Column:
    """First label of the host without ``www.``; ``site`` where there is no host."""
    label = F.split_part(F.regexp_replace(host_of(url), r"^www\.", ""), F.lit("."), F.lit(1))
    return F.coalesce(F.nullif(label, F.lit("")), F.lit("site"))


def _shop(url: Column | str, table: Mapping[str, str]) -> Column:
    """Value of the longest listed host that the URL's host is, or is below."""
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    upper = F.regexp_replace(host, r"^[^.]+\.", "")
    return F.coalesce(F.element_at(known, host), F.element_at(known, upper))


def retailer_of(url: Column | str) -> Column:
    """Retailer key of a URL: that of a listed host, else the host's slug. Two shops of one name have two keys."""
    return F.coalesce(_shop(url, {host: key for host, key, _ in RETAILERS}), host_slug(url))


def country_of(url: Column | str) -> Column:
    """Country code of a listed host, else NULL."""
    return _shop(url, {host: country for host, _, country in RETAILERS})


def query_param(url: Column | str, name: str) -> Column:
    return extract(query_of(url), rf"(?:^|&){name}=([^&]*)")


def absolutise(url: Column | str, base: Column | str) -> Column:
    """Resolve scheme-relative, root-relative and plain relative references."""
    url, base = _col(url), _col(base)
    scheme = F.regexp_extract(base, r"^([A-Za-z][\w+.\-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][\w+.\-]*://[^/?#]+)", 1)
    folder = F.regexp_replace(drop_query(base), r"(?<=[^/:])/[^/]*$", "")
    return (
        F.when(url.startswith("//"), F.concat(scheme, F.lit(":"), url))
        .when(url.startswith("/"), F.concat(origin, url))
        .when(url.rlike(r"^[A-Za-z][\w+.\-]*:"), url)
        .otherwise(F.concat(folder, F.lit("/"), url))
    )


def repair(url: Column | str) -> Column:
    """Add a missing scheme and encode white space."""
    trimmed = F.trim(_col(url))
    with_scheme = F.when(
        (trimmed == "") | trimmed.rlike(r"(?i)^https?://"), trimmed
    ).otherwise(F.concat(F.lit("https://"), trimmed))
    return F.regexp_replace(with_scheme, r"\s+", "%20")


# --- U3, U4, U5: identifiers ------------------------------------------------------------------


def last_segment(url: Column | str) -> Column:
    return F.nullif(file_name(F.rtrim(path_of(url), F.lit("/"))), F.lit(""))


def file_name(address: Column) -> Column:
    """What follows the last slash. A plain scan: an end-anchored pattern would retry at every letter."""
    return F.substring_index(address, "/", -1)


def stem(segment: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(segment, r"(?<=.)\.[^.]*$", "")


def hash_id(url: Column | str, length: int) -> Column:
    return F.substring(F.sha1(_col(url)), 1, length)


def with_stable_id(
    df: DataFrame,
    rules: Mapping[str, IdRule],
    default: IdRule,
    url: str = "url",
    retailer: str = "retailer",
    out: str = "product_id",
) -> DataFrame:
    """Add the stable product id by retailer rule.

    Retailers sharing a pattern share one guarded branch, and the parts of the URL are staged as
    columns first, so the whole lookup stays one map-only, code-generated projection.
    """
    names = list(rules)
    staged = df.withColumn("_url", F.regexp_replace(F.col(url), r"#.*$", "")).withColumns(
        {"_path": path_of("_url"), "_query": query_of("_url"), "_segment": last_segment("_url")}
    )
    sources = {"url": F.col("_url"), "path": F.col("_path"), "query": F.col("_query"), "full": F.col(url)}
    key = F.coalesce(F.when(F.col(retailer).isin(*names), F.col(retailer)), F.lit("*"))
    staged = staged.withColumn("_rule", key)
    every = {**rules, "*": default}

    def group(rank: int):
        grouped: dict[tuple, list[str]] = {}
        for name, rule in every.items():
            if len(rule.patterns) > rank:
                pattern, part = rule.patterns[rank]
                part = "full" if rule.keep_fragment else part
                grouped.setdefault((pattern, part, rule.prefix, rule.upper), []).append(name)
        return grouped.items()

    tries = []
    for rank in range(max(len(r.patterns) for r in every.values())):
        for (pattern, part, prefix, upper), members in group(rank):
            found = extract(sources[part], pattern)
            found = F.upper(found) if upper else found
            found = F.concat(F.lit(prefix), found) if prefix else found
            tries.append(F.when(F.col("_rule").isin(*members), found))

    segment = F.col("_segment")
    clean = F.nullif(F.regexp_replace(segment, _ID_CHARS, ""), F.lit(""))
    shapes = {"segment": clean, "tail": F.right(clean, F.lit(20)), "raw": segment, "stem": F.nullif(stem(segment), F.lit(""))}
    for kind, value in shapes.items():
        members = [n for n, r in every.items() if r.fallback == kind]
        if members:
            tries.append(F.when(F.col("_rule").isin(*members), value))
    last = F.sha1(F.col("_url"))
    for length in sorted({r.hash_length for r in every.values()}):
        members = [n for n, r in every.items() if r.hash_length == length and not r.constant]
        if members:
            tries.append(F.when(F.col("_rule").isin(*members), F.substring(last, 1, length)))
    for name, rule in every.items():
        if rule.constant:
            tries.append(F.when(F.col("_rule") == name, F.lit(rule.constant)))
    return staged.withColumn(out, F.coalesce(*tries)).drop("_url", "_path", "_query", "_segment", "_rule")


def asin(url: Column | str) -> Column:
    """Ten-character article number from the path, then the query, else a hash."""
    url = _col(url)
    return F.coalesce(
        extract(path_of(url), r"/dp/([A-Z0-9]{10})"),
        extract(F.upper(query_param(url, "asin")), r"^([A-Z0-9]{10})$"),
        hash_id(url, 10),
    )


def id_from_page(html: Column | str) -> Column:
    """Article number printed on, or embedded in, a page."""
    html = _col(html)
    return F.coalesce(
        extract(html, r'"(?:sku|productID|mpn)"\s*:\s*"([^"]+)"'),
        extract(html, r"(?i)Internet\s*#\s*([A-Za-z0-9\-]+)"),
        extract(html, r"(?i)Model\s*#\s*([A-Za-z0-9\-._]+)"),
        extract(html, r"(?i)ITEM\s*#\s*:?\s*([A-Za-z0-9\-]+)"),
    )


# --- U8-U12, U16: image URLs ------------------------------------------------------------------


def set_params(
    url: Column | str, values: Mapping[str, str], defaults: Mapping[str, str] | None = None
) -> Column:
    """Set query parameters in place, append those missing, keep all others in their order."""
    url = _col(url)
    everything = {**values, **{k: v for k, v in (defaults or {}).items() if k not in values}}
    name_of = lambda p: F.split_part(p, F.lit("="), F.lit(1))
    given = F.filter(F.split(query_of(url), "&"), lambda p: p != "")

    def rewritten(pair: Column) -> Column:
        out = None
        for name, value in values.items():
            hit = F.lit(f"{name}={value}")
            out = F.when(name_of(pair) == name, hit) if out is None else out.when(name_of(pair) == name, hit)
        return pair if out is None else out.otherwise(pair)

    def rebuilt(pairs: Column, keys: Column) -> Column:
        firsts = F.filter(pairs, lambda p, i: F.array_position(keys, name_of(p)) == i + 1)
        added = [F.when(~F.array_contains(keys, k), F.lit(f"{k}={v}")) for k, v in everything.items()]
        return F.concat(F.transform(firsts, rewritten), F.array_compact(F.array(*added)))

    parts = bind(given, lambda pairs: bind(F.transform(pairs, name_of), lambda keys: rebuilt(pairs, keys)))
    return F.concat(drop_query(url), F.lit("?"), F.array_join(parts, "&"))


def drop_params(url: Column | str, names: Sequence[str]) -> Column:
    """Remove query parameters, keeping all others."""
    url = _col(url)
    kept = F.filter(
        F.split(query_of(url), "&"),
        lambda p: (p != "") & ~F.split_part(p, F.lit("="), F.lit(1)).isin(*names),
    )
    query = F.array_join(kept, "&")
    return F.concat(drop_query(url), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def rewrite_size(url: Column | str, rewrites: Iterable[tuple[str, str]]) -> Column:
    """Fold the size rewrites of a rule table over a URL."""
    out = _col(url)
    for pattern, replacement in rewrites:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def size_variants(url: Column | str, pattern: str, sizes: Sequence[str], keep_original: bool = False) -> Column:
    """One URL per size, largest first, without repeats."""
    url = _col(url)
    made = F.transform(
        F.array(*[F.lit(s) for s in sizes]), lambda s: F.regexp_replace(url, F.lit(pattern), s)
    )
    return F.array_distinct(F.concat(F.array(url), made) if keep_original else made)


def unwrap_proxy(url: Column | str) -> Column:
    """Original image behind an image-proxy URL."""
    url = _col(url)
    target = F.try_url_decode(query_param(url, "url"))
    return F.coalesce(
        F.when(F.locate("/_next/image", url) > 0, target),
        F.regexp_replace(url, r"/cdn-cgi/image/[^/]+/", "/"),
    )


def srcset_largest(srcset: Column | str, tie: str = "first") -> Column:
    """Largest candidate of a ``srcset``; ``tie`` is ``first``, ``last``, or ``item`` for the last item."""
    items = F.filter(
        F.transform(F.split(_col(srcset), ","), lambda p: F.regexp_replace(F.trim(p), r"\s+", " ")),
        lambda p: p != "",
    )
    address = lambda p: F.split_part(p, F.lit(" "), F.lit(1))
    if tie == "item":
        return F.when(F.size(items) > 0, address(F.element_at(items, -1)))
    sign = -1 if tie == "first" else 1
    ranked = F.transform(
        items,
        lambda p, i: F.struct(
            F.coalesce(extract(p, r" (\d+)w$").cast("int"), F.lit(0)).alias("width"),
            (i * sign).alias("place"),
            address(p).alias("url"),
        ),
    )
    return F.array_max(ranked)["url"]


def compose_asset_url(
    prefix: str, asset: Column | str, params: str, suffixes: Sequence[str] = ("",)
) -> Column:
    """Array of image URLs for an asset id, one per suffix, in order."""
    return F.array(*[F.concat(F.lit(prefix), _col(asset), F.lit(s + params)) for s in suffixes])


# --- U13-U15: names and extensions ------------------------------------------------------------


def name_from_slug(url: Column | str) -> Column:
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"^/+|/+$", ""), r"\.html", "")
    slug = F.split_part(path, F.lit(".product."), F.lit(1))
    words = F.trim(F.regexp_replace(F.translate(slug, "-_", "  "), r"\s+", " "))
    return F.nullif(F.initcap(words), F.lit(""))


# Image content types and suffixes, in the order they are tried.
CONTENT_TYPES = [("jpeg|jpg", ".jpg"), ("png", ".png"), ("webp", ".webp"), ("gif", ".gif"), ("svg", ".svg"), ("avif", ".avif")]
URL_SUFFIXES = [("jpe?g", ".jpg"), ("png", ".png"), ("webp", ".webp"), ("gif", ".gif"), ("svg", ".svg"), ("avif", ".avif")]
# Leading bytes in hexadecimal, as LIKE patterns.
MAGIC_BYTES = [
    ("FFD8FF%", ".jpg"),
    ("89504E470D0A1A0A%", ".png"),
    ("474946383761%", ".gif"),
    ("474946383961%", ".gif"),
    ("52494646________57454250%", ".webp"),
    ("________66747970%", ".avif"),
]


def _chain(pairs: Iterable[tuple[Column, str]]) -> Column:
    out = None
    for condition, value in pairs:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out


def magic_extension(body: Column | str) -> Column:
    head = F.hex(F.substring(_col(body), 1, 12))
    return _chain((head.like(p), ext) for p, ext in MAGIC_BYTES)


def file_extension(content_type: Column | str, url: Column | str, body: Column | str) -> Column:
    """Extension from the content type, then the URL, then the leading bytes, else ``.jpg``."""
    kind = F.lower(_col(content_type))
    name = F.lower(drop_query(url))
    return F.coalesce(
        _chain((kind.rlike(p), ext) for p, ext in CONTENT_TYPES),
        _chain((name.rlike(rf"\.{p}$"), ext) for p, ext in URL_SUFFIXES),
        magic_extension(body),
        F.lit(".jpg"),
    )


# Letters written as one ASCII letter.
ONE_LETTER = {
    "a": "àáâãåą", "e": "èéêëę", "i": "ìíîï", "o": "òóôõ", "u": "ùúû",
    "c": "çć", "n": "ñń", "l": "ł", "s": "ś", "z": "źż",
    "A": "ÅĄ", "C": "Ć", "E": "Ę", "L": "Ł", "N": "Ń", "O": "Ó", "S": "Ś", "Z": "ŹŻ",
    "-": "–—", "_": "/\\:*?\"<>|",
}
# Letters written as several ASCII letters.
SEVERAL_LETTERS = {
    "ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue", "æ": "ae", "œ": "oe",
}
# The same for shops whose names write German and Romance letters only; other letters go.
WESTERN_ONE_LETTER = {
    "a": "àáâã", "e": "èéêë", "i": "ìíîï", "o": "òóôõ", "u": "ùúû", "c": "ç", "n": "ñ", "_": "/\\:*?\"<>|",
}
WESTERN_SEVERAL_LETTERS = {k: SEVERAL_LETTERS[k] for k in "äöüßÄÖÜ"}


def safe_name(name: Column | str, max_length: int = 120, default: str = "product", western: bool = False) -> Column:
    """File-safe ASCII name of at most ``max_length`` characters, with all letters of the shops or the ``western`` ones."""
    several = WESTERN_SEVERAL_LETTERS if western else SEVERAL_LETTERS
    one_letter = WESTERN_ONE_LETTER if western else ONE_LETTER
    out = F.trim(F.regexp_replace(F.coalesce(_col(name), F.lit("")), r"[\s ]+", " "))
    for letter, ascii_text in several.items():
        out = F.replace(out, F.lit(letter), F.lit(ascii_text))
    source = "".join(one_letter.values())
    target = "".join(k * len(v) for k, v in one_letter.items())
    out = F.translate(out, source, target)
    out = F.regexp_replace(out, r"[^\x00-\x7F]", "")
    out = F.regexp_replace(out, r"[^\w.\-]+", "_")
    out = F.regexp_replace(F.regexp_replace(out, r"_+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(F.substring(out, 1, max_length), F.lit("")), F.lit(default))
