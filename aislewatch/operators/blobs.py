"""JSON inside pages (J). Blobs are VARIANT values; walking them stays inside the page's row."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewatch.functions.text import bind
from aislewatch.operators.json_scan import scanned
from aislewatch.session import allow_repeated_keys, spread


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


# --- J1, J2: find and parse -------------------------------------------------------------------


def jsonld_texts(html: Column | str) -> Column:
    """Bodies of all ``application/ld+json`` scripts, in page order."""
    pattern = r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def tolerant_blobs(texts: Column) -> Column:
    """Split blobs joined by line breaks, drop trailing commas, parse, skip what does not parse.

    Of a repeated key the last value counts; the active session is set to read such objects.
    """
    session = SparkSession.getActiveSession()
    if session is not None:
        allow_repeated_keys(session)

    def parse(text: Column) -> Column:
        return F.try_parse_json(F.regexp_replace(F.trim(text), r"\s*,\s*$", ""))

    def pieces(text: Column) -> Column:
        # The parser ignores text after a complete value, so joined blobs are told by their parts:
        # when every part parses, the parts are the blobs.
        def chosen(parts: Column) -> Column:
            whole = parse(text)
            all_parse = F.forall(parts, lambda p: p.isNotNull())
            return F.when(all_parse | whole.isNull(), parts).otherwise(F.array(whole))

        return bind(F.transform(F.split(text, r"\n(?=\s*\{)"), parse), chosen)

    return F.filter(F.flatten(F.transform(texts, pieces)), lambda v: v.isNotNull())


# --- J3: objects of a type --------------------------------------------------------------------

# Types that describe something for sale.
SALE_TYPES = ("Product", "Offer", "AggregateOffer", "SomeProducts")


def _elements(v: Column) -> Column:
    return F.coalesce(_get(v, "$", "array<variant>"), F.array(v))


def _has_type(v: Column, types: Sequence[str]) -> Column:
    listed = F.coalesce(_get(v, '$["@type"]', "array<string>"), F.array(_get(v, '$["@type"]')))
    return F.exists(listed, lambda t: t.isin(*types))


def objects(blobs: Column, types: Sequence[str] | None = SALE_TYPES) -> Column:
    """Lists and ``@graph`` flattened to objects, optionally of the given types."""
    flat = F.flatten(F.transform(blobs, _elements))
    spread = F.flatten(
        F.transform(flat, lambda o: F.concat(F.array(o), F.coalesce(_get(o, '$["@graph"]', "array<variant>"), F.array())))
    )
    return spread if types is None else F.filter(spread, lambda o: F.coalesce(_has_type(o, types), F.lit(False)))


# --- J4, J6, J7: walking ----------------------------------------------------------------------

# Keys that carry stock flags in application state.
FLAG_KEYS = {
    "in_stock": (("instock", "in_stock", "isinstock"), "BOOLEAN"),
    "purchasable": (("purchasable", "isavailable", "available"), "BOOLEAN"),
    "availability": (("availability",), "STRING"),
    "availability_status": (("availabilitystatus", "availability_status", "stockstatus", "stock_status"), "STRING"),
}
WALK_TYPE = "struct<products:array<struct<start:int,size:int>>,found:map<string,string>,flags:map<string,string>>"
_ARROW_WALK = pa.struct([
    ("products", pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))),
    ("found", pa.map_(pa.string(), pa.string())), ("flags", pa.map_(pa.string(), pa.string())),
])


def walk(
    df: DataFrame, text: str, out: str = "walk", searches: Mapping[str, Sequence[str]] | None = None,
    flags: Mapping[str, tuple[Sequence[str], str]] = FLAG_KEYS,
) -> DataFrame:
    """Scan a JSON text once, to any depth, and add what the scan finds as the struct ``out``.

    ``products``: places in the text (from 1) of all objects of type Product; ``found``: for each name of ``searches`` the
    value of its keys in the first object that holds any; ``flags``: the last value of each flag. Objects
    come before what they hold, in the order of the text. Of a repeated key the last value counts. Texts and
    numbers stand as they were written, objects and lists as slices of the text. What is no JSON holds nothing.
    """
    wanted = dict(searches or {})

    def harvest(part: pa.Array) -> pa.Array:
        rows = []
        for start in range(0, len(part), 256):
            for value in part.slice(start, 256).to_pylist():
                row = scanned(value, wanted, flags)
                spans = [{"start": start, "size": size} for start, size in row["products"]]
                rows.append({"products": spans, "found": list(row["found"].items()), "flags": list(row["flags"].items())})
        return pa.array(rows, _ARROW_WALK)

    read = F.arrow_udf(harvest, WALK_TYPE)
    return spread(df).withColumn(out, read(F.col(text)))


def product_texts(walked: Column, text: Column | str) -> Column:
    """The JSON text of every object of type Product, outermost and first ones first."""
    text = F.col(text) if isinstance(text, str) else text
    return F.transform(walked["products"], lambda p: F.substr(text, p["start"], p["size"]))


def products_at_any_depth(walked: Column, text: Column | str) -> Column:
    """Every object with ``@type`` Product as a VARIANT; NULL for one that nests deeper than a VARIANT may."""
    text = F.col(text) if isinstance(text, str) else text
    return F.transform(walked["products"], lambda p: F.try_parse_json(F.substr(text, p["start"], p["size"])))


def first_of_keys(walked: Column, name: str) -> Column:
    """Depth-first, the first object holding any key of a search; within it the first listed key."""
    return F.element_at(walked["found"], name)


def last_flag(walked: Column, name: str) -> Column:
    """Last value of the flag's type under any of its keys (compared in lower case)."""
    return F.element_at(walked["flags"], name)


def stock_flags(walked: Column) -> Column:
    """Struct of the four harvested flags."""
    return F.struct(*[F.lower(last_flag(walked, name)).alias(name) for name in FLAG_KEYS])


# --- J5, J8, J9, J11 --------------------------------------------------------------------------


def first_path(v: Column, paths: Sequence[str], kind: str = "string") -> Column:
    """First non-empty value of a list of paths."""
    if kind == "string":
        return F.coalesce(*[F.nullif(F.trim(_get(v, p, kind)), F.lit("")) for p in paths])
    return F.coalesce(*[_get(v, p, kind) for p in paths])


def resolve_reference(text: Column, v: Column, root: str = "ROOT_QUERY", call: str = "product(", kind: str = "ProductType") -> Column:
    """Follow ``root.call(...).__ref`` to its entity, else the first entity of the kind.

    The cache is one map inside one row, so the reference is a map lookup rather than a join.
    """
    cache = _get(v, "$", "map<string,variant>")
    typed = lambda e: F.when(_get(e, "$.__typename") == kind, e)

    def looked_up(c: Column) -> Column:
        calls = _get(F.element_at(c, root), "$", "map<string,variant>")
        refs = F.filter(
            F.transform(
                F.filter(F.map_entries(calls), lambda e: e["key"].startswith(call)), lambda e: _get(e["value"], "$.__ref")
            ),
            lambda r: r.isNotNull(),
        )
        targets = F.filter(F.transform(refs, lambda r: typed(F.element_at(c, r))), lambda e: e.isNotNull())
        keys = F.filter(F.json_object_keys(text), lambda k: k.startswith(kind + ":"))
        fallback = F.filter(F.transform(keys, lambda k: typed(F.element_at(c, k))), lambda e: e.isNotNull())
        return F.coalesce(F.get(targets, F.lit(0)), F.get(fallback, F.lit(0)))

    return bind(cache, looked_up)


def assigned_json(html: Column, name: str) -> Column:
    """JSON of a named script element, or assigned to that name in a script."""
    tagged = F.regexp_extract(html, rf"""(?is)<script[^>]*\bid=["']{name}["'][^>]*>(.*?)</script>""", 1)
    assigned = F.regexp_extract(html, rf"(?is)\b{name}\s*=\s*(\{{.*?\}}|\[.*?\])\s*;?\s*</script>", 1)
    return F.coalesce(
        F.try_parse_json(F.nullif(F.trim(tagged), F.lit(""))), F.try_parse_json(F.nullif(F.trim(assigned), F.lit("")))
    )


def offers(product: Column) -> Column:
    """Offers of a product, one or many, as (pos, price, currency, availability) in order."""
    raw = _get(product, "$.offers", "variant")

    def one(o: Column, i: Column) -> Column:
        return F.struct(
            i.alias("pos"),
            F.coalesce(_get(o, "$.price"), _get(o, "$.lowPrice")).alias("price"),
            _get(o, "$.priceCurrency").alias("currency"),
            F.coalesce(_get(o, "$.availability"), _get(o, "$.itemAvailability")).alias("availability"),
        )

    return F.when(raw.isNotNull(), F.transform(_elements(raw), one))


def pick_offer(listed: Column, field: str, policy: str = "first") -> Column:
    """Field of the first (or last) offer that has it."""
    filled = F.filter(listed, lambda o: o[field].isNotNull())
    return F.get(filled, F.lit(0) if policy == "first" else F.size(filled) - 1)[field]


# --- J10, J12, J13: raw script text -----------------------------------------------------------


def _largest_braces(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def largest(text: str | None) -> str | None:
        if not text:
            return None
        opened: list[int] = []
        start = size = 0
        for at, letter in enumerate(text):
            if letter == "{":
                opened.append(at)
            elif letter == "}" and opened:
                begin = opened.pop()
                if at - begin + 1 > size:
                    start, size = begin, at - begin + 1
        return text[start : start + size] if size > 80 else None

    for part in parts:
        yield part.map(largest)


def largest_object(text: Column | str) -> Column:
    """Largest balanced ``{...}``, kept when longer than 80 characters. Brace matching needs a
    stack, which no built-in has, so this one goes through Arrow."""
    return F.pandas_udf(_largest_braces, T.StringType())(text)


def keyed_value(text: Column, keys: Sequence[str]) -> Column:
    """First quoted or bare value of the first key found, in plain or escaped script text."""

    def one(key: str) -> Column:
        pattern = rf"""\\?["']{key}\\?["']\s*:\s*(?:\\?["']([^"'\\]*)\\?["']|(-?\d+(?:\.\d+)?))"""
        quoted = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
        return F.coalesce(quoted, F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")))

    return F.coalesce(*[one(k) for k in keys])


def text_window(text: Column, anchor: Column, before: int, after: int) -> Column:
    """Text around the first occurrence of an anchor, NULL when it is absent."""
    at = F.position(anchor, text)
    start = F.greatest(F.lit(1), at - before)
    size = at - start + F.length(anchor) + after
    return F.when((at > 0) & (F.length(anchor) > 0), F.substr(text, start, size))
