"""Text expressions (T). A document's lines stay an array inside its row, so nothing shuffles."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[\s\u00A0]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside lambdas, which see it as a variable."""
    return F.transform(F.array(value), use)[0]


def clean(text: Column | str) -> Column:
    """Collapse white space and trim; NULL becomes the empty string."""
    return F.trim(F.regexp_replace(F.coalesce(_col(text), F.lit("")), _SPACE + "+", " "))


def clean_lines(text: Column | str) -> Column:
    """Normalise line ends, drop blanks before them, keep at most one empty line."""
    out = F.regexp_replace(F.coalesce(_col(text), F.lit("")), r"\r\n?", "\n")
    out = F.regexp_replace(out, r"[ \t]+\n", "\n")
    return strip_space(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{_SPACE}+|{_SPACE}+$", "")


# The named character references of HTML, one literal that the optimiser folds to a map.
_NAMED = json.dumps({name[:-1]: letters for name, letters in html5.items() if name.endswith(";")})
_REFERENCE = r"^(#\d{1,9}|#[xX][0-9A-Fa-f]{1,8}|[A-Za-z][A-Za-z0-9]*);"


def decode_entities(text: Column | str) -> Column:
    """Named, decimal and hexadecimal character references, in one scan, so nothing is decoded twice.

    A reference to no character is U+FFFD; an unknown name stays as it is.
    """
    out = _col(text)
    return F.when(out.contains("&"), _decoded(out)).otherwise(out)


def _decoded(text: Column) -> Column:
    """Cut the text at each ampersand and decode the head of every piece."""
    named = F.from_json(F.lit(_NAMED), "map<string,string>")

    def piece(part: Column) -> Column:
        def read(name: Column) -> Column:
            digits = F.regexp_extract(name, r"^#(\d+)$", 1)
            hexes = F.regexp_extract(name, r"^#[xX](\w+)$", 1)
            point = F.when(digits != "", digits.cast("bigint")).when(hexes != "", F.conv(hexes, 16, 10).cast("bigint"))
            real = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
            numeric = F.when(real, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")).otherwise("\ufffd")
            letters = F.when(name.startswith("#"), numeric).otherwise(F.element_at(named, name))
            rest = F.substr(part, F.length(name) + 2)
            return F.when((name == "") | letters.isNull(), F.concat(F.lit("&"), part)).otherwise(F.concat(letters, rest))

        return bind(F.regexp_extract(part, _REFERENCE, 1), read)

    parts = F.split(text, "&")
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(piece(p))), "")


def fragment_to_text(html: Column | str) -> Column:
    """HTML fragment to text: bullets for list items, line breaks kept, other tags dropped."""
    out = F.regexp_replace(_col(html), r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    out = F.regexp_replace(out, r"(?i)\s*<li\b[^>]*>\s*", "\n• ")
    out = F.regexp_replace(out, r"(?i)\s*(?:<br\s*/?>|</?(?:p|h[1-6])\b[^>]*>)\s*", "\n")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->|<[^>]+>", " ")
    out = F.regexp_replace(decode_entities(out), r"[ \t\u00A0]+", " ")
    out = F.regexp_replace(F.regexp_replace(out, r" ?\n ?", "\n"), r"\n{3,}", "\n\n")
    return strip_space(out)


def body_text(html: Column | str) -> Column:
    """Visible text of a page on one line."""
    out = F.regexp_replace(_col(html), r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    return clean(decode_entities(F.regexp_replace(out, r"<[^>]+>", " ")))


def lines(text: Column | str) -> Column:
    return F.split(_col(text), "\n")


def strip_bullets(line: Column | str) -> Column:
    """Remove bullets and dashes at both ends of a line and collapse its white space."""
    out = F.regexp_replace(clean(line), r"^[•\-]+\s*", "")
    return F.trim(F.regexp_replace(out, r"\s*[•\-]+\s*$", ""))


LINE_KEYS = {
    "alphanumeric": lambda l: F.lower(F.regexp_replace(l, r"[^\p{L}\p{N}_]+", "")),
    "lower": F.lower,
    "first_fifty": lambda l: F.lower(F.substring(l, 1, 50)),
    "exact": lambda l: l,
}


def distinct_lines(items: Column, key: str = "exact") -> Column:
    """Order-preserving distinct of an array by a line key: the first of each key stays.

    Sorting (key, position) puts the first of each key in front, so the cost is n log n.
    """
    make = LINE_KEYS[key]
    keyed = F.sort_array(
        F.transform(items, lambda l, i: F.struct(make(l).alias("key"), i.alias("pos"), l.alias("line")))
    )
    firsts = bind(
        keyed,
        lambda k: F.filter(k, lambda e, i: (i == 0) | (F.get(k, i - 1)["key"] != e["key"])),
    )
    back = F.sort_array(F.transform(firsts, lambda e: F.struct(e["pos"].alias("pos"), e["line"].alias("line"))))
    return back["line"]


def collapse_repeats(items: Column) -> Column:
    """Drop a line equal to the one before it."""
    return bind(items, lambda k: F.filter(k, lambda l, i: (i == 0) | (F.get(k, i - 1) != l)))


# Lines that belong to a rating block.
RATING_LINES = [
    r"out of 5 stars",
    r"average rating value",
    r"Same page link",
    r"Read\s+\d+\s+Reviews?",
    r"Read a Review",
]
# Whole lines of no value in a description.
DROP_LINES = [r"^request warranty information$", r"^imported$", r"^made in .*", r"^warranty.*available.*"]
# Call-to-action phrases cut inside a text.
CALLS_TO_ACTION = [
    r"(?i)\bmake your selection\b\s*:?(\s*[^\n]*)?",
    r"(?i)\badd to wish list\b",
    r"(?i)\bset a reminder\b",
    r"(?i)\bsave reminders?\b",
    r"(?i)\breminders?\b",
    r"(?i)\bqvc\s+app\b",
    r"(?i)\bdownload the qvc app\b",
    r"(?i)\babout the brand\b",
    r"(?i)\bitem number\s*[:#]?\s*\w+",
    r"(?i)\bshipping\s*&\s*returns\b.*",
    r"(?i)\bpolicies\b.*",
    r"(?i)\breviews?\b.*",
]


def drop_rating_lines(items: Column, patterns: Sequence[str] = tuple(RATING_LINES)) -> Column:
    """Drop rating lines, the first number after each run of them, and bare integers.

    One fold over the lines carries the flag "a rating line awaits its number" and notes which lines
    were consumed that way; only those few positions are collected.
    """
    rating = "(?i)" + "|".join(patterns)

    def step(state: Column, line: Column) -> Column:
        is_rating = line["rating"]
        taken = state["armed"] & line["number"] & ~is_rating
        return F.struct(
            (is_rating | (state["armed"] & ~taken)).alias("armed"),
            (state["at"] + 1).alias("at"),
            F.when(taken, F.array_append(state["taken"], state["at"])).otherwise(state["taken"]).alias("taken"),
        )

    def marked(line: Column) -> Column:
        bare = strip_space(line)
        return F.struct(
            line.alias("line"),
            bare.rlike(rating).alias("rating"),
            bare.rlike(r"^\d+(?:\.\d+)?$").alias("number"),
            bare.rlike(r"^\(?\d+\)?$").alias("bare"),
        )

    empty = F.struct(
        F.lit(False).alias("armed"), F.lit(0).alias("at"), F.array().cast("array<int>").alias("taken")
    )

    def kept(lines: Column) -> Column:
        return bind(
            F.aggregate(lines, empty, step)["taken"],
            lambda taken: F.filter(lines, lambda l, i: ~l["rating"] & ~l["bare"] & ~F.array_contains(taken, i)),
        )

    return bind(F.transform(items, marked), kept)["line"]


def drop_lines(items: Column, patterns: Iterable[str] = tuple(DROP_LINES)) -> Column:
    pattern = "|".join(f"(?:{p})" for p in patterns)
    return F.filter(items, lambda l: ~F.lower(l).rlike(pattern))


def cut_phrases(text: Column | str, patterns: Iterable[str] = tuple(CALLS_TO_ACTION)) -> Column:
    out = _col(text)
    for pattern in patterns:
        out = strip_space(F.regexp_replace(out, pattern, ""))
    return clean(out)


def strip_affixes(text: Column | str, prefix: str = "", suffix: str = "") -> Column:
    """Remove a prefix and a suffix given as patterns."""
    out = _col(text)
    out = F.regexp_replace(out, rf"(?i)^\s*(?:{prefix})\s*", "") if prefix else out
    return F.trim(F.regexp_replace(out, rf"(?i)\s*(?:{suffix})\s*$", "") if suffix else out)


def strip_leading_name(text: Column | str, name: Column | str) -> Column:
    text, name = _col(text), _col(name)
    starts = (F.length(name) > 0) & F.lower(text).startswith(F.lower(name))
    rest = F.regexp_replace(F.substr(text, F.length(name) + 1), r"^[\s:\-—]+", "")
    return F.when(starts, rest).otherwise(text)


def brand_title(brand: Column | str, title: Column | str, dash: str = " – ") -> Column:
    """``brand – title``, unless the title already names the brand."""
    brand, title = F.nullif(clean(brand), F.lit("")), F.nullif(clean(title), F.lit(""))
    composed = F.concat_ws(dash, brand, title)
    return F.nullif(F.when(F.contains(F.lower(title), F.lower(brand)), title).otherwise(composed), F.lit(""))


def first_long_enough(candidates: Sequence[tuple[Column, int]]) -> Column:
    """First candidate longer than its own length gate."""
    return F.coalesce(*[F.when(F.length(c) > gate, c) for c, gate in candidates])


def longest_specific(candidates: Column, generic: str) -> Column:
    """Longest element that matches no generic pattern; the first one on ties."""
    fit = F.filter(candidates, lambda c: c.isNotNull() & ~c.rlike(generic))
    ranked = F.transform(fit, lambda c, i: F.struct(F.length(c).alias("n"), (-i).alias("place"), c.alias("text")))
    return F.array_max(ranked)["text"]


def bullets_or_paragraphs(bullets: Column, paragraphs: Column, most: int = 3) -> Column:
    """Bulleted list when there is one, with the first paragraph as its lead, else the first paragraphs."""
    marked = F.array_join(F.transform(bullets, lambda b: F.concat(F.lit("• "), b)), "\n")
    lead = F.when(F.size(paragraphs) > 0, F.concat(F.get(paragraphs, F.lit(0)), F.lit("\n"))).otherwise("")
    return F.when(F.size(bullets) > 0, F.concat(lead, marked)).otherwise(
        F.array_join(F.slice(paragraphs, 1, most), "\n")
    )


def title_head(title: Column | str) -> Column:
    return clean(F.split_part(_col(title), F.lit("|"), F.lit(1)))


def unescape_script(text: Column | str) -> Column:
    """Undo script escaping before pattern tests."""
    out = F.replace(_col(text), F.lit("\\\\"), F.lit(""))
    out = F.replace(F.replace(out, F.lit('\\"'), F.lit('"')), F.lit("\\'"), F.lit("'"))
    return F.replace(out, F.lit("\\u0026"), F.lit("&"))
