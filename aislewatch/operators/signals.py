"""Verdicts by shop (V6): a page's tests as bits of one long, and each shop's rules as rows over them.

The tests of a page's shop are read once, while the page is parsed; the rules are a constant table, and the
verdict is the first of the shop's rows whose masks fit the bits. A new shop is a new entry of ``rules.verdicts``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from aislewatch.functions import phrases
from aislewatch.operators.selectors import Elements, compiled
from aislewatch.rules.stock import STOCK_CONTAINERS
from aislewatch.rules.verdicts import EMPTY_RULE, PHRASE_LISTS, SHOPS, STATUS_RULE, Shop, Signal

_JSONLD = re.compile(r"""<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>""", re.I | re.S)


@lru_cache(maxsize=1024)
def _regex(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.I | re.S)


class Page:
    """One parsed page as the signals see it; what several of them need is made once."""

    def __init__(self, url: str | None, html: str, nodes: list[dict], texts: list[str]):
        self.url, self.html, self.nodes, self.texts = url or "", html, nodes, texts
        self.elements = Elements(nodes)
        self.body = " ".join(texts).lower()
        self._found: dict | None = None
        self._products: list[dict] | None = None
        self._source: str | None = None

    def text_of(self, node: int) -> str:
        at = self.nodes[node]
        return " ".join(self.texts[at["t_from"] : at["t_to"]])

    def found(self) -> dict:
        """All phrases of all lists that the text holds."""
        if self._found is None:
            self._found = phrases.find(self.body, phrases.all_phrases())
        return self._found

    def source(self) -> str:
        """The raw page without the escapes of script text."""
        if self._source is None:
            self._source = self.html
            if "\\" in self.html:
                self._source = self.html.replace("\\\\", "").replace('\\"', '"').replace("\\'", "'")
        return self._source

    def products(self) -> list[dict]:
        """Objects of type Product at the top of the page's data blocks."""
        if self._products is None:
            self._products = []
            for text in _JSONLD.findall(self.html):
                try:
                    data = json.loads(text)
                except (ValueError, RecursionError):
                    continue
                some = data if isinstance(data, list) else [data]
                self._products += [o for o in some if isinstance(o, dict) and o.get("@type") == "Product"]
        return self._products

    def path(self) -> str:
        bare = re.sub(r"[?#].*$", "", self.url, flags=re.S)
        found = re.match(r"(?:[A-Za-z][\w+.\-]*:)?//[^/]*(/.*)$", bare, re.S)
        return found.group(1).lower() if found else ""

    def first_area(self, selectors: tuple[str, ...]) -> int | None:
        return next((n for n in map(self.elements.first, selectors) if n is not None), None)


def read(signal: Signal, page: Page) -> tuple[bool, str | None]:
    """Whether a signal holds on a page, and its value."""
    kind, where, elements = signal.kind, signal.where, page.elements
    if kind == "element":
        hit = next((s for s in where if elements.select(s)), None)
        return hit is not None, hit
    if kind == "count":
        n = sum(len(elements.select(s)) for s in where)
        return n >= signal.least, str(n)
    if kind == "inner":
        outer = elements.first(where[0])
        n = 0 if outer is None else sum(elements.inside(k, outer) for k in elements.select(where[1]))
        return n >= signal.least, str(n)
    if kind in ("text", "any_text"):
        area = page.first_area(signal.area) if signal.area else None
        for selector in where:
            some = [n for n in elements.select(selector) if area is None or elements.inside(n, area)]
            for node in some if kind == "any_text" else some[:1]:
                value = page.text_of(node)
                if _regex(signal.pattern).search(value):
                    return True, value.lower() if signal.lower else value
        return False, None
    if kind == "area_text":
        area = page.first_area(where)
        value = page.body if area is None else page.text_of(area)
        return bool(_regex(signal.pattern).search(value)), None
    if kind == "said":
        found = page.found()
        hit = next((p for p in PHRASE_LISTS[where[0]] if _number(p) in found), None)
        return hit is not None, hit and hit[: signal.cut]
    if kind == "says":
        return bool(_regex(signal.pattern).search(page.body)), None
    if kind == "number":
        hit = _regex(signal.pattern).search(page.body)
        value = hit and hit.group(1).replace(",", "")
        return bool(value) and int(value) >= signal.least, value
    if kind in ("source", "address", "path"):
        text = {"source": page.source, "address": lambda: page.url, "path": page.path}[kind]()
        hit = _regex(signal.pattern).search(text)
        return hit is not None, hit and (hit.group(1) if hit.re.groups else hit.group(0))
    if kind == "product":
        held = page.products()
        if not signal.pattern:
            return bool(held), None
        value = next((o[signal.pattern] for o in held if o.get(signal.pattern)), None)
        return value is not None, value if isinstance(value, str) else None
    given = _regex(signal.pattern).search(page.url)
    wanted = given.group(1) if given else None
    if kind == "lost_id":
        return wanted is not None and wanted not in page.html, wanted
    if kind == "own":
        held = (elements.attrs[n].get(where[1], "") for n in elements.select(where[0]))
        return wanted is not None and any(wanted in value for value in held), wanted
    if kind == "other_code":
        codes = {c.upper() for pattern in where for c in _regex(pattern).findall(page.html)}
        return wanted is not None and bool(codes) and wanted.upper() not in codes, wanted
    raise ValueError(f"unknown kind of signal: {kind}")


@lru_cache(maxsize=1)
def _numbers() -> dict[str, int]:
    return {p: n for n, p in enumerate(phrases.all_phrases())}


def _number(phrase: str) -> int:
    return _numbers()[phrase]


def read_all(shop: Shop, page: Page) -> tuple[int, dict[str, str]]:
    """The bits of a shop's signals, the first one lowest, and their values."""
    bits, values = 0, {}
    for number, (name, signal) in enumerate(shop.signals.items()):
        holds, value = read(signal, page)
        bits |= holds << number
        if value is not None:
            values[name] = value
    return bits, values


PROBE_TYPE = f"struct<bits:bigint,texts:map<string,string>,hits:{phrases.HITS_TYPE},stock_hits:{phrases.HITS_TYPE}>"
PROBE_ARROW = pa.struct([
    ("bits", pa.int64()), ("texts", pa.map_(pa.string(), pa.string())), ("hits", phrases.ARROW_HITS), ("stock_hits", phrases.ARROW_HITS),
])


def probe(row: Mapping, html: str, tree: Mapping) -> dict:
    """Signals of a page under the rules of its ``retailer`` (NULL without rules), and the phrases it holds.

    ``stock_hits`` are those in the shop's stock container, NULL where the shop names none.
    """
    page, retailer = Page(row.get("url"), html, tree["nodes"], tree["texts"]), row.get("retailer")
    out = {"bits": None, "texts": None, "hits": phrases.rows_of(page.found()), "stock_hits": None}
    if retailer in SHOPS:
        bits, values = read_all(SHOPS[retailer], page)
        out |= {"bits": bits, "texts": list(values.items())}
    if retailer in STOCK_CONTAINERS:
        said = " ".join(page.text_of(n) for n in page.elements.select(STOCK_CONTAINERS[retailer])).lower()
        out["stock_hits"] = phrases.rows_of(phrases.find(said, phrases.all_phrases()))
    return out


# --- Rules as rows ----------------------------------------------------------------------------

_RULE = "struct<need:bigint,one_of:bigint,without:bigint,among:bigint,least:int,most:int,valid:boolean,reason:string,value:string>"


@lru_cache(maxsize=1)
def rule_rows() -> str:
    """JSON of all shops' rules, masks in place of names. A rule that names an unknown signal is refused."""
    book = {}
    for name, shop in SHOPS.items():
        if len(shop.signals) > 63:
            raise ValueError(f"{name} has more signals than a long has bits")
        places = {s: n for n, s in enumerate(shop.signals)}
        for signal in shop.signals.values():
            for selector in (*signal.where, *signal.area) if signal.kind in ("element", "count", "inner", "text", "any_text") else ():
                compiled(selector)

        def mask(names: tuple[str, ...]) -> int:
            return sum(1 << places[n] for n in names)

        book[name] = [
            {
                "need": mask(r.need), "one_of": mask(r.one_of), "without": mask(r.without), "among": mask(r.among),
                "least": r.least, "most": r.most, "valid": r.valid, "reason": r.reason, "value": r.value,
            }
            for r in shop.rules
        ]
    return json.dumps(book, ensure_ascii=False)


def has_rules(retailer: Column) -> Column:
    return F.coalesce(retailer.isin(*SHOPS), F.lit(False))


def verdict(retailer: Column, signals: Column, http_status: Column | None = None, html_given: Column | None = None) -> Column:
    """Struct(is_invalid, reason): the first of the shop's rules that fits the bits; NULL for a shop without rules.

    The status and a missing page are judged before the rules.
    """
    bits = signals["bits"]
    book = F.from_json(F.lit(rule_rows()), f"map<string,array<{_RULE}>>")

    def score(rule: Column) -> Column:
        return F.bit_count(bits.bitwiseAND(rule["among"]))

    def fits(rule: Column) -> Column:
        return (
            (bits.bitwiseAND(rule["need"]) == rule["need"])
            & ((rule["one_of"] == 0) | (bits.bitwiseAND(rule["one_of"]) != 0))
            & (bits.bitwiseAND(rule["without"]) == 0)
            & score(rule).between(rule["least"], rule["most"])
        )

    first = F.filter(F.element_at(book, retailer), fits)

    def told(rule: Column) -> Column:
        reason = F.replace(rule["reason"], F.lit("{}"), F.coalesce(F.element_at(signals["texts"], rule["value"]), F.lit("")))
        reason = F.replace(reason, F.lit("{score}"), score(rule).cast("string"))
        return F.struct((~rule["valid"]).alias("is_invalid"), reason.alias("reason"))

    def fixed(reason: str) -> Column:
        return F.struct(F.lit(True).alias("is_invalid"), F.lit(reason).alias("reason"))

    out = F.get(F.transform(F.slice(first, 1, 1), told), F.lit(0))
    if html_given is not None:
        out = F.when(~html_given & has_rules(retailer), fixed(EMPTY_RULE)).otherwise(out)
    if http_status is not None:
        out = F.when((http_status == 404) & has_rules(retailer), fixed(STATUS_RULE)).otherwise(out)
    return out
