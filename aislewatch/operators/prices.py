"""Price of a page by its retailer's strategies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from aislewatch.functions import money
from aislewatch.functions.text import bind
from aislewatch.operators import html
from aislewatch.rules.prices import DEFAULT_STRATEGIES, PRICE_STRATEGIES, Strategy

PARSERS = {
    "dollars": money.dollars,
    "pounds": money.pounds,
    "bare_pounds": lambda c: money.pounds(c, bare=True),
    "euros": money.euros,
    "kronor": money.kronor,
    "zloty": money.zloty,
    "whole_zloty": lambda c: money.zloty(c, whole=True),
    "minor": money.minor_units,
    "any": lambda c: F.coalesce(money.any_currency(c)["amount"], money.dollars(c)),
    "plain": lambda c: F.replace(F.trim(c), F.lit(","), F.lit(".")).try_cast(money.MONEY),
    "signed": lambda c: F.coalesce(money.any_currency(c)["amount"], money.euros(c), money.kronor(c)),
}


def _patterns(strategies: Sequence[Strategy]) -> list[str]:
    return [s.where for s in strategies if s.kind == "script"]


def _by_retailer(retailer: Column, table: Mapping[str, Column], default: Column) -> Column:
    out = None
    for name, value in table.items():
        out = F.when(retailer == name, value) if out is None else out.when(retailer == name, value)
    return default if out is None else out.otherwise(default)


def script_finds(
    page: Column, retailer: Column, table: Mapping[str, Sequence[Strategy]] = PRICE_STRATEGIES, default: Sequence[Strategy] = DEFAULT_STRATEGIES
) -> Column:
    """All texts found by each of the retailer's patterns over the raw page, in strategy order.

    Taken before the page is tokenised, so the raw page need not be carried any further.
    """

    def finds(strategies: Sequence[Strategy]) -> Column:
        found = [F.filter(F.regexp_extract_all(page, F.lit(p), F.lit(1)), lambda x: x != "") for p in _patterns(strategies)]
        return F.array(*found) if found else F.array().cast("array<array<string>>")

    return _by_retailer(retailer, {n: finds(s) for n, s in table.items() if _patterns(s)}, finds(default))


def place_texts(
    dom: Column, retailer: Column, jsonld: Column, scripts: Column,
    table: Mapping[str, Sequence[Strategy]] = PRICE_STRATEGIES, default: Sequence[Strategy] = DEFAULT_STRATEGIES,
) -> Column:
    """The retailer's places in strategy order, all elements of each in page order: (parse, source, floor, text)."""

    def reader(s: Strategy):
        return (lambda n: html.attr(n, s.attr)) if s.attr else (lambda n: html.text_of(dom, n))

    def texts(strategies: Sequence[Strategy]) -> Column:
        out, script_no = [], 0
        for s in strategies:
            if s.kind == "node":
                found = html.select(dom["nodes"], **s.where)
                out.append(F.transform(found, reader(s)))
            elif s.kind == "meta":
                out.append(F.array(html.meta(dom, *s.where)))
            elif s.kind == "jsonld":
                out.append(F.array(jsonld))
            elif s.kind == "body":
                out.append(F.array(html.page_text(dom)))
            else:
                out.append(F.coalesce(F.get(scripts, F.lit(script_no)), F.array().cast("array<string>")))
                script_no += 1

        def place(s: Strategy, found: Column) -> Column:
            head = [F.lit(s.parse).alias("parse"), F.lit(s.source).alias("source"), F.lit(s.floor or 0).alias("floor")]
            return F.transform(found, lambda text: F.struct(*head, text.alias("text")))

        return F.flatten(F.array(*[place(s, found) for s, found in zip(strategies, out)]))

    return _by_retailer(retailer, {n: texts(s) for n, s in table.items()}, texts(default))


def price_at(places: Column) -> Column:
    """Struct(value, source) of the first place whose text parses under its strategy.

    One lambda holds every parser once, whatever the number of retailers and strategies.
    """

    def read(place: Column) -> Column:
        value = None
        for name, parse in PARSERS.items():
            hit = parse(place["text"])
            value = F.when(place["parse"] == name, hit) if value is None else value.when(place["parse"] == name, hit)
        return F.struct(value.alias("value"), place["source"].alias("source"), place["floor"].alias("floor"))

    given = F.filter(places, lambda p: p["text"].isNotNull())
    fit = F.filter(F.transform(given, read), lambda r: F.coalesce(r["value"] >= r["floor"], F.lit(False)))
    chosen = lambda best: F.when(
        best.isNotNull(), F.struct(best["value"].alias("value"), best["source"].alias("source"))
    )
    return bind(F.get(fit, F.lit(0)), chosen)
