"""Stock expressions (K). A state is a nullable boolean: TRUE, FALSE or unknown."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewatch.functions import text as tx
from aislewatch.functions.phrases import PhraseBook, with_phrase_hits
from aislewatch.rules import stock as rules
from aislewatch.rules.retailers import LANGUAGES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def availability(text: Column | str, preorder_is_sold_out: bool = False) -> Column:
    """Schema.org availability to a state."""
    text = F.lower(_col(text))
    sold_out = r"outofstock|out_of_stock|soldout|\boos\b|discontinued"
    if preorder_is_sold_out:
        sold_out += "|preorder"
    return F.when(text.rlike(sold_out), False).when(text.rlike("instock"), True)


def first_known(states: Column) -> Column:
    """First state of an array that is not unknown."""
    return F.get(F.filter(states, lambda s: s.isNotNull()), F.lit(0))


def button(text: Column | str, disabled: Column, aria_disabled: Column | None = None, classes: Column | None = None) -> Column:
    """State shown by a buy button: its text, and whether it can be pressed."""
    text = F.lower(_col(text))
    off = F.coalesce(disabled, F.lit(False))
    if aria_disabled is not None:
        off = off | F.coalesce(F.lower(aria_disabled).isin("true", "1"), F.lit(False))
    if classes is not None:
        off = off | F.coalesce(classes.rlike(r"(?i)\bdisabled\b"), F.lit(False))
    return (
        F.when(text.rlike(rules.NOT_YET_TEXT), False)
        .when(text.rlike(rules.BUY_TEXT), ~off)
    )


#: Stands for a page whose language is unknown: all lists are tried.
ANY_LANGUAGE = "any"


def _book() -> PhraseBook:
    """Lists of phrases by country code, one of each for pages of no listed country, and one of all languages."""
    spoken = {**LANGUAGES, "": ("en",), ANY_LANGUAGE: ("en", "pl", "sv", "de", "fr")}
    lists = {}
    for code, languages in spoken.items():
        lists[f"no {code}"] = [p for lang in languages for p in rules.NEGATIVE_PHRASES[lang]]
        lists[f"yes {code}"] = [p for lang in languages for p in rules.POSITIVE_PHRASES[lang]]
    return PhraseBook(lists)


def state_of_hits(container: Column, body: Column, country: Column | str) -> Column:
    """K3: struct(state, text) from the phrases that ``phrase_hits`` found: the stock container's first, then the
    page's, unavailable before available, in the languages of the country. Phrases count as whole words."""
    book, code = _book(), _col(country)
    code = F.when(code.isin(*LANGUAGES, ANY_LANGUAGE), code).otherwise(F.lit(""))

    def tried(hits: Column, kind: str, state: bool) -> Column:
        phrase = book.first_phrase(hits, F.concat(F.lit(f"{kind} "), code), whole=True)
        return tx.bind(phrase, lambda p: F.when(p.isNotNull(), F.struct(F.lit(state).alias("state"), p.alias("text"))))

    return F.coalesce(
        tried(container, "no", False), tried(container, "yes", True), tried(body, "no", False), tried(body, "yes", True)
    )


def with_phrase_state(
    df: DataFrame, container: Column | str, body: Column | str, country: Column | str, out: str = "spoken"
) -> DataFrame:
    """K3: add struct(state, text) from the phrases of a stock container and of a page's text, in the languages of
    the page's country, English elsewhere. Each text is read once for all lists."""
    plain = {n: F.when(_col(c).isNotNull(), tx.clean(c)) for n, c in (("_c", container), ("_b", body))}
    staged = with_phrase_hits(df, plain)
    return staged.withColumn(out, state_of_hits(F.col("_c"), F.col("_b"), country)).drop("_c", "_b")


def offered_state(retailer: Column | str, text: Column | str) -> Column:
    """``availability`` under the retailer's rule for pre-orders."""
    strict = _col(retailer).isin(*rules.PREORDER_IS_SOLD_OUT)
    return F.when(strict, availability(text, preorder_is_sold_out=True)).otherwise(availability(text))


def by_precedence(
    retailer: Column | str,
    signals: Mapping[str, Column],
    precedence: Mapping[str, Sequence[str]] = rules.PRECEDENCE,
    default: Sequence[str] = rules.DEFAULT_PRECEDENCE,
) -> Column:
    """Struct(state, text, source) of the first signal a retailer believes that has an answer.

    ``signals`` maps a signal name to struct(state, text). Retailers with the same order share a branch.
    """
    retailer = _col(retailer)

    def ordered(names: Sequence[str]) -> Column:
        return F.coalesce(
            *[
                F.when(
                    signals[n]["state"].isNotNull(),
                    F.struct(
                        signals[n]["state"].alias("state"), signals[n]["text"].alias("text"), F.lit(n).alias("source")
                    ),
                )
                for n in names
            ]
        )

    groups: dict[tuple[str, ...], list[str]] = {}
    for name, order in precedence.items():
        groups.setdefault(tuple(order), []).append(name)
    branch = None
    for order, members in groups.items():
        value = ordered(order)
        branch = F.when(retailer.isin(*members), value) if branch is None else branch.when(retailer.isin(*members), value)
    return branch.otherwise(ordered(default))


def count_vote(text: Column | str) -> Column:
    """Compare how often a page says "currently unavailable" and "in stock"."""
    text = F.lower(_col(text))
    out_n = F.regexp_count(text, F.lit("currently unavailable"))
    in_n = F.regexp_count(text, F.lit("in stock"))
    return F.when((out_n > 0) & (out_n >= in_n), False).when(in_n > out_n, True)


def quantity_left(text: Column | str) -> Column:
    """Number of items left, when a page tells it."""
    text = F.lower(_col(text))
    found = F.coalesce(
        F.nullif(F.regexp_extract(text, r"only (\d+) left", 1), F.lit("")),
        F.nullif(F.regexp_extract(text, r"(\d+)\+? in stock", 1), F.lit("")),
        F.nullif(F.regexp_extract(text, r"in stock\D{0,5}(\d+)", 1), F.lit("")),
    )
    return found.cast("int")


def status_code(code: Column | str) -> Column:
    """State of a platform status code."""
    code = F.upper(F.trim(_col(code)))
    return (
        F.when(code.isin("IN_STOCK", "AVAILABLE", "INSTORE", "ONLINE"), True)
        .when(code.startswith("OUT") | (code == "NOT_AVAILABLE"), False)
    )


def default_state(retailer: Column | str, state: Column, button_present: Column | None = None) -> Column:
    """Answer when no signal speaks: unknown, but for the retailers with another policy."""
    retailer = _col(retailer)
    out = F.when(retailer.isin(*rules.UNKNOWN_IS_SOLD_OUT), F.lit(False))
    if button_present is not None:
        out = out.when(retailer == "tesco", button_present)
    return F.coalesce(state, out)
