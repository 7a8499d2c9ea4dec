"""Price expressions (P). Money is DECIMAL(12,2) from the first parse to the last format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
_BLANK = r"[\s  ]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _plain(number: Column) -> Column:
    """Comma-grouped number to money."""
    return F.regexp_replace(number, r"[,\s]", "").try_cast(MONEY)


def dollars(text: Column | str) -> Column:
    """``$1,234.50``; the sign is optional and missing cents are zero."""
    text = _col(text)
    whole = _found(text, r"\$?\s*(\d[\d,]*)(?:\.(\d{2}))?", 1)
    cents = F.coalesce(_found(text, r"\$?\s*(\d[\d,]*)(?:\.(\d{2}))?", 2), F.lit("00"))
    return F.concat_ws(".", F.regexp_replace(whole, ",", ""), F.when(whole.isNotNull(), cents)).try_cast(MONEY)


def pounds(text: Column | str, bare: bool = False) -> Column:
    """``£1,234.5``; with ``bare`` a number without the sign is accepted as a last resort."""
    text = _col(text)
    number = _found(text, r"£\s*([\d,]+(?:\.\d{1,2})?)")
    if bare:
        number = F.coalesce(number, _found(text, r"\b([\d,]+(?:\.\d{1,2})?)\b"))
    return _plain(number)


def _european(number: Column) -> Column:
    """A last separator followed by exactly two digits is the decimal point; all others group."""
    number = F.regexp_replace(number, _BLANK, "")
    whole = F.regexp_replace(F.regexp_replace(number, r"[.,]\d{2}$", ""), r"[.,]", "")
    cents = F.coalesce(_found(number, r"[.,](\d{2})$"), F.lit("00"))
    return F.when(number.rlike(r"\d"), F.concat_ws(".", whole, cents)).try_cast(MONEY)


def euros(text: Column | str) -> Column:
    """Euro text in both decimal styles: ``1.234,50 €`` and ``€69.99``."""
    return _european(_found(_col(text), r"(\d[\d.,\s  ]*[.,]\d{2})(?!\d)"))


def kronor(text: Column | str) -> Column:
    """``1 234,50 kr`` or ``SEK``."""
    return _european(_found(_col(text), r"(?i)(\d[\d\s .,]*)(?:SEK|kr)\b"))


# Phrases of an instalment offer, whose amount is not the price.
INSTALMENT = r"(?i)zapłać później|raty|allegropay|w (?:styczniu|lutym|marcu|kwietniu|maju|czerwcu|lipcu|sierpniu|wrześniu|październiku|listopadzie|grudniu)"


def zloty(text: Column | str, whole: bool = False) -> Column:
    """Złoty text whose integer, grouped or not, and fraction may stand in separate nodes; instalments are skipped.

    With ``whole`` a text without a fraction may give a whole number of one to six digits.
    """
    text = _col(text)
    pattern = rf"(?<!\d)(\d{{1,3}}(?:{_BLANK}\d{{3}})+|\d{{1,6}}){_BLANK}*[.,]{_BLANK}*(\d{{2}})\b"
    units = F.regexp_replace(_found(text, pattern, 1), _BLANK, "")
    amount = F.concat_ws(".", units, _found(text, pattern, 2))
    value = plausible(F.nullif(amount, F.lit("")).try_cast(MONEY), "0.50", "100000")
    if whole:
        bare = _found(text, r"\b(\d{1,6})\b").try_cast(MONEY)
        fraction = text.rlike(rf"\d{{1,6}}{_BLANK}*[.,]{_BLANK}*\d{{2}}")
        value = F.coalesce(value, F.when(~fraction, plausible(bare, "1", "100000")))
    return F.when(~text.rlike(INSTALMENT), value)


def australian_dollars(text: Column | str) -> Column:
    text = _col(text)
    number = F.coalesce(
        _found(text, r"A\$\s*([\d,]+(?:\.\d{1,2})?)"),
        _found(text, r"\$\s*([\d,]+(?:\.\d{1,2})?)"),
        _found(text, r"\b(\d[\d,]*(?:\.\d{1,2})?)\b"),
    )
    return _plain(number)


# Currency symbols by ISO code.
SYMBOLS = {"USD": "$", "GBP": "£", "EUR": "€", "CAD": "$", "AUD": "$"}


def any_currency(text: Column | str) -> Column:
    """Struct of symbol and amount for the first ``£``, ``$`` or ``€`` price."""
    text = _col(text)
    pattern = r"([£$€])\s?(\d[\d,]*(?:\.\d{2})?)"
    symbol = _found(text, pattern, 1)
    return F.when(
        symbol.isNotNull(), F.struct(symbol.alias("symbol"), _plain(_found(text, pattern, 2)).alias("amount"))
    )


def with_symbol(amount: Column | str, code: Column | str) -> Column:
    """Prefix the amount text with the symbol of its currency code, unless it is there already."""
    text, code = F.trim(_col(amount)), F.upper(_col(code))
    symbol = None
    for iso, sign in SYMBOLS.items():
        symbol = F.when(code == iso, sign) if symbol is None else symbol.when(code == iso, sign)
    return F.when(symbol.isNotNull() & ~text.startswith(symbol), F.concat(symbol, text)).otherwise(text)


def minor_units(text: Column | str) -> Column:
    """Pennies, cents or grosze to the major unit."""
    units = _found(_col(text), r"^\s*(\d{1,10})\s*$").try_cast("decimal(12,0)")
    return (units / 100).cast(MONEY)


def split_nodes(whole: Column | str, fraction: Column | str) -> Column:
    """Integer and fraction rendered in two nodes."""
    whole = F.nullif(F.regexp_replace(_col(whole), r"\D", ""), F.lit(""))
    fraction = F.coalesce(F.nullif(F.regexp_replace(_col(fraction), r"\D", ""), F.lit("")), F.lit("00"))
    return F.when(whole.isNotNull(), F.concat_ws(".", whole, fraction)).try_cast(MONEY)


def labelled(text: Column | str) -> Column:
    """Amount and currency of an accessible label such as ``Amount: 54.99 Currency: AUD``."""
    text = _col(text)
    return F.struct(
        _plain(_found(text, r"(?i)Amount:\s*\$?([\d,]+(?:\.\d{1,2})?)")).alias("amount"),
        F.upper(_found(text, r"(?i)Currency:\s*([A-Za-z]{3})")).alias("currency"),
    )


def format_money(amount: Column | str, currency: Column | str) -> Column:
    """``54.99 GBP``."""
    return F.concat_ws(" ", _col(amount).cast(MONEY).cast("string"), F.when(_col(amount).isNotNull(), _col(currency)))


def format_symbol(amount: Column | str, symbol: str) -> Column:
    """``$54.99``."""
    return F.concat(F.lit(symbol), _col(amount).cast(MONEY).cast("string"))


def plausible(amount: Column, low: str, high: str) -> Column:
    """The amount if it lies strictly within the bounds, else NULL."""
    return F.when((amount > F.lit(low).cast(MONEY)) & (amount < F.lit(high).cast(MONEY)), amount)


def at_least(amount: Column, floor: int) -> Column:
    """Floor for weak strategies."""
    return F.when(amount >= floor, amount)


def first_with_source(strategies: Sequence[tuple[Column, str]]) -> Column:
    """Ordered choice with provenance: struct(value, source) of the first strategy with a value.

    ``coalesce`` stops at the first hit, so later strategies cost nothing on rows already decided.
    """
    return F.coalesce(
        *[F.when(v.isNotNull(), F.struct(v.alias("value"), F.lit(s).alias("source"))) for v, s in strategies]
    )


def saving_fields(current: Column, original: Column, saving: Column) -> dict[str, Column]:
    """Original price, saving and saving percentage, each derived from the other two where missing."""
    current, original, saving = (c.cast(MONEY) for c in (current, original, saving))
    full = F.coalesce(original, (current + saving).cast(MONEY))
    saved = F.coalesce(saving, F.greatest(F.lit(0).cast(MONEY), (full - current).cast(MONEY)))
    saved = F.when(current.isNotNull() | saving.isNotNull(), saved)
    share = (full - current).cast("decimal(20,8)") / full * 100
    return {
        "price_original": full,
        "price_saving": F.when(full.isNotNull() | saving.isNotNull(), saved),
        "price_saving_pct": F.when((full > 0) & current.isNotNull(), F.round(share, 2)).cast("decimal(9,2)"),
    }


def unless_sold_out(amount: Column, in_stock: Column) -> Column:
    """No price for an item known to be out of stock."""
    return F.when(~in_stock.eqNullSafe(F.lit(False)), amount)


def source_label(onsite: Column, jsonld_used: Column) -> Column:
    """``onsite``, ``jsonld`` or ``mixed``, by which inputs were used."""
    return F.when(jsonld_used & onsite, "mixed").when(jsonld_used, "jsonld").otherwise("onsite")
