"""One automaton over all phrases: where a text holds which of them.

The phrases of every shop and language go into one trie automaton, which reads a text once, however many
lists there are. What it finds is an array of a row, at most one entry per phrase, from which each list
is answered by its order: no list scans the text again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewatch.rules import stock as stock_rules
from aislewatch.rules import validity as validity_rules

HIT_TYPE = "struct<phrase:int,at:int,whole_at:int>"
HITS_TYPE = f"array<{HIT_TYPE}>"
ARROW_HITS = pa.list_(pa.struct([("phrase", pa.int32()), ("at", pa.int32()), ("whole_at", pa.int32())]))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_phrases() -> tuple[str, ...]:
    """Every phrase of every list, once; a phrase's place is its number."""
    lists: list[Iterable[str]] = [
        *validity_rules.ERROR_PHRASES.values(), validity_rules.ENDED_PHRASES, validity_rules.UNAVAILABLE_PHRASES,
        *stock_rules.NEGATIVE_PHRASES.values(), *stock_rules.POSITIVE_PHRASES.values(),
    ]
    return tuple(dict.fromkeys(p for phrases in lists for p in phrases))


@lru_cache(maxsize=8)
def automaton(phrases: tuple[str, ...]) -> ahocorasick.Automaton:
    """The automaton of lower-case phrases, built once per worker."""
    machine = ahocorasick.Automaton()
    for number, phrase in enumerate(phrases):
        machine.add_word(phrase, number)
    machine.make_automaton()
    return machine


def _is_word(letter: str) -> bool:
    return letter.isalnum() or letter == "_"


def find(text: str, phrases: tuple[str, ...]) -> dict[int, list[int | None]]:
    """Per phrase number: where the lower-case text first holds it, and first as whole words (from 1, or None)."""
    found: dict[int, list[int | None]] = {}
    for end, number in automaton(phrases).iter(text) if phrases else ():
        held = found.get(number)
        if held is not None and held[1] is not None:
            continue
        phrase = phrases[number]
        start = end - len(phrase) + 1
        left = start == 0 or not _is_word(text[start - 1]) or not _is_word(phrase[0])
        right = end + 1 == len(text) or not _is_word(text[end + 1]) or not _is_word(phrase[-1])
        whole = start + 1 if left and right else None
        if held is None:
            found[number] = [start + 1, whole]
        elif whole is not None:
            held[1] = whole
    return found


def rows_of(found: Mapping[int, Sequence[int | None]]) -> list[dict]:
    """What ``find`` found as rows of ``HITS_TYPE``, in the order of the phrases."""
    return [{"phrase": n, "at": found[n][0], "whole_at": found[n][1]} for n in sorted(found)]


def with_phrase_hits(df: DataFrame, texts: Mapping[str, Column | str], phrases: Sequence[str] | None = None) -> DataFrame:
    """Add a column of finds for each text, by the column's name: (phrase, at, whole_at), positions from 1.

    ``whole_at`` is the first place where no letter, digit or underscore touches the phrase, or NULL. A text is
    lower-cased and its white space must have been collapsed. NULL gives NULL, a text without a phrase an empty
    array. A column has at most one entry per phrase, so it is bounded whatever the text holds. The other columns pass through Arrow, so none may be of type VARIANT.
    """
    listed = tuple(phrases) if phrases is not None else all_phrases()
    kept, names = df.columns, list(texts)
    source = df.select("*", *[F.lower(_col(text)).alias(f"_text{n}") for n, text in enumerate(texts.values())])

    def hits(column: pa.Array) -> pa.Array:
        rows = []
        for start in range(0, len(column), 256):
            rows += [None if t is None else rows_of(find(t, listed)) for t in column.slice(start, 256).to_pylist()]
        return pa.array(rows, ARROW_HITS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k) for k in range(len(kept))]
            found = [hits(batch.column(len(kept) + k)) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns + found, names=kept + names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return source.mapInArrow(read, ", ".join(fields + [f"`{n}` {HITS_TYPE}" for n in names]))


class PhraseBook:
    """Lists of phrases by name, answered from the hits of one pass."""

    def __init__(self, lists: Mapping[str, Sequence[str]], phrases: Sequence[str] | None = None):
        self.phrases = tuple(phrases) if phrases is not None else all_phrases()
        numbers = {p: n for n, p in enumerate(self.phrases)}
        self.lists = {name: [numbers[p] for p in listed] for name, listed in lists.items()}

    def _text(self, number: Column) -> Column:
        return F.get(F.array(*[F.lit(p) for p in self.phrases]), number)

    def _list(self, name: Column | str) -> Column:
        """Numbers of a list in its order; NULL for a name without one."""
        if isinstance(name, str):
            return F.array(*[F.lit(n) for n in self.lists[name]]).cast("array<int>")
        table = ", ".join(f"'{k}', array({', '.join(map(str, v))})" for k, v in self.lists.items())
        return F.element_at(F.expr(f"map({table})"), name)

    def first_hit(self, hits: Column, name: Column | str, whole: bool = False, keep=None) -> Column:
        """The hit of the list's first phrase that the text holds, else NULL.

        ``name`` is a list's name, or a column of names. With ``whole`` only whole words count; ``keep`` is a
        further test of a hit.
        """

        def counts(h: Column) -> Column:
            test = h["whole_at"].isNotNull() if whole else F.lit(True)
            return test if keep is None else test & keep(h)

        fit = F.filter(hits, counts)
        order = F.transform(self._list(name), lambda n: F.get(F.filter(fit, lambda h: h["phrase"] == n), F.lit(0)))
        return F.get(F.filter(order, lambda h: h.isNotNull()), F.lit(0))

    def first_phrase(self, hits: Column, name: Column | str, whole: bool = False, keep=None) -> Column:
        """The list's first phrase that the text holds, else NULL."""
        return self._text(self.first_hit(hits, name, whole, keep)["phrase"])


def away_from(text: Column, terms: str, reach: int, phrases: Sequence[str] | None = None):
    """V12 as a test of a hit: no term lies within ``reach`` characters of the phrase's first place."""
    listed = tuple(phrases) if phrases is not None else all_phrases()
    sizes = F.array(*[F.lit(len(p)) for p in listed])

    def away(hit: Column) -> Column:
        at, size = hit["at"], F.get(sizes, hit["phrase"])
        before = F.substr(text, F.greatest(F.lit(1), at - reach), F.least(at - 1, F.lit(reach)))
        after = F.substr(text, at + size, F.lit(reach))
        return ~before.rlike(terms) & ~after.rlike(terms)

    return away
