"""LM scoring by a probabilistic suffix tree over words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewatch.llm.shared import WORDS, discard, mix, run_hashes, stored, texts_of

DEPTH = 3
#: A context is grown, and a word after it stored, from so many occurrences on, whatever the size of the corpus.
LEAST_COUNT = 2
#: Contexts of this share of all tokens are broadcast as a tree, at most DEPTH / LEAST_CONTEXT; the others stay in tables.
LEAST_CONTEXT = 2e-6
#: So are the words after them from this share on: at most DEPTH / LEAST_EVENT.
LEAST_EVENT = 2e-6
#: A context stays if its next-word distribution diverges from its suffix's by so many nats.
LEAST_DIVERGENCE = 0.01
#: Weight, in tokens, of the suffix's distribution in that of a context.
PRIOR = 10.0
#: Stands for the end token among the hashes of words.
END = np.uint64(0x656E64)
#: Tokens or events that a task gathers before it counts them.
GATHERED = 2_000_000
#: Characters of texts that are read together, so that no step is taken text by text.
RUN_CHARACTERS = 1 << 19
#: Word sequences that a task gathers before it deals them to buckets by their hash, many to a row.
GATHERED_GRAMS = 1_000_000
#: Training tokens for each bucket when sequences are counted, and when they are looked up; and the least number of buckets.
COUNTED_TOKENS, ASKED_TOKENS, LEAST_BUCKETS = 2_000_000, 16_000_000, 16
#: Longer sequences than of two tokens are counted in so many turns, by their hash, which bounds the disk that they take at once.
TURNS = 2
#: Rows of many sequences that Spark hands to Python at once.
_FEW_ROWS = 32


def _counts(parts: list[np.ndarray]) -> pa.RecordBatch:
    values, counts = np.unique(np.concatenate(parts) if parts else np.empty(0, np.int64), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], ["key", "n"])


def _runs(texts: Iterable[str]) -> Iterator[list[str]]:
    """Consecutive texts, of about ``RUN_CHARACTERS`` together; a longer one stands alone or ends a run."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= RUN_CHARACTERS or len(run) >= RUN_CHARACTERS // 64:
            yield run
            run, size = [], 0
    if run:
        yield run


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of texts one after the other, each ended by the end token, and the place after each text's end token."""
    data = [text.encode("utf-8") for text in texts]
    hashes, starts = WORDS.scan(b"\n".join(data))
    words = np.searchsorted(starts, np.cumsum([len(d) + 1 for d in data]))
    return np.insert(hashes, words, END), words + np.arange(1, len(data) + 1)


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (key, n): how often each token, by its hash, occurs in the texts of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for texts in _runs(t for batch in batches for t in texts_of(batch.column("text"))):
            parts.append(_tokens(texts)[0].view(np.int64))
            size += len(parts[-1])
            if size >= GATHERED:
                yield _counts(parts)
                parts, size = [], 0
        yield _counts(parts)

    found = docs.select("text").mapInArrow(run, "key bigint, n bigint")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


class _Table:
    """Numbers by key, a hash, for keys that share their first ``bits``; those of equal keys are added up. A key's place is found by its next bits, and a few steps."""

    def __init__(self, keys: np.ndarray, bits: int, *values: np.ndarray):
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
        self.keys = np.append(keys[first], ~np.uint64(0))
        self.values = [np.append(np.add.reduceat(v[order], first) if len(first) else v, v.dtype.type(0)) for v in values]
        width = max(1, min(64 - bits, len(first).bit_length()))
        self.shift, self.mask = np.uint64(64 - bits - width), np.uint64((1 << width) - 1)
        self.starts = np.searchsorted(self._cells(keys[first]), np.arange(1 << width))

    def _cells(self, keys: np.ndarray) -> np.ndarray:
        return ((keys >> self.shift) & self.mask).astype(np.int64)

    def places(self, wanted: np.ndarray) -> np.ndarray:
        """Places of keys, that after the last for those that are not there; values there are 0."""
        at = self.starts.take(self._cells(wanted))
        held = self.keys.take(at)
        out = np.where(held == wanted, at, len(self.keys) - 1)
        left = np.flatnonzero(held < wanted)
        at = at[left]
        while len(left):
            at += 1
            held, own = self.keys.take(at), wanted[left]
            found = held == own
            out[left[found]] = at[found]
            more = held < own
            left, at = left[more], at[more]
        return out


@dataclass
class Tree:
    """Contexts as a tree of suffixes: a node's child prepends one older word.

    ``words`` are the hashes, ascending, of the tokens that may be stored; a token's number is its place.
    ``child_keys`` and ``event_keys`` are ascending; a key is node * 2**32 + token number. Node 0 is the
    empty context, whose distribution is that of single tokens. No context holds the end token, so texts
    whose tokens stand one after the other are scored as each by itself.
    """

    words: np.ndarray
    word_log: np.ndarray
    child_keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    child_nodes: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    parents: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    event_keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    event_log: np.ndarray = field(default_factory=lambda: np.empty(0))
    backoff_log: np.ndarray = field(default_factory=lambda: np.zeros(1))

    @cached_property
    def _tables(self) -> list[_Table]:
        return [_Table(self.words, 0, np.arange(len(self.words)) + 1)] + [
            _Table(mix(keys.view(np.uint64)), 0, values + 1)
            for keys, values in ((self.child_keys, self.child_nodes), (self.event_keys, np.arange(len(self.event_keys))))
        ]

    def _looked_up(self, table: int, keys: np.ndarray) -> np.ndarray:
        table, keys = self._tables[table], keys.view(np.uint64) if table == 0 else mix(keys.view(np.uint64))
        return table.values[0].take(table.places(keys)) - 1

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Token numbers, -1 for tokens that are not stored."""
        return self._looked_up(0, hashes)

    def deeper(self, nodes: np.ndarray, numbers: np.ndarray, depth: int) -> np.ndarray:
        """``nodes``, the contexts of ``depth`` - 1 words before each token, with one older word; -1 where there is none."""
        out = np.full(len(numbers), -1, np.int64)
        at = np.flatnonzero((nodes[depth:] >= 0) & (numbers[: max(0, len(numbers) - depth)] >= 0)) + depth
        out[at] = self._looked_up(1, (nodes[at] << 32) + numbers[at - depth])
        return out

    def states(self, numbers: np.ndarray, depth: int) -> np.ndarray:
        """The node of the context of exactly ``depth`` words before each token, or -1."""
        nodes = np.zeros(len(numbers), np.int64)
        for k in range(1, depth + 1):
            nodes = self.deeper(nodes, numbers, k)
        return nodes

    def log_scores(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token: log10 of its probability in its longest suffix state, and whether that is left open.

        It is open where the search ends at single tokens with a token that is not stored; the score
        then holds the backoff weights alone.
        """
        nodes, state = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        for depth in range(1, DEPTH + 1):
            state = self.deeper(state, numbers, depth)
            nodes = np.where(state >= 0, state, nodes)
        score, root = np.zeros(len(numbers)), nodes == 0
        at = np.flatnonzero(nodes)  # tokens whose search goes on, at ``nodes``
        nodes = nodes[at]
        while len(at):
            wanted = numbers[at]
            keys = np.where(wanted >= 0, (nodes << 32) + wanted, -1)
            event = self._looked_up(2, keys)
            hit = event >= 0
            score[at[hit]] += self.event_log[event[hit]]
            at, nodes = at[~hit], nodes[~hit]
            score[at] += self.backoff_log[nodes]
            nodes = self.parents[nodes]
            ended = nodes == 0
            root[at[ended]] = True
            at, nodes = at[~ended], nodes[~ended]
        stored_ = root & (numbers >= 0)
        score[stored_] += self.word_log[numbers[stored_]]
        return score, root & (numbers < 0)


def _after(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Hashes of word sequences, from those without the last word and those without the first."""
    out = before * np.uint64(0x9E3779B97F4A7C15)
    out += after
    return mix(out)


def _grams(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each sequence of ``size`` tokens within a text: the hashes without its last and first token, and its last place."""
    whole = hashes
    for _ in range(size - 2):
        whole = _after(whole[:-1], whole[1:])
    ends, inside = np.flatnonzero(hashes == END), np.ones(len(hashes), bool)
    inside[: size - 1] = False
    for k in range(1, size):
        after = ends + k
        inside[after[: np.searchsorted(after, len(hashes))]] = False
    at = np.flatnonzero(inside)
    first = at - (size - 1)
    return whole[first], whole[first + (size > 1)], at


def _buckets(tokens: int, each: int) -> int:
    """The number of buckets, as the logarithm of a power of two."""
    return (max(LEAST_BUCKETS, -(-tokens // each)) - 1).bit_length()


def _dealt(keys: np.ndarray, bits: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by bucket that keeps the order within each, and (bucket, begin, end) of those that are not empty."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
    return order, [(k, int(cuts[k]), int(cuts[k + 1])) for k in np.flatnonzero(np.diff(cuts)).tolist()]


@contextmanager
def _few_rows(spark: SparkSession) -> Iterator[None]:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(_FEW_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Many sequences stand in one row, by bucket of a hash: each column holds the numbers of all of them.
_MANY = "bucket int, kind int, a binary, b binary, c binary, d binary, e binary, f binary"
_NAMES = ["bucket", "kind", "a", "b", "c", "d", "e", "f"]
#: Kinds of rows: what is looked up, what asks, and what events come to (``_judged_events``).
_TABLE, _ASKING, _EVENT, _VALUE, _WEIGHT, _HOT = range(6)


def _deal(kind: int, keys: np.ndarray, bits: int, *columns: np.ndarray) -> list[tuple]:
    """Rows of ``columns`` by bucket of ``keys``."""
    order, runs = _dealt(keys, bits)
    columns = [c[order] for c in columns]
    return [(bucket, kind, *(c[a:b].tobytes() for c in columns)) for bucket, a, b in runs]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    rows = [r + (None,) * (len(_NAMES) - len(r)) for r in rows]
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
    columns = zip(*rows, strict=True) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _NAMES)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Each bucket with its rows (kind, a ... f), to be read before the next bucket."""
    rows = (tuple(batch.column(n)[k].as_py() for n in _NAMES) for batch in batches for k in range(batch.num_rows))
    for bucket, own in groupby(rows, lambda r: r[0]):
        yield bucket, (r[1:] for r in own)


def _together(rows: list[tuple], *kinds: type) -> list[np.ndarray]:
    """The columns of rows of one kind."""
    return [np.frombuffer(b"".join(r[k] for r in rows), kind) for k, kind in enumerate(kinds, 1)]


def _meet(*tables: DataFrame) -> DataFrame:
    """Rows of many in order of bucket and kind, each bucket in one task."""
    every = tables[0]
    for table in tables[1:]:
        every = every.union(table)
    return every.repartition("bucket").sortWithinPartitions("bucket", "kind")


def gram_counts(docs: DataFrame, size: int, tokens: int, turn: int, turns: int) -> DataFrame:
    """Sequences of ``size`` tokens that occur ``LEAST_COUNT`` times or more: hashes without the last, and without the first token, and how often.

    They are rows of many, in buckets of the hash without the first token. A turn has those whose hash leaves ``turn`` when divided by ``turns``.
    """
    bits, asked = _buckets(tokens, COUNTED_TOKENS), _buckets(tokens, ASKED_TOKENS)

    def dealt(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        keys, ctx, suf = (np.concatenate(x) for x in zip(*parts, strict=True))
        if size > 2:  # few come twice in a task
            return _batch(_deal(_ASKING, keys, bits, ctx, suf, np.ones(len(keys), np.int32)))
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        n = np.diff(np.append(first, len(keys))).astype(np.int32)
        return _batch(_deal(_ASKING, keys[first], bits, ctx[order[first]], suf[order[first]], n))

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for texts in _runs(t for batch in batches for t in texts_of(batch.column("text"))):
            ctx, suf, _ = _grams(_tokens(texts)[0], size)
            keys = _after(ctx, suf)
            if turns > 1:
                own = np.flatnonzero(keys % np.uint64(turns) == turn)
                keys, ctx, suf = keys[own], ctx[own], suf[own]
            parts.append((keys, ctx, suf))
            held += len(keys)
            if held >= GATHERED_GRAMS:
                yield dealt(parts)
                parts, held = [], 0
        if held:
            yield dealt(parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_bucket(batches):
            ctx, suf, n = _together(list(rows), np.uint64, np.uint64, np.int32)
            keys = _after(ctx, suf)
            order = np.argsort(keys)
            keys = keys[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            m = np.add.reduceat(n[order], first, dtype=np.int64)
            enough = m >= LEAST_COUNT
            at = order[first[enough]]
            yield _batch(_deal(_ASKING, suf[at], asked, ctx[at], suf[at], m[enough]))

    found = _meet(docs.select("text").mapInArrow(give, _MANY))
    with _few_rows(docs.sparkSession):
        return stored(found.mapInArrow(count, _MANY), "lm-counts")


def _events(counts: list[DataFrame], shorter: DataFrame, total: int) -> DataFrame:
    """What sequences come to, by those that are shorter by one token: ``_TABLE`` rows of key, probability, count.

    Each sequence is looked up without its first token, for the probability that its last one has after a shorter context, and then, where
    all of the same context meet, without its last, for the context's count.
    """
    bits = _buckets(total, ASKED_TOKENS)
    floors = (LEAST_CONTEXT * total, LEAST_EVENT * total)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_bucket(batches):
            lots = {_TABLE: [], _ASKING: []}
            for row in rows:
                lots[row[0]].append(row)
            keys, p = _together(lots[_TABLE], np.uint64, np.float64)
            table = _Table(keys, bits, p)
            ctx, suf, m = _together(lots[_ASKING], np.uint64, np.uint64, np.int64)
            yield _batch(_deal(_ASKING, ctx, bits, ctx, suf, m, table.values[0][table.places(suf)]))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_bucket(batches):
            lots = {_TABLE: [], _ASKING: []}
            for row in rows:
                lots[row[0]].append(row)
            if lots[_ASKING]:
                keys, _, m = _together(lots[_TABLE], np.uint64, np.float64, np.int64)
                table = _Table(keys, bits, m)
                ctx, suf, m, ps = _together(lots[_ASKING], np.uint64, np.uint64, np.int64, np.float64)
                yield _batch(_judged_events(ctx, suf, m, ps, table.values[0][table.places(ctx)], floors, bits))

    first = _meet(shorter, *counts).mapInArrow(suffixes, _MANY)
    with _few_rows(shorter.sparkSession):
        return stored(_meet(shorter, first).mapInArrow(contexts, _MANY), "lm-events", "kind")


def _judged_events(ctx: np.ndarray, suf: np.ndarray, m: np.ndarray, ps: np.ndarray, c: np.ndarray, floors: tuple[float, float], bits: int) -> list[tuple]:
    """Rows of all events of some contexts: ``m`` of ``c`` occurrences of the context, ``ps`` the probability after its suffix.

    ``_EVENT`` key, probability, count; ``_VALUE`` key, and what the event adds to the score that shorter contexts give and this one's
    backoff; ``_WEIGHT`` context, and log10 of its backoff weight. The latter two leave out zeros, and what reaches ``floors``, of contexts and events,
    which is for the tree: ``_HOT`` key, context, suffix, probability, log10 of the weight or NaN if the context does not diverge.
    """
    order = np.argsort(ctx)
    ctx, suf, m, ps, c = (x[order] for x in (ctx, suf, m, ps, c))
    first = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1])))
    sizes = np.diff(np.append(first, len(ctx)))
    own = (m + PRIOR * ps) / (c + PRIOR)
    rest = np.maximum(1 - np.add.reduceat(own, first), 1e-12)
    weight = rest / np.maximum(1 - np.add.reduceat(ps, first), 1e-12)
    gain = np.log(own / ps)
    keep = np.add.reduceat(own * gain, first) + rest * np.log(weight) >= LEAST_DIVERGENCE
    lb = np.where(keep, np.log10(weight), 0.0)
    hot_ctx = c[first] >= floors[0]
    cold = np.flatnonzero((lb != 0) & ~hot_ctx)
    rows = _deal(_WEIGHT, ctx[first[cold]], bits, ctx[first[cold]], lb[cold])
    keep, lb = np.repeat(keep, sizes), np.repeat(lb, sizes)
    keys, p = _after(ctx, suf), np.where(keep, own, ps)
    rows += _deal(_EVENT, keys, bits, keys, p, m)
    value = np.where(keep, gain / np.log(10) - lb, 0.0)
    hot = np.repeat(hot_ctx, sizes) & (m >= floors[1])
    cold = np.flatnonzero((value != 0) & ~hot)
    rows += _deal(_VALUE, keys[cold], bits, keys[cold], value[cold])
    hot = np.flatnonzero(hot)
    return rows + _deal(_HOT, keys[hot], bits, keys[hot], ctx[hot], suf[hot], p[hot], np.where(keep, lb, np.nan)[hot], m[hot])


def _packed(words: DataFrame, tokens: int) -> DataFrame:
    """Rows (key, p, m) as rows of many."""
    bits = _buckets(tokens, ASKED_TOKENS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys, p, m = (batch.column(n).to_numpy() for n in ("key", "p", "m"))
                yield _batch(_deal(_TABLE, keys.view(np.uint64), bits, keys, p, m))

    return words.mapInArrow(pack, _MANY)


def _of_kind(table: DataFrame, kind: int, name: int = _TABLE) -> DataFrame:
    return table.filter(F.col("kind") == kind).select("bucket", F.lit(name).alias("kind"), "a", "b", "c", "d", "e", "f")


@dataclass
class SuffixModel:
    tree: Tree
    #: Rows (key, n) of all training tokens.
    vocabulary: DataFrame
    train_tokens: int
    distinct: int
    #: For sequences of 1, 2 ... tokens, key and value of what the tree lacks; a key may come twice, its values are to be added.
    cold: list[DataFrame] = field(default_factory=list)
    #: Keys of sequences of which the tree lacks nothing.
    common: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))


def train(docs: DataFrame) -> SuffixModel:
    """Learn from all texts of ``docs``; null texts are empty, and each text ends with an end token.

    Every context, and every word after it, that occurs ``LEAST_COUNT`` times is learnt, so the model grows with the
    corpus: its contexts and events are tables. The most frequent ones, by share and so bounded in number, make up a tree that is
    built on the driver and broadcast. The vocabulary is a table too.
    """
    vocabulary = stored(word_counts(docs), "lm-vocabulary")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    smooth = total + 0.5 * (distinct + 1)
    frequent = vocabulary.filter(F.col("n") >= LEAST_EVENT * total).toPandas()
    hashes = frequent["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    words, counts = hashes[order], frequent["n"].to_numpy(np.float64)[order]
    tree = Tree(words, np.log10((counts + 0.5) / smooth))
    shorter = vocabulary.filter(F.col("n") >= LEAST_COUNT).select("key", ((F.col("n") + 0.5) / F.lit(smooth)).alias("p"), F.col("n").alias("m"))
    shorter = packed = stored(_packed(shorter, total), "lm-words")
    tables, hot = [], []
    common = [words[counts >= LEAST_CONTEXT * total]]
    for size in range(2, DEPTH + 2):
        turns = TURNS if size > 2 else 1
        found = [gram_counts(docs, size, total, turn, turns) for turn in range(turns)]
        tables.append(_events(found, shorter, total))
        discard(*found)
        if size > 2:
            _drop(tables[-2], _EVENT)
        shorter = _of_kind(tables[-1], _EVENT)
        rows = [(None, *r) for r in tables[-1].filter(F.col("kind") == _HOT).select("a", "b", "c", "d", "e", "f").collect()]
        hot.append(dict(zip(("key", "ctx", "suf", "p", "lb", "m"), _together(rows, np.uint64, np.uint64, np.uint64, np.float64, np.float64, np.int64), strict=True)))
        common.append(hot[-1]["key"][hot[-1]["m"] >= (LEAST_CONTEXT * total if size <= DEPTH else 0)])
    _drop(tables[-1], _EVENT)
    discard(packed)
    cold = [_of_kind(tables[0], _WEIGHT)]
    for k, table in enumerate(tables):
        own = _of_kind(table, _VALUE)
        cold.append(own.union(_of_kind(tables[k + 1], _WEIGHT)) if k + 1 < len(tables) else own)
    _grow(tree, hot)
    return SuffixModel(tree, vocabulary, int(total), int(distinct), cold, np.concatenate(common))


def _drop(table: DataFrame, kind: int) -> None:
    """Delete the rows of a kind, which nothing reads any more, of a table stored by kind."""
    files = [f for f in table.inputFiles() if f"/kind={kind}/" in f]
    if files:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def _grow(tree: Tree, hot: list[dict[str, np.ndarray]]) -> None:
    """Give a tree of single tokens the frequent events of each size, and contexts that diverge or are the suffix of one that does.

    A node is numbered after those of shorter contexts. The parent of a context lacks its first, oldest, word.
    """
    number = np.arange(len(tree.words))
    # Keys of each size, the numbers of their first and last words, and the place of each without its first word.
    sizes = [(tree.words, number, number, number)]
    for frame in hot:
        order = np.argsort(frame["key"])
        frame.update({n: x[order] for n, x in frame.items()})
        ctx, suf = (np.searchsorted(sizes[-1][0], frame[n]) for n in ("ctx", "suf"))
        sizes.append((frame["key"], sizes[-1][1][ctx], sizes[-1][2][suf], suf))
        frame["keep"], frame["at"] = ~np.isnan(frame["lb"]), ctx
    kept = [np.zeros(len(s[0]), bool) for s in sizes[:-1]]
    for k in range(len(hot) - 1, -1, -1):
        kept[k][hot[k]["at"][hot[k]["keep"]]] = True
        if k:
            kept[k - 1][sizes[k][3][kept[k]]] = True
    nodes, parents, firsts, backoff, keys, logs, count = [], [np.zeros(1, np.int64)], [], [np.zeros(1)], [], [], 1
    for k, (own, frame) in enumerate(zip(kept, hot, strict=True)):
        place = np.flatnonzero(own)
        nodes.append(np.full(len(own), -1, np.int64))
        nodes[k][place] = count + np.arange(len(place))
        count += len(place)
        parents.append(nodes[k - 1][sizes[k][3][place]] if k else np.zeros(len(place), np.int64))
        firsts.append(sizes[k][1][place])
        keep, weights = frame["keep"], np.zeros(len(own))
        weights[frame["at"][keep]] = frame["lb"][keep]
        backoff.append(weights[place])
        keys.append((nodes[k][frame["at"][keep]] << 32) + sizes[k + 1][2][keep])
        logs.append(np.log10(frame["p"][keep]))
    tree.parents, tree.backoff_log = np.concatenate(parents), np.concatenate(backoff)
    children = (tree.parents[1:] << 32) + np.concatenate(firsts)
    order = np.argsort(children)
    tree.child_keys, tree.child_nodes = children[order], np.arange(1, count)[order]
    keys, logs = np.concatenate(keys), np.concatenate(logs)
    order = np.argsort(keys)
    tree.event_keys, tree.event_log = keys[order], logs[order]


_SCORED = ["n_tokens", "n_known", "base_score", "score", "open_words", "open_counts", "key"]


def _judged(tree: Tree, texts: list[str]) -> pa.StructArray:
    """What is known of each of ``texts`` without the whole vocabulary: columns ``_SCORED``."""
    hashes, ends = _tokens(texts)
    begins = np.concatenate(([0], ends[:-1]))
    numbers = tree.numbers(hashes)
    found, open_ = tree.log_scores(numbers)
    frequent = numbers >= 0
    base = np.where(frequent, tree.word_log[numbers] if len(tree.word_log) else 0.0, 0.0)
    # A token that is not stored never ends at an event, so open words are exactly the others.
    text = np.repeat(np.arange(len(texts)), ends - begins)[open_]
    words = hashes[open_].view(np.int64)
    order = np.lexsort((words, text))
    text, words = text[order], words[order]
    first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (words[1:] != words[:-1])))[: len(words)])
    counts = np.diff(np.append(first, len(words)))
    offsets = pa.array(np.searchsorted(text[first], np.arange(len(texts) + 1)), pa.int32())
    arrays = [
        pa.array(ends - begins), pa.array(np.add.reduceat(frequent, begins, dtype=np.int64)),
        pa.array(np.add.reduceat(base, begins)), pa.array(np.add.reduceat(found, begins)),
        pa.ListArray.from_arrays(offsets, pa.array(words[first])), pa.ListArray.from_arrays(offsets, pa.array(counts)),
        pa.array(run_hashes(hashes, begins, ends).view(np.int64)),
    ]
    return pa.StructArray.from_arrays(arrays, _SCORED)


def cold_scores(docs: DataFrame, model: SuffixModel) -> DataFrame:
    """Rows (key, cold): what the tree lacks of the score of each distinct text, by the hash of its tokens.

    The probability of a word after its longest known context is that of the single word times a factor for each sequence, of the
    words up to it, that is an event, and each that is a context; so a score is a sum over sequences, and those that
    are not in the tree are looked up where their bucket is, size by size, and added up by text.
    """
    spark = docs.sparkSession
    bits = _buckets(model.train_tokens, ASKED_TOKENS)
    shared = spark.sparkContext.broadcast(model.common)

    def asking(sizes: tuple[int, ...]):  # noqa: ANN202
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common, place = _Table(shared.value, 0, np.ones(len(shared.value), np.int8)), TaskContext.get().partitionId() << 40
            parts, names, held = [], [], 0

            def asked() -> pa.RecordBatch:
                keys, text = (np.concatenate(x) for x in zip(*parts, strict=True))
                name = np.concatenate(names)
                rows = [(place // 977 % (1 << bits), _EVENT, np.arange(place, place + len(name)).tobytes(), name.tobytes())]
                order, runs = _dealt(keys, bits)
                keys, text = keys[order], text[order]
                for bucket, a, b in runs:
                    first = np.flatnonzero(np.concatenate(([True], text[a + 1 : b] != text[a : b - 1])))
                    rows.append((bucket, _ASKING, keys[a:b].tobytes(), (place + text[a + first]).tobytes(), first.tobytes()))
                return _batch(rows)

            for texts in _runs(t for batch in batches for t in texts_of(batch.column("text"))):
                hashes, ends = _tokens(texts)
                before = sum(map(len, names))
                for size in sizes:
                    ctx, suf, at = _grams(hashes, size)
                    keys = hashes if size == 1 else _after(ctx, suf)
                    rare = np.flatnonzero(common.values[0].take(common.places(keys)) == 0)
                    keys = keys[rare]
                    parts.append((keys, before + np.searchsorted(ends, at[rare], "right")))
                    held += len(keys)
                names.append(run_hashes(hashes, np.concatenate(([0], ends[:-1])), ends).view(np.int64))
                if held >= GATHERED_GRAMS:
                    yield asked()
                    place += before + len(texts)
                    parts, names, held = [], [], 0
            if held:
                yield asked()

        return ask

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_bucket(batches):
            lots, table = [], None
            for row in rows:
                if row[0] == _TABLE:
                    lots.append(row)
                    continue
                place, name = np.frombuffer(row[2 if row[0] == _ASKING else 1], np.int64), None
                if row[0] == _EVENT:  # the names of texts
                    value, name = np.zeros(len(place)), pa.array(np.frombuffer(row[2], np.int64))
                else:
                    table = table or _Table(*_together(lots, np.uint64)[:1], bits, _together(lots, np.uint64, np.float64)[1])
                    value = np.add.reduceat(table.values[0].take(table.places(np.frombuffer(row[1], np.uint64))), np.frombuffer(row[3], np.int64))
                    place, value = place[value != 0], value[value != 0]
                    name = pa.nulls(len(place), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(place), name, pa.array(value)], ["place", "key", "cold"])

    found = []
    for sizes in ((1, 2), *((k,) for k in range(3, DEPTH + 2))):
        tables = [t for t in (model.cold[k - 1] for k in sizes) if not t.isEmpty()]
        if not tables:
            continue
        answers = _meet(*tables, docs.select("text").mapInArrow(asking(sizes), _MANY)).mapInArrow(answer, "place bigint, key bigint, cold double")
        answers = answers.groupBy("place").agg(F.max("key").alias("key"), F.sum("cold").alias("cold"))
        # Rows of the same text have the same sum.
        with _few_rows(spark):
            found.append(stored(answers.groupBy("key").agg(F.min("cold").alias("cold")), "lm-answers"))
    if not found:
        return spark.createDataFrame([], "key bigint, cold double")
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every.groupBy("key").agg(F.sum("cold").alias("cold"))


def score(docs: DataFrame, model: SuffixModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with n_tokens, n_known, base_score and score of each text.

    Contexts and events that are not in the tree are looked up in their tables, see ``cold_scores``.
    Words below the floor are looked up in the vocabulary by a join: a task sends the distinct open
    words of each document with their counts. Null and empty texts are one end token. Rows are scored
    each by itself, so repeated rows and ties do not matter; an empty table gives an empty table.
    Input columns of the same names as the added ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.tree)

    @F.arrow_udf("n_tokens bigint, n_known bigint, base_score double, score double, open_words array<bigint>, open_counts array<bigint>, key bigint")
    def judge(column: pa.Array) -> pa.Array:
        # An empty column has no runs; one empty text gives the type of what is then cut off.
        judged = [_judged(shared.value, texts) for texts in _runs(texts_of(column))]
        return pa.concat_arrays(judged) if judged else _judged(shared.value, [""]).slice(1)

    cold = stored(cold_scores(docs, model), "lm-cold-scores")
    kept = [F.col(f"`{c}`") for c in keep if c not in ("n_tokens", "n_known", "base_score", "score")]
    own = F.struct(*kept, F.lit(None).cast("string").alias("_none")).alias("_own")
    first = docs.select(own, judge("text").alias("_j"), F.monotonically_increasing_id().alias("_row"))
    first = stored(first, "lm-first")
    open_ = first.select("_row", F.explode(F.arrays_zip("_j.open_words", "_j.open_counts")).alias("_o"))
    open_ = open_.select("_row", F.col("_o.open_words").alias("key"), F.col("_o.open_counts").alias("_times"))
    joined = open_.join(model.vocabulary, "key", "left")
    smooth = model.train_tokens + 0.5 * (model.distinct + 1)
    log = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(smooth))
    rare = joined.groupBy("_row").agg(
        F.sum(F.col("_times") * log).alias("_log"), F.sum(F.when(F.col("n") > 0, F.col("_times")).otherwise(0)).alias("_known")
    )
    whole = first.join(rare, "_row", "left").join(cold.select(F.col("key").alias("_key"), F.col("cold").alias("_cold")), F.col("_j.key") == F.col("_key"), "left")
    none = F.lit(0)
    return whole.select(
        *[F.col(f"_own.`{c}`") for c in keep if c not in ("n_tokens", "n_known", "base_score", "score")],
        F.col("_j.n_tokens").alias("n_tokens"),
        (F.col("_j.n_known") + F.coalesce("_known", none)).alias("n_known"),
        (F.col("_j.base_score") + F.coalesce("_log", none)).alias("base_score"),
        (F.col("_j.score") + F.coalesce("_log", none) + F.coalesce("_cold", none)).alias("score"),
    )
