"""Multi-index hashing: exact nearest neighbours of long bit hashes without comparing all pairs.

A hash is cut into substrings, and every item stands in one bucket per substring. Two hashes within distance D
agree nearly in some substring, so a query looks up only buckets near its own substrings. The buckets nearest
to a query give a first distance D of its k-th neighbour; the buckets within the radius that D implies then
hold every item as near. Which buckets exist, and how many items each holds, is a table of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislewatch.session import cut_lineage

#: Bits of a substring: about the logarithm of the number of items, and not more than keeps the table of
#: buckets (substrings times 2**width entries at most) small enough to be sent to every task.
LEAST_WIDTH, MOST_WIDTH = 8, 16
#: Items that the first look at the nearest buckets should meet, and of one bucket at most, in multiples of k.
FIRST_ITEMS = 8
#: Differing bits up to which the values about a query's own are looked up one by one.
_LOOKED_UP = 3
#: A query's buckets are gone through if they hold this share of all items at most: to mark an item of a bucket takes longer than to
#: compare an item where all are compared.
MET_SHARE = 0.1
#: Rows of a piece of either side that meet in one task: at most, and at least unless there is but one piece.
PIECE_ROWS, LEAST_ROWS, MOST_SMALL = 65_536, 2_048, 8
#: Rows by which ``share_met`` judges whether buckets rule anything out.
SAMPLE_ROWS, SAMPLE_QUERIES = 20_000, 64


def _words(column: pa.Array, words: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), words)


def substrings(words: np.ndarray, width: int) -> np.ndarray:
    """Values of the consecutive substrings of ``width`` bits of each hash; the last one may be shorter."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little")
    parts = math.ceil(bits.shape[1] / width)
    padded = np.zeros((len(bits), parts * width), np.int32)
    padded[:, : bits.shape[1]] = bits
    return padded.reshape(len(bits), parts, width) @ (1 << np.arange(width, dtype=np.int32))


class Buckets:
    """The existing buckets: substring number, value, and number of items, in that order."""

    def __init__(self, rows: list[tuple[int, int, int]], parts: int):
        rows = sorted(rows)
        self.part = np.array([r[0] for r in rows], np.int32)
        self.value = np.array([r[1] for r in rows], np.int32)
        self.items = np.array([r[2] for r in rows], np.int64)
        self.parts = parts
        self._near: list[np.ndarray] | None = None
        ends = np.searchsorted(self.part, np.arange(parts + 1))
        self.runs = [slice(int(start), int(end)) for start, end in zip(ends[:-1], ends[1:], strict=True)]

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Differing bits of a query's substrings and each bucket's value."""
        return np.concatenate([np.bitwise_count(self.value[run] ^ own[n]) for n, run in enumerate(self.runs)])

    @cached_property
    def _width(self) -> int:
        return max(1, int(self.value.max(initial=0)).bit_length())

    @cached_property
    def _numbers(self) -> np.ndarray:
        """The number of each substring's bucket of each value, -1 where there is none."""
        out = np.full((self.parts, 1 << self._width), -1, np.int32)
        out[self.part, self.value] = np.arange(len(self.part))
        return out

    @cached_property
    def _masks(self) -> list[np.ndarray]:
        """What makes of a value all values that differ from it in 0, 1, 2 ... bits."""
        masks = np.arange(1 << self._width, dtype=np.int32)
        ones = np.bitwise_count(masks)
        return [masks[ones == k] for k in range(self._width + 1)]

    def held(self, own: np.ndarray, distances: np.ndarray) -> np.ndarray:
        """``met`` of many queries, their substrings in rows."""
        if self._near is None:
            # Of each substring, the items in buckets that differ from a value in so many bits at most: bit by bit.
            self._near = []
            for run in self.runs:
                near = np.zeros((self._width + 1, 1 << self._width), np.int64)
                near[0, self.value[run]] = self.items[run]
                for bit in range(self._width):
                    pairs = near.reshape(len(near), -1, 2, 1 << bit)
                    near = near.copy()
                    near[1:] += pairs[:-1, :, ::-1].reshape(len(near) - 1, -1)
                self._near.append(np.cumsum(near, axis=0).astype(np.int64 if self.items.sum() >> 31 else np.int32))
        a, b = np.divmod(np.asarray(distances, np.int64), self.parts)
        total = np.zeros(len(own), np.int64)
        for n, near in enumerate(self._near):
            limit = np.where(n <= b, a, a - 1)
            outside = own[:, n] >> self._width
            # Bits that no bucket has are differences to all of them.
            limit, inside = limit - np.bitwise_count(outside), own[:, n] & ((1 << self._width) - 1)
            total += np.where(limit >= 0, near[np.clip(limit, 0, self._width), inside], 0)
        return total

    def nearest(self, own: np.ndarray, wanted: int) -> np.ndarray:
        """Numbers of the nearest buckets that together hold ``wanted`` items."""
        chosen, held, every = [], 0, np.arange(self.parts)[:, None]
        if (own >> self._width).any():  # bits that no bucket has
            return self._nearest_of_all(own, wanted, 0, chosen, held)
        # Where buckets lie close, few values about the query's own are enough; else all buckets are looked at.
        for distance, masks in enumerate(self._masks[: _LOOKED_UP + 1]):
            level = self._numbers[every, own[:, None] ^ masks]
            level = np.sort(level[level >= 0])
            sums = held + np.cumsum(self.items[level])
            chosen.append(level[: int(np.searchsorted(sums, wanted)) + 1])
            held = int(sums[-1]) if len(sums) else held
            if held >= wanted:
                return np.concatenate(chosen)
        return self._nearest_of_all(own, wanted, distance + 1, chosen, held)

    def _nearest_of_all(self, own: np.ndarray, wanted: int, least: int, chosen: list[np.ndarray], held: int) -> np.ndarray:
        far = self.distances(own)
        for distance in range(least, int(far.max(initial=0)) + 1):
            level = np.flatnonzero(far == distance)
            sums = held + np.cumsum(self.items[level])
            chosen.append(level[: int(np.searchsorted(sums, wanted)) + 1])
            held = int(sums[-1]) if len(sums) else held
            if held >= wanted:
                break
        return np.concatenate(chosen) if chosen else np.empty(0, np.int64)

    def met(self, own: np.ndarray, distance: int) -> int:
        """Items in the buckets of ``within``, those that stand in several counted as often."""
        a, b = divmod(distance, self.parts)
        limits = [a if n <= b else a - 1 for n in range(self.parts)]
        near = [np.bitwise_count(self.value[run] ^ own[n]) <= limits[n] for n, run in enumerate(self.runs)]
        return int(sum(np.dot(self.items[run], hit) for run, hit in zip(self.runs, near, strict=True)))

    def within(self, own: np.ndarray, distance: int) -> np.ndarray:
        """Numbers of the buckets of which one holds any item within ``distance``.

        Items that differed by more than a in each of the first b + 1 substrings and by more than a - 1 in the
        others, where distance = a * parts + b, would differ in more than ``distance`` bits.
        """
        a, b = divmod(distance, self.parts)
        return np.flatnonzero(self.distances(own) <= np.where(self.part <= b, a, a - 1))


def _explode(items: DataFrame, words: int, width: int, name: str) -> DataFrame:
    """Add the substrings as an array column."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = substrings(_words(batch["_v"], words), width) if batch.num_rows else np.empty((0, 1), np.int32)
            parts = pa.array(list(own.astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, parts], names=[*batch.schema.names, name])

    fields = ", ".join(f"`{n}` {t}" for n, t in items.dtypes)
    return items.mapInArrow(cut, f"{fields}, {name} array<int>")


def _distance(a: Column, b: Column, words: int) -> Column:
    total = None
    for n in range(words):
        bits = F.bit_count(a[n].bitwiseXOR(b[n]))
        total = bits if total is None else total + bits
    return total


def _width(count: int) -> int:
    return max(LEAST_WIDTH, min(MOST_WIDTH, math.ceil(math.log2(max(2, count)))))


class Block:
    """Some items with their own buckets: the columns of their words, and per substring its values and their items."""

    def __init__(self, words: np.ndarray, width: int):
        self.columns = np.ascontiguousarray(words.view(np.uint64).T)
        self.width, self.buckets, self.room = width, [], None
        for own in substrings(words, width).T:
            order = np.argsort(own, kind="stable")
            values, starts = np.unique(own[order], return_index=True)
            self.buckets.append((values, order, np.diff(starts, append=len(own))))

    def distances(self, own: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Differing bits of a hash (its words) and all items, or those of the given numbers."""
        if rows is not None:
            total = np.zeros(len(rows), np.uint16)
            for column, word in zip(self.columns, own.view(np.uint64), strict=True):
                total += np.bitwise_count(column[rows] ^ word)
            return total
        # Room that is used again for each query, and counts of single bytes as long as they hold the sum.
        if self.room is None:
            count = self.columns.shape[1]
            self.room = np.empty(count, np.uint64), np.empty(count, np.uint8), np.empty(count, np.uint8), np.empty(count, np.uint16)
        differs, ones, small, total = self.room
        total[:] = 0
        for n, (column, word) in enumerate(zip(self.columns, own.view(np.uint64), strict=True)):
            np.bitwise_xor(column, word, out=differs)
            if n % 3 == 0:
                np.bitwise_count(differs, out=small)
            else:
                np.bitwise_count(differs, out=ones)
                small += ones
            if n % 3 == 2 or n == len(self.columns) - 1:
                total += small
        return total

    def within(self, parts: np.ndarray, distance: int) -> np.ndarray:
        """Numbers of the items in the buckets of which one holds any item within ``distance``; see ``Buckets.within``."""
        a, b = divmod(distance, len(self.buckets))
        marked = np.zeros(self.columns.shape[1], bool)
        for n, (values, order, sizes) in enumerate(self.buckets):
            hit = np.bitwise_count(values ^ parts[n]) <= (a if n <= b else a - 1)
            marked[order[np.repeat(hit, sizes)]] = True
        return np.flatnonzero(marked)

    def nearest(self, own: np.ndarray, parts: np.ndarray | None, distance: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and distances of the k nearest items within ``distance``, ties by number; with ``parts``, a query's
        substrings, through the buckets."""
        rows = None if parts is None else self.within(parts, distance)
        total = self.distances(own, rows)
        near = np.flatnonzero(total <= distance)
        if len(near) > k:
            near = near[total[near] <= np.partition(total[near], k - 1)[k - 1]]
        near = near[np.argsort(total[near], kind="stable")[:k]]
        return (near if rows is None else rows[near]), total[near]


def share_met(queries: DataFrame, items: DataFrame, k: int) -> float:
    """Items that a query's buckets would meet, repeats counted, over all items: on average over a few queries by hash
    and a bounded sample of the items."""
    count, first = items.count(), items.select(F.size("_v").alias("n")).first()
    if not first:
        return 0.0
    take = lambda df, name, rows: _words(
        df.orderBy(F.xxhash64(name), name).limit(rows).select(F.col("_v").cast("array<bigint>").alias("_v")).toArrow()["_v"], first["n"]
    )
    sample, asked = take(items, "_item", SAMPLE_ROWS), take(queries, "_query", SAMPLE_QUERIES)
    if not len(asked):
        return 0.0
    width = _width(count)
    block, own = Block(sample, width), substrings(sample, width)
    met = 0
    for words, parts in zip(asked, substrings(asked, width), strict=True):
        total = block.distances(words, None)
        far = int(np.partition(total, k - 1)[k - 1]) if len(total) >= k else 64 * first["n"]
        a, b = divmod(far, own.shape[1])
        met += int((np.bitwise_count(own ^ parts) <= np.where(np.arange(own.shape[1]) <= b, a, a - 1)).sum())
    return met / (len(asked) * len(sample))


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_query").orderBy("_distance", "_item")
    return found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).drop("_r")


def nearest_hashes(queries: DataFrame, items: DataFrame, k: int, scan=None, scan_share: float | None = 1.0) -> DataFrame:
    """(_query, _item, _distance): the ``k`` nearest items by differing bits, ties by item; exact.

    Both sides hold distinct rows (_query or _item, _v), hashes being arrays of as many 64-bit words. Where a query's
    buckets would meet more than ``scan_share`` of all items, ``scan(queries, items)`` compares it with all of them
    in blocks, which is cheaper; with None every query goes through its buckets, but for those whose buckets hold more
    than ``MET_SHARE`` of the items, which are compared with all of them block by block.

    The first look joins a query with few buckets. The second brings chunks of queries and blocks of items together by
    key; a block has its buckets in the task that it comes to, so no list of buckets is written, and at most k rows of a
    query leave a block.
    """
    items, queries = cut_lineage(items), cut_lineage(queries)
    count, first = items.count(), items.select(F.size("_v").alias("n")).first()
    kinds = (dict(queries.dtypes)["_query"], dict(items.dtypes)["_item"])
    if not first:
        return queries.sparkSession.createDataFrame([], f"_query {kinds[0]}, _item {kinds[1]}, _distance int")
    words = first["n"]
    width = _width(count)
    parts = math.ceil(64 * words / width)
    keyed = cut_lineage(_explode(items, words, width, "_parts").select("_item", "_v", F.posexplode("_parts").alias("_part", "_value")))
    # At most parts * 2**width rows, whatever the number of items.
    rows = keyed.groupBy("_part", "_value").agg(F.count("*").alias("n")).collect()
    table = queries.sparkSession.sparkContext.broadcast(Buckets([tuple(r) for r in rows], parts))
    limit = None if scan is None or scan_share is None else scan_share * count

    def first_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = table.value
        for batch in batches:
            own = substrings(_words(batch["_v"], words), width) if batch.num_rows else []
            hits = [buckets.nearest(mine, FIRST_ITEMS * k) for mine in own]
            hit = np.concatenate(hits) if hits else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, hits)]).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(buckets.part[hit]), pa.array(buckets.value[hit])], names=["_part", "_value"]),
            )
            yield pa.RecordBatch.from_arrays([batch["_query"], batch["_v"], lists], names=["_query", "_v", "_keys"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Add the number of items in the buckets to visit, those that stand in several counted as often."""
        buckets = table.value
        for batch in batches:
            own = substrings(_words(batch["_v"], words), width) if batch.num_rows else []
            far = batch["_far"].to_numpy()
            # The table that answers many queries at once takes as long as some hundred of them alone.
            met = buckets.held(own, far) if batch.num_rows >= 256 else [buckets.met(m, int(f)) for m, f in zip(own, far, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(met, pa.int64())], names=[*batch.schema.names, "_met"])

    def near(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("_item", kind="stable", ignore_index=True)
        block = Block(np.stack(b["_v"].to_list()).astype(np.int64), width) if len(a) and len(b) else None
        out = [pd.DataFrame(columns=["_query", "_item", "_distance"])]
        if block is not None:
            own = np.stack(a["_v"].to_list()).astype(np.int64)
            parts = substrings(own, width)
            few = (a["_met"] <= MET_SHARE * count).to_numpy()
            hits = [block.nearest(own[n], parts[n] if few[n] else None, int(m), k) for n, m in enumerate(a["_far"])]
            at = np.repeat(np.arange(len(a)), [len(h[0]) for h in hits])
            rows, far = (np.concatenate([h[n] for h in hits]) for n in (0, 1))
            out = [pd.DataFrame({"_query": a["_query"].to_numpy()[at], "_item": b["_item"].to_numpy()[rows], "_distance": far.astype(np.int32)})]
        return out[0]

    def meet_blocks(asked: DataFrame) -> DataFrame:
        pieces = lambda rows: max(1, min(MOST_SMALL, math.ceil(rows / LEAST_ROWS)), math.ceil(rows / PIECE_ROWS))
        chunks, blocks = pieces(asked.count()), pieces(count)
        part = lambda name, number: F.pmod(F.xxhash64(name), F.lit(number)).cast("int")
        every = lambda number: F.explode(F.sequence(F.lit(0), F.lit(number - 1)))
        left = asked.select("_query", "_v", "_far", "_met", part("_query", chunks).alias("_chunk"), every(blocks).alias("_block"))
        right = items.select("_item", F.col("_v").cast("array<bigint>").alias("_v"), part("_item", blocks).alias("_block"), every(chunks).alias("_chunk"))
        key = ["_chunk", "_block"]
        schema = f"_query {kinds[0]}, _item {kinds[1]}, _distance int"
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(near, schema)

    queries = queries.select("_query", F.col("_v").cast("array<bigint>").alias("_v"))
    keys = queries.mapInArrow(first_buckets, f"_query {kinds[0]}, _v array<bigint>, _keys array<struct<_part:int,_value:int>>")
    left = keys.select("_query", F.col("_v").alias("_q"), F.inline("_keys"))
    # They give a first distance only, for which so many items of a bucket are enough however many it holds. Items with a
    # word that is null have no distance and come first among those met; with any of them, all items are met.
    few = keyed
    if items.filter(F.exists("_v", lambda word: word.isNull())).isEmpty():
        some = Window.partitionBy("_part", "_value").orderBy(F.xxhash64("_item"), "_item")
        few = keyed.withColumn("_r", F.row_number().over(some)).filter(F.col("_r") <= FIRST_ITEMS * k).drop("_r")
    pairs = left.join(few, ["_part", "_value"]).select("_query", "_item", _distance(F.col("_q"), F.col("_v"), words).alias("_distance"))
    # An item may stand in several of a query's buckets.
    begun = _top(pairs.distinct(), k)
    known = begun.groupBy("_query").agg(F.max("_distance").alias("_far"), F.count("*").alias("_n"))
    far = F.when(F.col("_n") >= k, F.col("_far")).otherwise(F.lit(64 * words))
    asked = queries.join(known.select("_query", far.alias("_far")), "_query", "left")
    asked = asked.withColumn("_far", F.coalesce("_far", F.lit(64 * words)).cast("int"))
    chosen = cut_lineage(asked.mapInArrow(measure, f"_query {kinds[0]}, _v array<bigint>, _far int, _met bigint"))
    if limit is None:
        found = meet_blocks(chosen)
    else:
        much = F.col("_met") > limit
        found = meet_blocks(chosen.filter(~much)).unionByName(scan(chosen.filter(much).select("_query", "_v"), items))
    return _top(found, k)
