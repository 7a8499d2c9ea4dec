"""N-gram Jaccard join: Voronoi regions of pivots, triangle-inequality windows, exact.

Unrelated texts are all at distance 1 of each other, so pivots cannot divide a corpus. Texts that
could be near each other are first brought together exactly (``part_keys``); within such a family
distances differ, and pivots, regions and windows do the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aislewatch.llm.shared import components, mix, rows_of, shingle_hashes, stored, word_hashes


@dataclass(frozen=True)
class Nearness:
    """Documents link when ``percent`` of the union of their ``width``-word shingles is shared."""

    width: int = 5
    percent: int = 80

    @property
    def reach(self) -> float:
        """The greatest Jaccard distance of a link, with some slack for rounding."""
        return 1 - self.percent / 100 + 1e-9


#: Sizes of sets fall into bands, each so many times as wide as the one before.
BAND_RATIO = 1.5
#: Shingles that one task joins at once; larger families are divided.
REGION_SHINGLES = 1_000_000
PIVOTS = 16
MOST_LEVELS = 4


def band_floor(band: np.ndarray | int) -> np.ndarray:
    return np.ceil(BAND_RATIO ** np.asarray(band, np.float64) - 1e-9)


def band_of(size: int) -> int:
    band = int(np.log(size) / np.log(BAND_RATIO))
    while band_floor(band + 1) <= size:
        band += 1
    while band_floor(band) > size:
        band -= 1
    return band


def part_keys(shingles: np.ndarray, near: Nearness) -> np.ndarray:
    """Keys of which two linked sets share at least one.

    The smaller of two linked sets, of size a, lies in a band; with threshold t at most
    d = floor(a * (1 - t) / t) shingles belong to one set only. Hash values are cut into m = d + 1 + s
    equal ranges, d taken for the largest a of the band. So at least s + 1 ranges hold the same
    shingles in both sets, and the one of them with most shingles is not among the s poorest ranges
    of either. Each set gives a key, of band, range and content, for all but its s poorest ranges: in
    its own band, and in every lower one in which a linked set may lie.
    """
    n = len(shingles)
    own = band_of(n)
    keys = []
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)))
    lowest = -(-n * near.percent // 100)
    least = own
    while least > 0 and band_floor(least) > lowest:
        least -= 1
    for band in range(own, least - 1, -1):
        most = int(band_floor(band + 1)) - 1
        spared = most * (100 - near.percent) // near.percent
        slack = spared // 4
        parts = spared + 1 + slack
        edges = np.arange(1, parts, dtype=np.uint64) * np.uint64((2**64 - 1) // parts)
        cuts = np.concatenate(([0], np.searchsorted(shingles, edges, "left"), [n]))
        counts = np.diff(cuts)
        content = sums[cuts[1:]] - sums[cuts[:-1]]
        place = np.arange(parts, dtype=np.uint64)
        if slack:
            kept = np.sort(np.lexsort((place, counts))[slack:])
        else:
            kept = np.arange(parts)
        seed = np.uint64(mix(np.array([band + 1], np.uint64))[0])
        keys.append(mix(mix(content[kept] + seed) + place[kept]))
    return np.concatenate(keys)


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit identity of a set, signed."""
    return int(mix(np.array([mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))]))[0].view(np.int64))


def _sets(batches: Iterator[pa.RecordBatch], near: Nearness, *names: str) -> Iterator[tuple]:
    for row in rows_of(batches):
        shingles = shingle_hashes(word_hashes(row["text"]), near.width)
        yield tuple(row[n] for n in names), shingles


def measure_sets(docs: DataFrame, near: Nearness) -> DataFrame:
    """Rows (doc_id, n_shingles, set): the size and identity of each document's set, null if empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, len(s), set_id(s) if len(s) else None) for (i,), s in _sets(iter([batch]), near, "doc_id")]
            ids, sizes, sets = zip(*found, strict=True) if found else ((), (), ())
            arrays = [pa.array(ids, batch.schema.field("doc_id").type), pa.array(sizes, pa.int64()), pa.array(sets, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "set"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_shingles bigint, set bigint")


#: Sets that a task remembers in order to give the keys of equal texts once.
_REMEMBERED_SETS = 1_000_000


def set_keys(docs: DataFrame, near: Nearness) -> DataFrame:
    """Rows (key, set) of every distinct set; copies within a task give theirs once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        of: list[int] = []
        size = 0

        def batch_of() -> pa.RecordBatch:
            keys = np.concatenate(held) if held else np.empty(0, np.uint64)
            sets = np.repeat(np.array(of, np.int64), [len(k) for k in held])
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(sets)], ["key", "set"])

        for _, shingles in _sets(batches, near):
            if not len(shingles):
                continue
            name = set_id(shingles)
            if name in seen:
                continue
            if len(seen) >= _REMEMBERED_SETS:
                seen.clear()
            seen.add(name)
            held.append(part_keys(shingles, near))
            of.append(name)
            size += len(held[-1])
            if size > 100_000:
                yield batch_of()
                held, of, size = [], [], 0
        yield batch_of()

    return docs.select("text").mapInArrow(run, "key bigint, set bigint")


def families(docs: DataFrame, near: Nearness) -> DataFrame:
    """Rows (node, root): sets that share keys, directly or over others, have the same root."""
    first = F.min("set").over(Window.partitionBy("key"))
    shared = set_keys(docs, near).select("set", first.alias("first")).filter("set != first").distinct()
    return components(shared.select(F.col("first").alias("a"), F.col("set").alias("b")), "jaccard-family")


def set_holders(measured: DataFrame) -> DataFrame:
    """Rows (set, least, holders): each set's smallest doc_id, and its number of documents."""
    null_ids = F.sum(F.col("doc_id").isNull().cast("bigint"))
    held = measured.filter("set is not null").groupBy("set")
    return held.agg(F.min("doc_id").alias("least"), (F.count_distinct("doc_id") + null_ids).alias("holders"))


def family_sets(docs: DataFrame, holders: DataFrame, family: DataFrame, near: Nearness) -> DataFrame:
    """Rows (region, node, n, shingles, holders, avoid): every set of a family once, its hashes as bytes."""
    wanted = family.join(holders.withColumnRenamed("set", "node"), "node")
    wanted = wanted.select(F.col("least").alias("_d"), "node", F.col("root").alias("region"), "holders")
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("_d")).select("region", "node", "holders", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Rows that share a doc_id may hold other sets: only the one asked for is taken.
            found = [
                (r, s, len(h), h.tobytes(), w, [])
                for (r, s, w), h in _sets(iter([batch]), near, "region", "node", "holders")
                if len(h) and set_id(h) == s
            ]
            columns = list(zip(*found, strict=True)) if found else [()] * len(_SETS)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _SETS)

    return texts.mapInArrow(run, _SETS_TYPE)


#: ``avoid`` names the places where a set also is: two sets that avoid the same place are counted there, not here.
_SETS = ["region", "node", "n", "shingles", "holders", "avoid"]
_SETS_TYPE = "region bigint, node bigint, n bigint, shingles binary, holders bigint, avoid array<bigint>"


def nameless_sets(docs: DataFrame, holders: DataFrame, family: DataFrame, near: Nearness) -> DataFrame:
    """The rows of ``family_sets`` for sets that only rows without a doc_id hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(set_id(h), len(h), h.tobytes()) for _, h in _sets(iter([batch]), near) if len(h)]
            nodes, sizes, data = zip(*found, strict=True) if found else ((), (), ())
            arrays = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "n", "shingles"])

    own = docs.filter("doc_id is null").select("text").distinct().mapInArrow(run, "node bigint, n bigint, shingles binary")
    wanted = family.join(holders.filter("least is null").withColumnRenamed("set", "node"), "node")
    empty = F.array().cast("array<bigint>").alias("avoid")
    return own.join(wanted, "node").select(F.col("root").alias("region"), "node", "n", "shingles", "holders", empty)


class Region:
    """Sets that one task joins: their shingles side by side, as dense numbers."""

    def __init__(self, nodes: list[int], shingles: list[np.ndarray]):
        self.nodes = nodes
        self.sizes = np.array([len(s) for s in shingles], np.int64)
        self.begin = np.concatenate(([0], np.cumsum(self.sizes)))
        values, numbers = np.unique(np.concatenate(shingles), return_inverse=True)
        self.flat = numbers.astype(np.int32)
        self.flag = np.zeros(len(values), np.int8)

    def shared(self, x: int, others: np.ndarray) -> np.ndarray:
        """Shingles that set ``x`` shares with each of ``others``."""
        lengths = self.sizes[others]
        ends = np.cumsum(lengths)
        index = np.arange(ends[-1]) + np.repeat(self.begin[others] - (ends - lengths), lengths)
        own = self.flat[self.begin[x] : self.begin[x + 1]]
        self.flag[own] = 1
        held = np.add.reduceat(self.flag[self.flat[index]], ends - lengths, dtype=np.int64)
        self.flag[own] = 0
        return held


def region_links(nodes: list[int], shingles: list[np.ndarray], near: Nearness) -> list[tuple[int, int]]:
    """Links that connect exactly what all links of the region connect.

    A pivot's distance to every set still open is computed once. What it links is taken out and
    searched in turn, by comparing with those open sets only whose distance to the pivot differs by
    no more than a link's reach, and whose size allows a link. When nothing more is found, the next
    open set becomes pivot. Every pair of sets that is left out is too far apart or connected.
    """
    if len(nodes) < 2:
        return []
    region = Region(nodes, shingles)
    sizes, open_, links = region.sizes, np.argsort(region.sizes, kind="stable"), []
    while len(open_) > 1:
        pivot, open_ = int(open_[0]), open_[1:]
        held = region.shared(pivot, open_)
        union = sizes[pivot] + sizes[open_] - held
        distance = np.full(len(sizes), np.nan)
        distance[open_] = 1 - held / union
        distance[pivot] = 0.0
        linked = 100 * held >= near.percent * union
        queue = open_[linked].tolist()
        links += [(nodes[pivot], nodes[y]) for y in queue]
        open_ = open_[~linked]
        while queue and len(open_):
            x = queue.pop()
            a = sizes[x]
            within = np.abs(distance[open_] - distance[x]) <= near.reach
            within &= (100 * np.minimum(sizes[open_], a) >= near.percent * np.maximum(sizes[open_], a))
            others = open_[within]
            if not len(others):
                continue
            held = region.shared(x, others)
            found = others[100 * held >= near.percent * (a + sizes[others] - held)]
            if len(found):
                links += [(nodes[x], nodes[y]) for y in found.tolist()]
                queue += found.tolist()
                open_ = open_[~np.isin(open_, found)]
    return links


def region_degrees(
    nodes: list[int], shingles: list[np.ndarray], holders: list[int], avoid: list[list[int]], near: Nearness
) -> tuple[list[tuple[int, int]], list[int]]:
    """Links that connect what all links of the region connect, and for each set the holders of those it links with.

    Sets are compared whose sizes allow a link and whose distances to the smallest set differ by no more than a
    link's reach. No list of pairs is made: a link adds to two sums, and is kept only where it connects.
    """
    degree = np.zeros(len(nodes), np.int64)
    if len(nodes) < 2:
        return [], degree.tolist()
    region = Region(nodes, shingles)
    order, links = np.argsort(region.sizes, kind="stable"), []
    sizes, weight = region.sizes[order], np.array(holders, np.int64)[order]
    column = {place: k for k, place in enumerate(sorted({x for places in avoid for x in places}))}
    avoided = np.zeros((len(nodes), len(column)), bool)
    for row, k in enumerate(order.tolist()):
        avoided[row, [column[x] for x in avoid[k]]] = True
    held = region.shared(int(order[0]), order)
    distance = 1 - held / (sizes[0] + sizes - held)
    group = np.arange(len(order))
    sums = np.zeros(len(order), np.int64)
    for k in range(len(order) - 1):
        to = int(np.searchsorted(near.percent * sizes, 100 * sizes[k], "right"))
        later = np.arange(k + 1, max(to, k + 1))
        later = later[np.abs(distance[later] - distance[k]) <= near.reach]
        if not len(later):
            continue
        held = region.shared(int(order[k]), order[later])
        found = later[100 * held >= near.percent * (sizes[k] + sizes[later] - held)]
        if not len(found):
            continue
        groups, first = np.unique(group[found], return_index=True)
        new = groups != group[k]
        if new.any():
            links += [(nodes[order[k]], nodes[order[y]]) for y in found[first[new]].tolist()]
            group[np.isin(group, groups)] = group[k]
        if column:
            found = found[~(avoided[found] & avoided[k]).any(axis=1)]
        sums[k] += weight[found].sum()
        sums[found] += weight[k]
    degree[order] = sums
    return links, degree.tolist()


def _links_batch(links: list[tuple[int, int | None, int | None]]) -> pa.RecordBatch:
    columns = zip(*links, strict=True) if links else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "linked"])


def join_regions(sets: DataFrame, near: Nearness, counted: bool = False) -> DataFrame:
    """Spanning links (a, b) within each region of ``sets``; a task holds one region at a time.

    If ``counted``, also rows (a, linked): the holders of the sets that a set links with, as far as they count here.
    """

    def join(nodes: list, held: list, holders: list, avoid: list) -> list[tuple]:
        if not counted:
            return [(a, b, None) for a, b in region_links(nodes, held, near)]
        links, degrees = region_degrees(nodes, held, holders, avoid, near)
        return [(a, b, None) for a, b in links] + [(x, None, n) for x, n in zip(nodes, degrees, strict=True) if n]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, nodes, held, holders, avoid, links = None, [], [], [], [], []
        for row in rows_of(batches):
            if nodes and row["region"] != region:
                links += join(nodes, held, holders, avoid)
                nodes, held, holders, avoid = [], [], [], []
                if len(links) > 10_000:
                    yield _links_batch(links)
                    links = []
            region = row["region"]
            nodes.append(row["node"])
            held.append(np.frombuffer(row["shingles"], np.uint64))
            holders.append(row["holders"])
            avoid.append(row["avoid"])
        yield _links_batch(links + join(nodes, held, holders, avoid))

    dealt = sets.repartition("region").sortWithinPartitions("region", "node")
    return dealt.select(*_SETS).mapInArrow(run, "a bigint, b bigint, linked bigint")


def voronoi(sets: DataFrame, level: int, near: Nearness) -> DataFrame:
    """Where pivots send every set of ``sets``: rows (parent, node, n, region, pivot, also).

    A set goes to the region of its nearest pivot, and to that of every pivot no more than twice the
    reach farther: of two linked sets, the second then is in the region of the first. ``pivot`` is the
    pivot's node where the set links with it. ``also`` names the set's smaller regions: of the regions
    where two sets meet, all but the smallest are in the ``also`` of both. Sets are spread by a hash within their region, so a
    large region is divided by many tasks; each gets the ``PIVOTS`` pivots.
    """
    order = F.xxhash64("node", F.lit(level))
    rank = F.row_number().over(Window.partitionBy("region").orderBy(order, "node"))
    pivots = sets.withColumn("_r", rank).filter(F.col("_r") <= PIVOTS).drop("_r")
    total = sets.groupBy("region").agg(F.sum("n").alias("_t"))
    total = total.select("region", F.ceil(4 * F.col("_t") / REGION_SHINGLES).cast("int").alias("_salts"))
    left = sets.join(total, "region").withColumn("_salt", F.pmod(order, "_salts").cast("int")).select(*_SETS, "_salt")
    salted = pivots.join(total, "region").withColumn("_salt", F.explode(F.expr("sequence(0, _salts - 1)")))
    right = salted.toDF(*[f"pivot_{c}" for c in salted.columns])

    def divide(rows: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        chosen = chosen.sort_values("pivot_node")
        names = chosen["pivot_node"].tolist()
        sets_of = [np.frombuffer(x, np.uint64) for x in chosen["pivot_shingles"]]
        out = []
        for parent, node, n, data in zip(*(rows[c] for c in _SETS[:4]), strict=True):
            own = np.frombuffer(data, np.uint64)
            held = np.array([len(np.intersect1d(own, p, assume_unique=True)) for p in sets_of])
            union = np.array([n + len(p) for p in sets_of]) - held
            distance = 1 - held / union
            sent = []
            for k in np.flatnonzero(distance <= distance.min() + 2 * near.reach).tolist():
                linked = 100 * held[k] >= near.percent * union[k]
                region = mix(np.array([parent, names[k], level], np.int64).view(np.uint64))
                region = int(mix(region[:1] + region[1:2] * np.uint64(3) + region[2:])[0].view(np.int64))
                sent.append((region, names[k] if linked else None))
            for region, pivot in sent:
                out.append((parent, node, n, region, pivot, sorted(other for other, _ in sent if other < region)))
        found = pd.DataFrame(out, columns=["parent", "node", "n", "region", "pivot", "also"])
        return found.astype({"pivot": "Int64"})

    both = left.groupBy("region", "_salt").cogroup(right.groupBy("pivot_region", "pivot__salt"))
    moved = both.applyInPandas(divide, "parent bigint, node bigint, n bigint, region bigint, pivot bigint, also array<bigint>")
    return stored(moved, "jaccard-voronoi")


def pair_blocks(sets: DataFrame) -> DataFrame:
    """Regions that pivots cannot divide, as regions of two blocks each, so that any two sets meet.

    Sets of the same block avoid each other in all of them but the block's region with itself.
    """
    total = sets.groupBy("region").agg(F.ceil(4 * F.sum("n") / REGION_SHINGLES).alias("_blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("_blocks"))
    dealt = sets.join(total, "region").withColumn("_own", own)
    dealt = dealt.withColumn("_other", F.explode(F.expr("sequence(0L, _blocks - 1)")))
    region = F.xxhash64("region", F.least("_own", "_other"), F.greatest("_own", "_other"))
    block = F.array(F.xxhash64("region", "_own", F.lit("block")))
    avoid = F.when(F.col("_own") == F.col("_other"), F.col("avoid")).otherwise(F.concat("avoid", block))
    return dealt.select(region.alias("region"), "node", "n", "shingles", "holders", avoid.alias("avoid"))


def links_within(sets: DataFrame, near: Nearness, counted: bool = False) -> DataFrame:
    """Links (a, b) that connect what all links between sets of the same region connect, exactly.

    If ``counted``, also rows (a, linked) that sum to the holders of all sets that ``a`` links with. A link
    counts once wherever its ends meet, so its number of regions does not matter, and no list of links is written.

    Regions above ``REGION_SHINGLES`` are divided by pivots again and again. Where windows would send
    more than twice a region's shingles on, or more than half of them to one place, pivots do not
    pay; such a region, and one still too large after ``MOST_LEVELS``, is joined by block pairs.
    """
    links: list[DataFrame] = []
    for level in range(MOST_LEVELS + 1):
        size = sets.groupBy("region").agg(F.sum("n").alias("_t"), F.count("*").alias("_c"))
        large = stored(size.filter((F.col("_t") > REGION_SHINGLES) & (F.col("_c") > 2)), "jaccard-large")
        links.append(join_regions(sets.join(large, "region", "left_anti"), near, counted))
        if large.isEmpty():
            break
        big = sets.join(large.select("region"), "region", "left_semi")
        if level == MOST_LEVELS:
            links.append(join_regions(pair_blocks(big), near, counted))
            break
        moved = voronoi(big, level, near)
        part = moved.groupBy("parent", "region").agg(F.sum("n").alias("_p"))
        part = part.groupBy("parent").agg(F.sum("_p").alias("_all"), F.max("_p").alias("_most"))
        pays = part.join(large, F.col("parent") == large["region"]).select(
            "parent", ((F.col("_all") <= 2 * F.col("_t")) & (F.col("_most") <= F.col("_t") / 2)).alias("_pays")
        )
        pays = stored(pays, "jaccard-pays")
        if not counted:  # a set that links with a pivot is in the pivot's region too
            to_pivot = moved.filter("pivot is not null")
            links.append(to_pivot.select(F.col("pivot").alias("a"), F.col("node").alias("b"), F.lit(None).cast("bigint").alias("linked")))
        stays = pays.filter("not _pays").select(F.col("parent").alias("region"))
        links.append(join_regions(pair_blocks(big.join(stays, "region", "left_semi")), near, counted))
        goes = moved.join(pays.filter("_pays"), "parent").select("parent", "node", F.col("region").alias("_new"), "also")
        old = big.withColumnRenamed("region", "parent")
        avoid = F.concat("avoid", "also").alias("avoid")
        divided = old.join(goes, ["parent", "node"]).select(F.col("_new").alias("region"), "node", "n", "shingles", "holders", avoid)
        sets = stored(divided, "jaccard-sets")
    return reduce(DataFrame.union, links)


def parted_by_rarest(sets: DataFrame, near: Nearness) -> DataFrame:
    """``sets`` with regions above ``REGION_SHINGLES`` divided, exactly, by the rarest shingles of their sets.

    A region may be held together by phrases that many texts have in common. Two linked sets share ``percent`` of the
    larger one at least; so if the shingles of a region stand in one order, the sets share one of the first that they
    need not have in common. The order is by the number of sets that hold a shingle, rare ones first, so that common
    phrases come last. Sets that share such a shingle, directly or over others, are a region; a set that shares none
    has no link and goes. Each shingle of a large region is shuffled a bounded number of times.
    """
    size = sets.groupBy("region").agg(F.sum("n").alias("_t"), F.count("*").alias("_c"))
    large = stored(size.filter((F.col("_t") > REGION_SHINGLES) & (F.col("_c") > 2)).select("region"), "jaccard-large")
    if large.isEmpty():
        return sets

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                held = [np.frombuffer(x, np.int64) for x in part.column("shingles").to_pylist()]
                rows = pa.array(np.repeat(np.arange(part.num_rows), [len(x) for x in held]))
                own = [part.column(c).take(rows) for c in ("region", "node", "n")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.concatenate(held))], ["region", "node", "n", "shingle"])

    big = sets.join(large, "region", "left_semi")
    each = big.select("region", "node", "n", "shingles").mapInArrow(occurrences, "region bigint, node bigint, n bigint, shingle bigint")
    holders = Window.partitionBy("region", "shingle")
    # Shingles of one set only would come first in its order, and meet nothing.
    met = each.withColumn("_held", F.count("*").over(holders)).filter("_held > 1")
    own = Window.partitionBy("region", "node")
    ranked = met.withColumn("_met", F.count("*").over(own)).withColumn("_r", F.row_number().over(own.orderBy("_held", "shingle")))
    shared = F.ceil(F.col("n") * near.percent / 100 - 1e-9)
    first = ranked.filter(F.col("_r") <= F.col("_met") - shared + 1).select("region", "shingle", "node")
    pairs = first.withColumn("_first", F.min("node").over(holders)).filter("node != _first")
    pairs = pairs.select(F.col("_first").alias("a"), F.col("node").alias("b")).distinct()
    group = components(pairs, "jaccard-rarest").select("node", F.col("root").alias("_root"))
    divided = big.join(group, "node").select(F.col("_root").alias("region"), *_SETS[1:])
    return sets.join(large, "region", "left_anti").select(*_SETS).union(stored(divided, "jaccard-sets"))


def _linked(docs: DataFrame, near: Nearness, counted: bool) -> DataFrame:
    """Rows (doc_id, n_shingles, set, component_id, holders, linked) of all documents; ``linked`` only if ``counted``."""
    measured = stored(measure_sets(docs, near), "jaccard-measured")
    holders = stored(set_holders(measured), "jaccard-holders")
    family = families(docs, near)
    found = family_sets(docs, holders, family, near).union(nameless_sets(docs, holders, family, near))
    sets = stored(found, "jaccard-sets")
    if not sets.groupBy("node").count().filter("count > 1").isEmpty():  # rows that share a doc_id, or have none
        sets = stored(sets.dropDuplicates(["node"]), "jaccard-sets")
    sets = parted_by_rarest(sets, near)
    links = stored(links_within(sets, near, counted), "jaccard-links")
    found = components(links.filter("b is not null").select("a", "b"), "jaccard-component")
    found = found.select(F.col("node").alias("set"), "root")
    # Components are settled among sets, so that a group of copies is one row.
    group = holders.join(found, "set", "left").withColumn("_group", F.coalesce("root", "set"))
    least = group.groupBy("_group").agg(F.min("least").alias("_least"))
    degree = links.filter("linked is not null").groupBy(F.col("a").alias("set")).agg(F.sum("linked").alias("linked"))
    each = group.join(least, "_group").join(degree, "set", "left").select("set", "holders", "linked", "_least")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_least", "doc_id")).alias("component_id")
    whole = measured.join(each, "set", "left")
    return whole.select("doc_id", "n_shingles", "set", component, "holders", "linked")


def near_components(docs: DataFrame, near: Nearness = Nearness()) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, n_links) of all documents of ``docs``.

    ``component_id`` is the smallest doc_id reachable by links, itself included; ``n_links`` counts the
    other documents with which the text links. Equal texts, and texts of
    equal sets, are linked. A null or empty text, or one without words, has no shingle and no link; a
    text of fewer words than ``width`` is one shingle. A row with a null doc_id has a null component
    of its own, still connects others, and counts as a document. Rows that share a doc_id and a set are one
    document; those with other sets count once per set. Other columns are ignored; an empty table gives an
    empty table. Sets are told apart by 64-bit hashes of words and shingles.
    """
    links = F.coalesce("linked", F.lit(0)) + F.coalesce(F.col("holders") - 1, F.lit(0))
    return _linked(docs, near, counted=True).select("doc_id", "n_shingles", "component_id", links.cast("bigint").alias("n_links"))


def keep_one(docs: DataFrame, near: Nearness = Nearness()) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its component, with their own columns only.

    Rows that repeat a doc_id stay or go together; rows with a null doc_id stay.
    """
    gone = _linked(docs, near, counted=False).filter("component_id != doc_id").select("doc_id").distinct()
    left, right = docs.alias("l"), gone.alias("r")
    return left.join(right, F.col("l.doc_id") == F.col("r.doc_id"), "left_anti")
