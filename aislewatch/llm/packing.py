"""Best-fit packing with conflicts: no bin holds two pieces of a duplicate cluster or too many of a source."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewatch.llm.mixing import word_count
from aislewatch.llm.shared import stored

CAPACITY = 2048
#: Pieces that one task packs together.
BLOCK_PIECES = 4096


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, source_limit: int) -> list[int]:
    """The bin of each item; items are taken in the order given.

    Bins lie in order of what is left in them. The first bin that can hold an item is found by
    bisection, and successors are tried until one is compatible: its cluster bitmap lacks the item's
    cluster, and the last plane of its source bitmaps the item's source. That is the tightest
    compatible bin. Without one a bin is opened. Clusters and sources below 0 conflict with nothing.
    """
    left: list[tuple[int, int]] = []
    planes: list[list[int]] = []
    held: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        source_bit = 1 << source if source >= 0 else 0
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(left, (size, -1))
        while at < len(left) and (held[left[at][1]] & cluster_bit or planes[left[at][1]][-1] & source_bit):
            at += 1
        if at < len(left):
            rest, place = left.pop(at)
        else:
            rest, place = capacity, len(held)
            held.append(0)
            planes.append([0] * source_limit)
        held[place] |= cluster_bit
        for k, plane in enumerate(planes[place]):
            if not plane & source_bit:
                planes[place][k] |= source_bit
                break
        insort(left, (rest - size, place))
        out.append(place)
    return out


def _dense(values: list, least: int) -> list[int]:
    """Small numbers for values that occur ``least`` times or more, -1 for others."""
    numbers = {v: k for k, v in enumerate(v for v, n in Counter(values).items() if n >= least)}
    return [numbers.get(v, -1) for v in values]


def pack(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None, source_limit: int | None = None) -> DataFrame:
    """Pack the words of ``docs`` into bins: rows (bin, doc_id, piece, first_word, n_words, source, cluster).

    A text of more than ``capacity`` words is cut into pieces of at most so many; every word is packed.
    ``cluster`` names a column of duplicate clusters; without it equal texts are a cluster. Pieces
    of a cluster, and so copies and pieces of one text, are in different bins. A bin holds at most
    ``source_limit`` pieces of a source; left out, it is what fits the block's largest source without
    more bins, at least 2.

    Pieces are dealt by a hash of doc_id to blocks of some ``BLOCK_PIECES``, each packed by one task from
    its largest piece to its smallest, ties by hash, doc_id and piece. Null and empty texts are pieces
    of no words. Null doc_id, source and cluster are values of their own; repeated rows are packed
    each. An empty table gives an empty table; other columns are ignored.
    """
    group = F.col(f"`{cluster}`").cast("string") if cluster else F.xxhash64(F.coalesce("text", F.lit(""))).cast("string")
    rows = docs.select("doc_id", "source", group.alias("cluster"), word_count().alias("_words"))
    count = F.greatest(F.ceil(F.col("_words") / capacity), F.lit(1))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)))
    first = F.col("piece") * capacity
    rows = rows.select(
        "doc_id", "source", "cluster", "piece", first.alias("first_word"),
        F.least(F.col("_words") - first, F.lit(capacity)).cast("bigint").alias("n_words"),
        F.xxhash64("doc_id", F.lit(5)).alias("_order"),
    )
    rows = stored(rows, "pack-pieces")
    blocks = max(1, -(-rows.count() // BLOCK_PIECES))
    # Pieces of one long text, and rows of one doc_id, are spread too.
    block = F.pmod(F.xxhash64("_order", "piece"), F.lit(blocks)).alias("_block")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n_words", "_order", "doc_id", "piece", "source"], ascending=[False, True, True, True, True])
        sources, words = part["source"].tolist(), int(part["n_words"].sum())
        most = max(Counter(sources).values())
        limit = source_limit or max(2, -(-5 * most * capacity // (4 * max(words, 1))))
        places = best_fit(
            part["n_words"].tolist(), _dense(sources, 1), _dense(part["cluster"].tolist(), 2), capacity, min(limit, len(part))
        )
        return part.assign(bin=(int(part["_block"].iloc[0]) << 32) + pd.Series(places, index=part.index))[_PACKED]

    packed = rows.select("*", block).groupBy("_block").applyInPandas(
        fill, f"bin bigint, doc_id {id_type}, piece bigint, first_word bigint, n_words bigint, source string, cluster string"
    )
    return packed


_PACKED = ["bin", "doc_id", "piece", "first_word", "n_words", "source", "cluster"]
