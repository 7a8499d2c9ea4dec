"""Document fingerprints: bottom-k sketches of shingle hashes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislewatch.llm.shared import rows_of, shingle_hashes, word_hashes

WIDTH = 5
SIZE = 256
#: Hashes are reduced to so many bits, which keeps them exact in signed 64-bit and short in text.
BITS = 48


def sketch_of(text: str, width: int = WIDTH, size: int = SIZE) -> np.ndarray:
    """The ``size`` smallest hashes, ascending, of the distinct word shingles of a whole text.

    A sketch with fewer than ``size`` hashes is the whole set. A text without words has none; one
    with fewer words than ``width`` is one shingle. A-Z count as a-z.
    """
    hashes = shingle_hashes(word_hashes(text), width) >> np.uint64(64 - BITS)
    return _distinct(hashes)[:size].astype(np.int64)


def _distinct(ascending: np.ndarray) -> np.ndarray:
    return ascending[np.concatenate(([True], ascending[1:] != ascending[:-1]))] if len(ascending) else ascending


def merged(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The sketch of the union."""
    return np.union1d(a, b)[:size]


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard similarity; exact where both sketches are whole sets. Two empty sets are alike."""
    union = merged(a, b, size)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, union[-1], "right") / len(union))


def distinct_count(a: np.ndarray, size: int = SIZE) -> float:
    """Estimated number of distinct shingles; exact below ``size``."""
    return float(len(a)) if len(a) < size else (size - 1) / ((float(a[size - 1]) + 1) / 2**BITS)


def containment(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has too; of an empty ``a``, 1."""
    if not len(a):
        return 1.0
    union = distinct_count(merged(a, b, size), size)
    return min(1.0, resemblance(a, b, size) * union / distinct_count(a, size))


def as_text(sketch: np.ndarray) -> str:
    """Base64 of the hashes as 6-byte little-endian integers."""
    return base64.b64encode(sketch.astype("<i8").view(np.uint8).reshape(-1, 8)[:, : BITS // 8].tobytes()).decode()


def sketches(text: Column | str, width: int = WIDTH, size: int = SIZE) -> Column:
    """The sketch of each text as an ascending array of long; of null and empty texts, an empty array."""

    @F.arrow_udf("array<bigint>")
    def sketch(column: pa.Array) -> pa.Array:
        return pa.array([sketch_of(x or "", width, size) for x in column.to_pylist()], pa.list_(pa.int64()))

    return sketch(text)


def merge_sketches(rows: DataFrame, by: list[str], sketch: str = "sketch", size: int = SIZE) -> DataFrame:
    """One sketch per group of ``by``: that of the union of the group's parts.

    Hashes are made distinct and ranked under the fixed limit ``size``, which Spark applies before the
    shuffle too, so a group of any number of parts needs ``size`` hashes per task. A group whose
    sketches are all empty or null keeps a row with an empty sketch.
    """
    hashes = rows.select(*by, F.explode(sketch).alias("_h")).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_h"))
    kept = hashes.withColumn("_r", rank).filter(F.col("_r") <= size)
    found = kept.groupBy(*by).agg(F.array_sort(F.collect_list("_h")).alias(sketch))
    same = [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in by]
    joined = rows.select(*by).distinct().alias("l").join(found.alias("r"), same, "left")
    empty = F.array().cast("array<bigint>")
    return joined.select(*[F.col(f"l.`{c}`") for c in by], F.coalesce(F.col(f"r.`{sketch}`"), empty).alias(sketch))


def compare_sketches(a: Column | str, b: Column | str, size: int = SIZE) -> Column:
    """A struct of resemblance, containment (of a in b) and union_count of two sketches; null as empty."""

    @F.arrow_udf("resemblance double, containment double, union_count double")
    def compare(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = [
            (np.array(x or [], np.int64), np.array(y or [], np.int64))
            for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True)
        ]
        values = [
            [resemblance(x, y, size) for x, y in pairs],
            [containment(x, y, size) for x, y in pairs],
            [distinct_count(merged(x, y, size), size) for x, y in pairs],
        ]
        arrays = [pa.array(v, pa.float64()) for v in values]
        return pa.StructArray.from_arrays(arrays, ["resemblance", "containment", "union_count"])

    return compare(a, b)


#: Documents that one range holds, about.
RANGE_ROWS = 8192
_LOWEST = -(1 << 63)


def with_successors(docs: DataFrame) -> DataFrame:
    """Rows (_range, _ahead, _key, text) such that each document stands before its successor.

    Ranges of ascending doc_id hold some ``RANGE_ROWS`` documents. The first document of a range also
    goes, marked ``_ahead``, to the end of the range before; that of the first range to the last one.
    Ranges are bounded by approximate quantiles of doc_id, so the driver sees a few numbers per range.
    Sorted within partitions by the first four columns. Each text is shuffled once.
    """
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOWEST)).alias("_key"), "text")
    keys = keyed.select("_key")
    count = keys.count()
    ranges = max(1, -(-count // RANGE_ROWS), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    steps = [k / ranges for k in range(1, ranges)]
    found = keys.select(F.col("_key").cast("double").alias("k")).approxQuantile("k", steps, 0.2 / ranges) if steps and count else []
    cuts = np.unique(np.array(found, np.float64))

    @F.arrow_udf("int")
    def range_of(key: pa.Array) -> pa.Array:
        at = np.searchsorted(cuts, key.to_numpy(zero_copy_only=False).astype(np.float64), "right")
        return pa.array(at.astype(np.int32))

    firsts = keys.select("_key", range_of("_key").alias("_range")).groupBy("_range").agg(F.min("_key").alias("first"))
    # One row per range: a few bytes each, counted above.
    ordered = sorted((r["_range"], r["first"]) for r in firsts.collect())
    begin = {first: ordered[k - 1][0] for k, (_, first) in enumerate(ordered)}
    starts = np.array(sorted(begin), np.int64)
    befores = np.array([begin[s] for s in starts.tolist()], np.int32)

    @F.arrow_udf("array<struct<_range:int,_ahead:boolean>>")
    def places(key: pa.Array) -> pa.Array:
        keys = key.to_numpy(zero_copy_only=False).astype(np.int64)
        own = np.searchsorted(cuts, keys.astype(np.float64), "right")
        at = np.searchsorted(starts, keys)
        first = (at < len(starts)) & (starts[np.minimum(at, len(starts) - 1)] == keys)
        ahead = befores[np.minimum(at, len(starts) - 1)]
        out = [
            [{"_range": r, "_ahead": False}, *([{"_range": p, "_ahead": True}] if f else [])]
            for r, f, p in zip(own.tolist(), first.tolist(), ahead.tolist(), strict=True)
        ]
        return pa.array(out, pa.list_(pa.struct([("_range", pa.int32()), ("_ahead", pa.bool_())])))

    placed = keyed.withColumn("_at", F.explode(places("_key"))).select("_at.*", "_key", "text")
    dealt = placed.repartitionById(ranges, F.col("_range"))
    return dealt.sortWithinPartitions("_range", "_ahead", "_key", "text")




_EDITED = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("contained_in_edited", pa.float64()), ("distinct_shingles", pa.float64()),
]


def compare_with_edited(docs: DataFrame, width: int = WIDTH, size: int = SIZE) -> DataFrame:
    """Fingerprints of every text and of its edited text, compared; and compared with the next document's.

    The edited text replaces the last floor(n/2) code points by the first as many (or all) of the next
    document by ascending doc_id; the last document's next is the first. Null texts are empty. Rows
    that share a doc_id follow each other by text (null first) and count as documents of their own; a
    null doc_id comes first. A single document is its own next. An empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        out: list[tuple] = []

        def row(own: tuple, following: tuple) -> tuple:
            _, key, text, sketch = own
            n = len(text)
            half = n // 2
            edited = text[: n - half] + following[2][:half]
            other = sketch_of(edited, width, size)
            return (
                None if key == _LOWEST else key, n, hashlib.sha256(edited.encode()).hexdigest(), as_text(sketch), as_text(other),
                resemblance(sketch, other, size), resemblance(sketch, following[3], size), containment(sketch, other, size),
                distinct_count(sketch, size),
            )

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[] for _ in _EDITED]
            arrays = [pa.array(c, t) for c, (_, t) in zip(columns, _EDITED, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, [n for n, _ in _EDITED])

        closed = True
        for r in rows_of(batches):
            text = r["text"] or ""
            if held is not None and held[0] == r["_range"] and closed:
                continue  # a further copy of the row that closed this range
            following = (r["_range"], r["_key"], text, sketch_of(text, width, size))
            if held is not None and held[0] == r["_range"]:
                out.append(row(held, following))
            closed = r["_ahead"]
            held = following
            if len(out) >= 256:
                yield batch_of()
        yield batch_of()

    kinds = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, contained_in_edited double, distinct_shingles double"
    )
    return with_successors(docs).mapInArrow(run, kinds)
