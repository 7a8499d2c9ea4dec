"""What the operators of this subpackage share: scratch tables, words, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folder: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names, with one subfolder per application.

    A folder of the machine is taken only where the setting is missing on a local master.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = _own_folder.setdefault(app, tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return f"{configured.rstrip('/')}/llm-{app}"


#: Rows that Spark hands to Python at once; it bounds the memory of both where texts are long.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    """The session, set to hand texts to Python in batches of ``BATCH_ROWS`` at most."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


#: Spark's setting by which a query's shuffle files go when the query ends, not when the driver collects its garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, parts: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors.

    The shuffle files of the write go with it, since nothing else reads them. Values of the column ``parts`` have a folder each.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_SHUFFLES_GO, "false")
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        (df.write.partitionBy(parts) if parts else df.write).parquet(path)
    finally:
        spark.conf.set(_SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for table in tables:
        files = table.inputFiles()
        if files:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application. Call it once the results have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def texts_of(column: pa.Array | pa.ChunkedArray) -> Iterator[str]:
    """The texts of an Arrow column, null as empty, taken out in small runs."""
    for start in range(0, len(column), 256):
        for text in column.slice(start, 256).to_pylist():
            yield text or ""


def rows_of(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[dict]:
    """Rows of a stream of batches, one by one; only ``size`` of them are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield from batch.slice(start, size).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a published finaliser: two multiplications, three shifts)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MULTIPLIER = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers, ``count`` at least, of an odd number modulo 2**64, and of its inverse."""
    if len(_powers.get("up", ())) < count:
        size = max(count, 1 << 16)
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of ``values``, each that of the run alone: sums of values times powers."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = powers(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class WordScan:
    """Finds and hashes the words of UTF-8 bytes without making objects of them.

    ``alike[b]`` is the byte that byte ``b`` counts as, or -1 if it separates words.
    """

    #: So that the numbers of a chunk's bytes stay in the processor's cache.
    CHUNK = 1 << 15

    def __init__(self, alike: list[int]):
        table = np.array(alike)
        self.inside = table >= 0
        self.values = mix(np.maximum(table, 0).astype(np.uint64) + np.uint64(1))

    def scan(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of each word; a chunk of many words, or one long word, is hashed at a time."""
        codes = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(codes) + 2, bool)
        self.inside.take(codes, out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[0::2], edges[1::2]
        out, at = [np.empty(0, np.uint64)], 0
        while at < len(starts):
            first = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, first + self.CHUNK, "right")))
            values = self.values.take(codes[first : ends[to - 1]])
            out.append(run_hashes(values, starts[at:to] - first, ends[at:to] - first))
            at = to
        return np.concatenate(out), starts


#: Words ``[^\\x20\\x09-\\x0D]+`` with A-Z counting as a-z.
WORDS = WordScan([-1 if c == 0x20 or 0x09 <= c <= 0x0D else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)])


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text; of null, none."""
    return WORDS.scan((text or "").encode("utf-8"))[0]


def shingle_hashes(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes, ascending, of all runs of ``width`` words; a shorter text is one shingle."""
    n = len(word_hashes)
    if n == 0:
        return word_hashes
    width = min(width, n)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + word_hashes[k : n - width + 1 + k])
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def components(links: DataFrame, label: str) -> DataFrame:
    """Connected components of ``links`` (a, b): one row (node, root) per node, root the smallest id.

    Each round every node takes its smallest neighbour as parent, parents are followed twice, and
    links are rewritten to the parents, which drops what has met. Rounds grow with the logarithm of
    a component's diameter. Every table is written to the shared folder; only row counts reach the
    driver. Self links and null ends are ignored; repeated links count once.
    """
    edges = stored(
        links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{label}-links",
    )
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        parent = stored(parent.select("node", F.least("node", "least").alias("parent")), f"{label}-parents")
        for _ in range(2):
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            parent = parent.join(up, "parent").select("node", F.col("above").alias("parent"))
        parent = stored(parent, f"{label}-parents")
        steps.append(parent)
        of_a = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        of_b = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(of_a, "a").join(of_b, "b").filter("pa != pb")
        edges = stored(
            moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), f"{label}-links"
        )
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0].select("node", F.col("parent").alias("root"))
    for step in steps[1:]:
        step = step.select(F.col("node").alias("root"), F.col("parent").alias("_next"))
        found = found.join(step, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
    return found
