"""Token ids in ORC: integer run-length encoding, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

END_ID = 2
#: Pieces whose ids a Python worker gathers before those gathered earlier, and not met since, are forgotten.
REMEMBERED_PIECES = 600_000
#: Rows between two entries of a row index; stripes are closed at about this many bytes.
INDEX_STRIDE = 1000
STRIPE_BYTES = 16 * 1024 * 1024

#: Letters up to here have been letters in every version of Unicode that a tokenizer may know.
_LAST_LETTER = "\u024f"
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
_LINE_END = re.compile(r"(?<=\S)\n(?=\S)")


class SpaceRun(Exception):
    """A blank follows white space."""


class AfterBlank(dict):
    """Ids of a blank and the piece up to the next blank, by that piece; ``SpaceRun`` where white space ends it."""

    def __init__(self, whole: PieceEncoder):
        super().__init__()
        self.whole, self.older = whole, {}

    def __missing__(self, rest: str) -> bytes:
        if not rest or rest[-1].isspace():
            raise SpaceRun
        value = self.older.get(rest)
        if value is None:
            value = self.whole.composed(" " + rest)
        if len(self) >= REMEMBERED_PIECES:
            self.older = dict(self)
            self.clear()
        self[rest] = value
        return value


class PieceEncoder(dict):
    """Ids of pieces of text, as bytes of little-endian 32-bit integers, remembered when met again.

    A byte-level tokenizer first cuts a text by a pattern in which a blank after a character that is
    not white space always starts a new part, and a merge never crosses parts. So a text may be cut
    there, and the pieces encoded apart give the same ids as the text. Behind the same reasoning, a
    sentence mark after a letter, and a line end between two characters that are not white space,
    stand alone. A tokenizer of another kind is given whole texts.
    """

    def __init__(self, file: str, specials_are_text: bool = False):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.after_blank = AfterBlank(self)
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = specials_are_text
        kind = self.tokenizer.pre_tokenizer
        cuts = kind.__getstate__() if kind is not None else b""
        byte_level = cuts.startswith(b'{"type":"ByteLevel"') and b'"use_regex":true' in cuts
        self.by_piece = byte_level and b'"add_prefix_space":false' in cuts and self.tokenizer.normalizer is None
        #: How the tokenizer spells the bytes of a blank and of common letters, asked from itself.
        spelt = [" ", *(c for c in map(chr, range(ord(_LAST_LETTER) + 1)) if c.isalpha())]
        self.byte_letters = {ord(c): kind.pre_tokenize_str(c)[0][0] for c in spelt} if self.by_piece else {}

    def __missing__(self, piece: str) -> bytes:
        value = self.older.get(piece)
        if value is None:
            value = self.composed(piece)
        if len(self) >= REMEMBERED_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = value
        return value

    def composed(self, piece: str) -> bytes:
        """A plain word goes to the model at once; others are put together from plain words where that is safe."""
        letters = piece[1:] if piece[:1] == " " else piece
        if letters.isalpha() and (letters.isascii() or max(letters) <= _LAST_LETTER):
            spelt = self.byte_letters[0x20] + letters if letters is not piece and letters.isascii() else piece.translate(self.byte_letters)
            ids = [token.id for token in self.tokenizer.model.tokenize(spelt)]
            return struct.pack(f"<{len(ids)}I", *ids)
        lines = _LINE_END.split(piece) if "\n" in piece else [piece]
        if len(lines) > 1:
            return self["\n"].join(map(self.__getitem__, lines))
        if piece[-1:] in ".,;:!?" and piece[-2:-1].isalpha():
            word = self.after_blank[piece[1:-1]] if piece[0] == " " else self[piece[:-1]]
            return word + self[piece[-1]]
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        if not self.by_piece:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        if not rest:
            return self[first]
        last = rest.pop()
        try:
            if first[-1:].isspace():
                raise SpaceRun
            between = b"".join(map(self.after_blank.__getitem__, rest))
        except SpaceRun:
            return b"".join(map(self.__getitem__, _BEFORE_SPACE.split(text)))
        return (self[first] if first else b"") + between + self[" " + last]


@lru_cache(maxsize=2)
def encoder(file: str, specials_are_text: bool) -> PieceEncoder:
    """One encoder per Python worker, kept between tasks."""
    return PieceEncoder(file, specials_are_text)


def encode(docs: DataFrame, tokenizer: str, end_id: int = END_ID, specials_are_text: bool = False) -> DataFrame:
    """Rows (doc_id, part_start, n, ids) in ascending doc_id order over ascending partitions.

    ``ids`` are those of the whole text and ``end_id``, ``n`` in number; null and empty texts give ``end_id`` alone.
    ``part_start`` counts the ids before the document in its partition. Null doc_ids come first;
    rows that share a doc_id stay apart, ordered by a hash of their text, and may lie in several partitions;
    an empty table gives an empty table. Only doc_id and text are read.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer, specials_are_text)
        start = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [known.ids(text or "") + end for text in part.column("text").to_pylist()]
                counts = np.array([len(x) // 4 for x in ids], np.int32)
                ends = np.cumsum(counts, dtype=np.int64)
                begins = np.concatenate(([0], ends))
                values = pa.array(np.frombuffer(b"".join(ids), "<u4").view(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), values)
                starts = pa.array(start + begins[:-1], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), starts, pa.array(counts), lists], ["doc_id", "part_start", "n", "ids"]
                )
                start += int(ends[-1])

    # Rows that share a doc_id are parted by a hash of their text, and equal ones by their place, so that no range
    # must hold them all.
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("_text"), F.monotonically_increasing_id().alias("_row"))
    order = ["doc_id", "_text", "_row"]
    ordered = hashed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"doc_id {id_type}, part_start bigint, n int, ids array<int>")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    """Encode ``docs`` and write ORC files under ``path``, one or more per range of doc_ids.

    Integers are run-length encoded by the format; each stripe carries a row index and a Bloom filter
    on doc_id, so a reader skips stripes by metadata, and tasks read stripes side by side. Nulls, empty
    texts, repeated rows and an empty table are as in ``encode``; other columns are not written.
    """
    writer = encode(docs, tokenizer, **options).write
    settings = {
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true",
        "orc.row.index.stride": str(INDEX_STRIDE), "orc.stripe.size": str(STRIPE_BYTES), "compression": "zstd",
    }
    writer.options(**settings).orc(path)


def read_token_files(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """Rows (doc_id, start, ids); ``start`` counts the ids of all documents before, over all files.

    ``doc_ids`` becomes a pushed filter that min-max indexes and Bloom filters answer. Starts come
    from one row per written partition, whose totals are read without the ids' values.
    """
    rows = spark.read.orc(path)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("bigint").alias("_part")
    total = rows.select(part, (F.col("part_start") + F.col("n")).alias("n")).groupBy("_part").agg(F.max("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    bases = total.select("_part", F.coalesce(before, F.lit(0)).alias("_base"))
    if doc_ids is not None:
        rows = rows.filter(F.col("doc_id").isin(list(doc_ids)))
    # The number of written partitions bounds the broadcast: a few bytes for each.
    found = rows.select("doc_id", "part_start", "ids", part).join(F.broadcast(bases), "_part")
    return found.select("doc_id", (F.col("_base") + F.col("part_start")).alias("start"), "ids")


def ids_crc32(ids: Column | str) -> Column:
    """Unsigned CRC-32 of a list of ids as little-endian unsigned 32-bit integers; of null, 0."""

    @F.arrow_udf("bigint")
    def checksum(lists: pa.Array) -> pa.Array:
        ends = np.cumsum([n or 0 for n in lists.value_lengths().to_pylist()], dtype=np.int64) * 4
        data = memoryview(lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes())
        begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        return pa.array([zlib.crc32(data[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], pa.int64())

    return checksum(ids)


def texts_back(files: DataFrame, tokenizer: str) -> DataFrame:
    """Rows (doc_id, text) decoded from read rows, without the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokenizer.from_file(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [known.decode(ids[:-1], skip_special_tokens=False) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    id_type = files.schema["doc_id"].dataType.simpleString()
    return files.select("doc_id", "ids").mapInArrow(run, f"doc_id {id_type}, text string")
