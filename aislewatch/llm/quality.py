"""Quality rules: compression bands over whole documents and fixed chunks."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewatch.llm.shared import texts_of


@dataclass(frozen=True)
class Band:
    """Limits for texts of up to ``most`` bytes (None: any length): bytes per compressed byte."""

    most: int | None
    whole_least: float
    whole_most: float
    chunk_least: float
    chunk_most: float


#: Short texts compress badly because the frame costs some bytes and nothing repeats yet, so limits
#: rise with length. The lower limits reject encoded or random bytes (base64 comes to 1.33), the upper
#: ones repetition.
BANDS = (
    Band(512, 1.10, 6.0, 1.10, 6.0),
    Band(2048, 1.25, 8.0, 1.25, 8.0),
    Band(8192, 1.35, 9.0, 1.33, 12.0),
    Band(65536, 1.40, 12.0, 1.33, 16.0),
    Band(None, 1.40, 16.0, 1.33, 20.0),
)
CHUNK_BYTES = 4096
LEVEL = 3
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Share of a document's chunks that must lie outside the chunk limits to reject it.
BAD_CHUNK_SHARE = 0.5

FIELDS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("whole_ratio", pa.float64()), ("n_chunks", pa.int64()),
    ("n_flat_chunks", pa.int64()), ("n_noisy_chunks", pa.int64()), ("reason", pa.string()),
]
_TYPE = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, whole_ratio double, "
    "n_chunks bigint, n_flat_chunks bigint, n_noisy_chunks bigint, reason string"
)


def repeated_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur at least twice in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: set = set()
    twice = {w for w in windows if w in seen or seen.add(w)}
    count = end = 0
    for start, window in enumerate(windows):
        if window in twice:
            count += start + 3 - max(start, end)
            end = start + 3
    return count


def ratios(data: bytes, compressor: zstandard.ZstdCompressor, chunk: int = CHUNK_BYTES) -> tuple[float, list[float]]:
    """Bytes per compressed byte of the whole text and of each chunk.

    Chunks hold ``chunk`` bytes; a rest shorter than half a chunk stays with the one before it.
    """
    if not data:
        return 0.0, []
    whole = len(data) / len(compressor.compress(data))
    count = max(1, round(len(data) / chunk))
    if count == 1:
        return whole, [whole]
    pieces = [data[k * chunk : (k + 1) * chunk if k + 1 < count else None] for k in range(count)]
    return whole, [len(p) / len(compressor.compress(p)) for p in pieces]


def measure(text: str, compressor: zstandard.ZstdCompressor, bands: tuple[Band, ...]) -> tuple:
    """The values of ``FIELDS`` for one text."""
    data = text.encode("utf-8")
    words = data.split()
    word_chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    whole, chunks = ratios(data, compressor)
    band = next(b for b in bands if b.most is None or len(data) <= b.most)
    flat = sum(r > band.chunk_most for r in chunks)
    noisy = sum(r < band.chunk_least for r in chunks)
    reason = None
    if not words:
        reason = "empty"
    elif whole > band.whole_most:
        reason = "repetitive"
    elif whole < band.whole_least:
        reason = "incompressible"
    elif flat >= BAD_CHUNK_SHARE * len(chunks):
        reason = "repetitive chunks"
    elif noisy >= BAD_CHUNK_SHARE * len(chunks):
        reason = "incompressible chunks"
    return (
        len(words), word_chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), whole,
        len(chunks), flat, noisy, reason,
    )


def compression_quality(text: Column | str, bands: tuple[Band, ...] = BANDS) -> Column:
    """A struct of counts, ratios and the reason of a rejection by the compression bands, or null.

    Null and empty texts, and texts of white space, count zero and get the reason ``empty``. Every
    row is judged by its own text, so repeated rows, ties and row order do not matter, and an empty
    table gives an empty table. The whole text is compressed, however long.
    """

    @F.arrow_udf(_TYPE)
    def judge(column: pa.Array) -> pa.Array:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        rows = [measure(text, compressor, bands) for text in texts_of(column)]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in FIELDS]
        arrays = [pa.array(c, t) for c, (_, t) in zip(columns, FIELDS, strict=True)]
        return pa.StructArray.from_arrays(arrays, [n for n, _ in FIELDS])

    return judge(text)


def with_quality(docs: DataFrame, into: str = "_quality", bands: tuple[Band, ...] = BANDS) -> DataFrame:
    """``docs`` and a struct column ``into`` (replaced if there is one): counts, base rule, verdict."""
    q = F.col(into)
    failed = (q["n_words"] < LEAST_WORDS) | (100 * q["n_repeat_words"] > MOST_REPEATED_PERCENT * q["n_words"])
    judged = docs.withColumn(into, compression_quality("text", bands))
    return judged.withColumn(
        into, q.withField("base_failed", failed).withField("kept", ~failed & q["reason"].isNull())
    )


def keep_good(docs: DataFrame, bands: tuple[Band, ...] = BANDS) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only. Rows without text do not pass."""
    into = "_quality"
    while into in docs.columns:
        into += "_"
    return with_quality(docs, into, bands).filter(F.col(into)["kept"]).drop(into)
