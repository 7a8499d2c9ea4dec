"""Chat formatting: columnar byte assembly of turns, with a loss mask, and the way back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewatch.llm.shared import rows_of

#: The template of a turn: MARK role SEP text END. Control strings are those of MARK, SEP and END.
MARK, SEP, END = "### ", ": ", "</turn>\n"
#: A part of a conversation is closed at the end of a turn once it holds so many bytes.
PART_BYTES = 8 * 1024 * 1024
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Break every control string by a backslash inside it; backslashes are doubled.

    ``###`` becomes ``#\\##`` and ``</turn>`` becomes ``<\\/turn>``, so no control string stands in the
    output of a text.
    """
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    if "##" in text:
        text = text.replace("##", "#\\#")
    if "</" in text:
        text = text.replace("</", "<\\/")
    return text


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    return _UNESCAPE.sub(r"\1", text) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def assemble(pieces: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Interleave string columns row by row into one preallocated buffer of bytes.

    Returns the buffer and the byte offsets of all segments, row-major. Lengths of the segments give
    running offsets; each segment's source less its target offset, repeated over its bytes, gives
    the index from which every byte of the buffer is taken.
    """
    rows, width = len(pieces[0]), len(pieces)
    sources, begins, lengths = [], np.empty((rows, width), np.int64), np.empty((rows, width), np.int64)
    base = 0
    for k, piece in enumerate(pieces):
        _, offsets, data = piece.cast(pa.large_string()).buffers()
        at = np.frombuffer(offsets, np.int64, rows + 1, piece.offset * 8)
        held = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
        sources.append(held)
        begins[:, k] = at[:-1] - at[0] + base
        lengths[:, k] = np.diff(at)
        base += len(held)
    lengths, begins = lengths.ravel(), begins.ravel()
    targets = np.concatenate(([0], np.cumsum(lengths)))
    out = np.empty(targets[-1], np.uint8)
    index = np.repeat(begins - targets[:-1], lengths) + np.arange(targets[-1])
    np.take(np.concatenate(sources), index, out=out)
    return out, targets


def _char_counts(out: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points before each byte offset: bytes that do not continue a character."""
    before = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
    return before[offsets]


_PART = (
    "conv_id {id}, part bigint, first_turn {turn}, n_turns bigint, text string, "
    "loss_starts array<bigint>, loss_ends array<bigint>"
)


def format_conversations(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """Format ``turns`` (conv_id, turn, role, text) into parts of conversations.

    One row (conv_id, part, first_turn, n_turns, text, loss_starts, loss_ends) per part; parts of a
    conversation, in the order of ``part``, follow each other without a gap. Most conversations are
    one part. Longer ones are cut between turns, by ``PART_BYTES`` and where a task ends, so a
    conversation that holds a third of all rows is formatted by many tasks. ``loss_starts`` and
    ``loss_ends`` are code point offsets in ``text`` of the texts whose role is ``learn``.

    Turns are ordered by turn (null first), then role and text; repeated rows are turns of their own.
    Null role and null text are empty, a null conv_id is one conversation. An empty table gives an
    empty table; other columns are ignored.
    """
    conv, turn = turns.schema["conv_id"].dataType.simpleString(), turns.schema["turn"].dataType.simpleString()

    def batch_of(rows: list[dict], kinds: pa.Schema) -> pa.RecordBatch:
        count = len(rows)
        fixed = [pa.array([x] * count, pa.string()) for x in (MARK, SEP, END)]
        roles = pa.array([escape_role(r["role"] or "") for r in rows], pa.string())
        texts = pa.array([escape(r["text"] or "") for r in rows], pa.string())
        out, offsets = assemble([fixed[0], roles, fixed[1], texts, fixed[2]])
        chars = _char_counts(out, offsets)
        cuts = [0]
        for k in range(1, count):
            first = cuts[-1]
            if rows[k]["conv_id"] != rows[first]["conv_id"] or offsets[5 * k] - offsets[5 * first] >= PART_BYTES:
                cuts.append(k)
        cuts.append(count)
        text_ends = offsets[5 * np.array(cuts)]
        text = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(text_ends.astype(np.int64)), pa.py_buffer(out))
        spans: list[tuple[list[int], list[int]]] = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            told = [k for k in range(a, b) if (rows[k]["role"] or "") == learn]
            spans.append(tuple([int(chars[5 * k + j] - chars[5 * a]) for k in told] for j in (3, 4)))
        heads = [rows[k] for k in cuts[:-1]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([h["conv_id"] for h in heads], kinds.field("conv_id").type), pa.array([h["_place"] for h in heads], pa.int64()),
                pa.array([h["turn"] for h in heads], kinds.field("turn").type), pa.array(np.diff(cuts), pa.int64()), text.cast(pa.string()),
                pa.array([s for s, _ in spans], pa.list_(pa.int64())), pa.array([e for _, e in spans], pa.list_(pa.int64())),
            ],
            ["conv_id", "part", "first_turn", "n_turns", "text", "loss_starts", "loss_ends"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size, last, place, kinds = 0, object(), 0, None
        for batch in batches:
            kinds = batch.schema
            for row in rows_of(iter([batch])):
                changed = row["conv_id"] != last
                if held and (size >= PART_BYTES or (changed and len(held) >= 512)):
                    yield batch_of(held, kinds)
                    held, size = [], 0
                last, place = row["conv_id"], place + 1
                held.append(row | {"_place": place})
                size += len(row["text"] or "")
        if held:
            yield batch_of(held, kinds)

    keys = ["conv_id", "turn", "role", "text"]
    ordered = turns.select(*keys).repartitionByRange(*keys[:2]).sortWithinPartitions(*keys)
    numbered = ordered.mapInArrow(run, _PART.format(id=conv, turn=turn))
    # Tasks hold ascending ranges, and a task numbers its turns, so these two place a part.
    return numbered.withColumn("part", F.spark_partition_id().cast("bigint") * F.lit(1 << 40) + F.col("part"))


_ROLE = re.compile(r"(?:[^\\:]|\\.)*", re.DOTALL)


def turns_of(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, chars) of each turn of a formatted part.

    ``start`` is where the escaped text starts, ``chars`` the length of the whole formatted turn.
    """
    at = 0
    while at < len(text):
        if not text.startswith(MARK, at):
            raise ValueError("a turn does not start with its mark")
        colon = _ROLE.match(text, at + len(MARK)).end()
        start = colon + len(SEP)
        end = text.index(END, start)
        yield unescape(text[at + len(MARK) : colon]), unescape(text[start:end]), start, end + len(END) - at
        at = end + len(END)


def _masked(text: str, start: int, spans: dict[int, int]) -> str | None:
    return unescape(text[start : spans[start]]) if start in spans else None


def read_conversations(parts: DataFrame) -> DataFrame:
    """Read formatted parts back: rows (conv_id, part, position, role, text, learned, chars), one per turn.

    ``learned`` is the text under the loss mask that starts where the turn's text starts, unescaped,
    or null; ``chars`` is the length of the formatted turn in code points.
    """
    conv = parts.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "part", "position", "role", "text", "learned", "chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([
                batch.schema.field("conv_id"), ("part", pa.int64()), ("position", pa.int64()), ("role", pa.string()),
                ("text", pa.string()), ("learned", pa.string()), ("chars", pa.int64()),
            ])
            for row in rows_of(iter([batch]), 64):
                masked = dict(zip(row["loss_starts"], row["loss_ends"], strict=True))
                found = [
                    (row["conv_id"], row["part"], k, role, text, _masked(row["text"], a, masked), chars)
                    for k, (role, text, a, chars) in enumerate(turns_of(row["text"]))
                ]
                yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in found], schema)

    columns = ["conv_id", "part", "text", "loss_starts", "loss_ends"]
    kinds = f"conv_id {conv}, part bigint, position bigint, role string, text string, learned string, chars bigint"
    return parts.select(*columns).mapInArrow(run, kinds)


def digest_conversations(turns: DataFrame) -> DataFrame:
    """One row of digests per conversation of what ``read_conversations`` returns.

    Turns are hashed one after another as they stream by, so a conversation of any length needs the
    memory of one turn.
    """
    conv = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = object(), None
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kind, done = None, []

        def close() -> None:
            if state is not None:
                done.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def batch_of() -> pa.RecordBatch:
            schema = pa.schema(zip(names, [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()], strict=True))
            return pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in done], schema)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for row in rows_of(iter([batch])):
                if state is None or row["conv_id"] != key:
                    close()
                    key, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{row['role']}\n{row['text']}\n".encode())
                if row["learned"] is not None:
                    state[2] += len(row["learned"])
                    state[3].update(row["learned"].encode())
                state[4] += row["chars"]
            yield batch_of()
            done.clear()
        close()
        if done:
            yield batch_of()

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "position")
    kinds = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return ordered.mapInArrow(run, f"conv_id {conv}, {kinds}")
