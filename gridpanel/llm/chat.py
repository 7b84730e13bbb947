"""Chat formatting by columnar byte assembly.

A conversation becomes one text: for each turn a marked header with the role,
the escaped text and an end mark::

    <|turn|>role<|text|>...<|end|>

Segment lengths (header, role, mark, text, end) of a whole batch are laid out
in numpy, cumulative offsets give every segment's place, and the bytes of
headers and contents are scattered into one preallocated Arrow buffer, whose
value offsets are the conversations' ends.

Escaping puts one more backslash between ``<`` (and any backslashes behind
it) and ``|``, so an escaped text holds no control string, and taking one
backslash away restores it.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import slices, spread

TURN, TEXT, END = b"<|turn|>", b"<|text|>", b"<|end|>"
_ESCAPE, _UNESCAPE = re.compile(rb"<(\\*)\|"), re.compile(rb"<\\(\\*)\|")
_TURN_TEXT = re.compile(rb"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.S)
#: a control conversation whose texts look like another template's control strings
CONTROL = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
CHUNK_BYTES = 16 << 20          # text laid out at once; a longer turn is a chunk of its own
CHUNK_TURNS = 4096              # and turns, as each has marks of its own


def escape(data: bytes) -> bytes:
    return _ESCAPE.sub(rb"<\\\1|", data)


def unescape(data: bytes) -> bytes:
    return _UNESCAPE.sub(rb"<\1|", data)


def _escaped(col: pa.Array) -> pa.Array:
    """Binary values with control openings escaped; only values that hold one are touched in Python."""
    col = pc.fill_null(col, "").cast(pa.binary())
    hit = pc.match_substring_regex(col, rb"<\\*\|")
    if not pc.any(hit).as_py():
        return col
    return pa.array([escape(v) if h else v for v, h in zip(col.to_pylist(), hit.to_pylist())], pa.binary())


def _bytes_and_lengths(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and len(col.buffers()[2]) else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], np.diff(offsets)


def assemble(role: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte buffer with all formatted turns, and the length of each turn."""
    n = len(role)
    role_data, role_len = _bytes_and_lengths(_escaped(role))
    text_data, text_len = _bytes_and_lengths(_escaped(text))
    fixed = [np.full(n, len(x), np.int64) for x in (TURN, TEXT, END)]
    lens = np.stack([fixed[0], role_len, fixed[1], text_len, fixed[2]], 1)        # (turn, segment)
    starts = (np.cumsum(lens.ravel()) - lens.ravel()).reshape(lens.shape)
    out = np.empty(int(lens.sum()), np.uint8)                                     # the preallocated buffer
    for seg, mark in ((0, TURN), (2, TEXT), (4, END)):
        out[starts[:, seg, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    out[spread(starts[:, 1], role_len)] = role_data
    out[spread(starts[:, 3], text_len)] = text_data
    return out, lens.sum(1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of ``CHUNK_BYTES`` of text and ``CHUNK_TURNS`` rows at most."""
    for batch in batches:
        for part in slices(batch, "t", CHUNK_BYTES):
            for lo in range(0, part.num_rows, CHUNK_TURNS):
                yield part.slice(lo, CHUNK_TURNS)


def format_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """``(conv_id, formatted)``: one row for each value of ``conv_col``, null included.

    Turns go by ``turn_col`` (nulls first), ties by role, then text. Null roles
    and texts count as empty. Rows are dealt by conversation and sorted on
    disk; a task streams its conversations, so its memory is a batch plus the
    text of the conversation at hand (a single value of the result)."""
    rows = df.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("n"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("r"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    kind = dict(rows.dtypes)["c"]
    rows = rows.repartition("c").sortWithinPartitions("c", "n", "r", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, open_parts = None, []                # the conversation that may go on in the next chunk
        ctype = None
        for batch in _chunks(batches):
            conv = batch.column("c")
            ctype = conv.type
            ids = conv.to_pylist()
            data, lens = assemble(batch.column("r"), batch.column("t"))
            ends = np.cumsum(lens)
            cut = [i for i in range(1, len(ids)) if ids[i] != ids[i - 1]]
            first = [0, *cut]
            last = [*cut, len(ids)]
            offsets = np.r_[0, ends[np.array(last) - 1]]
            out_ids, out_end = [], []
            if open_parts and ids[0] != open_id:
                yield _whole([open_id], [b"".join(open_parts)], ctype, conv_col)
                open_parts = []
            lead = 0
            if open_parts:                            # goes on: only if a boundary follows is it whole
                open_parts.append(data[:offsets[1]].tobytes())
                lead = 1
                if len(first) > 1:
                    yield _whole([open_id], [b"".join(open_parts)], ctype, conv_col)
                    open_parts = []
            if len(first) - 1 > lead:                 # whole conversations, straight from the buffer
                value_offsets = (offsets[lead:len(first)] - offsets[lead]).astype(np.int32)
                body = data[offsets[lead]:offsets[len(first) - 1]]
                texts = pa.Array.from_buffers(pa.string(), len(first) - 1 - lead,
                                              [None, pa.py_buffer(value_offsets), pa.py_buffer(np.ascontiguousarray(body))])
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in first[lead:-1]], ctype), texts],
                                                 names=[conv_col, "formatted"])
            if not (lead and len(first) == 1):
                open_id, open_parts = ids[first[-1]], [data[offsets[len(first) - 1]:].tobytes()]
        if open_parts:
            yield _whole([open_id], [b"".join(open_parts)], ctype, conv_col)

    return rows.mapInArrow(run, f"`{conv_col}` {kind}, formatted string")


def _whole(ids: list, texts: list, ctype: pa.DataType, conv_col: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, ctype), pa.array(texts, pa.binary()).cast(pa.string())],
                                      names=[conv_col, "formatted"])


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """The (role, text) turns of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _TURN_TEXT.findall(formatted)]


def loss_spans(formatted: bytes, role: bytes = b"assistant") -> list[tuple[int, int]]:
    """Byte spans under the loss mask: the (escaped) texts of the role's turns."""
    return [m.span(2) for m in _TURN_TEXT.finditer(formatted) if unescape(m[1]) == role]


def read_back(df: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digest of formatted conversations, from the formatted text alone: conv_id, n_turns, turns_sha256
    (role, newline, text, newline of each turn), loss_chars and loss_sha256 (unescaped text under the
    loss mask) and formatted_chars (code points)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column("formatted").cast(pa.binary()).to_pylist():
                turns = hashlib.sha256()
                parsed = parse(value)
                for role, text in parsed:
                    turns.update(role + b"\n" + text + b"\n")
                loss = b"".join(unescape(value[a:b]) for a, b in loss_spans(value))
                out.append((len(parsed), turns.hexdigest(), len(loss.decode("utf-8")), hashlib.sha256(loss).hexdigest(),
                            len(value.decode("utf-8"))))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(conv_col), *[pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))]],
                names=[conv_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return df.select(conv_col, "formatted").mapInArrow(
        run, f"`{conv_col}` {dict(df.dtypes)[conv_col]}, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")


def with_control(conversations: DataFrame) -> DataFrame:
    """The conversations and the control conversation -1. Rows that the table itself has under -1 are turns of the same
    conversation: all go by turn, then role, then text, like those of any other."""
    control = conversations.sparkSession.createDataFrame(CONTROL, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionAll(control)


def format_digest(conversations: DataFrame) -> DataFrame:
    return read_back(format_conversations(with_control(conversations)))
