"""Byte-level BPE encoding and decoding with length-bucketed numpy matrices.

A text is cut by the vocabulary's split pattern. Pieces not seen before are
laid out in padded matrices, one for each length bucket. In each round every
row merges its leftmost pair of minimum rank (found by a hashed pair table),
rows shift left over the gap, and finished rows leave the matrix. Pieces
longer than ``LONG`` bytes run the same merges on one flat array, where a
round applies the leading merges of equal rank that provably do not create a
lower-ranked pair in between.

Memory of a task is bounded: texts are processed in slices of ``CHUNK`` bytes
(a longer text alone), and the memo of known pieces is emptied at
``MEMO_PIECES``.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, spread

CHUNK = 1 << 20
MEMO_PIECES = 200_000
LONG = 512
MAX_VOCABULARY_BYTES = 64 << 20     # proven bound of what is broadcast
NONE = np.int32(2**31 - 1)          # rank of a pair that is no token
_SHIFT, _MULTIPLIER = 24, np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open-addressing hash table from (left id, right id) to the id of the merged token."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(merged), 1) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys = (left.astype(np.int64) << _SHIFT) | right
        slot, todo, self.probes = self._slot(keys), np.arange(len(keys)), 1
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], merged[won]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
            self.probes += bool(len(todo))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, ``NONE`` where the pair is no token or either side is padding (-1)."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        keys = (left.astype(np.int64) << _SHIFT) | right
        keys[(left < 0) | (right < 0)] = -2
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0) & (keys >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out.reshape(shape)


class Vocabulary:
    """Token bytes by id, the id of every single byte, and the pair table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern, self.ids = pattern, ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.byte_id = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte_id < 0).any():
            raise ValueError("a byte-level vocabulary holds all 256 single bytes")
        pairs = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read a rank file: one base64 token and its rank on each line."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}, pattern)


def merge_rows(ids: np.ndarray, lens: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """BPE of all rows of a padded matrix (-1 beyond ``lens``): final ids (same padding) and lengths."""
    out, out_len = np.full(ids.shape, -1, np.int32), lens.copy()
    rows, m = np.arange(len(ids)), ids
    rank = pairs.get(m[:, :-1], m[:, 1:])
    while True:
        if rank.shape[1]:
            at = rank.argmin(1)
            best = rank[np.arange(len(m)), at]
            live = best != NONE
        else:
            live = np.zeros(len(m), bool)
        done = ~live
        if done.any():
            out[rows[done], :m.shape[1]] = m[done]
            out_len[rows[done]] = (m[done] >= 0).sum(1)
            if not live.any():
                return out, out_len
            m, rank, rows, at, best = m[live], rank[live], rows[live], at[live], best[live]
        # merge at (at, at + 1): the row shrinks by one column, and so does the matrix
        r, cols = np.arange(len(m)), np.arange(m.shape[1] - 1)
        m[r, at] = best
        m = np.take_along_axis(m, cols + (cols > at[:, None]), 1)
        cols = cols[:-1]
        rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), 1)
        width = m.shape[1]
        k = np.flatnonzero(at > 0)
        rank[k, at[k] - 1] = pairs.get(m[k, at[k] - 1], best[k])
        k = np.flatnonzero(at < width - 1)
        rank[k, at[k]] = pairs.get(best[k], m[k, at[k] + 1])


def merge_long(tok: np.ndarray, pairs: PairTable) -> np.ndarray:
    """BPE of one long piece, with the result of merging one leftmost minimum pair after another.

    A round takes the non-overlapping positions of the minimum rank, left to
    right, up to the first merge that creates a pair of lower rank."""
    tok = tok.astype(np.int32)
    rank = pairs.get(tok[:-1], tok[1:])
    while len(rank):
        low = rank.min()
        if low == NONE:
            break
        pos = np.flatnonzero(rank == low)
        fresh = np.r_[True, np.diff(pos) > 1]
        first = pos[np.maximum.accumulate(np.where(fresh, np.arange(len(pos)), 0))]
        pos = pos[(pos - first) % 2 == 0]
        padded = np.r_[tok, -1]
        left = np.where(pos > 0, tok[pos - 1], -1)
        left[1:][np.diff(pos) == 2] = low
        new = np.full(len(pos), low, np.int32)
        lower = np.minimum(pairs.get(left, new), pairs.get(new, padded[pos + 2])) < low
        if lower.any():
            pos = pos[:int(lower.argmax()) + 1]
        tok[pos] = low
        keep = np.ones(len(tok), bool)
        keep[pos + 1] = False
        tok = tok[keep]
        at = pos - np.arange(len(pos))          # places of the merged tokens
        keep = np.ones(len(rank), bool)
        keep[pos] = False
        rank = rank[keep]
        near = np.unique(np.r_[at - 1, at])
        near = near[(near >= 0) & (near < len(rank))]
        rank[near] = pairs.get(tok[near], tok[near + 1])
    return tok


def encode_pieces(pieces: list[bytes], voc: Vocabulary) -> list[np.ndarray]:
    """Ids of each piece; a piece that is itself a token is that token."""
    out: list = [None] * len(pieces)
    rest = []
    for k, p in enumerate(pieces):
        i = voc.ids.get(p)
        if i is None and p:
            rest.append(k)
        else:
            out[k] = np.array([] if i is None else [i], np.int32)
    lens = np.array([len(pieces[k]) for k in rest], np.int64)
    bucket = np.ceil(np.log2(np.maximum(lens, 2))).astype(int)
    rest = np.array(rest, np.int64)
    for b in np.unique(bucket):
        rows = np.flatnonzero(bucket == b)
        if (1 << b) > LONG:
            for k in rest[rows]:
                out[k] = merge_long(voc.byte_id[np.frombuffer(pieces[k], np.uint8)], voc.pairs)
            continue
        width = int(lens[rows].max())
        ids = np.full((len(rows), width), -1, np.int32)
        flat = np.frombuffer(b"".join(pieces[k] for k in rest[rows]), np.uint8)
        ids[np.arange(width) < lens[rows][:, None]] = voc.byte_id[flat]
        done, n = merge_rows(ids, lens[rows], voc.pairs)
        for k, row, m in zip(rest[rows].tolist(), done, n.tolist()):
            out[k] = row[:m]
    return out


class Encoder:
    """Encodes lists of texts; remembers the ids of pieces, up to ``MEMO_PIECES``."""

    def __init__(self, voc: Vocabulary):
        self.voc, self.split = voc, regex.compile(voc.pattern).findall
        self.clear()

    def clear(self):
        owner = self

        class Memo(dict):
            def __missing__(self, piece):
                self[piece] = n = len(self)
                owner.new.append(piece)
                return n
        self.memo, self.new = Memo(), []
        self.pool = np.empty(1 << 16, np.int32)
        self.start = np.empty(1 << 14, np.int64)
        self.count = np.empty(1 << 14, np.int64)
        self.used = 0

    def _learn(self):
        """Encode the pieces met for the first time and append their ids to the pool."""
        ids = encode_pieces([p.encode("utf-8") for p in self.new], self.voc)
        n0, n1 = len(self.memo) - len(ids), len(self.memo)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        need = self.used + int(counts.sum())
        if need > len(self.pool):
            self.pool = np.resize(self.pool, 2 * need)
        if n1 > len(self.start):
            self.start, self.count = np.resize(self.start, 2 * n1), np.resize(self.count, 2 * n1)
        if ids:
            self.pool[self.used:need] = np.concatenate(ids)
        self.start[n0:n1] = self.used + np.cumsum(counts) - counts
        self.count[n0:n1] = counts
        self.used, self.new = need, []

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids laid end to end, and the number of ids of each text."""
        if len(self.memo) > MEMO_PIECES:
            self.clear()
        pieces, n = [], np.empty(len(texts), np.int64)
        for k, t in enumerate(texts):
            before = len(pieces)
            if t:
                pieces += self.split(t)
            n[k] = len(pieces) - before
        index = np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces))
        if self.new:
            self._learn()
        counts = self.count[index]
        ids = self.pool[spread(self.start[index], counts)]
        total = np.r_[0, np.cumsum(counts)]
        ends = np.cumsum(n)
        return ids, total[ends] - total[ends - n]


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Arrow binary values of ``sizes`` bytes each, over one buffer."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _tables(df: DataFrame, voc: Vocabulary):
    return df.sparkSession.sparkContext.broadcast(voc)


def encode(df: DataFrame, voc: Vocabulary, text_col: str = "text", id_col: str = "doc_id",
           out_col: str = "token_ids") -> DataFrame:
    """``(id_col, out_col)``: the ids of every whole text as little-endian unsigned 32-bit integers.

    A null or empty text gives an empty value. Row order, repeated rows and
    null ids are kept; other columns of ``df`` are ignored.
    """
    shared = _tables(df, voc)
    rows = df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(shared.value)
        for batch in batches:
            for part in slices(batch, "t", CHUNK):
                ids, n = enc.encode(part.column("t").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("k"), _binary(np.ascontiguousarray(ids, "<u4"), 4 * n)], names=[id_col, out_col])

    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)['k']}, `{out_col}` binary")


def decode(df: DataFrame, voc: Vocabulary, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``ids_col`` (little-endian unsigned 32-bit ids; null: none) replaced by its bytes in ``out_col``.

    Every other column is kept, so none of them may be called ``out_col``."""
    shared = _tables(df, voc)
    others = [c for c in df.columns if c != ids_col]
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c != ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.tokens.__getitem__
        for batch in batches:
            for part in slices(batch, ids_col, 4 * CHUNK):
                texts = [b"".join(map(token, np.frombuffer(v, "<u4").tolist())) if v else b""
                         for v in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in others] + [pa.array(texts, pa.binary())],
                                                 names=others + [out_col])

    return df.mapInArrow(run, f"{schema}, `{out_col}` binary")


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def round_trip(df: DataFrame, voc: Vocabulary, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, token_ids, decoded)`` of every row: ``encode`` and ``decode`` of its ids, in one pass over the rows."""
    shared = _tables(df, voc)
    rows = df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = shared.value
        enc, token = Encoder(voc), voc.tokens.__getitem__
        for batch in batches:
            for part in slices(batch, "t", CHUNK):
                ids, n = enc.encode(part.column("t").to_pylist())
                token_ids = _binary(np.ascontiguousarray(ids, "<u4"), 4 * n)
                texts = [b"".join(map(token, np.frombuffer(v, "<u4").tolist())) for v in token_ids.to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("k"), token_ids, pa.array(texts, pa.binary())],
                                                 names=[id_col, "token_ids", "decoded"])

    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)['k']}, token_ids binary, decoded binary")


def encode_checked(docs: DataFrame, voc: Vocabulary, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, n_tokens, token_ids)`` of every row; fails if decoding does not give a text back.

    Ids are those of ``encode``; a null text is empty."""
    shared = _tables(docs, voc)
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = shared.value
        enc, token = Encoder(voc), voc.tokens.__getitem__
        for batch in batches:
            for part in slices(batch, "t", CHUNK):
                texts = part.column("t").to_pylist()
                ids, n = enc.encode(texts)
                if b"".join(map(token, ids.tolist())) != "".join(t or "" for t in texts).encode("utf-8"):
                    raise ValueError("decoded bytes differ from the text")
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(n), _binary(np.ascontiguousarray(ids, "<u4"), 4 * n)],
                                                 names=[id_col, "n_tokens", "token_ids"])

    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)['k']}, n_tokens long, token_ids binary")


def encode_decode_digest(docs: DataFrame, voc: Vocabulary) -> DataFrame:
    """Digest of a round trip: doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of ``docs``.

    A null text counts as empty (0 tokens and the digest of no bytes)."""
    return round_trip(docs, voc).select("doc_id", n_tokens(F.col("token_ids")).alias("n_tokens"),
                                        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
