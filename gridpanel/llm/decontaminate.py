"""Benchmark decontamination by greedy string tiling.

Words are runs of word characters, in lower case; in scripts that put no space
between words every character is one. Seeds, the word n-grams of
the benchmark items, are joined with the texts: an index from seed to items
is broadcast (its size is checked first; a larger benchmark is taken in
blocks of bounded size) and probed with the rolling n-gram hashes of every
whole text. For each (text, item) pair that shares a seed, greedy string
tiling marks the longest common unmarked passages again and again: a running
Karp-Rabin search finds the longest length that still has a match, its
non-overlapping matches are marked on both sides, and the search goes on
below that length down to ``MIN_TILE`` words. As tiles may come in any order,
reordered passages count in full. A text is contaminated if its tiles cover
at least ``COVERAGE`` of an item's words and ``ENOUGH`` of them (all, of a
shorter item). A pair whose seed windows hold fewer words than that is dropped
before it is tiled: a common opener of thousands of items costs a count each.

Items too short for a seed are looked for as a whole: of ``SHORT`` words or
more anywhere in a text, of fewer only as a text that holds nothing else.

Nothing is shuffled: a passage that very many texts share is work in the
tasks that read them.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices

MIN_TILE = 5                    # words of the shortest tile, and of a seed
COVERAGE = 0.5                  # share of an item's words
ENOUGH = 8                      # words at least, so that one common phrase covers no item of ten
SHORT = 3                       # words of an item that is looked for inside texts
PAIRS = 2_000_000               # (seed place, item) entries that a task looks at together
INDEX_BYTES = 16 << 20          # bound of benchmark text in one broadcast index
CHUNK = 2 << 20
#: fixed ranges: Thai to Lao, Myanmar, Khmer, kana, ideographs
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_WORDS = re.compile(rf"[^\W{UNSPACED}]+|[{UNSPACED}]").findall
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


def _mix(ids: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values of word numbers."""
    x = (ids.astype(np.int64).astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Karp-Rabin hashes of all windows of any length over one sequence of word numbers."""

    def __init__(self, ids: np.ndarray, room: int):
        power = np.cumprod(np.r_[np.uint64(1), np.full(room, _BASE)])
        self.up = power
        self.sums = np.r_[np.uint64(0), np.cumsum(_mix(ids) * power[:len(ids)])]
        self.room = room

    def windows(self, starts: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[starts + size] - self.sums[starts]) * self.up[self.room - starts]


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Starts of windows of ``size`` words without a marked one."""
    if len(marked) < size:
        return np.empty(0, np.int64)
    before = np.r_[0, np.cumsum(marked)]
    return np.flatnonzero(before[size:] == before[:-size])


def tiles(item: np.ndarray, doc: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, text start, words), longest first; negative numbers in ``doc`` match nothing."""
    room = max(len(item), len(doc))
    hashes = Rolling(item, room), Rolling(doc, room)
    marked = np.zeros(len(item), bool), doc < 0
    top, out = min(len(item), len(doc)), []

    def matches(size: int):
        a, b = _free(marked[0], size), _free(marked[1], size)
        ha, hb = hashes[0].windows(a, size), hashes[1].windows(b, size)
        hit = np.isin(ha, hb)
        return a[hit], ha[hit], b, hb

    while top >= least:
        low, high = least - 1, top                    # longest length with a match lies in (low, high], or is none
        while low < high:
            mid = (low + high + 1) // 2
            if len(matches(mid)[0]):
                low = mid
            else:
                high = mid - 1
        if low < least:
            break
        a, ha, b, hb = matches(low)
        order = np.argsort(hb, kind="stable")
        for start, h in zip(a.tolist(), ha):
            if marked[0][start:start + low].any():
                continue
            lo, hi = np.searchsorted(hb[order], h, "left"), np.searchsorted(hb[order], h, "right")
            for place in b[order[lo:hi]].tolist():
                if not marked[1][place:place + low].any() and (item[start:start + low] == doc[place:place + low]).all():
                    marked[0][start:start + low] = True
                    marked[1][place:place + low] = True
                    out.append((start, place, low))
                    break
        top = low - 1                                 # what is left of this length has no partner
        if not len(_free(marked[0], least)):
            break
    return out


class Index:
    """Seeds of the benchmark items: word numbers, items as number sequences, and seed hash to items.

    A seed of an item is every window of ``least`` words; a shorter item is its own seed."""

    def __init__(self, items: list[tuple], least: int, coverage: float = COVERAGE):
        self.least, self.number, self.items = least, {}, []
        found: dict = {}                                # window size -> (seeds, their items)
        self.alone: dict = {}                           # items of very few words, by their words
        for item_id, text in items:
            w = words(text)
            if not w:
                continue
            ids = np.array([self.number.setdefault(x, len(self.number)) for x in w], np.int64)
            if len(w) < min(SHORT, least):
                self.alone.setdefault(tuple(ids.tolist()), []).append(len(self.items))
            else:
                size = min(least, len(w))
                seed = np.unique(windows(ids, size))
                seeds, owner = found.setdefault(size, ([], []))
                seeds.append(seed)
                owner.append(np.full(len(seed), len(self.items)))
            self.items.append((item_id, ids))
        length = np.array([len(ids) for _, ids in self.items], np.int64)
        self.needed = np.maximum(np.ceil(coverage * length - 1e-9).astype(np.int64), np.minimum(length, ENOUGH))
        self.seeds = {}
        for size, (seeds, owner) in found.items():
            seeds, owner = np.concatenate(seeds), np.concatenate(owner)
            order = np.argsort(seeds, kind="stable")
            self.seeds[size] = seeds[order], owner[order]

    def covered(self, texts: list[str | None]) -> Iterator[tuple[int, int, list]]:
        """(text, item, tiles) of every pair whose tiles cover what the item needs."""
        split = [words(t) for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        get = self.number.get
        # one sequence for all texts, with a gap after each
        ids = np.full(int(sizes.sum()) + len(split), -1, np.int64)
        at = 0
        for w, n in zip(split, sizes.tolist()):
            ids[at:at + n] = np.fromiter(map(get, w, repeat(-1)), np.int64, n)
            at += n + 1
        ends = np.cumsum(sizes + 1)
        if self.alone:
            for doc in np.flatnonzero((sizes > 0) & (sizes < SHORT)).tolist():
                own = tuple(ids[ends[doc] - 1 - sizes[doc]:ends[doc] - 1].tolist())
                for item in self.alone.get(own, ()):
                    yield doc, item, [(0, 0, len(own))]
        for size in sorted(self.seeds):
            yield from self._seeded(ids, ends, size)

    def _seeded(self, ids: np.ndarray, ends: np.ndarray, size: int) -> Iterator[tuple[int, int, list]]:
        seeds, owners = self.seeds[size]
        places = _free(ids < 0, size)
        if not len(places):
            return
        h = windows(ids, size)[places]
        lo, hi = np.searchsorted(seeds, h, "left"), np.searchsorted(seeds, h, "right")
        hit = hi > lo
        places, lo, hi = places[hit], lo[hit], hi[hit]
        docs, counts = np.searchsorted(ends, places, side="right"), hi - lo
        # texts in groups of bounded work
        first = np.flatnonzero(np.r_[True, np.diff(docs) != 0]) if len(docs) else np.empty(0, np.int64)
        before = np.r_[0, np.cumsum(counts)]
        start = 0
        while start < len(first):
            stop = max(start + 1, int(np.searchsorted(before[first], before[first[start]] + PAIRS, side="right")) - 1)
            part = slice(first[start], first[stop] if stop < len(first) else len(docs))
            yield from self._tiled(ids, docs[part], places[part], lo[part], counts[part], owners, size)
            start = stop

    def _tiled(self, ids, doc, places, lo, count, owners, size) -> Iterator[tuple[int, int, list]]:
        owner = owners[np.repeat(lo - np.cumsum(count) + count, count) + np.arange(int(count.sum()))]
        doc, places = np.repeat(doc, count), np.repeat(places, count)
        order = np.lexsort((places, owner, doc))
        doc, owner, places = doc[order], owner[order], places[order]
        new = np.r_[True, (np.diff(doc) != 0) | (np.diff(owner) != 0)]
        cut = np.flatnonzero(new)
        # words in a pair's windows: each adds what does not lie in the next one
        step = np.full(len(places), size)
        step[:-1] = np.where(new[1:], size, np.minimum(np.diff(places), size))
        enough = np.add.reduceat(step, cut) >= self.needed[owner[cut]]
        for a, b in zip(cut[enough].tolist(), np.r_[cut[1:], len(doc)][enough].tolist()):
            # all that can match: the seed windows, joined where they overlap, with gaps between
            near = np.unique(places[a:b, None] + np.arange(size))
            gaps = np.flatnonzero(np.diff(near) > 1) + 1
            item = int(owner[a])
            got = tiles(self.items[item][1], np.insert(ids[near], gaps, -1), size)
            if sum(n for _, _, n in got) >= self.needed[item]:
                yield int(doc[a]), item, got


def windows(ids: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` numbers."""
    mixed = _mix(ids)
    n = max(0, len(ids) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _BASE + mixed[k:k + n]
    return out


def index_blocks(benchmark: DataFrame, id_col: str, text_col: str, least: int, coverage: float, index_bytes: int) -> Iterator[Index]:
    """Indexes over the benchmark, each of about ``index_bytes`` of text at most.

    Items without a word take no part."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter(F.col("t").isNotNull())
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // index_bytes))
    for b in range(blocks):
        part = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        yield Index([(r["i"], r["t"]) for r in part.orderBy("i", "t").collect()], least, coverage)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", least: int = MIN_TILE, coverage: float = COVERAGE, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``(doc_id, item_id, n_tiles, matched_words, item_words, coverage)`` of every row of ``docs`` and every item that
    its tiles cover to ``coverage`` or more (and ``ENOUGH`` words; items shorter than ``least`` whole).

    Null and empty texts give nothing, as does an empty benchmark. Repeated
    rows give their rows again, and equal items one row each. Null ids are
    kept; other columns are ignored."""
    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"))
    schema = "doc_id long, item_id long, n_tiles int, matched_words int, item_words int, coverage double"
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
    out = None
    for index in index_blocks(benchmark, item_col, item_text_col, least, coverage, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in slices(batch, "t", CHUNK):
                    ids, found = part.column("k").to_pylist(), []
                    for doc, item, got in index.covered(part.column("t").to_pylist()):
                        item_id, seq = index.items[item]
                        matched = sum(n for _, _, n in got)
                        found.append((ids[doc], item_id, len(got), matched, len(seq), matched / len(seq)))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)],
                                                         names=["doc_id", "item_id", "n_tiles", "matched_words", "item_words", "coverage"])

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               least: int = MIN_TILE, coverage: float = COVERAGE, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that no item's tiles cover to ``coverage`` or more."""
    for index in index_blocks(benchmark, item_col, item_text_col, least, coverage, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in slices(batch, text_col, CHUNK):
                    clean = np.ones(part.num_rows, bool)
                    for doc, _, _ in index.covered(part.column(text_col).to_pylist()):
                        clean[doc] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
