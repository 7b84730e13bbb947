"""Near duplicates by an LSH forest over MinHash signatures, with exact confirmation.

1. ``sketch``: every whole text gives its set of word shingles, as 64-bit
   hashes; of it, the size, a 128-bit fingerprint and a signature of
   ``HASHES`` minima. Texts with equal sets are one class from here on.
2. ``neighbours``: ``TREES`` sort orders of the signatures. Order t starts with its
   own ``DEPTH`` minima; classes that share them are a region, and regions of
   more than ``REGION`` classes are taken at a greater depth, up to ``DEEPEST``. Within a
   region, classes meet their neighbours of longest common prefix; pairs
   whose signatures agree in ``AGREE`` of the places or more are candidates. Sort ranges are cut
   by sampled splitters of the whole order, so a region of any size is
   spread over tasks; the first and last rows of all ranges are then taken as an order of
   their own, in which neighbours on both sides of a cut meet. Each task keeps a spanning forest of its candidates, as
   only their connected groups matter.
3. ``confirm``: a candidate group is dealt into blocks of ``BLOCK`` classes, and two
   blocks meet in a task that compares full sets, all of one with all of the
   other, by products of membership matrices. Each task returns a spanning
   forest of its links, never the pairs. In groups of many blocks that is done
   for each block with itself and with the first one; classes that this joins to
   the group's main part need no comparison with one another. The others are
   joined with their group by ``prefix_pairs``: two sets of similarity t share a
   shingle among the rarest ``n - ceil(t n) + 1`` of each, so classes that share
   only a common template, whose shingles are frequent, never meet, and no
   link is lost. Their pairs are compared on full sets. Where rare shingles are
   shared by many (the join would give over ``LIGHT`` rows a class, which is
   counted first), their blocks meet all blocks instead.
4. ``components``: smallest label of linked classes, by rounds of neighbour
   minimum and pointer jumping.

Two texts of similarity 0.8 share a region of a tree with 0.8^3, so that all
20 trees miss them with 6e-7 where regions hold ``REGION`` classes or fewer;
that their signatures agree in fewer than half of 64 places has about 1e-8. In
larger regions a class meets its 31 nearest on either side in the order of up
to eight minima; the README gives the recall measured there.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import materialise, slices, spread

HASHES, TREES, DEPTH, DEEPEST = 64, 20, 3, 8
REGION = 32                     # classes of a region at most, before it is taken deeper
RANGE_ROWS = 4096               # rows of a sort range at least, on average
ONE_RANGE = 65_536              # rows around cuts that one task takes
AGREE = 0.5
BLOCK, BLOCK_SHINGLES = 64, 1 << 20
COLUMNS = 1 << 14               # shingles of a membership matrix at once
LIGHT = 16                      # rows of the prefix join a class of a group, on average, at most
COUNTERS = 1 << 18              # of shingle frequencies: a fixed 2 MB
BROADCAST_ROWS = 300_000        # rows of about 40 bytes that may be broadcast
CHUNK = 2 << 20
MEMO_WORDS = 500_000
SEED = 20_24
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    flips = rng.integers(0, 2**63, HASHES, dtype=np.uint64)
    odd = rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    # a tree's own first minima are no other tree's; deeper ones come from the rest
    orders = []
    for t in range(TREES):
        own = np.arange(DEPTH * t, DEPTH * t + DEPTH)
        orders.append(np.r_[own, rng.permutation(np.setdiff1d(np.arange(HASHES), own))[:DEEPEST - DEPTH]])
    return flips, odd, np.array(orders)


_FLIPS, _MULTIPLIERS, _ORDERS = _constants()


class Shingler:
    """Sets of word shingles of texts: words lie between ASCII white space, A-Z count as a-z."""

    def __init__(self, k: int):
        self.k = k
        self.clear()

    def clear(self):
        class Memo(dict):
            def __missing__(memo, word):
                memo[word] = n = len(memo)
                self.fresh.append(xxhash.xxh3_64_intdigest(word))
                return n
        self.memo, self.fresh, self.hashes = Memo(), [], np.empty(0, np.uint64)

    def sets(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text (fewer than ``k`` words: the whole sequence as one)."""
        if len(self.memo) > MEMO_WORDS:
            self.clear()
        split = [t.lower().split() if t else [] for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        index = np.fromiter((i for w in split for i in map(self.memo.__getitem__, w)), np.int64, int(sizes.sum()))
        if self.fresh:
            self.hashes = np.r_[self.hashes, np.array(self.fresh, np.uint64)]
            self.fresh = []
        h = self.hashes[index]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        n = np.where(sizes >= self.k, sizes - self.k + 1, 0)
        at = spread(starts, n)
        s = np.zeros(len(at), np.uint64)
        for j in range(self.k):
            s = _mixed(s * _ODD + h[at + j])
        cut = np.cumsum(n)
        out = []
        for d in range(len(split)):
            if n[d]:
                out.append(np.unique(s[cut[d] - n[d]:cut[d]]))
            elif sizes[d]:
                v = np.uint64(0)
                with np.errstate(over="ignore"):
                    for x in h[starts[d]:ends[d]]:
                        v = _mixed(v * _ODD + x)
                    out.append(np.array([_mixed(v + np.uint64(sizes[d]))]))
            else:
                out.append(np.empty(0, np.uint64))
        return out


def _mixed(x):
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` minima (32 bits each) of a set that is not empty."""
    out = None
    for lo in range(0, len(shingles), 4096):
        part = (((shingles[lo:lo + 4096, None] ^ _FLIPS) * _MULTIPLIERS) >> np.uint64(32)).min(0)
        out = part if out is None else np.minimum(out, part)
    return out.astype(np.uint32)


def sketch(df: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``(id, h, n, hi, lo, sig)`` of every row: ``h`` is a hash of the text; hi, lo and sig are null for an empty set."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), _text_hash(F.col(text_col)).alias("h"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for batch in batches:
            for part in slices(batch, "t", CHUNK):
                n, hi, lo, sig = [], [], [], []
                for s in shingler.sets(part.column("t").cast(pa.binary()).to_pylist()):
                    n.append(len(s))
                    if not len(s):
                        hi.append(None), lo.append(None), sig.append(None)
                        continue
                    print_ = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    hi.append(int.from_bytes(print_[:8], "little", signed=True))
                    lo.append(int.from_bytes(print_[8:], "little", signed=True))
                    sig.append(signature(s).tobytes())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("h"), pa.array(n, pa.int64()), pa.array(hi, pa.int64()),
                                                  pa.array(lo, pa.int64()), pa.array(sig, pa.binary())],
                                                 names=["id", "h", "n", "hi", "lo", "sig"])

    return rows.mapInArrow(run, "id long, h long, n long, hi long, lo long, sig binary")


def _text_hash(text) -> F.Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def forest_rows(classes: DataFrame) -> DataFrame:
    """``(key, rep, sig)``: for each class and tree, its place in the tree's order and a byte of each minimum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                m = part.num_rows
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint32).reshape(m, HASHES)
                keys = np.empty((m, TREES, 1 + 4 * DEEPEST), np.uint8)
                keys[:, :, 0] = np.arange(TREES)
                keys[:, :, 1:] = np.ascontiguousarray(sig[:, _ORDERS].astype(">u4")).view(np.uint8).reshape(m, TREES, -1)
                low = np.repeat(np.ascontiguousarray(sig.astype(np.uint8)), TREES, axis=0)
                yield pa.RecordBatch.from_arrays(
                    [_fixed(keys.reshape(m * TREES, -1)), pa.array(np.repeat(part.column("rep").to_numpy(), TREES)), _fixed(low)],
                    names=["key", "rep", "sig"])

    return classes.select("rep", "sig").mapInArrow(run, "key binary, rep long, sig binary")


def _fixed(rows: np.ndarray) -> pa.Array:
    offsets = (np.arange(len(rows) + 1) * rows.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _rows_of(col: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(len(col), width)


def smallest_label(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 with edges (a, b): the smallest node of each one's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == label).all():
            return label
        label = new


def region_pairs(keys: np.ndarray, sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of rows in one tree order: longest-common-prefix neighbours in regions of adaptive depth."""
    n = len(keys)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    parts = np.ascontiguousarray(keys[:, 1:]).view(">u4")
    same = np.logical_and.accumulate(parts[1:] == parts[:-1], axis=1)
    shared = np.where(keys[1:, 0] == keys[:-1, 0], same.sum(1), 0)        # prefix that a row shares with the next
    depth = np.full(n, DEEPEST)
    for d in range(DEEPEST, DEPTH - 1, -1):
        starts = np.flatnonzero(np.r_[True, shared < d])
        sizes = np.diff(np.r_[starts, n])
        depth[np.repeat(sizes, sizes) <= REGION] = d
    a, b, run = [], [], shared
    for offset in range(1, min(REGION, n)):
        if offset > 1:
            run = np.minimum(run[:-1], shared[offset - 1:])
        i = np.flatnonzero(run >= np.minimum(depth[:n - offset], depth[offset:]))
        if not (run >= DEPTH).any():
            break
        for lo in range(0, len(i), 1 << 16):
            p = i[lo:lo + (1 << 16)]
            p = p[(sigs[p] == sigs[p + offset]).sum(1) >= AGREE * HASHES]
            a.append(p)
            b.append(p + offset)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, np.int64), np.empty(0, np.int64))


def neighbours(classes: DataFrame) -> DataFrame:
    """``(a, b)``: edges that connect all candidate pairs of the forest."""
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _order_edges(forest_rows(classes), TREES * classes.count(), parts)


def _order_edges(rows: DataFrame, n: int, parts: int) -> DataFrame:
    """``(a, b)`` of the ``n`` forest rows ``rows``, sorted in at most ``parts`` ranges.

    Each range also returns its first and last ``2 * REGION`` rows. In key order the last ones of a range lie next to the
    first ones of the next, or, where ranges are shorter, of those after it; they are taken in the same way until one range holds them."""
    ranges = min(parts, -(-n // RANGE_ROWS))
    cut = ranges > 1
    placed = rows.repartitionByRange(ranges, "key", "rep") if cut else rows.repartition(1)
    seam = 2 * REGION

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "key", "sig"]

        def edges(keys, reps, sigs):
            a, b = region_pairs(keys, sigs)
            root = reps[smallest_label(len(reps), a, b)]
            found = root != reps
            none = pa.nulls(int(found.sum()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(root[found]), pa.array(reps[found]), none, none], names=names)

        def ends(keys, reps, sigs):
            return pa.RecordBatch.from_arrays([pa.array(reps), pa.array(reps), _fixed(keys), _fixed(sigs)], names=names)

        held, first, last = None, 0, 0                  # rows returned of the start, rows after them
        for batch in batches:
            for lo in range(0, batch.num_rows, 20_000):
                part = batch.slice(lo, 20_000)
                new = (_rows_of(part.column("key"), 1 + 4 * DEEPEST), part.column("rep").to_numpy(), _rows_of(part.column("sig"), HASHES))
                # the last rows before stay in view, so that regions go on over the seam
                held = new if held is None else tuple(np.concatenate([x[-seam:], y]) for x, y in zip(held, new))
                yield edges(*held)
                start = min(seam - first, part.num_rows)
                first, last = first + start, last + part.num_rows - start
                if cut and start:
                    yield ends(*(x[:start] for x in new))
        if cut and last:
            yield ends(*(x[-min(seam, last):] for x in held))

    found = materialise(placed.sortWithinPartitions("key", "rep").mapInArrow(run, "a long, b long, key binary, sig binary"), "forest")
    within = found.filter("key is null").select("a", "b")
    if not cut:
        return within
    around = found.filter("key is not null").select("key", F.col("a").alias("rep"), "sig")
    left = around.count()
    return within.unionAll(_order_edges(around, left, parts if left > ONE_RANGE else 1))


def components(edges: DataFrame, name: str) -> DataFrame:
    """``(node, comp)``: the smallest node of the component of every node of ``edges`` (a, b).

    Each round takes the smallest label around a node, then the label of that
    label; it ends when the sum of labels stays, as they never grow."""
    way = lambda x, y: F.struct(F.col(x).alias("src"), F.col(y).alias("dst"))              # noqa: E731
    # both directions and loops in one pass: a union would compute the edges four times
    both = edges.select(F.explode(F.array(way("a", "b"), way("b", "a"), way("a", "a"), way("b", "b"))).alias("e")).select("e.*")
    both = materialise(both.distinct(), f"{name}-edges")
    labels = both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("comp"))
    before = None
    while True:
        labels = materialise(labels, f"{name}-labels")
        total = labels.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]
        if total == before or total is None:
            return labels
        before = total
        near = (both.join(labels, both["dst"] == labels["node"]).groupBy("src").agg(F.min("comp").alias("near")))
        up = labels.select(F.col("node").alias("up"), F.col("comp").alias("above"))
        labels = (near.join(up, near["near"] == up["up"])
                  .select(F.col("src").alias("node"), F.least("near", "above").alias("comp")))


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``left`` and ``right`` (indices into ``sets``) of Jaccard similarity ``percent`` / 100 or more."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    owner = np.repeat(np.arange(len(sets)), size)
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = count[column] > 1                            # a shingle of one set alone is in no intersection
    owner, column = owner[kept], column[kept]
    number = np.cumsum(count > 1) - 1
    column = number[column]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(left), len(right)), np.int64)
    n_columns = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, n_columns, COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, n_columns - lo)), np.float32)
        m[owner[a:b], column[a:b] - lo] = 1
        common += (m[left] @ m[right].T).astype(np.int64)
    union = size[left][:, None] + size[right][None, :] - common
    i, j = np.nonzero((100 * common >= percent * union) & (common > 0))
    return left[i], right[j]


def _sets_of(df: DataFrame, members: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``members`` (id, h and other columns) with ``s``, the shingle set of each from its whole text."""
    rows = df.select(F.col(id_col).cast("long").alias("__id"), _text_hash(F.col(text_col)).alias("__h"), F.col(text_col).alias("t"))
    small, names = members.count() <= BROADCAST_ROWS, [c for c in members.columns if c not in ("id", "h")]
    same = (F.col("__id") == F.col("id")) & (F.col("__h") == F.col("h"))
    # a row that repeats would give its class twice: harmless, as links of a class with itself are none
    texts = rows.join(F.broadcast(members) if small else members, same).select(*names, "t")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for batch in batches:
            for part in slices(batch, "t", CHUNK):
                sets = shingler.sets(part.column("t").cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names],
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=[*names, "s"])

    kinds = dict(members.dtypes)
    return texts.mapInArrow(to_sets, ", ".join(f"{c} {kinds[c]}" for c in names) + ", s binary")


def _compare(met: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: a spanning forest of the links between block ``x`` and block ``y`` of each group.

    ``met``: rep, comp, own (the member's block), x, y, s."""
    def compare(table: pa.Table) -> pa.Table:
        reps, own = table.column("rep").to_numpy(), table.column("own").to_numpy()
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("s").to_pylist()]
        left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
        a, b = linked(sets, left, right, percent) if len(left) and len(right) else (left[:0], left[:0])
        root = reps[smallest_label(len(reps), a, b)]
        found = root != reps
        return pa.table({"a": pa.array(root[found], pa.int64()), "b": pa.array(reps[found], pa.int64())})

    # dealt by the meeting, also where the rows lie by group already: a large group's meetings spread over tasks
    return met.repartition("comp", "x", "y").groupBy("comp", "x", "y").applyInArrow(compare, "a long, b long")


def _blocks(members: str, shingles: str) -> F.Column:
    return F.ceil(F.greatest(F.col(members) / BLOCK, F.col(shingles) / BLOCK_SHINGLES)).cast("long")


def confirm(df: DataFrame, candidates: DataFrame, classes: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """``(a, b)``: edges that connect all classes linked within a candidate group, from full sets.

    Groups of one block are compared at once. In larger ones every block first
    meets itself and block 0; the part of the group that this joins is
    settled, and the rest finds its partners by ``prefix_pairs``, so that the
    work follows the pairs that share rare shingles, not the group's square."""
    sized = candidates.join(classes.select("rep", "id", "h", "n"), candidates["node"] == F.col("rep")).select("rep", "id", "h", "comp", "n")
    groups = sized.groupBy("comp").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    members = materialise(sized.join(groups.select("comp", _blocks("members", "shingles").alias("nb")), "comp")
                          .select("rep", "id", "h", "comp", "n", "nb", F.pmod(F.xxhash64("rep"), F.col("nb")).alias("own")), "members")
    sets = _sets_of(df, members.select("rep", "id", "h", "comp", "nb", "own"), id_col, text_col, k)
    # block b as (b, b) and (0, b); block 0 as (0, 0) and with every other
    zero = F.lit(0).cast("long")
    pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))                                      # noqa: E731
    others = F.when(F.col("nb") > 1, F.transform(F.sequence(F.lit(1).cast("long"), F.greatest("nb", F.lit(2)) - 1), lambda j: pair(zero, j)))
    meetings = F.when(F.col("own") == 0, F.concat(F.array(pair(zero, zero)), F.coalesce(others, F.array().cast("array<struct<x:bigint,y:bigint>>")))) \
        .otherwise(F.array(pair(F.col("own"), F.col("own")), pair(zero, F.col("own"))))
    first = _compare(sets.select("rep", "comp", "own", "s", F.explode(meetings).alias("m")).select("rep", "comp", "own", "m.x", "m.y", "s"), percent)
    large = members.filter("nb > 1")
    if large.isEmpty():
        return first
    labels = components(first, "first-links")
    named = materialise(large.join(labels.select(F.col("node").alias("rep"), F.col("comp").alias("part")), "rep", "left")
                        .select("rep", "id", "h", "comp", "n", F.coalesce("part", "rep").alias("part")), "parts")
    most = (named.groupBy("comp", "part").count().groupBy("comp")
            .agg(F.max_by("part", F.struct("count", "part")).alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1"))
    known = labels.filter(F.col("node") != F.col("comp")).select(F.col("comp").alias("a"), F.col("node").alias("b"))
    rest = materialise(named.join(most, "comp").select("rep", "id", "h", "comp", "n", (F.col("part") == F.col("main")).alias("settled")), "unsettled")
    full = materialise(_sets_of(df, rest, id_col, text_col, k).dropDuplicates(["rep"]), "unsettled-sets")
    placed = materialise(prefix_rows(full, percent), "prefixes")
    met = placed.groupBy("comp", "token").agg(F.count_if(~F.col("settled")).alias("u"), F.count(F.lit(1)).alias("t"))
    light = (met.groupBy("comp").agg(F.sum(F.col("u") * F.col("t")).alias("rows"))
             .join(rest.groupBy("comp").agg(F.count(F.lit(1)).alias("members")), "comp").filter(F.col("rows") <= LIGHT * F.col("members")).select("comp"))
    light = materialise(light, "light-groups")
    if light.count() <= BROADCAST_ROWS:
        light = F.broadcast(light)
    out = known.unionAll(verified(prefix_pairs(placed.join(light, "comp", "left_semi"), percent), full, percent))
    return out.unionAll(_all_blocks(full.join(light, "comp", "left_anti"), percent))


def _all_blocks(sets: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: a spanning forest of the links between unsettled classes and all others of their group, block by block."""
    counts = sets.groupBy("comp").agg(*[f(F.when(c, v).otherwise(0)).alias(name) for name, f, c, v in (
        ("nu", F.sum, ~F.col("settled"), F.lit(1)), ("su", F.sum, ~F.col("settled"), F.col("n")),
        ("ns", F.sum, F.col("settled"), F.lit(1)), ("ss", F.sum, F.col("settled"), F.col("n")))])
    counts = materialise(counts.select("comp", _blocks("nu", "su").alias("bu"), _blocks("ns", "ss").alias("bs")).filter("bu > 0"), "block-counts")
    if counts.count() <= BROADCAST_ROWS:                # a row a group: its sets need not gather for them
        counts = F.broadcast(counts)
    # unsettled blocks 0 .. bu - 1 meet all blocks, settled ones only these
    dealt = sets.join(counts, "comp").select("rep", "comp", "settled", "bu", "bs", "s", F.when(
        F.col("settled"), F.col("bu") + F.pmod(F.xxhash64("rep"), F.greatest("bs", F.lit(1)))).otherwise(F.pmod(F.xxhash64("rep"), F.col("bu"))).alias("own"))
    zero = F.lit(0).cast("long")
    other = F.explode(F.sequence(zero, F.when(F.col("settled"), F.col("bu")).otherwise(F.col("bu") + F.col("bs")) - 1))
    met = dealt.withColumn("other", other).select("rep", "comp", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "s")
    return _compare(met, percent)


def _counters(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each counter occur: ``COUNTERS`` numbers, whatever the table's size."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in slices(batch, "s", CHUNK):
                total += np.bincount(_counter(np.frombuffer(b"".join(part.column("s").to_pylist()), np.uint64)), minlength=COUNTERS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["c", "n"])

    found = sets.select("s").mapInArrow(count, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[found.column("c").to_numpy()] = found.column("n").to_numpy()
    return out


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - (COUNTERS.bit_length() - 1))).astype(np.int64)


def prefix(shingles: np.ndarray, counters: np.ndarray, percent: int) -> np.ndarray:
    """The first ``n - ceil(percent n / 100) + 1`` shingles of a set in the order of their counters, then of themselves:
    one order for all sets, so two of that similarity have one of these in common."""
    n = len(shingles)
    order = np.lexsort((shingles, counters[_counter(shingles)]))
    return shingles[order[:n + (-percent * n // 100) + 1]]


def prefix_rows(sets: DataFrame, percent: int) -> DataFrame:
    """``(rep, comp, settled, n, token)``: each class (rep, comp, settled, s) with every shingle of its prefix."""
    counters = _counters(sets)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "s", CHUNK):
                all_sets = [np.frombuffer(s, np.uint64) for s in part.column("s").to_pylist()]
                first = [prefix(s, counters, percent) for s in all_sets]
                at = pa.array(np.repeat(np.arange(len(first)), [len(f) for f in first]))
                size = pa.array([len(s) for s in all_sets], pa.int64())
                token = np.concatenate(first).view(np.int64) if first else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([*[part.column(c).take(at) for c in ("rep", "comp", "settled")], size.take(at), pa.array(token)],
                                                 names=["rep", "comp", "settled", "n", "token"])

    return sets.mapInArrow(rows, "rep long, comp long, settled boolean, n long, token long")


def prefix_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: distinct pairs of classes of a group that may be linked, unsettled ones with all others.

    ``placed``: ``prefix_rows``. Pairs meet on (group, shingle of both
    prefixes) if their sizes allow the similarity; adaptive execution splits a
    hot key of the join."""
    u = placed.filter(~F.col("settled")).select(F.col("rep").alias("a"), "comp", "token", F.col("n").alias("na"))
    v = placed.select(F.col("rep").alias("b"), "comp", "token", "settled", F.col("n").alias("nb"))
    fits = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (F.col("a") != F.col("b")) & (F.col("settled") | (F.col("a") < F.col("b")))
    return u.join(v, ["comp", "token"]).filter(fits).select("a", "b").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` whose full sets have the similarity."""
    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "s", CHUNK):
                whole = [np.frombuffer(s, np.int64) for s in part.column("s").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(whole, pa.list_(pa.int64()))], names=["rep", "v"])

    held = sets.select("rep", "s").mapInArrow(arrays, "rep long, v array<long>")
    both = (pairs.join(held.select(F.col("rep").alias("a"), F.col("v").alias("va")), "a")
            .join(held.select(F.col("rep").alias("b"), F.col("v").alias("vb")), "b"))
    common = F.size(F.array_intersect("va", "vb"))
    return both.filter(100 * common >= percent * (F.size("va") + F.size("vb") - common)).select("a", "b")


def _named(df: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, h, n, comp, first)`` of every row; ``first``: of its group's rows with an id, this is the smallest by id,
    then hash of the text."""
    rows = materialise(sketch(df, id_col, text_col, k), "sketch")
    classes = (rows.filter(F.col("hi").isNotNull() & F.col("id").isNotNull()).groupBy("hi", "lo")
               .agg(F.min(F.struct("id", "h")).alias("m"), F.first("n").alias("n"), F.first("sig").alias("sig"))
               .select("hi", "lo", "m.id", "m.h", "n", "sig"))
    classes = materialise(classes.withColumn("rep", F.col("id")), "classes")
    if not classes.groupBy("id").count().filter("count > 1").isEmpty():
        # one id is the smallest of several classes: number them in the order of ids, so that the smallest number
        # of a group is still the one with its smallest id
        ordered = classes.drop("rep").repartitionByRange("id", "h").sortWithinPartitions("id", "h")
        classes = materialise(ordered.withColumn("rep", F.monotonically_increasing_id()), "numbered-classes")
    candidates = components(neighbours(classes), "candidates")
    labels = components(confirm(df, candidates, classes, id_col, text_col, k, percent), "links")
    named = (classes.join(labels, classes["rep"] == labels["node"], "left")
             .select("hi", "lo", "rep", F.coalesce("comp", "rep").alias("comp"), F.col("id").alias("cid"), F.col("h").alias("ch")))
    heads = classes.select(F.col("rep").alias("head"), F.col("id").alias("group_id"))
    inner = named.filter(F.col("comp") != F.col("rep")).join(heads, F.col("comp") == F.col("head")).drop("head")
    named = named.filter(F.col("comp") == F.col("rep")).withColumn("group_id", F.col("cid")).unionByName(inner)
    named = materialise(named.select("hi", "lo", "group_id", "cid", "ch", (F.col("comp") == F.col("rep")).alias("head")), "class-labels")
    first = F.coalesce(F.col("head") & (F.col("id") == F.col("cid")) & (F.col("h") == F.col("ch")), F.lit(True))
    return (rows.select("id", "h", "n", "hi", "lo").join(named, ["hi", "lo"], "left")
            .select("id", "h", "n", F.coalesce("group_id", "id").alias("comp"), first.alias("first")))


def near_duplicates(df: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n, comp)`` of every row: set size, and the smallest id that links reach (its own without any).

    Two rows are linked if 100 * |intersection| >= percent * |union| of their
    sets of ``k``-word shingles. Null, empty and blank texts have an empty set
    (n = 0) and are linked with nothing. A row without an id joins its group
    but never names it; without other members its comp is null. Repeated rows
    stay rows; rows of one id and different texts are judged each by its own
    text. Other columns are ignored."""
    return _named(df, k, percent, id_col, text_col).select("id", "n", "comp")


def near_duplicate_digest(docs: DataFrame, k: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (doc_id = component_id; true for a row without either) of every row."""
    return near_duplicates(docs, k, percent).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"),
        F.col("id").eqNullSafe(F.col("comp")).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group, the one of the smallest id (of several texts under it, one); all columns stay.

    A decision falls on a row, not on an id: where an id occurs with different
    texts, each text stays or goes with its own group. Rows that repeat an id
    and its text leave one. Rows without an id cannot be named by a group's
    decision: they stay, one for each text."""
    labels = _named(docs, k, percent, id_col, text_col)
    dropped = materialise(labels.filter(~F.col("first") & F.col("id").isNotNull()).select(F.col("id").alias("__dropped"), F.col("h").alias("__h"))
                          .distinct(), "dropped")
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    repeated = docs.groupBy(F.col(id_col).alias("__id")).count().filter("count > 1").select("__id")
    repeated = materialise(repeated, "repeated")
    kept = docs.join(dropped, (docs[id_col] == dropped["__dropped"]) & (_text_hash(docs[text_col]) == dropped["__h"]), "left_anti")
    if not repeated.isEmpty():
        same = F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated
        twins = kept.join(same, kept[id_col].eqNullSafe(same["__id"]), "left_semi").withColumn("__text", F.xxhash64(text_col))
        once = twins.dropDuplicates([id_col, "__text"]).drop("__text")
        kept = kept.join(same, kept[id_col].eqNullSafe(same["__id"]), "left_anti").unionByName(once)
    return kept


ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM sh GROUP BY 1),
links AS (
  SELECT a.r AS a, b.r AS b FROM sh a JOIN sh b ON a.s = b.s AND a.r < b.r
  JOIN sizes na ON na.r = a.r JOIN sizes nb ON nb.r = b.r
  GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(na.n) + any_value(nb.n) - count(*))),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(r, o) AS (
  SELECT r, r FROM docs
  UNION
  SELECT reach.r, e.b FROM reach JOIN edges e ON e.a = reach.o),
named AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN docs d ON d.r = reach.o GROUP BY 1)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM docs d JOIN named c ON c.r = d.r LEFT JOIN sizes s ON s.r = d.r
"""
