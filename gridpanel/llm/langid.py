"""Language identification by a byte convolutional network, trained in numpy.

The network sees windows of ``Net.window`` bytes: each byte has an embedding,
filters of several widths slide over the window, every filter keeps its
largest response, and a softmax scores the languages. The embedding and the
filters meet in one table of responses per byte value and filter offset, so
applying a filter is a sum of table rows.

Training collects a bounded sample of labelled rows to the driver
(``rows_per_lang`` texts per language, one window each); the fitted net is a
few thousand numbers. Prediction covers whole texts: all windows of a text
are scored and their probabilities are averaged, weighted by the bytes they hold.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, spread

UND = "und"
PAD = 256                       # byte value of padding
ROWS_PER_LANG = 1500            # bound of the training sample for one language
MAX_LANGS = 500                 # bound of the label set
BLOCK = 128                     # windows scored at once
CHUNK = 4 << 20


@dataclass
class Net:
    """Filters per width, as tables (width, 257, filters); dense layer; label names."""
    window: int
    widths: tuple
    tables: list
    bias: list
    dense: np.ndarray
    dense_bias: np.ndarray
    langs: list

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Softmax over languages for each row of a (n, window) matrix of byte values (PAD beyond the text)."""
        out = np.empty((len(windows), len(self.langs)), np.float32)
        for lo in range(0, len(windows), BLOCK):
            z = pooled(windows[lo:lo + BLOCK], self.tables, self.bias)[0] @ self.dense + self.dense_bias
            e = np.exp(z - z.max(1, keepdims=True))
            out[lo:lo + BLOCK] = e / e.sum(1, keepdims=True)
        return out


def pooled(x: np.ndarray, tables: list, bias: list, places: bool = False):
    """Max-pooled rectified filter responses of (n, window) bytes, and where each maximum lies."""
    x = np.ascontiguousarray(x.T)            # position first: a slice of positions is contiguous
    feats, wheres = [], []
    for table, b in zip(tables, bias):
        width = len(table)
        steps = len(x) - width + 1
        total = table[0].take(x[:steps], axis=0)
        for k in range(1, width):
            total += table[k].take(x[k:k + steps], axis=0)
        feats.append(total.max(0) + b)
        if places:
            wheres.append(total.argmax(0))
    return np.maximum(np.concatenate(feats, 1), 0), wheres


def train(windows: np.ndarray, labels: np.ndarray, langs: list, widths=(2, 3, 4, 5), filters: int = 8,
          dim: int = 8, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Net:
    """Adam on the cross entropy, with gradients of the embedding, filters and dense layer worked out by hand."""
    rng = np.random.default_rng(seed)
    n_out = len(langs)
    emb = rng.normal(0, 0.3, (257, dim)).astype(np.float32)
    emb[PAD] = 0
    p = {"emb": emb, "dense": rng.normal(0, 0.2, (filters * len(widths), n_out)).astype(np.float32),
         "out": np.zeros(n_out, np.float32)}
    for w in widths:
        p[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * dim), (w, dim, filters)).astype(np.float32)
        p[f"b{w}"] = np.zeros(filters, np.float32)
    m1, m2, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(epochs if len(windows) else 0):
        order = rng.permutation(len(windows))
        for lo in range(0, len(order), batch):
            x, y = windows[order[lo:lo + batch]], labels[order[lo:lo + batch]]
            feats, wheres = pooled(x, [p["emb"] @ p[f"w{w}"] for w in widths], [p[f"b{w}"] for w in widths], True)
            z = feats @ p["dense"] + p["out"]
            e = np.exp(z - z.max(1, keepdims=True))
            err = e / e.sum(1, keepdims=True)
            err[np.arange(len(y)), y] -= 1
            err /= len(y)
            g = {"dense": feats.T @ err, "out": err.sum(0), "emb": np.zeros_like(p["emb"])}
            back = (err @ p["dense"].T) * (feats > 0)
            for i, w in enumerate(widths):
                d, at = back[:, i * filters:(i + 1) * filters], wheres[i]
                g[f"b{w}"] = d.sum(0)
                g[f"w{w}"] = np.empty_like(p[f"w{w}"])
                for k in range(w):
                    byte = x[np.arange(len(x))[:, None], at + k]                     # (n, filters)
                    g[f"w{w}"][k] = np.einsum("nfd,nf->df", p["emb"][byte], d)
                    np.add.at(g["emb"], byte, d[..., None] * p[f"w{w}"][k].T[None])
            g["emb"][PAD] = 0
            t += 1
            for k in p:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                p[k] = (p[k] - rate * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return Net(windows.shape[1], tuple(widths), [np.ascontiguousarray(p["emb"] @ p[f"w{w}"]) for w in widths],
               [p[f"b{w}"] for w in widths], p["dense"], p["out"], list(langs))


def cut(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts (the last one padded), the bytes each holds, and windows per text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    per = -(-sizes // window)
    data = np.r_[np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16), np.full(window, PAD, np.uint16)]
    starts = spread(np.zeros(len(per), np.int64), per) * window + np.repeat(np.cumsum(sizes) - sizes, per)
    held = np.minimum(np.repeat(np.cumsum(sizes), per) - starts, window)
    x = data[np.minimum(starts[:, None] + np.arange(window), len(data) - 1)]
    x[np.arange(window) >= held[:, None]] = PAD
    return x, held, per


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        rows_per_lang: int = ROWS_PER_LANG, window: int = 256, seed: int = 7, **train_options) -> Net:
    """Fit on a bounded sample of the rows of ``df`` whose text has a letter and whose label is not null.

    Rows are drawn by a hash of the id at a rate set from the label's row
    count, so that about ``rows_per_lang`` (at most twice as many) reach the
    driver for each label; of each text one window, at a place set by the hash,
    leaves the executors. No labelled row: a net without languages, which
    predicts ``und``. More than ``MAX_LANGS`` labels: an error."""
    rows = df.filter(F.col(lang_col).isNotNull() & has_letter(F.col(text_col))).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("h"))
    counts = df.filter(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang")).count().limit(MAX_LANGS + 1).collect()
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} labels")
    langs = sorted(r["lang"] for r in counts)
    if not langs:
        return train(np.empty((0, window), np.uint16), np.empty(0, np.int64), [], **train_options)
    units = 1 << 30
    rate = F.lit(0)
    for r in counts:
        rate = F.when(F.col("lang") == r["lang"], min(units, -(-units * rows_per_lang // r["count"]))).otherwise(rate)
    size = F.octet_length("text")
    start = F.pmod(F.shiftright("h", 31), F.greatest(size - window, F.lit(0)) + 1).cast("int")
    sample = (rows.filter(F.pmod("h", F.lit(units)) < rate)
              .select("lang", F.substring(F.col("text").cast("binary"), start + 1, F.lit(window)).alias("bytes"), "h")
              .limit(2 * rows_per_lang * len(langs)).collect())
    sample.sort(key=lambda r: (r["h"], bytes(r["bytes"]), r["lang"]))
    x, _, _ = cut([bytes(r["bytes"]) for r in sample], window)
    index = {lang: i for i, lang in enumerate(langs)}
    return train(x, np.array([index[r["lang"]] for r in sample], np.int64), langs, seed=seed, **train_options)


def has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def predict(df: DataFrame, net: Net, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, lang_pred, score)`` of every row of ``df``, from all windows of the whole text.

    ``lang_pred`` is the label of the largest mean probability (ties: the
    first in order) and ``score`` that probability. Null or letterless texts,
    and nets without languages, give ``und`` and 0.0. Row order, repeated rows
    and null ids are kept; other columns are ignored."""
    shared = df.sparkSession.sparkContext.broadcast(net)
    rows = df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"),
                     F.coalesce(has_letter(F.col(text_col)), F.lit(False)).alias("ok"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        names = np.array([*net.langs, UND], object)
        for batch in batches:
            for part in slices(batch, "t", CHUNK):
                ok = part.column("ok").to_numpy(zero_copy_only=False).astype(bool) & bool(net.langs)
                which, score = np.full(len(ok), len(net.langs)), np.zeros(len(ok))
                if ok.any():
                    texts = pc.filter(part.column("t"), pa.array(ok)).cast(pa.binary()).to_pylist()
                    mean = document_probabilities(net, texts)
                    which[ok], score[ok] = mean.argmax(1), np.clip(mean.max(1), 0, 1)
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(names[which], pa.string()), pa.array(score)],
                                                 names=[id_col, "lang_pred", "score"])

    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)['k']}, lang_pred string, score double")


def keep_recognised(df: DataFrame, net: Net, min_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose text has a letter and a mean probability of ``min_score`` or more in
    its best language. Without languages (nothing labelled), every row whose text has a letter."""
    shared = df.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for part in slices(batch, text_col, CHUNK):
                if net.langs:
                    mean = document_probabilities(net, part.column(text_col).cast(pa.binary()).to_pylist())
                    part = part.filter(pa.array(mean.max(1) >= min_score))
                yield part

    return df.filter(has_letter(F.col(text_col))).mapInArrow(run, df.schema)


def document_probabilities(net: Net, texts: list[bytes]) -> np.ndarray:
    """Mean window probabilities of each (non-empty) text, weighted by the bytes of a window."""
    total = np.zeros((len(texts), len(net.langs)))
    weight = np.zeros(len(texts))
    step = max(1, CHUNK // net.window)
    # a slice of windows at a time: a very long text never becomes one matrix
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    lo = 0
    while lo < len(texts):
        hi, room = lo, step * net.window
        while hi < len(texts) and (hi == lo or room >= sizes[hi]):
            room -= int(sizes[hi])
            hi += 1
        owner = np.arange(lo, hi)
        group = texts[lo:hi]
        for part in ([group] if hi > lo + 1 else [[group[0][i:i + step * net.window]]
                                                  for i in range(0, max(1, len(group[0])), step * net.window)]):
            x, held, per = cut(part, net.window)
            own = np.repeat(owner, per)
            np.add.at(total, own, net.probabilities(x).astype(float) * held[:, None])
            np.add.at(weight, own, held)
        lo = hi
    return total / np.maximum(weight, 1)[:, None]


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 4, is 2 (a null id is never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, **fit_options) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by a net fitted on the rows not held out."""
    net = fit(docs.filter(~held_out(F.col("doc_id"))), **fit_options)
    return predict(docs, net).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
