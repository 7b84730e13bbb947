import zlib

import numpy as np
import pytest

from gridpanel.llm import langid

SF = "/root/testdata/sf0.01"


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify(frame).join(frame.select("doc_id", "lang", "n_chars"), "doc_id").toPandas()
    assert len(got) == frame.count()
    assert (got.held_out == got.doc_id.map(is_held_out)).all()
    assert got.score.between(0, 1).all()
    known = got[got.held_out & got.lang.notna() & (got.n_chars > 100)]
    assert (known.lang_pred == known.lang).mean() > 0.97


def test_lang_of_held_out_rows_is_never_learned(spark):
    rows = [(i, "uno dos tres " * 5 if is_held_out(i) else "one two three " * 5, "es" if is_held_out(i) else "en") for i in range(200)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), epochs=1)
    assert {r["lang_pred"] for r in got.collect()} == {"en"}


def test_odd_texts(spark, docs, odd_texts):
    frame = docs([*enumerate(odd_texts), (None, "no id"), (3, "a")])
    rows = langid.identify(frame, epochs=1).collect()
    assert len(rows) == len(odd_texts) + 2
    for r in rows:
        text = "x" if r["doc_id"] is None else odd_texts[r["doc_id"]]
        none = text is None or not any(c.isalpha() for c in text)
        assert (r["lang_pred"] == "und") == none and (not none or r["score"] == 0.0)
    assert langid.identify(docs([])).count() == 0


def test_no_labels_gives_und(spark):
    frame = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert langid.identify(frame).collect()[0]["lang_pred"] == "und"
    net = langid.fit(frame)
    assert langid.keep_recognised(frame, net, 0.3).count() == 1


def test_training_sample_is_bounded(spark, monkeypatch):
    frame = spark.range(4000).selectExpr("id as doc_id", "concat('word ', id) as text", "'en' as lang")
    seen = []
    original = langid.train
    monkeypatch.setattr(langid, "train", lambda x, *a, **k: seen.append(len(x)) or original(x, *a, **k))
    langid.fit(frame, rows_per_lang=50, epochs=1)
    assert 20 <= seen[0] <= 100


def test_all_windows_count():
    langs = ["a", "b"]
    rng = np.random.default_rng(0)
    x = np.where(rng.random((400, 32)) < 0.5, 97, 98).astype(np.uint16)
    y = np.arange(400) % 2
    x[y == 1] += 10
    net = langid.train(x, y, langs, epochs=4)
    # one window of the first kind, then many of the second: a prefix would say "a"
    text = bytes(x[0].astype(np.uint8)) + b"".join(bytes(r.astype(np.uint8)) for r in x[1:41:2])
    assert langs[langid.document_probabilities(net, [text])[0].argmax()] == "b"


def plain_probabilities(net, window):
    """Forward pass of one window, place by place: convolution, maximum over places, rectification, softmax."""
    feats = []
    for table, bias in zip(net.tables, net.bias):
        width, _, filters = table.shape
        for f in range(filters):
            best = max(sum(float(table[k, window[i + k], f]) for k in range(width)) for i in range(len(window) - width + 1))
            feats.append(max(0.0, best + float(bias[f])))
    z = [float(net.dense_bias[c]) + sum(v * float(net.dense[j, c]) for j, v in enumerate(feats)) for c in range(len(net.langs))]
    e = np.exp(np.array(z) - max(z))
    return e / e.sum()


def test_forward_pass_equals_plain_loops():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 257, (60, 20)).astype(np.uint16), rng.integers(0, 4, 60)
    net = langid.train(x, y, list("abcd"), epochs=2)
    got = net.probabilities(x[:12])
    for row, p in zip(x[:12], got):
        assert np.allclose(p, plain_probabilities(net, row), atol=1e-5)


def test_first_step_follows_finite_differences():
    """Adam's first step is the rate times the gradient's sign: against central differences of the loss, for every
    parameter of the dense layer and the biases; the filters' step must lower the loss as well."""
    rng = np.random.default_rng(1)
    x, y = rng.integers(97, 123, (64, 24)).astype(np.uint16), rng.integers(0, 3, 64)
    before, after = (langid.train(x, y, ["a", "b", "c"], epochs=e, batch=64, rate=0.01) for e in (0, 1))

    def loss(tables, bias, dense, out):
        z = langid.pooled(x, tables, bias)[0].astype(float) @ dense + out
        z -= z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).mean())

    def parts(net):
        return [t.astype(float) for t in net.tables], [b.astype(float) for b in net.bias], net.dense.astype(float), net.dense_bias.astype(float)
    tables, bias, dense, out = parts(before)
    checked = 0
    for array, stepped in [(dense, after.dense), (out, after.dense_bias), *zip(bias, after.bias)]:
        start = array.copy()
        for i in np.ndindex(array.shape):
            array[i] = start[i] + 1e-5
            up = loss(tables, bias, dense, out)
            array[i] = start[i] - 1e-5
            slope = (up - loss(tables, bias, dense, out)) / 2e-5
            array[i] = start[i]
            if abs(slope) > 1e-4:
                assert np.sign(stepped[i] - start[i]) == -np.sign(slope) and abs(abs(stepped[i] - start[i]) - 0.01) < 1e-4
                checked += 1
    assert checked > 80
    moved = [t0 + 0.05 * (t1 - t0) for t0, t1 in zip(tables, parts(after)[0])]
    assert loss(moved, bias, dense, out) < loss(tables, bias, dense, out)


def test_training_lowers_the_loss():
    rng = np.random.default_rng(1)
    x, y = rng.integers(97, 123, (64, 24)).astype(np.uint16), rng.integers(0, 3, 64)

    def loss(net):
        p = net.probabilities(x)
        return -np.log(p[np.arange(len(y)), y] + 1e-9).mean()
    losses = [loss(langid.train(x, y, ["a", "b", "c"], epochs=e, batch=64)) for e in (0, 5, 40)]
    assert losses[0] > losses[1] > losses[2]


@pytest.mark.parametrize("size", [0, 1, 255, 256, 257, 1000])
def test_cut_covers_every_byte(size):
    text = bytes(i % 251 for i in range(size))
    x, held, per = langid.cut([b"zz", text], 256)
    assert per.tolist() == [1, -(-size // 256)] and held.sum() == size + 2
    assert bytes(x[1:].ravel()[x[1:].ravel() != langid.PAD].astype(np.uint8)) == text
