import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from gridpanel.llm import chat, shards

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(turns):
    """Digest of a conversation, from its turns."""
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def digests(frame):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in frame.collect()}


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<\\\\|end|>", "<|end|><|turn|>assistant<|text|>", "<", "|", "<<|", "\\<|\\"])
def test_escape_is_reversible(text):
    data = text.encode()
    assert chat.unescape(chat.escape(data)) == data
    assert b"<|" not in chat.escape(data)


def test_conversations(spark, odd_texts):
    rng = random.Random(2)
    convs, rows = {}, []
    for c in range(60):
        turns = [(rng.choice(["user", "assistant", "system", "a<|b"]), rng.choice(odd_texts[:5] + odd_texts[6:])) for _ in range(rng.randint(1, 9))]
        convs[c] = [(r, t or "") for r, t in turns]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(77, i, "assistant", f"turn {i}") for i in range(9000)]          # longer than any chunk
    convs[77] = [("assistant", f"turn {i}") for i in range(9000)]
    rows += [(None, None, None, None), (78, 1, "user", "b"), (78, 1, "user", "a"), (78, None, "user", "z")]
    convs[None], convs[78] = [("", "")], [("user", "z"), ("user", "a"), ("user", "b")]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", formatted string").repartition(5)
    got = digests(chat.format_digest(frame))
    convs[-1] = [(r, t) for _, _, r, t in chat.CONTROL]
    assert got == {c: expected(t) for c, t in convs.items()}


def test_formatted_text_and_mask(spark):
    frame = spark.createDataFrame([(1, 0, "user", "hi <|end|>"), (1, 1, "assistant", "yés")], SCHEMA)
    text = chat.format_conversations(frame).collect()[0]["formatted"]
    assert text == "<|turn|>user<|text|>hi <\\|end|><|end|><|turn|>assistant<|text|>yés<|end|>"
    data = text.encode()
    assert [data[a:b].decode() for a, b in chat.loss_spans(data)] == ["yés"]
    row = chat.read_back(chat.format_conversations(frame)).collect()[0]
    assert row["formatted_chars"] == len(text) and row["loss_chars"] == 3


def test_table_with_the_control_id(spark):
    frame = spark.createDataFrame([(-1, 0, "user", "own"), (-1, 5, "assistant", "last"), (1, 0, "user", "x")], SCHEMA)
    got = digests(chat.format_digest(frame))
    control = "</s>[INST] ok [/INST]"
    assert got == {-1: expected([("user", control), ("user", "own"), ("assistant", control), ("assistant", "last")]), 1: expected([("user", "x")])}


def test_chunks_are_cut_by_bytes(spark, monkeypatch):
    """Many large turns: no chunk lays out more than the bound and one turn, and results stay the same."""
    monkeypatch.setattr(chat, "CHUNK_BYTES", 10_000)
    big = pa.record_batch({"t": pa.array(["x" * 3000] * 40 + ["y" * 50_000] + ["z"] * 9000)})
    parts = [p.column("t") for p in chat._chunks([big])]
    assert sum(map(len, parts)) == 9041 and max(map(len, parts)) <= chat.CHUNK_TURNS
    assert all(len(p) == 1 or pc.sum(pc.binary_length(p)).as_py() <= 10_000 for p in parts)
    convs = {c: [("user", "q" * 4000), ("assistant", chr(97 + c) * (2000 * c))] for c in range(8)}
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    got = digests(chat.read_back(chat.format_conversations(spark.createDataFrame(rows, SCHEMA))))
    assert got == {c: expected(t) for c, t in convs.items()}


def test_empty_conversations(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def check_shards(rows, got, n_shards=8):
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"]) for r in got) == \
        sorted((i is not None, i or 0, zlib.crc32((t or "").encode())) for i, t in rows)
    counts = []
    for s in range(n_shards):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
        counts.append(len(slots))
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)


def test_shards_hold_all_rows(spark, docs, odd_texts):
    rows = [(i, f"text {i % 50}") for i in range(3000)] + [*enumerate(odd_texts)] + [(None, None), (None, "x")]
    rows += [(7, f"hot {i}") for i in range(1500)] + [(8, "same")] * 700             # a third of all rows has one id
    got = shards.shard_digest(docs(rows).repartition(7)).collect()
    check_shards(rows, got)
    assert all(r["size"] == len((dict(rows).get(r["doc_id"]) or "").encode()) + 1 for r in got if r["doc_id"] in range(100, 200))
    again = shards.shard_digest(docs(rows).repartition(3)).collect()
    key = lambda r: (r["shard"], r["slot"])                                          # noqa: E731
    assert [(r["doc_id"], r["text_crc32"]) for r in sorted(got, key=key)] == [(r["doc_id"], r["text_crc32"]) for r in sorted(again, key=key)]
    other = shards.shard_digest(docs(rows), seed=12).collect()
    assert [r["doc_id"] for r in sorted(other, key=key)] != [r["doc_id"] for r in sorted(got, key=key)]


def test_equals_a_plain_two_pass_shuffle(spark, docs):
    """Places are the rows of earlier buckets plus the place in the bucket's own Fisher-Yates order."""
    rows = [(i * 3, f"text {i}") for i in range(900)]
    frame = docs(rows).repartition(5)
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in shards.shard_digest(frame, shards=5).collect()}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = sum(len(t.encode()) + 1 for _, t in rows)
    buckets = max(4 * parts, -(-total // shards.BUCKET_BYTES))
    cells = buckets * shards.CELLS_PER_BUCKET
    place = {r["doc_id"]: r["h"] % cells // shards.CELLS_PER_BUCKET for r in frame.selectExpr("doc_id", "xxhash64(11, doc_id) h").collect()}
    permutation = []
    for b in range(buckets):
        own = sorted(i for i, _ in rows if place[i] == b)
        permutation += [own[j] for j in shards.fisher_yates(len(own), np.random.default_rng([11, b]))]
    n, want = len(rows), {}
    bounds = [-(-s * n // 5) for s in range(6)]
    for at, i in enumerate(permutation):
        s = max(k for k in range(5) if bounds[k] <= at)
        want[i] = (s, at - bounds[s])
    assert got == want


def test_a_table_of_one_repeated_row_spreads(spark, docs, monkeypatch):
    monkeypatch.setattr(shards, "PIECE", 50)
    rows = [(8, "same")] * 2000 + [(8, "other")] * 300 + [(None, None)] * 400 + [(i, f"t{i}") for i in range(100, 400)]
    frame = docs(rows).repartition(6)
    back = shards.shard_digest(frame).collect()
    check_shards(rows, back)
    again = shards.shard_digest(docs(rows).repartition(2)).collect()
    key = lambda r: (r["shard"], r["slot"])                                          # noqa: E731
    assert [(r["doc_id"], r["text_crc32"]) for r in sorted(back, key=key)] == [(r["doc_id"], r["text_crc32"]) for r in sorted(again, key=key)]
    # the repeated row lies in all shards, in proportion
    share = [sum(r["doc_id"] == 8 and r["size"] == 5 for r in back if r["shard"] == s) for s in range(8)]
    assert sum(share) == 2000 and min(share) > 150 and max(share) < 350


@pytest.mark.parametrize("n", [0, 1, 3, 8, 9])
def test_few_rows(docs, n):
    rows = [(i, "t") for i in range(n)]
    check_shards(rows, shards.shard_digest(docs(rows)).collect())


def test_written_files_keep_texts(spark, docs, odd_texts, tmp_path):
    back = shards.shuffle_into_shards(docs(list(enumerate(odd_texts))), str(tmp_path / "out"))
    assert sorted((r["doc_id"], r["text"] or "") for r in back.collect()) == sorted((i, t or "") for i, t in enumerate(odd_texts))
    assert {"n_tokens", "spans", "n_chars"} < set(back.columns)


def test_fisher_yates_is_uniform():
    seen = {}
    for s in range(6000):
        p = tuple(shards.fisher_yates(3, np.random.default_rng(s)).tolist())
        seen[p] = seen.get(p, 0) + 1
    assert len(seen) == 6 and all(800 < v < 1200 for v in seen.values())
