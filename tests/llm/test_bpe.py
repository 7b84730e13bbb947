import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from gridpanel.llm import bpe


@pytest.fixture(scope="module")
def voc():
    return bpe.load_vocabulary(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def reference(voc):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=voc.ids, special_tokens={})


def ids_of(encoder, texts):
    ids, n = encoder.encode(texts)
    ends = np.cumsum(n)
    return [ids[a:b].tolist() for a, b in zip(ends - n, ends)]


def test_random_texts_equal_tiktoken(voc, reference):
    rng = random.Random(5)
    bits = ["a", "b", " ", "aa", "abab", "\n", "é", "日本", "𝒳", "'s", "1", "²", "_", " ", "　", "\x1c", "\x85", "​", "the", "ing", " the"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 200))) for _ in range(500)]
    encoder = bpe.Encoder(voc)
    assert ids_of(encoder, texts) == [reference.encode_ordinary(t) for t in texts]
    assert ids_of(encoder, texts[:50]) == [reference.encode_ordinary(t) for t in texts[:50]]      # from the memo


def test_long_pieces_equal_tiktoken(voc, reference):
    rng = random.Random(6)
    texts = ["a" * 5000, "ab" * 3000, "abcabd" * 1500, "the" * 2000 + "ing" * 3000, " " * 3000, "а" * 3000,
             "".join(rng.choice("abcdefgh") for _ in range(20000)), "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20000))]
    assert ids_of(bpe.Encoder(voc), texts) == [reference.encode_ordinary(t) for t in texts]


def test_memo_is_bounded(voc, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_PIECES", 20)
    encoder = bpe.Encoder(voc)
    for i in range(20):
        text = f"word{i} other{i * 7} thing"
        assert ids_of(encoder, [text]) == [reference.encode_ordinary(text)]
        assert len(encoder.memo) < 40


def test_round_trip_query(spark, docs, odd_texts, voc, reference):
    frame = docs([*enumerate(odd_texts), (None, "no id"), (3, "a")])
    rows = {(r["doc_id"], r["decoded_sha256"]): r for r in bpe.encode_decode_digest(frame, voc).collect()}
    assert len(rows) == len(odd_texts) + 1                # (3, "a") occurs twice
    for i, t in [*enumerate(odd_texts), (None, "no id")]:
        ids = reference.encode_ordinary(t or "")
        r = rows[(i, hashlib.sha256((t or "").encode()).hexdigest())]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode_decode_digest(docs([]), voc).count() == 0


def test_encode_then_decode(spark, docs, odd_texts, voc):
    ids = bpe.encode(docs(list(enumerate(odd_texts))), voc)
    back = {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decode(ids, voc).collect()}
    assert back == {i: t or "" for i, t in enumerate(odd_texts)}
    checked = {r["doc_id"]: bytes(r["token_ids"]) for r in bpe.encode_checked(docs(list(enumerate(odd_texts))), voc).collect()}
    assert checked == {r["doc_id"]: bytes(r["token_ids"]) for r in ids.collect()}
