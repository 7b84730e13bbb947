"""The pipeline over small tables, stage by stage against plain versions, and the registered queries."""
import random

import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from gridpanel.llm import queries, secretscan

from .test_neardup import brute
from .test_secretscan import weak

SF = "/root/testdata/sf0.01"


def test_all_operators_are_registered():
    names = entry.queries()
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert set(queries.oracle_sql()) <= set(entry.oracle_sql())


@pytest.fixture
def tables(spark, words, odd_texts, tmp_path):
    rng = random.Random(11)
    english = ["the", "and", "that", "with", "this", "have", "from", "they", "would", "there"]
    spanish = ["que", "los", "para", "como", "pero", "esta", "cuando", "muy", "sobre", "también"]
    make = lambda vocabulary, n: " ".join(rng.choice(vocabulary) + rng.choice(["", "s", "a"]) for _ in range(n))       # noqa: E731
    item = " ".join(rng.choice(words) for _ in range(20))
    rows = [(i, make(english, 60), "en") for i in range(60)] + [(100 + i, make(spanish, 60), "es") for i in range(60)]
    rows += [(200, rows[0][1], "en"), (201, rows[3][1], "en"), (202, item + " " + make(english, 20), "en"), (203, make(english, 30) + " token=abcdef99", "en")]
    rows += [(300 + i, t, None) for i, t in enumerate(odd_texts)] + [rows[5], (None, make(english, 30), "en")]
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), rows, item


def test_stages(spark, tables):
    path, rows, item = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in pipeline.STAGES:
        staged = stage(spark, docs, path)
        docs = spark.createDataFrame(staged.collect(), staged.schema)
        seen[name] = docs
        assert name == "byte_bpe" or docs.columns == columns
    number = lambda i: -1 if i is None else i                                                  # noqa: E731
    kept = sorted((number(r["doc_id"]), r["text"]) for r in seen["language_id"].collect())
    letters = [(i, t) for i, t, _ in rows if t and any(c.isalpha() for c in t)]
    assert set(kept) <= {(number(i), t) for i, t in letters}
    assert {i for i, t, lang in rows if lang and i is not None} <= {i for i, _ in kept}       # clean documents stay
    with_ids = [(i, t) for i, t in kept if i >= 0]
    groups = {(i, c) for _, i, _, c in brute(with_ids, 5)}
    after = sorted(r["doc_id"] for r in seen["near_duplicates"].collect() if r["doc_id"] is not None)
    assert after == sorted({c for _, c in groups})
    assert set(after) - {r["doc_id"] for r in seen["decontamination"].collect()} == {202}
    texts = {r["doc_id"]: r for r in seen["secret_scan"].collect()}
    assert secretscan.PLACEHOLDER in texts[203]["text"] and "abcdef99" not in texts[203]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in texts.values())
    assert {r["doc_id"]: r["n_tokens"] > 0 for r in seen["byte_bpe"].collect()} == dict.fromkeys(texts, True)


def test_run_equals_its_stages(spark, tables):
    import numpy as np
    import public_tokenizers as P
    path, rows, _ = tables
    got = pipeline.run(spark, path).collect()
    from gridpanel.llm.bpe import load_vocabulary
    voc = load_vocabulary(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=voc.ids, special_tokens={})
    original = {i: t for i, t, _ in rows}
    assert len(got) > 100
    for r in got:
        if r["doc_id"] is not None and not weak(original[r["doc_id"]]):        # texts with secrets have changed
            assert np.frombuffer(r["token_ids"], "<u4").tolist() == reference.encode_ordinary(original[r["doc_id"]])


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
