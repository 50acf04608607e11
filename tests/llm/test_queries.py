from __future__ import annotations

import hashlib
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as registry
import corpus_pipeline
from orderflow.llm import decontaminate, language, queries, suffix_dedup
from orderflow.llm.common import table
from orderflow.llm.shingles import shingle_set
from tests.llm.test_near_dedup import _brute as near_brute
from tests.llm.test_suffix_dedup import brute as suffix_brute

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def test_each_operator_has_one_query():
    names = registry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_gives_the_same_rows(spark, sf_dir, name):
    found = registry.queries()[name](spark, sf_dir)
    database = duckdb.connect()
    for t in TABLES:
        database.execute(f"CREATE VIEW {t} AS FROM '{sf_dir}/{t}.parquet'")
    columns = sorted(found.columns)
    reply = database.execute(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})")
    rows = [tuple(r) for r in found.select(*columns).collect()]
    assert sorted(rows, key=repr) == sorted(reply.fetchall(), key=repr)


@pytest.fixture(scope="module")
def texts(spark):
    rows = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def test_op1_agrees_with_the_library(spark, sf_dir, texts):
    library = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    rows = registry.queries()["op1_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_op3_and_op4_and_op9_keep_their_promises(spark, sf_dir, texts):
    placed = registry.queries()["op3_shards"](spark, sf_dir).toPandas()
    sums = placed.groupby("shard")["size"].sum()
    assert set(sums.index) == set(range(24)) and sums.max() / sums.mean() < 1.1
    assert set(placed["law"]) == {"bytes"} and placed["grown_shard"].isna().all()
    scored = registry.queries()["op4_quality"](spark, sf_dir).toPandas()
    labels = table(spark, sf_dir, "labels").toPandas()
    both = scored.merge(labels, on="doc_id")
    held = both[both["held_out"]]
    assert len(scored) == len(texts) and (held["predicted"] == held["quality"]).mean() >= 0.8
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang").toPandas()
    found = registry.queries()["op9_language"](spark, sf_dir).toPandas().merge(docs, on="doc_id")
    assert len(found) == len(texts)
    assert (found["lang"] == found["lang_pred"])[found["held_out"]].mean() >= 0.95


def test_op5_agrees_with_the_definition(spark, sf_dir, texts):
    wanted = suffix_brute(texts.items())
    rows = registry.queries()["op5_suffix_dedup"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        removed, spans, kept = wanted[row["doc_id"]]
        assert (row["n_removed"], row["n_spans"]) == (removed, spans)
        assert row["n_bytes"] == len(texts[row["doc_id"]].encode())
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_pipeline_agrees_with_its_stages_by_brute_force(spark, sf_dir, texts):
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs)
    scorer = language.Scorer(model)
    kept = {}
    for i, text in texts.items():
        lang, score = scorer.predict(text)
        if lang != "und" and score >= corpus_pipeline.LEAST_SCORE:
            kept[i] = text
    near = near_brute(kept.items(), 5)
    kept = {i: t for i, t in kept.items() if near[i][2]}
    cut = {}
    for i, (removed, _, _) in suffix_brute(kept.items()).items():
        data, text = kept[i].encode(), kept[i]
        if removed:
            text = _whole_characters(data, kept, i)
        if text or not removed:
            cut[i] = text
    items = [shingle_set(r["text"], 5) for r in table(spark, sf_dir, "benchmark").collect()]
    clean = {}
    for i, text in cut.items():
        held = shingle_set(text, 5)
        common = [np.isin(item, held).sum() for item in items]
        if not any(c >= decontaminate.needed(len(s), 80) for c, s in zip(common, items, strict=True)):
            clean[i] = text
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in rows} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in clean.items()
    }
    assert 0 < len(clean) < len(texts)


def _whole_characters(data, kept, i):
    seen = {kept[j].encode()[s : s + 100] for j in kept if j < i for s in range(len(kept[j].encode()) - 99)}
    gone = bytearray(len(data))
    for s in range(len(data) - 99):
        if data[s : s + 100] in seen:
            gone[s : s + 100] = b"\1" * 100
        seen.add(data[s : s + 100])
    starts = [m.start() for m in re.finditer(rb"[\x00-\x7f\xc0-\xff]", data)] + [len(data)]
    return b"".join(
        data[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True) if not all(gone[a:b])
    ).decode()


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_dedup", "suffix_dedup", "decontaminate", "bpe",
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).schema.names == docs.schema.names
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_removed_spans_merge():
    ranges = [{"first": 10, "last": 12}, {"first": 0, "last": 0}, {"first": 100, "last": 100},
              {"first": 300, "last": 301}]
    assert suffix_dedup.removed_spans(401, ranges) == [(0, 200), (300, 401)]
