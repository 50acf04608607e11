from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as registry
from orderflow.llm import bpe
from orderflow.llm import token_files as tf
from orderflow.llm.common import table
from tests.llm.conftest import words

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("end", [50, 70_000])
def test_compression_gives_back_all_symbols(end):
    rng = np.random.default_rng(4)
    for case in (
        rng.integers(0, 4, 5000),
        np.zeros(3000, np.int64),
        np.tile([1, 2, 3, end], 700),
        np.full(50, end),
        np.zeros(0, np.int64),
        np.array([1]),
    ):
        symbols = np.append(case, end).astype(np.uint32)
        rules, body = tf.compress(symbols, end)
        lengths = tf.rule_lengths(rules, end)
        back = tf.Grammar(rules, lengths, end, 2).expand(body)
        assert back.tolist() == np.where(symbols == end, 2, symbols).tolist()
        # No rule reaches over an end.
        assert not (rules == end).any() and (body == end).sum() == (symbols == end).sum()
        for k, (a, b) in enumerate(rules.tolist()):
            assert max(a, b) < end + 1 + k
    long = np.tile(rng.integers(0, end, 40), 200).astype(np.uint32)
    rules, body = tf.compress(long, end)
    assert len(body) + 2 * len(rules) < len(long) / 5


def expected(library, docs):
    place, out = 0, []
    for doc_id, text in docs:
        ids = [*library(text), tf.END_ID]
        out.append((doc_id, place, len(ids), np.array(ids, "<u4").tobytes()))
        place += len(ids)
    return out


def test_files_round_trip(spark, documents, library, tmp_path):
    docs = [(k, words(k, 5 + k % 90)) for k in range(-20, 120)]
    docs += [(200, None), (201, ""), (202, "a#b " * 40_000), (203, "#"), (204, "漢字 é ½")]
    docs += [(205, "<|endoftext|> in <|endoftext|>"), (206, " " * 5000 + "x"), (207, "x" * 3000)]
    path = tf.write_tokens(documents(*docs), PATH, f"{tmp_path}/ids", shard_ids=2000)
    rows = [tuple(r) for r in tf.read_tokens(spark, path).collect()]
    assert sorted(rows) == expected(library, docs)
    assert tf.read_shards(spark, path).count() > 5


def test_ids_at_random(spark, documents, library, tmp_path):
    docs = [(k, words(3 * (k % 7), 400)) for k in range(40)]
    path = tf.write_tokens(documents(*docs), PATH, f"{tmp_path}/ids", shard_ids=20_000)
    texts = dict(docs)
    seen = 0
    for row in tf.read_shards(spark, path).collect():
        row = row.asDict()
        for k, doc_id in enumerate(row["doc_ids"]):
            want = [*library(texts[doc_id]), tf.END_ID]
            for a, b in ((0, None), (0, 1), (5, 9), (100, 333), (len(want) - 1, len(want)), (9, 9), (7, 10**9)):
                assert tf.document_ids(row, k, a, b).tolist() == want[a : len(want) if b is None else b]
            seen += 1
        assert row["width"] == 2 and len(row["body"]) < 2 * row["n_ids"]
    assert seen == 40


def test_null_and_repeated_ids(spark, documents, library, tmp_path):
    docs = [(None, "a b"), (None, "c"), (5, "x y"), (5, "x y"), (5, None), (1, "one")]
    path = tf.write_tokens(documents(*docs), PATH, f"{tmp_path}/ids")
    rows = sorted((tuple(r) for r in tf.read_tokens(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, None, 1, 5, 5, 5]
    place = 0
    for _, start, n, ids in rows:
        assert start == place and len(ids) == 4 * n
        place += n
    want = sorted((str(i), ids) for i, _, _, ids in expected(library, docs))
    assert sorted((str(r[0]), r[3]) for r in rows) == want


def test_empty_table(spark, documents, tmp_path):
    path = tf.write_tokens(documents((1, "a")).limit(0), PATH, f"{tmp_path}/ids")
    assert tf.read_tokens(spark, path).count() == 0


def test_query_agrees_with_the_library(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents").orderBy("doc_id").select("doc_id", "text").collect()
    got = registry.queries()["op12_token_files"](spark, sf_dir)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = [tuple(r) for r in got.orderBy("doc_id").collect()]
    assert rows == [(i, s, n, zlib.crc32(ids)) for i, s, n, ids in expected(library, docs)]
    assert dict(got.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    assert got.where(F.col("n_tokens") < 1).isEmpty()


def test_plain_texts_are_told_as_the_codec_does():
    rng = np.random.default_rng(0)
    for _ in range(300):
        run = int(rng.integers(1, 900))
        text = b"ab cd " * int(rng.integers(0, 90)) + bytes([rng.choice([0x20, 0x61])]) * run
        text += b" ef gh" * int(rng.integers(0, 90)) + ("é" if rng.random() < 0.5 else "漢").encode()
        data = np.frombuffer(text, np.uint8)
        assert tf._plain(data) == bpe._is_plain(data)


def test_fast_tokenizer_looks_for_the_special_tokens_only(library):
    # Told of none, it stops at every character to look for the empty string.
    encoder = tf.Encoder(PATH)
    assert encoder.ranked.special_tokens_set == {"<|endoftext|>"}
    rng = np.random.default_rng(8)
    parts = np.array([" ", "  ", "\n", "\t", "a", "Zé", "'s", "'LL", "12", "#!", "\u00a0", "½", "<|end", "oftext|>"])
    for _ in range(200):
        text = "".join(rng.choice(parts, int(rng.integers(1, 60))))
        assert encoder.array(text.encode()).tolist() == library(text), repr(text)
