from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from orderflow.llm import bpe
from tests.llm.conftest import DOCUMENTS

PATH = public_tokenizers.path("byte_bpe_50k.json")
_CODEC = bpe.Codec(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_both_libraries_split_plain_characters_alike():
    codec = _CODEC
    assert codec.ranks is not None
    for point in range(0x240):
        c = chr(point)
        for text in (c, f"a{c}", f"{c}a", f" {c}", f"{c} ", f"a{c}{c}b", f"{c}1", f"1{c} ",
                     f"  {c}\n{c}  x", f"!{c}?", f"'{c}", f"'{c}l l", f"{c}'s {c}"):
            whole = codec.whole.encode(text, add_special_tokens=False).ids
            assert codec.ranked.encode_ordinary(text) == whole, repr(text)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.sampled_from(["the ", "don't", "'", "l", "é", " ", "\n", "12", "<|endoftext|>",
                              " ", "中文", "🙂", "endof", "<|", "!!", "x" * 50]), max_size=60),
    st.lists(st.integers(0, 400), max_size=8),
)
def test_assembled_chunks_agree_with_the_whole_text(parts, cuts):
    codec, text = _CODEC, "".join(parts)
    data = text.encode()
    edges = {k for k in cuts if k < len(data) and data[k] & 0xC0 != 0x80}
    edges = sorted(edges | {0, len(data)})
    shared = {}
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if (a + b) % 3:
            ids = codec.encode(data[a:b])
            shared[a] = (b, np.asarray(ids, codec.dtype).tobytes())
    whole = codec.whole.encode(text, add_special_tokens=False).ids
    assert bpe.assemble(codec, data, shared).tolist() == whole
    assert codec.decode(whole) == codec.whole.decode(whole, skip_special_tokens=False)


def _expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_documents_agree_with_the_library(documents, library):
    rng = random.Random(4)
    vocabulary = ["the", "Ünder", "don't", "we'll", "12,5", "naïve", "<|endoftext|>", "中文", "🙂!"]
    shared = " ".join(rng.choice(vocabulary) for _ in range(3000))
    pairs = [(i, shared[rng.randrange(99) : 9000 + 40 * i] + f" end {i}") for i in range(8)]
    pairs += [(20, ""), (21, None), (22, "a" * 5000), (23, " \n\t " * 900), (24, shared * 4)]
    pairs += [(None, shared), (25, shared), (25, shared), (25, "other " + shared), (26, "�\0")]
    frame = documents(*pairs)
    rows = bpe.decode(bpe.encode(frame, PATH), PATH).collect()
    want = sorted((-1 if i is None else i, *_expected(library, t)) for i, t in pairs)
    got = sorted(
        (-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"])
        for r in rows
    )
    assert got == want


def test_shared_chunks_are_encoded_once():
    """Chunks of equal passages are equal wherever these stand."""
    rng = random.Random(8)
    passage = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(4000))
    keys = []
    for start in ("", "something else before it. ", "é" * 400):
        data = (start + passage).encode()
        array = np.frombuffer(data, np.uint8)
        ends = bpe.chunk_ends(array, np.array([0, len(array)]))[0]
        keys.append({hashlib.md5(data[a:b]).digest() for a, b in zip([0, *ends], ends)})
    assert len(keys[0] & keys[1] & keys[2]) >= len(keys[0]) - 3 > 4


def test_no_rows(spark):
    frame = spark.createDataFrame([], DOCUMENTS)
    assert bpe.decode(bpe.encode(frame, PATH), PATH).count() == 0


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Codec(public_tokenizers.path("word_bpe_49k.json"))


def test_texts_apart_take_one_worker_for_each_task(documents, capsys, library):
    shared = "a passage of many words that several texts have. " * 60
    texts = [(k, f"only here {k} " * 90 if k % 2 else f"{k} {shared}") for k in range(20)]
    encoded = bpe.encode(documents(*texts, (20, None), (21, "")), PATH)
    got = {r["doc_id"]: (r["n_tokens"], bytes(r["ids"])) for r in encoded.collect()}
    assert got == {k: _expected(library, text)[:2] for k, text in [*texts, (20, None), (21, "")]}
    encoded.explain()
    plan = capsys.readouterr().out
    # The last branch of the union encodes them, and asks the filter itself.
    assert "ArrowEvalPython" in plan and "ArrowEvalPython" not in plan.rsplit("MapInArrow", 1)[1]


def _python_in_a_stage(plan):
    """The most Python evaluations one above the other without a shuffle between."""
    most, above = 0, []
    for line in plan.splitlines():
        lead, name = re.match(r"([ :+-]*)(?:\*\(\d+\) )?(\w*)", line).groups()
        while above and above[-1][0] >= len(lead):
            above.pop()
        count = above[-1][1] if above else 0
        count = 0 if "Exchange" in name else count + ("InArrow" in name or "EvalPython" in name)
        above.append((len(lead), count))
        most = max(most, count)
    return most


def test_a_task_holds_one_python_worker(documents, capsys, library):
    # Workers stay beside an executor's JVM, as many as its tasks ever held at once.
    shared = "a passage of many words that several texts have. " * 60
    texts = [(k, f"only here {k} " * 90 if k % 2 else f"{k} {shared}") for k in range(20)]
    docs = documents(*texts, (20, None), (21, ""), extra=False)
    for frame in (bpe.encode(docs, PATH), corpus_pipeline.tokenize(docs.sparkSession, docs, "")):
        frame.explain()
        assert _python_in_a_stage(capsys.readouterr().out) == 1
    rows = {r["doc_id"]: (r["n_tokens"], bytes(r["ids"]), r[3]) for r in frame.collect()}
    for k, text in [*texts, (20, None), (21, "")]:
        n, ids, decoded = _expected(library, text)
        assert rows[k] == (n, ids, hashlib.sha256(decoded.encode()).hexdigest())
