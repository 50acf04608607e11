from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderflow.llm import suffix_dedup
from orderflow.llm.suffix_array import common_prefixes, suffix_order
from tests.llm.conftest import DOCUMENTS


def brute(pairs):
    """Bytes to remove, straight from the definition; ids are distinct."""
    seen, out = set(), {}
    for i, text in sorted(pairs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(data[s : s + 100])
        edges = [k for k in range(len(data)) if gone[k] and not (k and gone[k - 1])]
        out[i] = (sum(gone), len(edges), bytes(c for c, g in zip(data, gone, strict=True) if not g))
    return out


def found(frame):
    return {
        r["doc_id"]: (
            sum(s["end"] - s["begin"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"])
        )
        for r in frame.collect()
    }


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=200), st.integers(1, 3))
def test_suffix_order_and_common_prefixes(data, times):
    array = np.frombuffer(data * times, np.uint8)
    whole = array.tobytes()
    order, place = suffix_order(array)
    assert order.tolist() == sorted(range(len(whole)), key=lambda k: whole[k:])
    assert place[order].tolist() == list(range(len(whole)))
    shared = common_prefixes(array, order, place, 20)
    for k in range(1, len(order)):
        a, b = whole[order[k - 1] :], whole[order[k] :]
        n = next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))
        assert shared[k] == min(n, 20)


def test_common_prefixes_across_lanes():
    array = np.random.default_rng(2).integers(0, 2, 9000).astype(np.uint8)
    array = np.concatenate([array, array[:5000]])
    order, place = suffix_order(array)
    shared = common_prefixes(array, order, place, 100)
    whole = array.tobytes()
    for k in range(1, len(order), 17):
        a, b = whole[order[k - 1] :][:100], whole[order[k] :][:100]
        n = next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))
        assert shared[k] == n


def _corpus(seed):
    rng = random.Random(seed)
    letters = "abcé \n"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(130), text(99), text(400), "ab" * 200, "x" * 700, ""]
    pairs = [(i, text(rng.randrange(300)) + rng.choice(passages) + text(rng.randrange(200)))
             for i in range(60)]
    pairs += [(100, passages[4] * 2), (101, passages[2]), (102, "y" * 99), (103, "y" * 100)]
    pairs += [(104, "y" * 101), (105, ""), (106, None), (107, "\0" * 300), (108, "\0" * 250)]
    # One passage, many different surroundings: many contexts of few anchors.
    pairs += [(200 + i, text(90) + passages[2] + text(90)) for i in range(60)]
    return pairs


@pytest.mark.parametrize(("contexts", "sorted_bytes"), [(4096, 1 << 20), (5, 2000)])
def test_agrees_with_the_definition(documents, monkeypatch, contexts, sorted_bytes):
    monkeypatch.setattr(suffix_dedup, "SHARD_CONTEXTS", contexts)
    monkeypatch.setattr(suffix_dedup, "SORTED_BYTES", sorted_bytes)
    pairs = _corpus(contexts)
    assert found(suffix_dedup.remove_repeats(documents(*pairs))) == brute(pairs)


def test_repeated_rows_null_ids_and_characters(documents):
    text = "é" + "".join(chr(97 + k % 26) + chr(97 + k * 7 % 26) for k in range(60)) + "é"
    after = "".join(chr(65 + k * 5 % 26) for k in range(90))
    frame = documents((5, "q" + text + after), (5, "q" + text + after), (None, text), (7, "zz" + text[1:]))
    out = suffix_dedup.remove_repeats(frame, whole_characters=True)
    assert out.columns == [*frame.columns, "n_bytes", "removed", "kept"]
    rows = sorted((r["doc_id"] or 0, bytes(r["kept"]).decode()) for r in out.collect())
    # A null id comes before all; of the rows with id 5 none is earlier than the other.
    assert rows == [(0, text), (5, "q" + after), (5, "q" + after), (7, "zz")]


def test_half_a_character_stays_whole(documents):
    tail = "".join(chr(97 + k * k % 23) + chr(65 + k % 19) for k in range(60))
    # The second bytes of the two first characters are the same.
    pairs = [(1, "é" + tail), (2, "©" + tail)]
    cut = found(suffix_dedup.remove_repeats(documents(*pairs)))
    assert cut == brute(pairs) and len(cut[2][2]) == 1
    whole = found(suffix_dedup.remove_repeats(documents(*pairs), whole_characters=True))
    assert whole[2][2].decode() == "©"


def test_long_text_and_no_rows(spark, documents):
    rng = random.Random(1)
    block = "".join(rng.choice("abcdefgh ") for _ in range(1_500_000))
    pairs = [(1, block), (2, "tail " + block[700_000:900_000])]
    out = found(suffix_dedup.remove_repeats(documents(*pairs)))
    assert out[1][0] == 0 and out[2] == (200_000, 1, b"tail ")
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_very_long_texts_go_in_pieces(monkeypatch):
    data = np.random.default_rng(5).integers(0, 4, 40_000).astype(np.uint8)
    bounds = np.array([0, 15_000, 15_050, 40_000])
    whole = suffix_dedup.anchors(data, bounds)
    monkeypatch.setattr(suffix_dedup, "_PLACE_BITS", 13)
    pieces = suffix_dedup.anchors(data, bounds)
    covered = lambda a: np.concatenate([np.arange(x, y + 1) for x, y in zip(a[3], a[4])])
    assert sorted(covered(whole)) == sorted(covered(pieces))


def test_columns_with_clashing_names(spark, documents):
    text = "abcdefghij" * 12
    docs = documents((1, text), (2, text), (3, "short"))
    odd = docs.selectExpr("*", "7 AS kept", "8 AS n_bytes", "9 AS removed", "'a' AS _id", "'b' AS _hash", "'c' AS _ranges")
    found = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(odd).collect()}
    plain = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs).collect()}
    for doc_id, row in found.items():
        for name in ("n_bytes", "removed", "kept"):
            assert row[name] == plain[doc_id][name]
        assert (row["_id"], row["_hash"], row["_ranges"]) == ("a", "b", "c")
