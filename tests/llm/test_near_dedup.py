from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from orderflow.llm import lsh_forest
from orderflow.llm.components import connected
from orderflow.llm.shingles import shingle_set
from tests.llm.conftest import DOCUMENTS, words


def _brute(pairs, size, percent=80):
    sets = {i: shingle_set(t, size) for i, t in pairs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            union = len(sets[a]) + len(sets[b]) - both
            if a < b and both and 100 * both >= percent * union:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def _found(frame):
    return {
        r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in frame.collect()
    }


def test_a_dense_group_of_edited_copies_agrees_with_brute_force(documents):
    """Copies far apart from one another: all passes have something to do."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(150)]
    pairs = []
    for i in range(260):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 8])):
            text[rng.randrange(len(text))] = f"e{rng.randrange(40)}"
        pairs.append((i * 7 % 260, " ".join(text)))
    pairs += [(1000 + i, words(rng.randrange(10**6), 60)) for i in range(40)]
    found = _found(lsh_forest.near_duplicates(documents(*pairs), size=4))
    assert found == _brute(pairs, 4)


def test_threshold_case_short_texts_and_ties(documents):
    pairs = [
        (1, words(0, 12)),
        (2, words(0, 13)),
        (3, words(0, 12).upper()),
        (4, "one two"),
        (5, "ONE\ttwo"),
        (6, "one"),
        (7, ""),
        (8, " \n"),
        (9, "two one"),
    ]
    found = _found(lsh_forest.near_duplicates(documents(*pairs), size=4))
    assert found == _brute(pairs, 4)
    assert found[5] == (1, 4, False) and found[7] == (0, 7, True)


def test_nulls_repeated_rows_and_repeated_ids(documents):
    frame = documents(
        (3, words(0, 30)), (3, words(0, 30)), (None, words(0, 30)), (5, None),
        (9, words(0, 30)), (9, words(500, 30)), (12, words(500, 30)),
    )
    rows = lsh_forest.near_duplicates(frame).collect()
    assert len(rows) == 7
    by_id = {}
    for row in rows:
        by_id.setdefault(row["doc_id"], set()).add((row["component_id"], row["kept"]))
    # The two texts of id 9 tie both groups together.
    assert by_id == {
        3: {(3, True)}, None: {(None, True)}, 5: {(5, True)}, 9: {(3, False)}, 12: {(3, False)},
    }
    kept = lsh_forest.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, 3), (False, 5), (True, 0),
    ]


def test_no_documents(spark):
    frame = spark.createDataFrame([], DOCUMENTS)
    assert lsh_forest.near_duplicates(frame).count() == 0
    assert lsh_forest.keep_first(frame).count() == 0


@pytest.mark.parametrize("count", [1 << 10, 1 << 17])
def test_signatures_do_not_depend_on_blocks(count):
    hashes = np.random.default_rng(1).integers(0, 1 << 63, count).astype(np.uint64)
    begin = np.array([0, 3, 3, 10, count])
    found = lsh_forest.signatures(hashes, begin, 20)
    for k, (a, b) in enumerate(zip(begin[:-1], begin[1:], strict=True)):
        if a < b:
            alone = lsh_forest.signatures(hashes[a:b], np.array([0, b - a]), 20)
            assert (found[k] == alone[0]).all()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)]
    edges += [(7, 3), (5, 5), (200, 200)]
    found = connected(spark.createDataFrame(edges, "a bigint, b bigint"))
    got = {r["id"]: r["component"] for r in found.collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}


def test_columns_with_clashing_names(documents):
    docs = documents((1, words(0, 30)), (2, words(0, 30)), (3, words(50, 30)))
    odd = docs.selectExpr("*", "'a' AS _hash", "'b' AS _gone", "'c' AS _text", "'d' AS kept", "'e' AS component_id")
    rows = lsh_forest.keep_first(odd).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 3]
    assert {(r["_hash"], r["_gone"], r["_text"], r["kept"], r["component_id"]) for r in rows} == {tuple("abcde")}


def test_neighbours_in_a_sorted_order_are_those_with_the_longest_common_prefix():
    rng = np.random.default_rng(5)
    tuples = np.column_stack([rng.integers(0, 6, 200), rng.integers(0, 3, (200, 3))])
    tuples = tuples[np.lexsort(tuples.T[::-1])]
    level = 63 // 3
    base, deep = tuples[:, 0], tuples[:, 1] << 2 * level | tuples[:, 2] << level | tuples[:, 3]
    ids = rng.permutation(200)
    columns = [ids, ids, ids, base, deep]
    rows = pa.RecordBatch.from_arrays(
        [pa.array(c) for c in columns], ["id", "hash", "n_shingles", "base", "deep"]
    )

    def shared(a, b):
        same = [*(tuples[a] == tuples[b]), False]
        return 5 + same.index(False) if same[0] else 0

    for cuts in ([200], [1, 1, 0, 2, 196], [1] * 200):
        at = np.concatenate(([0], np.cumsum(cuts)))
        batches = [rows.slice(a, n) for a, n in zip(at, cuts, strict=False)]
        found = [r for b in lsh_forest._neighbours(iter(batches)) for r in b.to_pylist()]
        by_id = {r["id"]: r for r in found}
        assert len(by_id) == len(found)
        for k in range(200):
            # No row of the whole order shares a longer prefix than the neighbour given.
            longest = max(shared(k, other) for other in range(200) if other != k)
            if longest:
                row = by_id[ids[k]]
                place = int(np.flatnonzero(ids == row["near"])[0])
                assert row["depth"] == longest == shared(k, place)
            else:
                assert ids[k] not in by_id or by_id[ids[k]]["near"] is None


def test_a_region_is_split_at_the_depth_that_leaves_few():
    level = 63 // 3
    # Region 1: 40 members, 10 of each first value; region 2: 40 of one first value, 4 of
    # each second; region 3: 40 with equal values; region 4: few members.
    rows = [(1, (k % 4) << 2 * level | k) for k in range(40)]
    rows += [(2, (k % 10) << level | k) for k in range(40)]
    rows += [(3, 7)] * 40 + [(4, 7)] * 16
    rows = sorted((base, deep, k) for k, (base, deep) in enumerate(rows))
    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
    names = ["base", "deep", "id", "hash", "n_shingles"]
    rows = pa.RecordBatch.from_arrays([*columns, columns[2], columns[2]], names)
    for size in (136, 1, 7, 50):
        batches = (rows.slice(k, size) for k in range(0, 136, size))
        parts = {}
        for batch in lsh_forest._neighbours(batches):
            for r in batch.to_pylist():
                parts.setdefault((r["base"], r["part"]), []).append(r["id"])
        assert sorted((b, len(ids)) for (b, _), ids in parts.items()) == (
            [(1, 10)] * 4 + [(2, 4)] * 10 + [(3, 40), (4, 16)]
        )
        assert [b for b, part in parts if part is None] == [4]
