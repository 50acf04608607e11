from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
import pytest

from orderflow.llm import shards
from tests.llm.conftest import DOCUMENTS


def _placed(frame, **settings) -> pd.DataFrame:
    return shards.assign_shards(frame, **settings).toPandas()


def _check(found: pd.DataFrame, pairs) -> None:
    wanted = sorted(
        (-1 if i is None else i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
        for i, t in pairs
    )
    rows = found[["doc_id", "size", "text_crc32"]].fillna({"doc_id": -1}).astype("int64")
    assert sorted(map(tuple, rows.itertuples(index=False))) == wanted
    for _, group in found.groupby("shard"):
        assert sorted(group["slot"]) == list(range(len(group)))


@pytest.mark.parametrize("rows_per_pack", [50_000, 200])
def test_shares_are_near_equal_and_slots_gapless(documents, rows_per_pack):
    rng = random.Random(5)
    pairs = [(i, f"{i} " + "word " * int(rng.paretovariate(1.2) * 8 % 900)) for i in range(1500)]
    # A third of the rows have one text.
    pairs += [(5000 + i, "the same text everywhere") for i in range(750)]
    found = _placed(documents(*pairs), shards=6, rows_per_pack=rows_per_pack)
    _check(found, pairs)
    sums = found.groupby("shard").agg(b=("size", "sum"), t=("tokens", "sum"), n=("slot", "count"))
    spread = sums.max() / sums.min()
    assert spread["b"] < 1.05 and spread["t"] < 1.1 and spread["n"] < 1.1


def test_equal_texts_share_a_shard_unless_they_are_many(documents):
    pairs = [(i, f"text {i % 100}") for i in range(200)]
    found = _placed(documents(*pairs), shards=4)
    assert (found.groupby("text_crc32")["shard"].nunique() == 1).all()


def test_nulls_repeated_rows_and_few_or_no_rows(spark, documents):
    pairs = [(1, None), (1, None), (2, ""), (None, "é"), (3, "é")]
    _check(_placed(documents(*pairs)), pairs)
    assert shards.assign_shards(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_a_vector_goes_where_it_fits_best():
    vectors = np.array([[4.0, 1.0], [1.0, 4.0], [1.0, 4.0], [4.0, 1.0]])
    weights = shards._WEIGHTS
    shards._WEIGHTS = np.ones(2)
    try:
        bins = shards.pack_vectors(vectors, 2)
    finally:
        shards._WEIGHTS = weights
    sums = np.array([vectors[bins == k].sum(axis=0) for k in range(2)])
    assert (sums == 5).all()


def test_packing_agrees_with_a_plain_packer():
    """Each vector where the weighted dot product with what is left is highest, the first of these."""
    rng = np.random.default_rng(8)
    for bins in (1, 3, 7):
        vectors = rng.integers(0, 50, (60, 3)).astype(float)
        totals = vectors.sum(axis=0)
        left = [[1.0] * 3 for _ in range(bins)]
        wanted = []
        for vector in vectors:
            need = [v * bins / t for v, t in zip(vector, totals, strict=True)]
            fits = [sum(w * n * r for w, n, r in zip((4, 1, 1), need, own, strict=True)) for own in left]
            best = max(range(bins), key=lambda b: (round(fits[b], 9), -b))
            wanted.append(best)
            left[best] = [r - n for r, n in zip(left[best], need, strict=True)]
        assert shards.pack_vectors(vectors, bins).tolist() == wanted
