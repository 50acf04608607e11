"""Shards of near-equal bytes, tokens and rows by vector bin packing.

What is placed is a group of equal texts, a vector of its bytes, tokens and rows in
shares of a shard's capacity.  A group goes where the dot product of its vector
with the residual capacity is highest, large groups first.

Groups are dealt by hash into packs of about ``rows_per_pack`` rows, at most
``MAX_PACKS`` of them.  Each pack is packed in one task into as many bundles as
there are shards.  Then every pack's bundles are dealt to the shards, one to each,
by the same rule on the sums of the bundles, so that what one pack leaves uneven
the next one evens out.  A group too large for that, by rows or bytes, is split
into pieces by a hash of the id before it is shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import saved

SHARDS = 24
ROWS_PER_PACK = 50_000
MAX_PACKS = 20_000
# A piece of a group is at most this part of what one shard gets of a pack.
PIECE = 4

_SUMS = ["bytes", "tokens", "rows"]
# Bytes weigh most in the dot product: their evenness is what is promised.
_WEIGHTS = np.array([4.0, 1.0, 1.0])
_PACKED = (
    "doc_id bigint, size bigint, tokens bigint, text_crc32 bigint, pack bigint, "
    "bundle int, place bigint"
)


def pack_vectors(vectors: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each vector, placed in the given order."""
    totals = vectors.sum(axis=0)
    need = vectors / np.where(totals > 0, totals / bins, 1)
    residual = np.ones((bins, vectors.shape[1]))
    out = np.empty(len(vectors), np.int32)
    for k, vector in enumerate(need):
        out[k] = best = int(np.argmax(residual @ (_WEIGHTS * vector)))
        residual[best] -= vector
    return out


def _pack(shards: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "size", "text_crc32"], kind="stable")
        unit = rows.groupby(["one", "two", "piece"], sort=True)
        groups = unit.agg(bytes=("size", "sum"), tokens=("tokens", "sum"), rows=("size", "count"))
        vectors = groups[_SUMS].to_numpy(float)
        largest = (vectors / np.maximum(vectors.sum(axis=0), 1)).max(axis=1)
        order = np.argsort(-largest, kind="stable")
        bundle = np.empty(len(groups), np.int32)
        bundle[order] = pack_vectors(vectors[order], shards)
        rows = rows.assign(bundle=bundle[unit.ngroup().to_numpy()])
        rows["place"] = rows.groupby("bundle").cumcount()
        return rows[["doc_id", "size", "tokens", "text_crc32", "pack", "bundle", "place"]]

    return run


def _deal(shards: int):
    """Deal each pack's bundles to the shards, one to each."""

    def run(bundles: pd.DataFrame) -> pd.DataFrame:
        bundles = bundles.sort_values(["pack", "bundle"]).reset_index(drop=True)
        totals = bundles[_SUMS].to_numpy(float).sum(axis=0)
        bundles[_SUMS] = bundles[_SUMS].astype("int64")
        need = bundles[_SUMS].to_numpy(float) / np.where(totals > 0, totals / shards, 1)
        residual, rows = np.ones((shards, len(_SUMS))), np.zeros(shards, np.int64)
        shard, start = np.empty(len(bundles), np.int32), np.empty(len(bundles), np.int64)
        for members in bundles.groupby("pack").indices.values():
            free = np.ones(shards, bool)
            for k in members[np.argsort(-need[members].sum(axis=1), kind="stable")]:
                best = int(np.argmax(np.where(free, residual @ (_WEIGHTS * need[k]), -np.inf)))
                free[best] = False
                residual[best] -= need[k]
                shard[k], start[k] = best, rows[best]
                rows[best] += bundles["rows"].iat[k]
        return bundles[["pack", "bundle"]].assign(shard=shard, start=start)

    return run


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, rows_per_pack: int = ROWS_PER_PACK
) -> DataFrame:
    """``doc_id``, ``size``, ``tokens``, ``text_crc32``, ``shard`` and ``slot`` of each row.

    ``size`` is the text's UTF-8 bytes plus 8, ``tokens`` its words.  Slots run
    from 0 without gaps in each shard.  A null text is like an empty one; null
    ids are allowed; repeated rows are placed each; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = saved(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text) + 8).cast("bigint").alias("size"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("tokens"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(F.lit(1), text).alias("one"),
            F.xxhash64(F.lit(2), text).alias("two"),
        ),
        "sizes",
    )
    total = rows.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    packs = min(MAX_PACKS, max(1, -(-total["rows"] // rows_per_pack)))
    parts = shards * packs * PIECE
    pieces = F.ceil(
        F.greatest(
            F.col("rows") * parts / F.lit(total["rows"] or 1),
            F.col("bytes") * parts / F.lit(total["bytes"] or 1),
        )
    )
    groups = rows.groupBy("one", "two").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    large = groups.where("rows > 1").withColumn("pieces", pieces).where("pieces > 1")
    piece = F.pmod(F.xxhash64("doc_id"), F.coalesce("pieces", F.lit(1)))
    units = rows.join(large.select("one", "two", "pieces"), ["one", "two"], "left").withColumn(
        "piece", piece
    )
    packed = units.drop("pieces").withColumn(
        "pack", F.pmod(F.xxhash64("one", "two", "piece"), F.lit(packs))
    )
    packed = saved(packed.groupBy("pack").applyInPandas(_pack(shards), _PACKED), "packed")
    bundles = packed.groupBy("pack", "bundle").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
    )
    # A row for each pack and bundle, at most MAX_PACKS * shards: small enough for one task.
    dealt = bundles.groupBy(F.lit(0).alias("all")).applyInPandas(
        _deal(shards), "pack bigint, bundle int, shard int, start bigint"
    )
    return packed.join(F.broadcast(dealt), ["pack", "bundle"]).select(
        "doc_id",
        "size",
        "tokens",
        "text_crc32",
        "shard",
        (F.col("start") + F.col("place")).alias("slot"),
    )
