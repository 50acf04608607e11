"""Benchmark decontamination: short test items searched in long documents.

An item with m distinct shingles counts as contained when a document holds at
least ``share`` of them.  Such a document then holds one of *any* m - ceil(share
* m) + 1 of the item's shingles, so the item's smallest that many MinHash values
are a sketch that no containing document can miss.  Items are put into partitions
by size (powers of two); each has its own sketch length, its own bound on the
hash values worth looking up and its own least document size.  A document that
meets a sketch is then verified on the full shingle sets.

An item with fewer words than a shingle is one shingle of all its words, and is searched
among the documents' shingles of that many words; only lengths that occur are searched.

Items are held in blocks of at most ``block_shingles`` shingles, which bounds
what is sent to the executors; every block is searched in all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import saved, text_blocks, texts
from orderflow.llm.shingles import shingle_hashes, shingle_set, shingle_sets, word_hashes

SHINGLE = 5
SHARE_PERCENT = 80
BLOCK_SHINGLES = 1 << 20

_ITEM = "item_id bigint, size int, n_shingles bigint, shingles binary"
_FOUND = (
    "doc_id bigint, hash bigint, item_id bigint, n_shingles bigint, n_common bigint"
)


def needed(n_shingles: int, percent: int) -> int:
    """Shingles that a document must share with an item of this size."""
    return -(-n_shingles * percent // 100)


@dataclass
class Partition:
    """Items of one size class: sorted sketch keys, and the item that each belongs to."""

    least: int
    largest_key: np.uint64
    keys: np.ndarray
    items: np.ndarray


def size_partitions(sets: list[np.ndarray], percent: int) -> list[Partition]:
    classes: dict[int, list[int]] = {}
    for k, shingles in enumerate(sets):
        classes.setdefault(len(shingles).bit_length(), []).append(k)
    out = []
    for members in classes.values():
        spare = max(len(sets[k]) - needed(len(sets[k]), percent) for k in members)
        # Sets are sorted by hash, so a set's first values are its smallest.
        keys = np.concatenate([sets[k][: spare + 1] for k in members])
        items = np.concatenate([np.full(len(sets[k][: spare + 1]), k) for k in members])
        order = np.argsort(keys, kind="stable")
        least = min(needed(len(sets[k]), percent) for k in members)
        out.append(Partition(least, keys.max(), keys[order], items[order]))
    return out


@dataclass
class Search:
    """Items whose shingles have one number of words: their partitions and shingle sets."""

    size: int
    ids: list[int]
    sets: list[np.ndarray]
    partitions: list[Partition]


def searches(items: list[tuple[int, int, np.ndarray]], percent: int) -> list[Search]:
    """One search for each shingle size of (id, size, shingle set) items."""
    out = []
    for size in sorted({size for _, size, _ in items}):
        ids = [item for item, own, _ in items if own == size]
        sets = [shingles for _, own, shingles in items if own == size]
        out.append(Search(size, ids, sets, size_partitions(sets, percent)))
    return out


def _items(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in text_blocks(batches):
            sets = shingle_sets(data, bounds, size)
            counts = np.diff(word_hashes(data, bounds)[1])
            for k in np.flatnonzero((counts > 0) & (counts < size)):
                sets[k] = shingle_set(data[bounds[k] : bounds[k + 1]].tobytes(), int(counts[k]))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("item_id"),
                    pa.array(np.minimum(counts, size), pa.int32()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["item_id", "size", "n_shingles", "shingles"],
            )

    return run


def _contained(data: np.ndarray, bounds: np.ndarray, search: Search, percent: int):
    """(text, item, common shingles) for each text that holds an item of the search."""
    hashes, begin = shingle_hashes(data, bounds, search.size)
    counts, sets = np.diff(begin), search.sets
    meets: set[tuple[int, int]] = set()
    for part in search.partitions:
        near = np.flatnonzero(hashes <= part.largest_key)
        left = np.searchsorted(part.keys, hashes[near], "left")
        hit = np.flatnonzero(part.keys[left] == hashes[near])
        docs = np.searchsorted(begin, near[hit], "right") - 1
        for doc, shingle, k in zip(docs, near[hit], left[hit], strict=True):
            while counts[doc] >= part.least and k < len(part.keys):
                if part.keys[k] != hashes[shingle]:
                    break
                meets.add((int(doc), int(part.items[k])))
                k += 1
    last, held = -1, hashes
    for doc, item in sorted(meets):
        if doc != last:
            last, held = doc, np.unique(hashes[begin[doc] : begin[doc + 1]])
        at = np.minimum(np.searchsorted(held, sets[item]), len(held) - 1)
        common = int(np.count_nonzero(held[at] == sets[item]))
        if common >= needed(len(sets[item]), percent):
            yield doc, item, common


def _search(shared, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = searches(shared.value, percent)
        for rows, data, bounds in text_blocks(batches):
            docs, numbers = [], []
            for search in parts:
                for doc, item, common in _contained(data, bounds, search, percent):
                    docs.append(doc)
                    numbers.append((search.ids[item], len(search.sets[item]), common))
            key = rows.select(["doc_id", "hash"]).take(pa.array(docs, pa.int64()))
            columns = [pa.array([row[k] for row in numbers], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*key.columns, *columns], ["doc_id", "hash", "item_id", "n_shingles", "n_common"]
            )

    return run


def _drop(shared, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = searches(shared.value, percent)
        for rows, data, bounds in text_blocks(batches):
            clean = np.ones(rows.num_rows, bool)
            for search in parts:
                clean[[doc for doc, _, _ in _contained(data, bounds, search, percent)]] = False
            yield rows.filter(pa.array(clean))

    return run


def _blocks(spark, items: DataFrame, size: int, block_shingles: int):
    """The items that have shingles, in broadcast blocks: ids, words in a shingle, shingle sets."""
    sketched = saved(
        items.select(
            F.col("item_id").cast("bigint").alias("item_id"),
            F.col("text").cast("string").alias("text"),
        )
        .mapInArrow(_items(size), _ITEM)
        .where("n_shingles > 0"),
        "items",
    )
    total = sketched.agg(F.sum("n_shingles")).first()[0] or 0
    blocks = -(-total // block_shingles)
    for block in range(blocks):
        # Blocks split by hash; the sizes even out, as an item is far smaller than a block.
        part = sketched.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == block)
        rows = part.select("item_id", "size", "shingles").collect()
        if rows:
            yield spark.sparkContext.broadcast(
                [(item, own, np.frombuffer(held, np.uint64)) for item, own, held in rows]
            )


def find_contained(
    docs: DataFrame,
    items: DataFrame,
    size: int = SHINGLE,
    percent: int = SHARE_PERCENT,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """Pairs of a document and an item it contains.

    Returns ``doc_id``, ``hash`` (of the text), ``item_id``, ``n_shingles`` (of
    the item) and ``n_common``; repeated rows give repeated pairs.  Null and
    empty items and texts, and items without words, match nothing.  An item with
    fewer words than a shingle is found wherever just those words follow one another.
    Null ids are kept; other columns are ignored.
    """
    spark = docs.sparkSession
    sources = texts(docs).where("length(text) > 0")
    found = spark.createDataFrame([], _FOUND)
    for shared in _blocks(spark, items, size, block_shingles):
        found = found.unionByName(sources.mapInArrow(_search(shared, percent), _FOUND))
    return found


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    size: int = SHINGLE,
    percent: int = SHARE_PERCENT,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """The documents that contain no item, with all their columns; no shuffle.

    Repeated rows go or stay together; null and empty texts stay.
    """
    for shared in _blocks(docs.sparkSession, items, size, block_shingles):
        docs = docs.mapInArrow(_drop(shared, percent), docs.schema)
    return docs
