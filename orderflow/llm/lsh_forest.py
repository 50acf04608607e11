"""Near-duplicate documents by an LSH forest.

Each of ``trees`` orders sorts documents by a tuple of MinHash values.  At Jaccard
similarity s two documents share a prefix of length d in one order with chance s**d, so
with 40 orders at depth 6 a pair at s = 0.8 is missed with a chance of 5e-6, and a closer
one far more rarely.  Depth ``BASE`` is the floor, as shallower prefixes are never asked
for: all six values sort as one hash, the values below it one by one.  An order is put
into ranges and sorted, and each document has the longest prefix in common with one of its
neighbours.  Documents whose prefixes of depth ``BASE`` are equal are a region; one of more
than ``FEW`` members is split at the least depth, down to ``DEEP``, that leaves so few, as the
sorted order shows it; the end of a range may hide some.

Candidates are taken in passes that never list all pairs of a region:

1. Documents with equal shingle sets become one class; only its first stays.
2. Each document is compared with the neighbour, over all orders, with whom it has the
   longest prefix in common, and with the least ids of its regions, which draw a group
   together.  The links found join documents to components.
3. In regions that still hold several components, shingles are counted that occur in
   another of their documents: only these can be common to a pair.  Members are
   compared with the one that has the largest share of them, the likeliest centre, of
   the region and, where it is large, of its part at the depth that it asks for.
4. What is left at base depth, pairs of a region in different components, is compared
   one by one if set sizes and countable shingles allow a link, and if of ``BITS``
   further MinHash values, one bit of each, not so many differ that similarity enough
   is out of the question (a chance below 1e-6, like that of a miss by the forest).
   Pairs within a component need no comparison: they change nothing in the result.

Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

import functools
import hashlib
import math
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import free_names, mix, saved, text_blocks, texts
from orderflow.llm.components import connected, nearby
from orderflow.llm.shingles import shingle_hashes, shingle_set, shingle_sets

SHINGLE = 5
PERCENT = 80
TREES = 40
BASE = 6
DEEP = 9
# Members of a region that needs no greater depth.
FEW = 16
# Bits of each value below the base that order documents.
_LEVEL = 63 // (DEEP - BASE)

# One-bit MinHash values of documents in open regions, and standard deviations allowed.
BITS = 2048
_DEVIATIONS = 5.2

_SIGNED = (
    "doc_id bigint, hash bigint, n_shingles bigint, digest binary, "
    "base array<bigint>, deep array<bigint>"
)
# Shingles signed at once: keeps a block of values in the processor's cache.
_AT_ONCE = 1 << 15
_MEMBERS = (
    "id bigint, hash bigint, n_shingles bigint, base bigint, part bigint, depth int, near bigint"
)
_BIT_COLUMNS = [f"bits{k}" for k in range(BITS // 64)]
# Shingles of confirmed pairs that a task holds.
_KEPT = 1 << 22


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    values = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    flips, factors = (values >> np.uint64(32)).astype(np.uint32).reshape(2, count)
    return flips, factors | np.uint32(1)


def signatures(hashes: np.ndarray, begin: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values for each text that has shingles (others: the largest value)."""
    flips, factors = _permutations(count)
    out = np.full((len(begin) - 1, count), np.uint32(0xFFFFFFFF))
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    full = np.flatnonzero(np.diff(begin) > 0)
    k = 0
    while k < len(full):
        # A run of texts that fits the block; a longer text goes in pieces.
        end = int(np.searchsorted(begin[full], begin[full[k]] + _AT_ONCE, "right"))
        run = full[k : max(end - 1, k + 1)]
        low, high = begin[run[0]], begin[run[-1] + 1]
        for piece in range(low, high, 4 * _AT_ONCE):
            values = short[piece : min(piece + 4 * _AT_ONCE, high)]
            if len(run) == 1:
                for p in range(count):
                    least = ((values ^ flips[p]) * factors[p]).min()
                    out[run[0], p] = min(out[run[0], p], least)
            else:
                starts = begin[run] - low
                for p in range(count):
                    out[run, p] = np.minimum.reduceat((values ^ flips[p]) * factors[p], starts)
        k += len(run)
    return out


def prefix_keys(signature: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """One 64-bit key for each text and order: its prefix of this length."""
    values = signature.reshape(len(signature), trees, -1)[:, :, :depth].astype(np.uint64)
    key = np.broadcast_to(np.arange(trees, dtype=np.uint64), values.shape[:2])
    for level in range(depth):
        key = mix(key * np.uint64(0x9FB21C651E98DF25) + values[:, :, level])
    return key.view(np.int64)


def branch_keys(signature: np.ndarray, trees: int) -> np.ndarray:
    """One number for each text and order that sorts like its values below the base."""
    values = signature.reshape(len(signature), trees, -1)[:, :, BASE:DEEP]
    values = values.astype(np.int64) >> (32 - _LEVEL)
    return functools.reduce(
        lambda key, level: key << _LEVEL | values[:, :, level],
        range(DEEP - BASE),
        np.zeros(values.shape[:2], np.int64),
    )


def common_depths(base: np.ndarray, deep: np.ndarray, apart: int = 1) -> np.ndarray:
    """Length of the prefix that each row shares with the one so far on; 0 if its region ends
    before."""
    differ = deep[:-apart] ^ deep[apart:]
    depth = np.full(len(differ), BASE, np.int32)
    for level in range(DEEP - BASE):
        depth += differ >> (_LEVEL * level) == 0
    return np.where(base[:-apart] == base[apart:], depth, np.int32(0))


def _parts(base: np.ndarray, deep: np.ndarray) -> pa.Array:
    """A key of each row's prefix at the least depth that at most ``FEW`` rows share with it,
    or the greatest depth; null where that is the whole region."""
    # Depths to which some run of FEW + 1 rows that holds this row is alike.
    alike = np.zeros(len(base) + FEW, np.int32)
    if len(base) > FEW:
        alike[FEW : len(base)] = common_depths(base, deep, FEW)
    alike = np.lib.stride_tricks.sliding_window_view(alike, FEW + 1).max(axis=1)
    depth = np.minimum(alike + 1, DEEP)
    prefix = (deep >> (_LEVEL * (DEEP - np.maximum(depth, BASE)))).astype(np.uint64)
    key = mix(mix(base.view(np.uint64)) + prefix * np.uint64(DEEP) + depth.astype(np.uint64))
    return pa.array(key.view(np.int64), mask=alike < BASE)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted range, the rows that share a prefix with a neighbour, with its ``depth``,
    that neighbour (``near``) and the ``part`` of a large region that they are in.  The first
    and last row stay, as others may lie beyond."""

    def look(rows: pa.RecordBatch, start: int, end: int, last: bool) -> pa.RecordBatch:
        ids, base, deep = (rows.column(n).to_numpy() for n in ("id", "base", "deep"))
        depths = np.concatenate(([0], common_depths(base, deep), [0])).astype(np.int32)
        before, after = depths[:-1], depths[1:]
        near = np.where(before >= after, np.roll(ids, 1), np.roll(ids, -1))
        depth = np.maximum(before, after)
        stays = depth > 0
        stays[0] = True
        stays[-1] |= last
        kept = rows.select(["id", "hash", "n_shingles", "base"])
        out = pa.RecordBatch.from_arrays(
            [*kept.columns, _parts(base, deep), pa.array(depth), pa.array(near, mask=depth == 0)],
            [*kept.schema.names, "part", "depth", "near"],
        )
        return out.slice(start, end - start).filter(pa.array(stays[start:end]))

    # The last rows wait for the next batch, with as many before them.
    held, start = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        end = batch.num_rows - FEW
        if end > start:
            yield look(batch, start, end, False)
            low = max(end - FEW, 0)
            batch, start = batch.slice(low), end - low
        held = batch
    if held is not None:
        yield look(held, start, held.num_rows, True)


def _sign(size: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in text_blocks(batches):
            hashes, begin = shingle_hashes(data, bounds, size)
            sets = [np.unique(hashes[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
            begin = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)
            signature = signatures(np.concatenate(sets), begin, trees * DEEP)
            keys = [prefix_keys(signature, trees, BASE), branch_keys(signature, trees)]
            ends = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * trees)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                    *(pa.ListArray.from_arrays(ends, pa.array(k.ravel())) for k in keys),
                ],
                ["doc_id", "hash", "n_shingles", "digest", "base", "deep"],
            )

    return run


def _confirm(size: int, percent: int):
    """Of pairs with both texts, those whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sets are kept for the pairs that follow, up to a number of shingles.
        kept, room = {}, _KEPT

        def shingles(key: int, text: str) -> np.ndarray:
            nonlocal room
            if key not in kept:
                found = shingle_set(text, size)
                room -= len(found)
                if room < 0:
                    kept.clear()
                    room = _KEPT - len(found)
                kept[key] = found
            return kept[key]

        for batch in batches:
            linked = []
            for a, b, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one, two = shingles(a, left), shingles(b, right)
                at = np.searchsorted(two, one)
                both = np.count_nonzero(two[np.minimum(at, len(two) - 1)] == one)
                linked.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _star(members: DataFrame, depth: str, best: Column) -> DataFrame:
    """Each member of a region beside the region's best member, a struct that ends in its id."""
    first = members.groupBy(depth).agg(F.max(best).alias("best"), F.count("*").alias("size"))
    first = first.where("size > 1").select(depth, F.col("best.id").alias("a"))
    pairs = members.join(first, depth).select("a", F.col("id").alias("b"))
    return pairs.where("a <> b").distinct()


def _list_shingles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in text_blocks(batches):
            sets = shingle_sets(data, bounds, size)
            row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [rows.column("id").take(pa.array(row)), pa.array(np.concatenate(sets).view(np.int64))],
                ["id", "shingle"],
            )

    return run


def _list_bits(size: int):
    """One bit of ``BITS`` MinHash values of each text, as 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in text_blocks(batches):
            hashes, begin = shingle_hashes(data, bounds, size)
            odd = (signatures(hashes, begin, BITS) >> np.uint32(16)).astype(np.uint8) & 1
            bits = np.packbits(odd, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("id"),
                    rows.column("hash"),
                    *(pa.array(bits[:, k].copy()) for k in range(BITS // 64)),
                ],
                ["id", "hash", *_BIT_COLUMNS],
            )

    return run


def _with_common(members: DataFrame, near: DataFrame, size: int, percent: int) -> DataFrame:
    """Members with ``common``: their shingles that another member has.  A link to a set
    of n needs percent / (100 + percent) of the two sizes' sum in common; members whose
    common shingles cannot be enough for any set are left out."""
    ids = members.select("id").distinct()
    shingles = near.join(ids, "id", "left_semi").mapInArrow(
        _list_shingles(size), "id bigint, shingle bigint"
    )
    shingles = saved(shingles, "shingles")
    often = shingles.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    common = shingles.join(often.select("shingle"), "shingle").groupBy("id")
    common = common.agg(F.count("*").alias("common"))
    return members.join(common, "id").where(100 * F.col("common") >= percent * F.col("n_shingles"))


def _open_regions(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members of regions that hold more than one component."""
    placed = members.drop("component").join(components, "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    seen = placed.groupBy("base").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high")
    )
    return placed.join(seen.where("_low <> _high").select("base"), "base")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, trees: int = TREES
) -> DataFrame:
    """``doc_id``, ``hash`` (of the text), ``n_shingles``, ``component_id`` and ``kept``, per row.

    Documents with at least ``percent`` of their shingles in common (of the
    union) are linked; ``component_id`` is the smallest id reachable over links.
    Texts that are null or have no word are linked with nothing.  Rows with one
    id but different texts count as one node; a null id is a node of its own,
    shared by all rows without id, with a null component, and is never linked.
    Repeated rows give repeated results.  ``kept`` holds where the id is the
    component's.
    """
    source = texts(docs)
    signed = saved(source.mapInArrow(_sign(size, trees), _SIGNED), "signed")
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("digest", "n_shingles").agg(
        F.min(F.struct("doc_id", "hash")).alias("first")
    )
    classes = saved(
        classes.select(
            "digest", "n_shingles", F.col("first.doc_id").alias("id"), F.col("first.hash")
        ),
        "classes",
    )
    # Equal sets are linked; one id with several texts ties their classes together.
    edges = [
        usable.join(classes.select("digest", "n_shingles", "id"), ["digest", "n_shingles"])
        .select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
        .where("a <> b")
    ]

    keyed = signed.select("doc_id", "hash", "base", "deep").dropDuplicates(["doc_id", "hash"])
    keyed = classes.withColumnRenamed("id", "doc_id").join(keyed, ["doc_id", "hash"])
    members = keyed.select(
        F.col("doc_id").alias("id"),
        "hash",
        "n_shingles",
        F.explode(F.arrays_zip("base", "deep")).alias("key"),
    ).select("id", "hash", "n_shingles", "key.base", "key.deep")
    # Ranges cut large regions too: by the values below the base, then by id.
    order = ["base", "deep", "id"]
    members = members.repartitionByRange(*order).sortWithinPartitions(*order)
    members = saved(members.mapInArrow(_neighbours, _MEMBERS), "regions")
    wanted = members.select("id", "hash").distinct()
    near = saved(
        source.withColumnRenamed("doc_id", "id")
        .join(wanted, ["id", "hash"], "left_semi")
        .dropDuplicates(["id", "hash"])
        .select("id", "hash", "text"),
        "candidates",
    )
    orders = keyed.select(F.col("doc_id").alias("id"), "hash", F.col("base").alias("orders"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        right = near.select(F.col("id").alias("b"), F.col("text").alias("right"))
        left = near.select(F.col("id").alias("a"), F.col("text").alias("left"))
        both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
        found = both.mapInArrow(_confirm(size, percent), "a bigint, b bigint")
        return saved(found, "links", narrow=True)

    nearest = members.where("near <> id").groupBy("id")
    nearest = nearest.agg(F.max(F.struct("depth", (-F.col("near")).alias("low"))).alias("best"))
    other = -F.col("best.low")
    nearest = nearest.select(F.least("id", other).alias("a"), F.greatest("id", other).alias("b"))
    heads = _star(members, "base", F.struct((-F.col("id")).alias("low"), "id"))
    links = confirmed(nearest.unionByName(heads).distinct())
    components = saved(nearby(links), "components", narrow=True)
    open_ = _open_regions(members, components)
    open_ = saved(_with_common(open_, near, size, percent), "open", narrow=True)
    central = F.struct(
        (F.col("common") / F.col("n_shingles")).alias("share"), (-F.col("id")).alias("low"), "id"
    )
    pairs = _star(open_, "base", central).unionByName(_star(open_.where("part is not null"), "part", central))
    links = links.unionByName(confirmed(pairs.distinct()))
    components = saved(nearby(links), "components", narrow=True)
    open_ = saved(_open_regions(open_, components), "open", narrow=True)
    key = ["id", "hash"]
    bits = near.join(open_.select(*key).distinct(), key, "left_semi").mapInArrow(
        _list_bits(size), ", ".join(f"{name} bigint" for name in [*key, *_BIT_COLUMNS])
    )
    rest = saved(open_.join(bits, key).join(orders, key), "rest")
    one, two = rest.alias("one"), rest.alias("two")
    both_sizes = F.col("one.n_shingles") + F.col("two.n_shingles")
    differ = functools.reduce(
        operator.add,
        (F.bit_count(F.col(f"one.{n}").bitwiseXOR(F.col(f"two.{n}"))) for n in _BIT_COLUMNS),
    )
    # Bits of two documents agree with a chance of (1 + similarity) / 2.
    chance = (1 - percent / 100) / 2
    most = math.ceil(BITS * chance + _DEVIATIONS * math.sqrt(BITS * chance * (1 - chance)))
    same = F.zip_with("one.orders", "two.orders", lambda x, y: x == y)
    rest = one.join(two, F.col("one.base") == F.col("two.base")).where(
        (F.col("one.id") < F.col("two.id"))
        & (F.col("one.component") != F.col("two.component"))
        & (
            100 * F.least("one.n_shingles", "two.n_shingles")
            >= percent * F.greatest("one.n_shingles", "two.n_shingles")
        )
        & ((100 + percent) * F.least("one.common", "two.common") >= percent * both_sizes)
        & (differ <= most)
        # Once only: in the first order where the two meet.
        & (F.element_at("one.orders", F.array_position(same, True).cast("int")) == F.col("one.base"))
    )
    rest = rest.select(F.col("one.id").alias("a"), F.col("two.id").alias("b")).distinct()
    links = links.unionByName(confirmed(rest))
    for more in edges:
        links = links.unionByName(more)
    components = connected(links).withColumnRenamed("id", "doc_id")

    rows = signed.select("doc_id", "hash", "n_shingles").join(components, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component"))
    component = F.coalesce(component, "doc_id")
    return rows.select(
        "doc_id",
        "hash",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame, **settings) -> DataFrame:
    """One document of each group, with all columns, whatever their names; of repeated rows
    one stays as well."""
    found = near_duplicates(docs, **settings)
    own, gone_id, gone_hash = free_names(docs, "_hash", "_gone", "_text")
    gone = found.where("not kept").select(
        F.col("doc_id").alias(gone_id), F.col("hash").alias(gone_hash)
    )
    marked = docs.withColumn(own, F.xxhash64(F.col("text").cast("string")))
    on = (F.col("doc_id") == F.col(gone_id)) & (F.col(own) == F.col(gone_hash))
    rest = marked.join(gone.distinct(), on, "left_anti")
    return rest.dropDuplicates(["doc_id", own]).drop(own)
