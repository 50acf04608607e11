"""Removal of byte strings that occur earlier in the corpus, by suffix arrays.

A string of ``LENGTH`` bytes that starts at s is removed if the same string starts
earlier: in a document with a smaller id, or earlier in the same one.

*Which suffixes can match.*  Each string of ``LENGTH`` bytes has an anchor: of the
``GRAM``-byte substrings in it, the leftmost of least hash.  Equal strings have equal
anchors at equal distances, so only anchors that occur twice in the corpus matter, and
all strings that can be equal are found at occurrences of one anchor.  The strings
that one occurrence stands for are neighbours in the text: together they make its
context.

*Shards.*  Equal contexts are merged before any is moved; all but the first are
repeats.  The different contexts of an anchor meet in one shard.  An anchor with many
of them is split over several shards.

*In a shard*, the contexts' suffixes are sorted (Larsson-Sadakane) and the common
prefixes computed (Kasai).  Suffixes that share ``LENGTH`` bytes are one class; all
but the first are repeats.

*Across shards* of a split anchor, what each shard has found first is merged: the
shards' classes are dealt out in ranges of their digests and sorted, and equal
neighbours are compared.  No shard is searched for another's classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import BLOCK_BYTES, free_names, mix, saved, text_blocks
from orderflow.llm.suffix_array import common_prefixes, suffix_order

LENGTH = 100
GRAM = 24
# Different contexts of one anchor that a shard takes.
SHARD_CONTEXTS = 4096
# Bytes of contexts that are sorted at once; a shard of one anchor is never cut.
SORTED_BYTES = 1 << 17

_ANCHORS = "anchor bigint, context bigint, id bigint, hash bigint, at int, span int"
_CONTEXTS = "anchor bigint, part bigint, split boolean, id bigint, hash bigint, start int, text binary"
_FOUND = (
    "id bigint, hash bigint, first int, last int, anchor bigint, "
    "digest1 bigint, digest2 bigint, at int"
)
_VALUES = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x2545F4914F6CDD1D))
_BASE = 0x9FB21C651E98DF25
_PLACE_BITS = 24


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on; the last places have none."""
    widths: dict[int, np.ndarray] = {1: _VALUES[data]}
    power, width = {1: _BASE}, 1
    while 2 * width <= GRAM:
        half = widths[width]
        widths[2 * width] = half[:-width] * np.uint64(power[width]) + half[width:]
        power[2 * width] = power[width] ** 2 % (1 << 64)
        width *= 2
    out = widths[width]
    while width < GRAM:
        more = max(w for w in widths if w <= GRAM - width)
        tail = widths[more][width:]
        out = out[: len(tail)] * np.uint64(power[more]) + tail
        width += more
    return mix(out)


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts end to end: text number, anchor hash, anchor's place, first and last string.

    Each row stands for the strings that start from first to last, places counted
    in ``data``.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty.astype(np.uint64), empty, empty, empty
    if len(data) >= 1 << _PLACE_BITS:
        # A very long text: in pieces that overlap by what a string may need.
        out, step = [], (1 << _PLACE_BITS) - LENGTH
        for low in range(0, len(data) - LENGTH + 1, step):
            high = min(low + step + LENGTH - 1, len(data))
            found = anchors(data[low:high], np.clip(bounds, low, high) - low)
            out.append((found[0], found[1], *(x + low for x in found[2:])))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))
    grams = _gram_hashes(data)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    window, width = LENGTH - GRAM + 1, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = window - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    # Strings that lie in one text.
    counts = np.maximum(np.diff(bounds) - LENGTH + 1, 0)
    begin = np.concatenate(([0], np.cumsum(counts)))
    starts = np.arange(begin[-1]) + np.repeat(bounds[:-1] - begin[:-1], counts)
    text = np.repeat(np.arange(len(counts)), counts)
    place = (least[starts] & low).astype(np.int64)
    if not len(place):
        return empty, empty.astype(np.uint64), empty, empty, empty
    new = np.flatnonzero(np.diff(place, prepend=-1))
    end = np.append(new[1:], len(place)) - 1
    return text[new], grams[place[new]], place[new], starts[new], starts[end]


def _context_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``first`` to ``end``, wherever they stand."""
    inverse = np.full(len(data) + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    powers = np.full(len(data) + 1, _BASE, np.uint64)
    inverse[0] = powers[0] = 1
    powers, inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
    total = np.concatenate(([np.uint64(0)], np.cumsum(_VALUES[data] * powers[:-1])))
    return mix((total[end] - total[first]) * inverse[first] + (end - first).astype(np.uint64))


def _only_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, data, bounds in text_blocks(batches, limit=BLOCK_BYTES // 2):
        found = anchors(data, bounds)[1]
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["anchor"])


def _with_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, bounds in text_blocks(batches, limit=BLOCK_BYTES // 2):
        text, anchor, place, first, last = anchors(data, bounds)
        context = _context_hashes(data, first, last + LENGTH)
        key = rows.select(["id", "hash"]).take(pa.array(text))
        columns = [
            pa.array(anchor.view(np.int64)),
            pa.array(context.view(np.int64)),
            *key.columns,
            pa.array((first - bounds[text]).astype(np.int32)),
            pa.array((last - first).astype(np.int32)),
        ]
        yield pa.RecordBatch.from_arrays(
            columns, ["anchor", "context", "id", "hash", "at", "span"]
        )


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that a text has first."""
    names = ["anchor", "part", "split", "id", "hash", "start", "text"]
    for batch in batches:
        for rows, data, bounds in text_blocks([batch]):
            whole, wanted = data.tobytes(), rows.column("contexts")
            lists = np.asarray(wanted.value_lengths().fill_null(0))
            flat = wanted.flatten()
            anchor, part, split, start, span = flat.flatten()
            row = np.repeat(np.arange(len(lists)), lists)
            low = np.asarray(start, np.int64) + bounds[row]
            high = low + np.asarray(span) + LENGTH
            key = rows.select(["id", "hash"]).take(pa.array(row))
            texts = [whole[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [anchor, part, split, *key.columns, start, pa.array(texts, pa.binary())], names
            )


def _runs(flags: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of flags within one context."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    new = np.flatnonzero((np.diff(at, prepend=at[0] - 2) > 1) | (np.diff(own[at], prepend=-1) != 0))
    return at[new], at[np.append(new[1:], len(at)) - 1]


def repeats_in(
    texts: list[bytes], ids: np.ndarray, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sort the contexts' suffixes and flag strings that an earlier one equals.

    Gives, for each byte of the contexts end to end: its context, its place in the
    context, whether a string starts there, and whether that is a repeat.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    own = np.repeat(np.arange(len(texts)), sizes)
    inside = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    is_start = inside <= np.repeat(sizes - LENGTH, sizes)
    order, place = suffix_order(data)
    shared = common_prefixes(data, order, place, LENGTH)
    group = np.cumsum(shared < LENGTH) - 1
    # Earlier is a smaller id, then a smaller start; equal strings stand alike to their anchor.
    when = np.lexsort((starts, ids))
    turn = np.empty(len(texts), np.int64)
    same = np.zeros(len(texts), bool)
    same[1:] = (ids[when][1:] == ids[when][:-1]) & (starts[when][1:] == starts[when][:-1])
    turn[when] = np.cumsum(~same)
    real = is_start[order]
    first = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, group[real], turn[own[order[real]]])
    repeat = np.zeros(len(data), bool)
    repeat[order[real]] = turn[own[order[real]]] > first[group[real]]
    return own, inside, is_start, repeat


def _shard_rows(rows: pa.Table) -> pa.RecordBatch:
    texts = rows.column("text").to_pylist()
    ids, starts, hashes, anchor = (
        rows.column(name).to_numpy() for name in ("id", "start", "hash", "anchor")
    )
    split = rows.column("split").to_numpy()
    own, inside, is_start, repeat = repeats_in(texts, ids, starts)
    low, high = _runs(repeat, own)
    # What a part of a split anchor has found first goes on to the merge.
    rest = np.flatnonzero(is_start & ~repeat & split[own])
    digests = [
        hashlib.blake2b(texts[k][i : i + LENGTH], digest_size=16).digest()
        for k, i in zip(own[rest].tolist(), inside[rest].tolist(), strict=True)
    ]
    digest = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    context = np.concatenate([own[low], own[rest]])
    first = np.concatenate([starts[own[low]] + inside[low], starts[own[rest]] + inside[rest]])
    last = np.concatenate([starts[own[high]] + inside[high], starts[own[rest]] + inside[rest]])
    none = np.concatenate([np.ones(len(low), bool), np.zeros(len(rest), bool)])
    pad = np.zeros((len(low), 2), np.int64)
    both = np.concatenate([pad, digest])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[context]),
            pa.array(hashes[context]),
            pa.array(first.astype(np.int32)),
            pa.array(last.astype(np.int32)),
            pa.array(anchor[context]),
            pa.array(both[:, 0], mask=none),
            pa.array(both[:, 1], mask=none),
            pa.array(starts[context].astype(np.int32)),
        ],
        ["id", "hash", "first", "last", "anchor", "digest1", "digest2", "at"],
    )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor and part; blocks end where these change."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(n).to_numpy() for n in ("anchor", "part")])
        change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        lengths = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        if held:
            before = [held[-1].column(n)[-1].as_py() for n in ("anchor", "part")]
            if before != keys[:, 0].tolist():
                change = np.concatenate(([0], change))
        row, done = 0, 0
        for cut in change.tolist():
            so_far = size + int(lengths[cut - 1] if cut else 0) - done
            if so_far >= SORTED_BYTES:
                part = [*held, batch.slice(row, cut - row)]
                yield _shard_rows(pa.Table.from_batches(part))
                held, size, row, done = [], 0, cut, int(lengths[cut - 1] if cut else 0)
        if row < batch.num_rows:
            held.append(batch.slice(row))
            size += int(lengths[-1]) - done
    if held:
        yield _shard_rows(pa.Table.from_batches(held))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by digest, then id and start; all equal digests are in one task."""
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two, ids, first = (
            batch.column(n).to_numpy() for n in ("digest1", "digest2", "id", "first")
        )
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        heads = np.flatnonzero(new)
        head = heads[np.searchsorted(heads, np.arange(len(one)), "right") - 1]
        head_id, head_first = ids[head], first[head]
        if last is not None and last[:2] == (one[0], two[0]):
            carried = head == 0
            head_id, head_first = head_id.copy(), head_first.copy()
            head_id[carried], head_first[carried] = last[2:]
        last = (one[-1], two[-1], head_id[-1], head_first[-1])
        repeat = (ids != head_id) | (first != head_first)
        yield batch.select(["id", "hash", "first", "last"]).filter(pa.array(repeat))


def repeated_strings(source: DataFrame) -> DataFrame:
    """``id``, ``hash`` and ``ranges`` of the places where repeated strings start.

    ``source`` has ``id``, ``hash`` and ``text``, none null.  ``ranges`` is an array
    of first and last start.
    """
    counts = source.select("text").mapInArrow(_only_anchors, "anchor bigint")
    counts = counts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    shared = saved(counts.select("anchor"), "anchors")
    found = source.mapInArrow(_with_contexts, _ANCHORS)
    found = saved(found.join(shared.hint("shuffle_hash"), "anchor"), "occurrences")

    earliest = F.min(F.struct("id", "at", "hash", "span")).alias("first")
    contexts = saved(
        found.groupBy("anchor", "context").agg(F.count("*").alias("n"), earliest), "contexts"
    )
    # Equal contexts: all but the first are repeats, from their first string to their last.
    again = found.join(contexts.where("n > 1"), ["anchor", "context"]).where(
        (F.col("id") != F.col("first.id")) | (F.col("at") != F.col("first.at"))
    )
    again = again.select("id", "hash", F.col("at").alias("first"), (F.expr("at + span")).alias("last"))

    parts = contexts.groupBy("anchor").agg(F.count("*").alias("different")).where("different > 1")
    parts = parts.select("anchor", F.ceil(F.col("different") / SHARD_CONTEXTS).alias("parts"))
    wanted = contexts.join(parts, "anchor").select(
        "anchor",
        F.pmod(F.xxhash64("context"), F.col("parts")).alias("part"),
        (F.col("parts") > 1).alias("split"),
        F.col("first.id").alias("id"),
        F.col("first.hash").alias("hash"),
        F.col("first.at").alias("start"),
        F.col("first.span").alias("span"),
    )
    by_text = wanted.groupBy("id", "hash").agg(
        F.collect_list(F.struct("anchor", "part", "split", "start", "span")).alias("contexts")
    )
    cut = source.join(by_text, ["id", "hash"]).mapInArrow(_cut_contexts, _CONTEXTS)
    # Repeated rows cut the same contexts twice.
    shards = cut.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    sorted_ = saved(shards.mapInArrow(_shards, _FOUND), "repeats")
    within = sorted_.where("digest1 is null").select("id", "hash", "first", "last")
    merge = sorted_.where("digest1 is not null").repartitionByRange("digest1", "digest2")
    merge = merge.sortWithinPartitions("digest1", "digest2", "id", "first")
    across = merge.mapInArrow(_merge, "id bigint, hash bigint, first int, last int")

    every = within.unionByName(across).unionByName(again)
    return every.groupBy("id", "hash").agg(
        F.collect_list(F.struct("first", "last")).alias("ranges")
    )


def removed_spans(size: int, ranges: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes, as begin and end."""
    out: list[list[int]] = []
    for one in sorted((r["first"], r["last"] + LENGTH) for r in ranges or ()):
        if out and one[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], one[1])
        else:
            out.append([*one])
    return [(a, min(b, size)) for a, b in out]


def _without(whole_characters: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in text_blocks([batch]):
                whole = data.tobytes()
                kept, spans = [], []
                for k, ranges in enumerate(rows.columns[-1]):
                    text = whole[bounds[k] : bounds[k + 1]]
                    runs = removed_spans(len(text), ranges.as_py())
                    if whole_characters:
                        runs = [_characters(text, a, b) for a, b in runs]
                    edges = [0, *(x for run in runs for x in run), len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                    spans.append([{"begin": a, "end": b} for a, b in runs])
                kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns[:-1],
                        pa.array([int(n) for n in np.diff(bounds)], pa.int64()),
                        pa.array(spans, kind),
                        pa.array(kept, pa.binary()),
                    ],
                    names,
                )

    return run


def _characters(text: bytes, begin: int, end: int) -> tuple[int, int]:
    """The whole characters in a run of bytes."""
    while begin < end and text[begin] & 0xC0 == 0x80:
        begin += 1
    while end > begin and end < len(text) and text[end] & 0xC0 == 0x80:
        end -= 1
    return begin, end


def remove_repeats(docs: DataFrame, whole_characters: bool = False) -> DataFrame:
    """``docs`` with ``n_bytes``, ``removed`` (spans of bytes) and ``kept`` (the rest).

    All other columns stay, whatever their names; columns of ``docs`` with these three
    names give way to the new ones.  With ``whole_characters`` a character is removed only if all its bytes are.  Null
    texts are empty; texts shorter than ``LENGTH`` lose nothing.  A null id is a
    document before all others.  Rows with equal ids are one document, in which
    strings at equal starts are not earlier than one another: repeated rows have
    equal results.
    """
    docs = docs.drop("n_bytes", "removed", "kept")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = _key()
    source = docs.select(*key, text.alias("text"))
    ranges = repeated_strings(source.where(F.octet_length("text") >= LENGTH))
    own = free_names(docs, "_id", "_hash", "_ranges")
    ranges = saved(ranges, "ranges").select(
        *[F.col(c).alias(name) for c, name in zip(("id", "hash", "ranges"), own, strict=True)]
    )
    keyed = docs.withColumns({own[0]: key[0], own[1]: key[1]})
    joined = keyed.join(ranges, own[:2], "left")
    joined = joined.select(*(F.col(f"`{c}`") for c in docs.columns), own[2])
    spans = F.lit(None).cast("array<struct<begin:int,end:int>>")
    schema = docs.withColumns(
        {"n_bytes": F.lit(None).cast("bigint"), "removed": spans, "kept": F.lit(b"")}
    ).schema
    return joined.mapInArrow(_without(whole_characters, schema.names), schema)


def _key() -> tuple[Column, Column]:
    least = F.lit(-(2**63))
    return (
        F.coalesce(F.col("doc_id").cast("bigint"), least).alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("hash"),
    )
