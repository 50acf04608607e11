"""Token ids in grammar-compressed files that can be read at random.

Documents are put in order of their id by ranges, encoded, ended with an end id, and
written as shards of about ``SHARD_IDS`` ids.  A shard is compressed by Re-Pair: frequent
pairs of adjacent symbols are replaced by new symbols, again and again.  Each round counts
all pairs of the shard, gives the most frequent ones a symbol each, and where two chosen
pairs overlap replaces the more frequent one.  No pair reaches over the end of a document.

A row of the files is a shard.  ``body`` holds its symbols, ``rules`` the two symbols that
stand for each new one and ``lengths`` the number of ids that it expands to; both are
enough to read any ids of a document without the others (:func:`document_ids`).  Symbols
below the vocabulary's size are ids, the next one is a document's end, the rest are rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from orderflow.llm.bpe import _LONG_PIECE, _PLAIN, Codec, _is_plain
from orderflow.llm.common import long_rows
from orderflow.session import shared_dir

END_ID = 2
SHARD_IDS = 1 << 21
# A round makes at most so many rules, each for a pair that is replaced so often at least;
# rounds end when one saves less than this share of the symbols.
ROUND_RULES = 5200
LEAST_USES = 4
LEAST_GAIN = 0.03
_SLOT_BITS = 18
# Any longer run of spaces or of other bytes covers a whole block of this many.
_RUN = _LONG_PIECE // 2

SHARDS = pa.schema(
    [
        ("part", pa.int32()),
        ("shard", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("vocabulary", pa.int32()),
        ("end_id", pa.int32()),
        ("width", pa.int32()),
        ("rules", pa.large_binary()),
        ("lengths", pa.large_binary()),
        ("body", pa.large_binary()),
    ]
)
_DECODED = pa.schema(
    [
        ("part", pa.int32()),
        ("place", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.binary()),
    ]
)


class Encoder(Codec):
    """The codec with ids as arrays, without a list of them in between."""

    def array(self, text: bytes) -> np.ndarray:
        plain = self.ranks is not None and _plain(np.frombuffer(text, np.uint8))
        if plain and not any(token in text for token in self.special):
            return self.ranked.encode_to_numpy(text.decode(), disallowed_special=())
        return np.array(self.encode(text), np.uint32)


def _plain(data: np.ndarray) -> bool:
    """As the codec asks, but without a look at every word where no run of bytes is long."""
    whole = data[: len(data) // _RUN * _RUN].reshape(-1, _RUN)
    spaces = np.count_nonzero(whole <= 0x20, axis=1)
    if (spaces % _RUN != 0).all() and len(data) > _RUN:
        return data.max() <= _PLAIN
    return _is_plain(data)


def _slot(keys: np.ndarray) -> np.ndarray:
    factor, bits = keys.dtype.type(0x9E3779B1), 8 * keys.itemsize
    return (keys * factor) >> keys.dtype.type(bits - _SLOT_BITS)


def compress(symbols: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Rules (two symbols each) and the symbols left; new symbols count up from ``end + 1``.

    If ``end`` leaves room below 2**16, there are only as many rules as keep symbols there.
    """
    small = end + 1 + ROUND_RULES < 1 << 16
    room = (1 << 16) - end - 1 if small else 1 << 24
    shift, kind = (16, np.uint32) if small else (32, np.uint64)
    none = kind(np.iinfo(kind).max)
    rules, body = np.zeros((0, 2), np.uint32), symbols.astype(kind)
    while len(body) > 1 and len(rules) < room:
        key = (body[:-1] << kind(shift)) | body[1:]
        ends = np.flatnonzero(body == end)
        key[ends[ends < len(key)]] = none
        key[ends[ends > 0] - 1] = none
        ordered = np.sort(key)
        ordered = ordered[: np.searchsorted(ordered, none)]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        count = np.diff(first, append=len(ordered))
        often = np.flatnonzero(count >= LEAST_USES)
        often = often[np.argsort(-count[often], kind="stable")]
        pairs = ordered[first[often[: min(ROUND_RULES, room - len(rules))]]]
        if not len(pairs):
            break
        # The more frequent of two pairs takes a slot; the other waits for a later round.
        table = np.full(1 << _SLOT_BITS, len(pairs), np.int32)
        table[_slot(pairs[::-1])] = np.arange(len(pairs) - 1, -1, -1, dtype=np.int32)
        rank = table[_slot(key)]
        # An empty slot stands for a pair of ends, which no key is.
        at = np.flatnonzero(np.append(pairs, kind((end << shift) + end))[rank] == key)
        found = rank[at]
        next_to = at[1:] == at[:-1] + 1
        first_wins = found[:-1] <= found[1:]
        best = np.ones(len(at), bool)
        best[1:] &= ~(next_to & first_wins)
        best[:-1] &= ~next_to | first_wins
        at, found = at[best], found[best]
        uses = np.bincount(found, minlength=len(pairs))
        kept = np.flatnonzero(uses >= LEAST_USES)
        if not len(kept):
            break
        number = np.zeros(len(pairs), kind)
        number[kept] = end + 1 + len(rules) + np.arange(len(kept))
        new = number[found]
        at, new = at[new > 0], new[new > 0]
        body[at] = new
        stay = np.ones(len(body), bool)
        stay[at + 1] = False
        body = body[stay]
        low = kind((1 << shift) - 1)
        made = np.stack([pairs[kept] >> kind(shift), pairs[kept] & low], axis=1).astype(np.uint32)
        rules = np.concatenate([rules, made])
        if len(at) < LEAST_GAIN * (len(body) + len(at)):
            break
    return rules, body


def _levels(rules: np.ndarray, base: int) -> Iterator[tuple[int, int]]:
    """Runs of rules that only use what stands before the run, as those of a round do."""
    highest, start = rules.max(axis=1, initial=0).astype(np.int64), 0
    while start < len(rules):
        later = np.flatnonzero(highest[start:] >= base + start)
        end = start + int(later[0]) if len(later) else len(rules)
        yield start, end
        start = end


def rule_lengths(rules: np.ndarray, end: int) -> np.ndarray:
    """How many ids each rule expands to; a rule only uses earlier ones."""
    base = end + 1
    lengths = np.ones(base + len(rules), np.int64)
    for a, b in _levels(rules, base):
        lengths[base + a : base + b] = lengths[rules[a:b]].sum(axis=1)
    return lengths[base:]


class Grammar:
    """Expands symbols of a shard."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, end: int, end_id: int):
        base = end + 1
        lengths = lengths.astype(np.int32)
        self.length = np.concatenate([np.ones(base, np.int32), lengths])
        self.start = np.cumsum(self.length, dtype=np.int32) - self.length
        self.flat = np.zeros(base + int(lengths.sum()), np.uint32)
        self.flat[:base] = np.arange(base)
        self.flat[end] = end_id
        for a, b in _levels(rules, base):
            at = self.start[base + a]
            found = self.expand(rules[a:b].reshape(-1))
            self.flat[at : at + len(found)] = found

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of so many symbols as have less than 2**31 of them."""
        length = self.length[symbols]
        ends = np.cumsum(length, dtype=np.int32)
        total = int(ends[-1]) if len(ends) else 0
        from_to = np.repeat(self.start[symbols] - ends + length, length)
        from_to += np.arange(total, dtype=np.int32)
        return self.flat[from_to]


def _parts(row: dict) -> tuple[np.ndarray, Grammar]:
    kind = np.uint16 if row["width"] == 2 else np.uint32
    rules = np.frombuffer(row["rules"], kind).reshape(-1, 2)
    lengths = np.frombuffer(row["lengths"], np.uint32)
    body = np.frombuffer(row["body"], kind)
    return body, Grammar(rules, lengths, row["vocabulary"], row["end_id"])


def document_ids(row: dict, k: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of the ``k``-th document of a shard (a row of the files).

    The lengths of its symbols tell which of them hold these ids; only those are expanded.
    """
    body, grammar = _parts(row)
    ends = np.flatnonzero(body == row["vocabulary"])
    symbols = body[ends[k - 1] + 1 if k else 0 : ends[k] + 1]
    after = np.cumsum(grammar.length[symbols])
    stop = int(after[-1]) if stop is None else min(stop, int(after[-1]))
    if start >= stop:
        return np.zeros(0, np.uint32)
    a, b = np.searchsorted(after, [start, stop - 1], "right")
    skipped = int(after[a - 1]) if a else 0
    return grammar.expand(symbols[a : b + 1])[start - skipped : stop - skipped]


def _shard(ids: list[np.ndarray], docs: list, end: int, end_id: int, head: tuple) -> pa.RecordBatch:
    symbols = np.concatenate(ids)
    rules, body = compress(symbols, end)
    kind = np.uint16 if end + 1 + len(rules) <= 1 << 16 else np.uint32
    values = [
        *head,
        len(symbols),
        docs,
        end,
        end_id,
        kind().itemsize,
        rules.astype(kind).tobytes(),
        rule_lengths(rules, end).astype(np.uint32).tobytes(),
        body.astype(kind).tobytes(),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip(values, SHARDS.types, strict=True)], schema=SHARDS
    )


def _encode(path: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = Encoder(path), TaskContext.get().partitionId()
        end = len(codec.pieces)
        mark = np.array([end], np.uint32)
        ids: list[np.ndarray] = []
        docs: list[int | None] = []
        shard = first = held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                mine = codec.array(text.as_buffer().to_pybytes())
                if held and held + len(mine) >= shard_ids:
                    yield _shard(ids, docs, end, end_id, (part, shard, first))
                    shard, first, held, ids, docs = shard + 1, first + held, 0, [], []
                ids += [mine, mark]
                docs.append(doc_id.as_py())
                held += len(mine) + 1
        if docs:
            yield _shard(ids, docs, end, end_id, (part, shard, first))

    return run


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    path: str | None = None,
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
) -> str:
    """Write the ids of each document's whole text, with ``end_id`` after it; gives the path.

    Documents come by ascending ``doc_id``, nulls first, and by their place in the input
    where ids repeat.  Null and empty texts have the end id only.  A document that is longer
    than ``shard_ids`` has a shard of its own.  Other columns are ignored; an empty table
    gives files without a row.  ``tokenizer`` must be readable on the executors.
    """
    spark = docs.sparkSession
    long_rows(spark)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )
    ordered = rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    found = ordered.mapInArrow(_encode(tokenizer, end_id, shard_ids), from_arrow_schema(SHARDS))
    path = path or shared_dir(spark, "token-ids")
    found.write.parquet(path)
    return path


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows, one for each shard."""
    long_rows(spark)
    return spark.read.schema(from_arrow_schema(SHARDS)).parquet(path)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            body, grammar = _parts(row)
            ends = np.flatnonzero(body == row["vocabulary"]) + 1
            # As many documents at a time as have about a million symbols.
            done = 0
            place = row["first"]
            while done < len(ends):
                low = int(ends[done - 1]) if done else 0
                upto = max(done + 1, int(np.searchsorted(ends, low + (1 << 20), "right")))
                symbols = body[low : ends[upto - 1]]
                ids = grammar.expand(symbols)
                until = np.cumsum(grammar.length[symbols], dtype=np.int64)[ends[done:upto] - low - 1]
                counts = np.diff(until, prepend=0)
                offsets = np.concatenate(([0], 4 * until)).astype(np.int32)
                data = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(counts), row["part"], np.int32)),
                        pa.array(place + until - counts),
                        pa.array(row["doc_ids"][done:upto], pa.int64()),
                        pa.array(counts),
                        pa.Array.from_buffers(
                            pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
                        ),
                    ],
                    schema=_DECODED,
                )
                place += int(until[-1])
                done = upto


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids`` (unsigned 32-bit, little-endian).

    ``start`` is the number of ids of all documents before; ids end with the end id.
    """
    shards = read_shards(spark, path)
    decoded = shards.mapInArrow(_decode, from_arrow_schema(_DECODED))
    # A row for each range of documents: as many as the writer had tasks.
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    offsets = sums.select("part", before.alias("before"))
    return decoded.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids"
    )
