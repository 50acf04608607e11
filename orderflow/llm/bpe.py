"""Byte-level BPE with reuse of content-defined chunks, and its inverse.

Texts are cut where a rolling hash of the last bytes says so, so equal passages of
different documents have equal chunks.  A chunk that occurs more than once is
encoded once, from its first occurrence, and its tokens are sent to all others;
what is not shared is encoded where it stands, and texts without a shared chunk are
not moved at all.

Joins are then repaired.  Pre-tokens never continue over a place where a visible
ASCII character is followed by a space or a line feed, whatever stands around it:
tokens on both sides of such a seam are those of the whole text.  Of a shared
chunk, the tokens between its first and last seam are taken, as long as token ends
fall on the seams exactly; the text between two such stretches, which holds the
join, is encoded anew.  So the result agrees with encoding the whole text, token by
token.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import mix, saved, text_blocks

# A rolling hash over so many bytes; a cut for one value in so many; least bytes of a chunk.
WINDOW = 32
MEAN_CHUNK = 1024
LEAST_CHUNK = 256

# Texts of characters below U+0240, whose bytes are not above this one, are split alike by
# both libraries (see the tests).
_PLAIN = 0xC8
# Pieces this long are left to the library whose merges stay fast on them.
_LONG_PIECE = 400
# What needs no look ahead is one group, which tiktoken matches without backtracking.
_PATTERN = (
    r"(?:'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+)|\s+(?!\S)|\s+"
)
_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x51ED270B)).astype(np.uint32)

# Bits of the filter that tells which texts have no shared chunk: 8 MB, whatever the corpus.
FILTER_BITS = 1 << 26
_PLACES = ("place1", "place2")

_CHUNKS = "id bigint, hash bigint, start int, end int, key binary"
_SHARED = "array<struct<start:int,end:int,ids:binary>>"
_ENCODED = "doc_id bigint, n_tokens bigint, ids binary"


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself if visible, else from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Codec:
    """Encodes and decodes as the tokenizer file says; made in the task that uses it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec.get("pre_tokenizer") or {}
        odd = [t["content"] for t in spec["added_tokens"] if t["lstrip"] or t["rstrip"]]
        spaced = [t["content"] for t in spec["added_tokens"] if regex.search(r"\s", t["content"])]
        if (
            split.get("type") != "ByteLevel"
            or split.get("add_prefix_space")
            or not split.get("use_regex", True)
            or spec.get("normalizer")
            or odd
            or spaced
        ):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        self.path = path
        self.special = [token["content"].encode() for token in spec["added_tokens"]]
        self.special_ids = [token["id"] for token in spec["added_tokens"]]
        byte_of = _byte_of_character()
        vocabulary = spec["model"]["vocab"]
        spelled = {k: bytes(byte_of[c] for c in token) for token, k in vocabulary.items()
                   if token.encode() not in self.special}
        size = 1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])])
        self.pieces = [spelled.get(k, b"") for k in range(size)]
        for token in spec["added_tokens"]:
            self.pieces[token["id"]] = token["content"].encode()
        self.lengths = np.array([len(piece) for piece in self.pieces], np.int64)
        self.dtype = "<u2" if size <= 1 << 16 else "<u4"
        self.ranks = None
        if self._ids_are_ranks(spec["model"], vocabulary):
            self.ranks = {piece: k for k, piece in spelled.items()}

    @functools.cached_property
    def whole(self):
        """The file's own tokenizer, which encodes any text."""
        import tokenizers

        tokenizer = tokenizers.Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    @functools.cached_property
    def ranked(self):
        """A faster one for plain texts, with the same merges.

        It is told the special tokens, which no text that it gets holds: looking for none at
        all, it finds the empty string at every character.
        """
        import tiktoken

        special = {self.pieces[k].decode(): k for k in self.special_ids}
        return tiktoken.Encoding(
            "own", pat_str=_PATTERN, mergeable_ranks=self.ranks, special_tokens=special
        )

    @staticmethod
    def _ids_are_ranks(model: dict, vocabulary: dict[str, int]) -> bool:
        """Whether merges come in the order of the ids they make."""
        made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ids = [vocabulary.get(token, -1) for token in made]
        return ids == list(range(256, 256 + len(ids)))

    def encode(self, text: bytes) -> list[int]:
        """The ids of a text in UTF-8."""
        data = np.frombuffer(text, np.uint8)
        if self.ranks is not None and _is_plain(data):
            if not any(token in text for token in self.special):
                return self.ranked.encode_ordinary(text.decode())
        return self.whole.encode(text.decode(), add_special_tokens=False).ids

    def decode(self, ids) -> str:
        """Special tokens stay; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


def _is_plain(data: np.ndarray) -> bool:
    if not len(data):
        return True
    space = data <= 0x20
    ends = np.flatnonzero(space[1:] != space[:-1])
    longest = np.diff(ends, prepend=-1, append=len(data) - 1).max()
    return data.max() <= _PLAIN and longest < _LONG_PIECE


def chunk_ends(data: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """Where each text's chunks end, counted from the text's first byte."""
    value = _BYTE_VALUES[data]
    factor, width = 0x2C1B3C6D, 1
    while width < WINDOW and len(value) > width:
        value = value[:-width] * np.uint32(factor) + value[width:]
        factor, width = factor * factor % (1 << 32), 2 * width
    cuts = np.zeros(0, np.int64)
    if width == WINDOW:
        cuts = np.flatnonzero((value >> np.uint32(16)) % np.uint32(MEAN_CHUNK) == 0) + WINDOW
        cuts = cuts[cuts < len(data)]
        cuts = cuts[data[cuts] & 0xC0 != 0x80]
    out = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        ends: list[int] = []
        last = low
        own = cuts[np.searchsorted(cuts, low + WINDOW) : np.searchsorted(cuts, high)]
        for cut in own.tolist():
            if cut - last >= LEAST_CHUNK:
                ends.append(cut - int(low))
                last = cut
        if high > last:
            ends.append(int(high - low))
        out.append(ends)
    return out


def seams(data: np.ndarray) -> np.ndarray:
    """Places where a pre-token ends whatever stands around."""
    after = (data[1:] == 0x20) | (data[1:] == 0x0A)
    return np.flatnonzero(after & (data[:-1] > 0x20) & (data[:-1] < 0x7F)) + 1


def assemble(codec: Codec, text: bytes, shared: dict[int, tuple[int, bytes]]) -> np.ndarray:
    """Token ids of a whole text; ``shared`` has the end and tokens of chunks by their start."""
    data = np.frombuffer(text, np.uint8)
    seam = seams(data) if shared else None
    out, done = [], 0
    for start in sorted(shared):
        end, tokens = shared[start]
        first = 0 if start == 0 else int(np.searchsorted(seam, start, "right"))
        last = int(np.searchsorted(seam, end, "left")) - 1
        low = 0 if start == 0 else (int(seam[first]) if first < len(seam) else end)
        high = end if end == len(data) else (int(seam[last]) if last >= 0 else low)
        if low >= high or low < done:
            continue
        ids = np.frombuffer(tokens, codec.dtype)
        ends = np.concatenate(([0], np.cumsum(codec.lengths[ids]))) + start
        a, b = np.searchsorted(ends, [low, high])
        if ends[-1] != end or ends[a] != low or ends[b] != high:
            continue  # no exact agreement: the text is encoded with what follows
        if done < low:
            out.append(codec.encode(text[done:low]))
        out.append(ids[a:b])
        done = high
    if done < len(data):
        out.append(codec.encode(text[done:]))
    return np.concatenate([np.asarray(ids, "<u4") for ids in out] or [np.zeros(0, "<u4")])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, bounds in text_blocks(batches):
        ends = chunk_ends(data, bounds)
        count = [len(e) for e in ends]
        row = pa.array(np.repeat(np.arange(len(ends)), count))
        starts = [a for e in ends for a in [0, *e][:-1]]
        flat = [b for e in ends for b in e]
        whole = data.tobytes()
        base = np.repeat(bounds[:-1], count).tolist()
        keys = [
            hashlib.blake2b(whole[o + a : o + b], digest_size=16).digest()
            for o, a, b in zip(base, starts, flat, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("id").take(row),
                rows.column("hash").take(row),
                pa.array(starts, pa.int32()),
                pa.array(flat, pa.int32()),
                pa.array(keys, pa.binary()),
            ],
            ["id", "hash", "start", "end", "key"],
        )


def _encode_once(path: str):
    """The chunks that a document has first: their keys and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            for text, chunks in zip(batch.column("text"), batch.column("chunks"), strict=True):
                whole = text.as_py().encode()
                keys, ids = [], []
                for chunk in chunks.as_py():
                    keys.append(chunk["key"])
                    part = codec.encode(whole[chunk["start"] : chunk["end"]])
                    ids.append(np.asarray(part, codec.dtype).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(ids, pa.binary())], ["key", "ids"]
                )

    return run


def _assemble(path: str, excluded=None):
    """The ids of whole texts; with a broadcast filter, of those only that are not in it.

    Asking it here spares another Python worker for each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            if excluded is not None:
                hit = _hits(excluded.value, *(batch.column(name).to_numpy() for name in _PLACES))
                batch = batch.filter(pa.array(~hit))
            for rows, data, bounds in text_blocks([batch]):
                whole, out, counts = data.tobytes(), [], []
                for k, chunks in enumerate(rows.column("chunks")):
                    held = {c["start"]: (c["end"], c["ids"]) for c in chunks.as_py() or ()}
                    ids = assemble(codec, whole[bounds[k] : bounds[k + 1]], held)
                    counts.append(len(ids))
                    out.append(ids.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(counts, pa.int64()),
                        pa.array(out, pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "ids"],
                )

    return run


def _filter_places() -> list[Column]:
    return [
        F.pmod(F.xxhash64(F.lit(k), "id", "hash"), F.lit(FILTER_BITS)).alias(name)
        for k, name in enumerate(_PLACES, 1)
    ]


def _filter(keys: DataFrame):
    """A Bloom filter of fixed size of the ``id`` and ``hash`` in ``keys``, broadcast.

    The more keys, the more other rows pass too.
    """
    place = F.explode(F.array(*_filter_places())).alias("place")
    words = keys.select(place).groupBy(F.shiftright("place", 6).alias("word"))
    mask = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    rows = words.agg(F.bit_or(mask).alias("bits")).toArrow()
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(held)


def _hits(held: np.ndarray, *places: np.ndarray) -> np.ndarray:
    """Whether rows may be in the filter; no row that is in it is missed."""
    one, two = (held[p >> 6] >> (p & 63) & 1 for p in places)
    return (one & two) == 1


def _may_be_in(held) -> Column:
    """A condition that holds for all rows whose ``id`` and ``hash`` are in the filter."""

    def run(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series(_hits(held.value, one.to_numpy(), two.to_numpy()))

    return F.pandas_udf(run, "boolean")(*_filter_places())


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (unsigned 32-bit, little-endian) of each row.

    The ids are those of the tokenizers library for the whole text, without special
    tokens added; a special token that stands in a text is that token.  Null and
    empty texts have no tokens.  Null ids are kept, repeated rows give repeated
    results, other columns are ignored.  ``path`` must be readable on the executors.
    """
    text = F.col("text").cast("string")
    # Without nulls, so that both joins below use one and the same shuffle of the texts.
    source = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)).alias("id"),
        F.xxhash64(F.col("doc_id").isNull(), text).alias("hash"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    chunks = saved(source.select("id", "hash", "text").mapInArrow(_chunks, _CHUNKS), "chunks")
    first = F.min(F.struct("id", "hash", "start", "end")).alias("first")
    repeated = chunks.groupBy("key").agg(F.count("*").alias("n"), first).where("n > 1")
    repeated = saved(repeated, "repeated")
    holders = chunks.join(repeated.select("key"), "key").select("id", "hash").distinct()
    # Only texts with a shared chunk are shuffled; the rest are encoded where they stand.
    held = _filter(holders)
    apart = source.select(
        "doc_id", "text", F.lit(None).cast(_SHARED).alias("chunks"), *_filter_places()
    )
    source = source.where(_may_be_in(held))

    owned = repeated.select("key", "first.*").groupBy("id", "hash")
    owned = owned.agg(F.collect_list(F.struct("start", "end", "key")).alias("chunks"))
    # With the columns of the last join, so that Spark can use the shuffle again.  Both joins
    # shuffle: after a broadcast a task would hold the filter's Python worker and the encoder's.
    owners = source.join(owned.hint("merge"), ["id", "hash"]).select("doc_id", "text", "chunks")
    once = owners.mapInArrow(_encode_once(path), "key binary, ids binary")
    # A repeated owner row encodes its chunks again.
    once = once.groupBy("key").agg(F.min("ids").alias("ids"))
    shared = chunks.join(once, "key").groupBy("id", "hash")
    shared = shared.agg(F.collect_list(F.struct("start", "end", "ids")).alias("chunks"))
    rows = source.join(shared.hint("merge"), ["id", "hash"], "left")
    rows = rows.select("doc_id", "text", "chunks")
    return rows.mapInArrow(_assemble(path), _ENCODED).unionByName(
        apart.mapInArrow(_assemble(path, held), _ENCODED)
    )


def _decode(path: str, schema_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            for rows, data, bounds in text_blocks([batch], "ids"):
                whole = data.tobytes()
                decoded = [
                    codec.decode(np.frombuffer(whole[a:b], "<u4").tolist())
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(decoded, pa.string())], schema_names
                )

    return run


def decode(encoded: DataFrame, path: str, into: str = "decoded") -> DataFrame:
    """The rows with their ``ids`` decoded to text; null ids decode to an empty text."""
    schema = encoded.withColumn(into, F.lit("")).schema
    return encoded.mapInArrow(_decode(path, schema.names), schema)
