"""Language identification by words first, then ever shorter character n-grams.

Every language has a log frequency for each word and n-gram that was learned.  A
word that was learned in any language scores by its word frequencies; another
word scores by its longest learned n-grams, at the order where any is known.  A
text's sum over its words is turned into a probability over languages, which is lowered
if the text holds fewer words of the language found than its texts do: long texts in a
language that was not learned come out near 0, as does one of which nothing is known.

What a language has not shown scores the same for all languages, and less than
anything that one has shown: little data is no advantage.  A language without a
single learned word or n-gram is never predicted.

The model is fitted on a bounded sample, chosen by a hash of the id: about
``sample_docs`` labelled documents in all, but of each language at least about
``least_docs``, or all that it has.  All words and n-grams of the sample are kept, each
with the languages that have shown it.  Scoring reads every whole text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import saved

ORDERS = (4, 3, 2, 1)
SAMPLE_DOCS = 20_000
LEAST_DOCS = 1_000
UNKNOWN = "und"
# Words that a task remembers, and words of a text that are looked up at once.
REMEMBERED = 150_000
# Scores that it remembers, over words and languages: fewer words if languages are many.
_CELLS = 2_000_000
_AT_ONCE = 10_000

_COUNTS = "lang string, kind int, gram string, n bigint"
_LEARNED = pa.schema(
    [
        ("lang", pa.string()),
        ("kind", pa.int32()),
        ("gram", pa.string()),
        ("n", pa.int64()),
        ("total", pa.int64()),
    ]
)
_LETTERS = regex.compile(r"\p{L}+")


def grams(word: str, order: int) -> list[str]:
    """Character n-grams of a word with an edge mark on both sides."""
    marked = f"_{word}_"
    return [marked[k : k + order] for k in range(len(marked) - order + 1)]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            words.setdefault(lang, Counter()).update(_LETTERS.findall(text.lower()))
        for lang, seen in words.items():
            counts = Counter({(0, word): n for word, n in seen.items()})
            for word, n in seen.items():
                for order in ORDERS:
                    for gram in grams(word, order):
                        counts[order, gram] += n
            yield pd.DataFrame(
                [(lang, kind, gram, n) for (kind, gram), n in counts.items()],
                columns=["lang", "kind", "gram", "n"],
            )


class Model:
    """Languages, their log shares of documents, and log frequencies by kind and gram.

    Kind 0 is a word, others the order of an n-gram.
    """

    def __init__(self, shares: dict[str, float], rows: list[tuple] | pa.Table):
        """``rows`` has a language, kind, gram, its count and that of all of the kind."""
        if not isinstance(rows, pa.Table):
            columns = zip(*rows, strict=True) if rows else [()] * len(_LEARNED)
            rows = pa.table(
                [pa.array(c, kind) for c, kind in zip(columns, _LEARNED.types, strict=True)],
                schema=_LEARNED,
            )
        self.languages = sorted(shares)
        place = pa.array(self.languages, pa.string())
        lang = pc.index_in(rows.column("lang"), place).to_numpy().astype(np.int32)
        kind = rows.column("kind").to_numpy().astype(np.int8)
        seen, total = (rows.column(name).to_numpy().astype(float) for name in ("n", "total"))
        totals = np.zeros((1 + max(ORDERS), len(place)))
        totals[kind, lang] = total
        # A language of which nothing was learned has no chance.
        weights = np.where(totals.sum(axis=0) > 0, [shares[x] for x in self.languages], 0.0)
        with np.errstate(divide="ignore"):
            self.prior = np.log(weights / (weights.sum() or 1.0))
        # Share of a new text's words that are known: of those learned, words met twice.
        twice = (kind == 0) & (seen > 1)
        self.expected = np.bincount(lang[twice], seen[twice] / total[twice], len(place))
        # What is not seen counts as half a time in the largest total, in every language.
        self.unseen = np.log(0.5 / (totals.max(axis=1, initial=0) + 1))
        # Grams stand for themselves by kind and a hash of 64 bits, in the order of the hash.
        # A row's entries, from ``start`` on, are the languages that have shown it and how
        # far their log frequencies are above the unseen one.
        grams = rows.column("gram").combine_chunks().dictionary_encode()
        hashes = _hashes(grams.dictionary.to_pylist())[grams.indices.to_numpy()]
        order = np.lexsort((lang, hashes, kind))
        hashes, kinds = hashes[order], kind[order]
        new = (hashes[1:] != hashes[:-1]) | (kinds[1:] != kinds[:-1])
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(order)), bool), new)))
        self.start = np.append(first, len(order)).astype(np.int32)
        self.kind, self.lang = kinds[first], lang[order]
        self.gain = (np.log((seen + 0.5) / (total + 1))[order] - self.unseen[kinds]).astype(np.float32)
        bounds = np.searchsorted(self.kind, np.arange(2 + max(ORDERS)))
        self.bounds, self.hashes = bounds.tolist(), hashes[first]

    @property
    def place(self) -> dict[int, _Kind]:
        """By kind, the row of each gram."""
        return {kind: _Kind(self, kind) for kind in (0, *ORDERS)}

    def find(self, kind: int, grams: list[str]) -> np.ndarray:
        """The rows of grams of a kind, -1 for those that were not learned."""
        low, high = self.bounds[kind : kind + 2]
        mine, asked = self.hashes[low:high], _hashes(grams)
        if not len(mine):
            return np.full(len(grams), -1)
        spot = np.minimum(np.searchsorted(mine, asked), len(mine) - 1)
        return np.where(mine[spot] == asked, spot + low, -1)

    @property
    def rows(self) -> _Rows:
        return _Rows(self)

    def known(self, word: str) -> list[int]:
        """Rows of the word itself, or else of its longest n-grams; none if nothing is known."""
        return self.rows_of([word])[1].tolist()

    def rows_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a word's number and a row of it, by word."""
        row = self.find(0, words)
        owners, rows = [np.flatnonzero(row >= 0)], [row[row >= 0]]
        left = np.flatnonzero(row < 0)
        for order in ORDERS:
            if not len(left):
                break
            parts = [grams(words[k], order) for k in left.tolist()]
            owner = np.repeat(left, [len(part) for part in parts])
            row = self.find(order, [gram for part in parts for gram in part])
            owner, row = owner[row >= 0], row[row >= 0]
            owners.append(owner)
            rows.append(row)
            left = np.setdiff1d(left, owner, assume_unique=False)
        owner, row = np.concatenate(owners), np.concatenate(rows)
        by_word = np.argsort(owner, kind="stable")
        return owner[by_word], row[by_word]

    def words(self, words: list[str]) -> np.ndarray:
        """Mean log frequencies of each word's rows; zeros if nothing of it is known."""
        return self.look_up(words)[0]

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean log frequencies of each word's rows, and the most shown of them."""
        shape = (len(words), len(self.languages))
        word, flat = self.rows_of(words)
        if not len(flat):
            return np.zeros(shape), np.zeros(shape, np.uint8)
        sizes = np.bincount(word, minlength=len(words))
        first, count = self.start[flat], np.diff(self.start)[flat]
        owner = np.repeat(word, count)
        entry = np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)
        cell = owner * shape[1] + self.lang[entry]
        gain = np.bincount(cell, self.gain[entry] / sizes[owner], shape[0] * shape[1]).reshape(shape)
        # A word's rows are of one kind: all are the word, or n-grams of one order.
        kind = np.zeros(len(words), np.int8)
        kind[word] = self.kind[flat]
        gain[sizes > 0] += self.unseen[kind[sizes > 0], None]
        shown = np.zeros(shape, np.uint8)
        shown.reshape(-1)[cell] = np.where(kind[owner] == 0, 3, 1)
        return gain, shown

    def trust(self, language: int, words: int, known: int) -> float:
        """1 if as many words are known as the language's texts let expect, else the share.

        One word and two standard deviations fewer are no reason for doubt.
        """
        share = min(self.expected[language], 1.0)
        wanted = words * share
        allowed = known + 1 + 2 * math.sqrt(wanted * (1 - share))
        return min(1.0, allowed / wanted) if wanted else 1.0


def _hashes(grams: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(gram) for gram in grams], np.uint64)


class _Kind:
    """The grams of a kind and their rows."""

    def __init__(self, model: Model, kind: int):
        self.model, self.kind = model, kind

    def __len__(self) -> int:
        low, high = self.model.bounds[self.kind : self.kind + 2]
        return high - low

    def __getitem__(self, gram: str) -> int:
        (row,) = self.model.find(self.kind, [gram]).tolist()
        if row < 0:
            raise KeyError(gram)
        return row

    def __contains__(self, gram: str) -> bool:
        return self.model.find(self.kind, [gram])[0] >= 0


class _Rows:
    """Log frequencies of a gram in all languages, by its row."""

    def __init__(self, model: Model):
        self.model = model

    def __len__(self) -> int:
        return len(self.model.kind)

    def __getitem__(self, row: int) -> np.ndarray:
        model, out = self.model, np.full(len(self.model.languages), self.model.unseen[self.model.kind[row]])
        entries = slice(model.start[row], model.start[row + 1])
        out[model.lang[entries]] += model.gain[entries]
        return out


class _Places(dict):
    """Numbers words as they come; ``new`` holds those that came since it was emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = place = len(self)
        return place


class Scorer:
    """Scores texts, and remembers the words it has met."""

    def __init__(self, model: Model, remembered: int = REMEMBERED):
        self.model = model
        self.place = _Places()
        remembered = min(remembered, _CELLS // (len(model.languages) or 1))
        self.scores = np.zeros((remembered + _AT_ONCE, len(model.languages)))
        self.shown = np.zeros(self.scores.shape, np.uint8)

    def _look(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of up to ``_AT_ONCE`` words and what each language has shown of them."""
        place = self.place
        if len(place) > len(self.scores) - _AT_ONCE:
            place.clear()
        places = [place[word] for word in words]
        if place.new:
            new = slice(len(place) - len(place.new), len(place))
            self.scores[new], self.shown[new] = self.model.look_up(place.new)
            place.new.clear()
        return self.scores[places], self.shown[places]

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Words of several short texts are looked up together, those of a long one in parts."""
        out: list[tuple[str, float]] = []
        group: list[list[str]] = []
        size = 0
        for text in texts:
            words = _LETTERS.findall(text.lower()) if text else []
            if size and size + len(words) > _AT_ONCE:
                out += self._judge(group)
                group, size = [], 0
            group.append(words)
            size += len(words)
        return out + self._judge(group)

    def _judge(self, group: list[list[str]]) -> list[tuple[str, float]]:
        """One long list of words, or lists that have few together."""
        out = [(UNKNOWN, 0.0)] * len(group)
        filled = [k for k, words in enumerate(group) if words]
        if not filled or not self.model.languages:
            return out
        flat = [word for k in filled for word in group[k]]
        starts = np.cumsum([0, *(len(group[k]) for k in filled[:-1])])
        sums = np.zeros((len(filled), len(self.model.languages)))
        known, some = np.zeros((2, *sums.shape), int)
        # Words stay in order: sums do not depend on what was met before.
        for low in range(0, len(flat), _AT_ONCE):
            scores, shown = self._look(flat[low : low + _AT_ONCE])
            sums += np.add.reduceat(scores, starts, axis=0)
            known += np.add.reduceat((shown == 3).astype(int), starts, axis=0)
            some += np.add.reduceat((shown > 0).astype(int), starts, axis=0)
        for row, k in enumerate(filled):
            total = self.model.prior + sums[row]
            best = int(np.argmax(total))
            if total[best] == -np.inf:
                continue
            # The prior alone decides nothing: a language that has shown nothing of it scores 0.
            score = 1 / np.exp(total - total[best]).sum() if some[row, best] else 0.0
            trust = self.model.trust(best, len(group[k]), int(known[row, best]))
            out[k] = self.model.languages[best], float(score * trust)
        return out


def fit(
    labelled: DataFrame,
    sample_docs: int = SAMPLE_DOCS,
    per_order: int | None = None,
    least_docs: int = LEAST_DOCS,
) -> Model:
    """Learn from ``text`` and ``lang``; rows where either is null are left out.

    ``doc_id`` only chooses the sample, by language: a rare one keeps more of its rows,
    up to all, so that the sample leaves no language out.  ``per_order`` keeps only so many
    words and n-grams of each order and language, the most frequent, and of those with equal
    counts the first in code point order; without it all are kept.
    """
    usable = labelled.where("text is not null and lang is not null").select(
        "doc_id", "text", "lang"
    )
    sizes = {row["lang"]: row["count"] for row in usable.groupBy("lang").count().collect()}
    docs = sum(sizes.values())
    if not docs:
        return Model({}, [])
    grain = 1 << 30
    limits = [math.ceil(min(1, max(sample_docs / docs, least_docs / n)) * grain) for n in sizes.values()]
    # As Arrow: a list of rows would be an RDD, with Python workers of its own on executors.
    limits = labelled.sparkSession.createDataFrame(
        pa.table({"lang": pa.array(sizes, pa.string()), "limit": pa.array(limits, pa.int64())})
    )
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < F.col("limit")
    sample = usable.join(F.broadcast(limits), "lang").where(chosen).select("lang", "text")
    counts = sample.mapInPandas(_count, _COUNTS)
    counts = saved(counts.groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("total"))
    if per_order is not None:
        order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "gram")
        counts = counts.withColumn("place", F.row_number().over(order)).where(
            F.col("place") <= per_order
        )
    # The totals have five rows for each language; the rows are those of the bounded sample.
    rows = counts.join(F.broadcast(totals), ["lang", "kind"])
    rows = rows.select("lang", "kind", "gram", "n", "total")
    learned = rows.toArrow().cast(_LEARNED)
    return Model({k: n / docs for k, n in sizes.items()}, learned)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), all other columns kept.

    Columns of ``docs`` with these two names give way to the new ones.

    A text that is null, empty or without a letter is ``und`` with score 0, as is
    every text if nothing was learned.  One of which nothing is known has score 0 too.
    """
    # Part of the function, not a broadcast, which workers would hold for good.
    state = vars(model)
    rows = docs.drop("lang_pred", "score")
    schema = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.__new__(Model)
        vars(own).update(state)
        scorer = Scorer(own)
        for batch in batches:
            # Few rows at a time: only theirs are held as Python texts.
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                found = scorer.predict_all(part.column("text").to_pylist())
                langs, scores = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(scores)], names
                )

    return rows.mapInArrow(run, schema)
