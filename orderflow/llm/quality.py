"""A quality score: ridge regression on random Fourier features of document statistics.

Statistics of a whole text are standardised and mapped to cosines of random
projections, whose products approximate a Gaussian kernel.  The normal equations are
sums over labelled documents: every partition adds up its own, and only sums are
moved.  The fitted values are calibrated by isotonic regression on a histogram of
them, whose size does not depend on the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import saved, text_blocks
from orderflow.llm.shingles import word_hashes

FEATURES = 256
WIDTH = 2.5
RIDGE = 1.0
BINS = 2000

STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "symbols", "sentence_marks",
    "exclamations", "lines", "non_ascii", "repeats", "variety", "top_word", "line_symbols",
    "line_upper", "line_repeats",
)
_MEASURED = "doc_id bigint, statistics array<double>"


def _class(characters: str | range) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[[ord(c) for c in characters] if isinstance(characters, str) else list(characters)] = 1
    return out


_UPPER, _LOWER = _class(range(0x41, 0x5B)), _class(range(0x61, 0x7B))
_DIGIT, _HIGH = _class(range(0x30, 0x3A)), _class(range(0x80, 0x100))
_SYMBOL, _MARK = _class("#$%&*|~^_=+<>@\\{}[]/"), _class(".,;:!?")
_BANG, _LINE = _class("!"), _class("\n")
# Lines of fewer bytes say little.
_LEAST_LINE = 40


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _most(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The largest value of each run that ``at`` bounds; 0 for an empty run."""
    out = np.zeros(len(at) - 1)
    full = np.flatnonzero(np.diff(at) > 0)
    if len(full):
        out[full] = np.maximum.reduceat(values, at[full])
    return out


def measure(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The statistics of each text; an empty text has zeros."""
    size = np.diff(bounds).astype(float)
    words, at = word_hashes(data, bounds)
    count = np.diff(at).astype(float)
    some, long = np.maximum(count, 1), np.maximum(size, 1)

    def share(kind: np.ndarray, of: np.ndarray) -> np.ndarray:
        return _sums(kind[data], bounds) / of

    again = np.zeros(len(words), np.int64)
    again[1:] = words[1:] == words[:-1]
    again[at[:-1][np.diff(at) > 0]] = 0
    different, top = np.zeros(len(size)), np.zeros(len(size))
    for k in np.flatnonzero(count > 0):
        seen = np.unique(words[at[k] : at[k + 1]], return_counts=True)[1]
        different[k], top[k] = len(seen), seen.max()
    letters = np.maximum(_sums(_UPPER[data] + _LOWER[data], bounds), 1)

    # The same for lines: begins after each line feed, and where a text begins.
    cuts = np.unique(np.concatenate([bounds, np.flatnonzero(data == 0x0A) + 1]))
    line_size = np.diff(cuts)
    worth = line_size >= _LEAST_LINE
    of_text = np.searchsorted(cuts, bounds)
    line_letters = np.maximum(_sums(_UPPER[data] + _LOWER[data], cuts), 1)
    symbols = np.where(worth, _sums(_SYMBOL[data], cuts) / np.maximum(line_size, 1), 0)
    upper = np.where(worth, _sums(_UPPER[data], cuts) / line_letters, 0)
    # Spaces before equal words tell in which line a repeat stands: by its share of the text.
    line_words = np.maximum(_sums((data == 0x20).astype(np.int64), cuts) + 1, 1)
    place = _word_places(data, bounds, len(words))
    per_line = np.bincount(
        np.searchsorted(cuts, place, "right") - 1, weights=again, minlength=len(line_size)
    )
    repeats = np.where(worth, per_line[: len(line_size)] / line_words, 0)
    out = np.stack(
        [
            np.log1p(size),
            np.log1p(count),
            size / some,
            _sums(_UPPER[data], bounds) / letters,
            share(_DIGIT, long),
            np.sqrt(share(_SYMBOL, long)),
            share(_MARK, some),
            share(_BANG, some),
            np.sqrt(share(_LINE, some)),
            share(_HIGH, long),
            _sums(again, at) / some,
            np.log1p(different) / np.maximum(np.log1p(count), 1),
            top / some,
            np.sqrt(_most(symbols, of_text)),
            _most(upper, of_text),
            _most(repeats, of_text),
        ],
        axis=1,
    )
    return np.where(size[:, None] > 0, np.minimum(out, 50), 0)


def _word_places(data: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """Where each word begins; as many as ``word_hashes`` finds."""
    if not count:
        return np.zeros(0, np.int64)
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    first = np.empty(len(data), bool)
    first[0] = True
    first[1:] = space[:-1]
    first[bounds[:-1][bounds[:-1] < len(data)]] = True
    return np.flatnonzero(first & ~space)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, bounds in text_blocks(batches):
        found = measure(data, bounds)
        ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
        lists = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), lists], ["doc_id", "statistics"])


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``statistics`` of each row; a null text counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    return saved(rows.mapInArrow(_measure, _MEASURED), "statistics")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    # Fitted values and what they are worth: both ascend.
    fitted: np.ndarray
    worth: np.ndarray

    def raw(self, values: np.ndarray) -> np.ndarray:
        return design(values, self.mean, self.scale) @ self.weights

    def score(self, values: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(values), self.fitted, self.worth)


def design(values: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised rows, the rows themselves and a constant."""
    rows = np.clip((values - mean) / scale, -8, 8)
    random = np.random.default_rng(7)
    projection = random.normal(0, 1 / WIDTH, (rows.shape[1], FEATURES))
    shift = random.uniform(0, 2 * np.pi, FEATURES)
    waves = np.sqrt(2 / FEATURES) * np.cos(rows @ projection + shift)
    return np.hstack([waves, rows, np.ones((len(rows), 1))])


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest ascending values, by pooling neighbours that descend."""
    pools: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        pools.append([value * weight, weight, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            total, weight, size = pools.pop()
            pools[-1][0] += total
            pools[-1][1] += weight
            pools[-1][2] += size
    return np.concatenate([np.full(int(size), total / weight) for total, weight, size in pools])


def _values(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("statistics").flatten().to_numpy()
    return flat.reshape(batch.num_rows, -1)


def _equations(mean: np.ndarray, scale: np.ndarray):
    """A partition's sums for the normal equations, a row of the matrix each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = FEATURES + len(mean) + 1
        total = np.zeros((width, width + 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            label = batch.column("label").to_numpy()
            for low in range(0, batch.num_rows, 2000):
                x = design(_values(batch.slice(low, 2000)), mean, scale)
                total[:, :width] += x.T @ x
                total[:, width] += x.T @ label[low : low + 2000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), pa.array(list(total))], ["line", "sums"]
        )

    return run


def _add(lines: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {"line": [lines["line"].iat[0]], "sums": [np.sum(np.stack(lines["sums"]), axis=0)]}
    )


def fit(measured: DataFrame, labels: DataFrame) -> Model | None:
    """Learn from ``labels`` (``doc_id`` and ``label``, 0 or 1); None without any.

    A document with several labels has their mean; null labels are left out, as are
    null ids.
    """
    label = labels.where("label is not null").groupBy("doc_id")
    label = label.agg(F.avg(F.col("label").cast("double")).alias("label"))
    train = saved(measured.join(label, "doc_id"), "train")
    each = [F.col("statistics")[k] for k in range(len(STATISTICS))]
    moments = train.agg(
        F.count("*").alias("n"), *(f(x) for x in each for f in (F.avg, F.stddev_pop))
    ).first()
    if not moments[0]:
        return None
    mean, scale = np.array(moments[1::2], float), np.array(moments[2::2], float)
    scale[scale < 1e-9] = 1
    sums = train.mapInArrow(_equations(mean, scale), "line bigint, sums array<double>")
    sums = sums.groupBy("line").applyInPandas(_add, "line bigint, sums array<double>")
    matrix = np.array([row["sums"] for row in sorted(sums.collect(), key=lambda r: r["line"])])
    square = matrix[:, :-1] + RIDGE * np.eye(len(matrix))
    model = Model(mean, scale, np.linalg.solve(square, matrix[:, -1]), np.zeros(1), np.zeros(1))
    bin_ = F.floor(F.least(F.greatest("fitted", F.lit(-1.0)), F.lit(2.0)) * (BINS / 3))
    rows = apply(train, model, "fitted").groupBy(bin_.alias("bin"))
    bins = rows.agg(F.count("*"), F.avg("fitted"), F.avg("label")).collect()
    _, n, fitted, mean_label = np.array(sorted(bins, key=lambda r: r[0]), float).T
    model.fitted, model.worth = fitted, isotonic(mean_label, n)
    return model


def apply(measured: DataFrame, model: Model | None, into: str = "score") -> DataFrame:
    """``measured`` with its score, or with the uncalibrated value if ``into`` is ``fitted``.

    Without a model every score is 0.5.
    """
    if model is None:
        return measured.withColumn(into, F.lit(0.5))
    parts = (model.mean, model.scale, model.weights, model.fitted, model.worth)
    schema = measured.withColumn(into, F.lit(0.0)).schema
    calibrated = into != "fitted"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*parts)
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                rows = batch.slice(low, 2000)
                values = _values(rows)
                score = own.score(values) if calibrated else own.raw(values)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(score)], schema.names
                )

    return measured.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id``, ``held_out`` and ``score`` of each row of ``docs``.

    ``labels`` has ``doc_id`` and ``label``; those that ``held_out`` (of ``doc_id``)
    marks are not learned from.  Only the text is an input of a score.  Null and empty
    texts are scored too, repeated rows alike; other columns are ignored.
    """
    measured = statistics(docs)
    model = fit(measured, labels.where(~held_out))
    return apply(measured, model).select("doc_id", held_out.alias("held_out"), "score")
