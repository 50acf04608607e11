"""Groups of spelling variants: words one edit apart, found by pivotal grams.

Words are counted over all documents; each task adds up before anything is shuffled.

Two words are near if one inserted, deleted or replaced character makes them equal.  Grams
are ordered by how many words have them, rare ones first.  A word's prefix is its three
rarest grams of two characters (and others like the third).  Two of these that do not
overlap are its pivots, chosen by dynamic programming so that their frequencies add up to
the least.  One edit cannot touch both pivots; the one left is a gram of the near word, and
lies in its prefix if that prefix reaches as far in the order of grams.  So each word's
pivots are joined with the prefixes of words whose prefix reaches as far.

Positions limit that join.  On one side of a gram that is left there is no edit: either all
characters up to it are the same, and so is its position, or all from it on are, and its
distance to the end is the same.  The key of the join is that side's text, and the lengths
differ by one at most.  A key with many words is dealt to several tasks.  Candidates are
verified by their edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import long_rows, saved

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH = 5
LEAST_COUNT = 3
# A form occurs so many times as often as its variant, at least.
FORM_RATIO = 2

EDITS = 1
GRAM = 2
PREFIX = GRAM * EDITS + 1
# Words a task counts before it hands over its sums.
COUNTED = 500_000
# A key's words are dealt out in parts of about this many.
PART = 500

Change = Callable[[int | None, str], str]


def _count(change: Change | None, least_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def hand_over() -> pa.RecordBatch:
            words = pa.array(total.keys(), pa.string())
            counts = pa.array(total.values(), pa.int64())
            return pa.RecordBatch.from_arrays([words, counts], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                # On bytes, only A-Z are lower-cased.
                lower = text.as_buffer().to_pybytes().lower().decode()
                found = Counter(RUN.findall(lower))
                key = doc_id.as_py()
                for word, n in found.items():
                    if change is not None:
                        word = change(key, word)
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield hand_over()
                    total.clear()
        yield hand_over()

    return run


def drop_letters(doc_id: int | None, run: str) -> str:
    """A letter less where a hash of document and word says so; a null id counts as empty text."""
    if doc_id != drop_letters.doc_id:
        text = "" if doc_id is None else str(doc_id)
        drop_letters.doc_id, drop_letters.head = doc_id, zlib.crc32(f"{text}:".encode())
    h = zlib.crc32(run.encode(), drop_letters.head)
    if h % 97:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


drop_letters.doc_id, drop_letters.head = None, zlib.crc32(b":")


def count_words(
    docs: DataFrame,
    change: Change | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word`` and ``n`` of all runs of letters in whole texts, lower-cased in A-Z only.

    ``change`` gives the word to count from a document's id and a run.  Words of fewer
    than ``least_length`` characters or ``least_count`` occurrences are left out.  Null
    texts have no words; other columns are ignored; rows count as often as they occur.
    """
    long_rows(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    counted = rows.mapInArrow(_count(change, least_length), "word string, n bigint")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def choose_pivots(grams: list[tuple[int, int]], count: int = EDITS + 1) -> list[int]:
    """Positions of ``count`` grams that do not overlap and whose weights add up to the least.

    ``grams`` has (position, weight) by position; ties go to the first.  ``best[k]`` holds,
    for the grams seen so far, the cheapest choice of ``k`` of them.
    """
    best: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * count]
    for i, (position, weight) in enumerate(grams):
        # The last gram that ends before this one begins.
        before = i
        while before and grams[before - 1][0] + GRAM > position:
            before -= 1
        row = list(best[i])
        for k in range(1, count + 1):
            rest = best[before][k - 1]
            if rest is not None and (row[k] is None or rest[0] + weight < row[k][0]):
                row[k] = (rest[0] + weight, [*rest[1], position])
        best.append(row)
    return best[-1][count][1]


def signature(word: str, order: dict[str, int], weight: dict[str, int]) -> tuple:
    """Positions of the prefix, those of the pivots, and the place of the prefix's last gram."""
    grams = [word[k : k + GRAM] for k in range(len(word) - GRAM + 1)]
    ranks = [order[gram] for gram in grams]
    last = sorted(ranks)[PREFIX - 1]
    prefix = [k for k, rank in enumerate(ranks) if rank <= last]
    pivots = choose_pivots([(k, weight[grams[k]]) for k in prefix])
    return prefix, pivots, last


_SIGNED = pa.schema(
    [
        ("word", pa.string()),
        ("side", pa.string()),
        ("length", pa.int32()),
        ("last", pa.int32()),
        ("pivot", pa.bool_()),
    ]
)


def _sign(order: dict[str, int], weight: dict[str, int]):
    """A row for each prefix gram and side; side texts carry a mark of the side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])
            for word in batch.column("word").to_pylist():
                prefix, pivots, last = signature(word, order, weight)
                for k in prefix:
                    for side in ("<" + word[: k + GRAM], ">" + word[k:]):
                        for column, value in zip(
                            columns, (word, side, len(word), last, k in pivots), strict=True
                        ):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _SIGNED.types, strict=True)], schema=_SIGNED
            )

    return run


def near_words(words: DataFrame) -> DataFrame:
    """``a`` and ``b`` of all ordered pairs of near words, from distinct ``word`` values.

    Words have ``LEAST_LENGTH`` characters or more.  The table of grams, which every task
    gets, has a row for each pair of the letters that words are made of: 8,100 for the
    letters of ``RUN``.
    """
    gram = F.expr(f"transform(sequence(1, length(word) - {GRAM - 1}), k -> substr(word, k, {GRAM}))")
    grams = words.select(F.explode(F.array_distinct(gram)).alias("gram")).groupBy("gram").count()
    weight = {row["gram"]: row["count"] for row in grams.toLocalIterator()}
    order = {g: k for k, g in enumerate(sorted(weight, key=lambda g: (weight[g], g)))}
    signed = words.select("word").mapInArrow(
        _sign(order, weight), "word string, side string, length int, last int, pivot boolean"
    )
    # Bits of the letters: one edit changes two of them at most.
    letters = F.expr(
        "aggregate(split(word, ''), 0L, (bits, c) -> bits | if(c = '', 0L, shiftleft(1L, ascii(c) % 64)))"
    )
    keyed = signed.select(
        F.xxhash64("side").alias("key"), "word", "length", "last", "pivot", letters.alias("letters")
    )
    keyed = saved(keyed, "grams")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > PART)
    parts = sizes.select("key", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    keyed = keyed.join(parts, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = keyed.withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    # Every pivot meets all parts of its key.
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    pivots = keyed.where("pivot").withColumn("part", every)
    p, q = pivots.alias("p"), dealt.alias("q")
    near = (
        (F.col("p.key") == F.col("q.key"))
        & (F.col("p.part") == F.col("q.part"))
        & (F.abs(F.col("p.length") - F.col("q.length")) <= EDITS)
        & (F.col("p.last") <= F.col("q.last"))
        & (F.bit_count(F.col("p.letters").bitwiseXOR(F.col("q.letters"))) <= 2 * EDITS)
        & (F.col("p.word") != F.col("q.word"))
        & (F.levenshtein(F.col("p.word"), F.col("q.word"), EDITS) == EDITS)
    )
    found = p.join(q.hint("merge"), near).select(F.col("p.word").alias("a"), F.col("q.word").alias("b"))
    one_way = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b")))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of ``word, form`` rows: the last word that forms lead to.

    Forms lead to more frequent words, so they end.  Each round doubles how far a word
    sees, and is a table in the shared folder.
    """
    reach = saved(forms.select("word", F.col("form").alias("root")), "roots", narrow=True)
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = reach.join(further, "root", "left")
        if step.where(F.col("further").isNotNull()).isEmpty():
            return reach
        step = step.select("word", F.coalesce("further", "root").alias("root"))
        reach = saved(step, "roots", narrow=True)


def group_variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word, from ``word`` and ``n``.

    A word's form is its near word of the largest ``n``, the smallest of these by code
    points, if it has ``FORM_RATIO`` times the word's own ``n`` at least; else null.
    ``root`` is where forms lead to, the word itself if it has none; ``n_near`` counts
    its near words.  Null words are left out.
    """
    words = saved(words.where(F.col("word").isNotNull()).select("word", "n"), "words")
    pairs = near_words(words).join(words.select(F.col("word").alias("b"), "n"), "b")
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("b").alias("form")))
    near = pairs.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), best.alias("best")
    )
    judged = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    fits = F.col("form_n") >= FORM_RATIO * F.col("n")
    judged = judged.select(
        "word",
        F.when(fits, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, F.col("form_n")).alias("form_n"),
    )
    judged = saved(judged, "variants")
    found = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
