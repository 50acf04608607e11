from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as registry
from orderflow.llm import spelling as sp
from orderflow.llm.common import table


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def neighbours(words):
    """Near words by the texts left after a deletion; a pair shares one of them."""
    left = {}
    for w in words:
        for t in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            left.setdefault(t, []).append(w)
    near = {w: set() for w in words}
    for group in left.values():
        for a, b in itertools.combinations(group, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    return near


def brute(counts):
    near, out = neighbours(counts), {}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def counted(docs, least_length=5, least_count=3):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= least_length and n >= least_count}


def found(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


@pytest.fixture
def group(spark):
    def run(counts):
        rows = spark.createDataFrame(list(counts.items()), "word string, n bigint")
        return found(sp.group_variants(rows.selectExpr("*", "1 AS key", "'x' AS form")))

    return run


def test_pivots_are_the_cheapest_that_do_not_overlap():
    chance = random.Random(6)
    for _ in range(300):
        spots = sorted(chance.sample(range(20), chance.randrange(3, 9)))
        grams = [(k, chance.randrange(1, 9)) for k in spots]
        for count in (2, 3):
            sums = [
                sum(w for _, w in pick)
                for pick in itertools.combinations(grams, count)
                if all(b[0] - a[0] >= 2 for a, b in itertools.pairwise(pick))
            ]
            if sums:
                pivots = sp.choose_pivots(grams, count)
                assert sum(dict(grams)[k] for k in pivots) == min(sums)
                assert all(b - a >= 2 for a, b in itertools.pairwise(pivots))


@pytest.mark.parametrize("letters", ["ab", "abc", "abcdéÉ"])
def test_words_of_few_letters_agree_with_brute_force(group, letters):
    """Repeated grams, ties in the order of grams, and long chains of near words."""
    chance = random.Random(len(letters))
    counts = {}
    for _ in range(400):
        word = "".join(chance.choice(letters) for _ in range(chance.randrange(5, 9)))
        counts[word] = chance.choice([3, 3, 5, 7, 14, 40, 100])
    assert group(counts) == brute(counts)


def test_every_edit_is_found(group):
    base = "rhythmische"
    near = {base[:k] + c + base[k + e :] for k in range(len(base) + 1) for e in (0, 1) for c in "exé"}
    near |= {base[:k] + base[k + 1 :] for k in range(len(base))}
    counts = {w: 3 for w in near if len(w) >= 5} | {base: 9}
    assert group(counts) == brute(counts)


def test_hot_keys_are_dealt_out(group, monkeypatch):
    monkeypatch.setattr(sp, "PART", 5)
    chance = random.Random(9)
    counts = {"xy" + "".join(chance.choice("abcde") for _ in range(5)): chance.randrange(3, 60) for _ in range(500)}
    assert group(counts) == brute(counts)


def test_chain_of_forms(group):
    words = ["aaaaaaaa"[:k] + "bcdefghijk"[: 10 - k] for k in range(9)]
    chain = ["bcdefgh", "bcdefghi", "bcdefghij", "bcdefghijk", "bcdefghijkl", "bcdefghijklm"]
    counts = {w: 3 for w in words} | {w: 3 * 2**k for k, w in enumerate(chain)}
    got = group(counts)
    assert got == brute(counts) and got["bcdefgh"][1] == "bcdefghijklm"


def test_counting_words(spark, documents):
    docs = [(k, "Étage ÉTAGE étage x1y2 don't-stop Straße ÿÀ×÷z " * 5) for k in range(200)]
    docs += [(None, "hello HELLO hello"), (900, None), (901, ""), (902, "z" * 100_000), (902, "z" * 100_000), (902, "z" * 100_000)]
    docs += [(903, "Hello"), (903, "Hello")]
    rows = sp.count_words(documents(*docs), sp.drop_letters).collect()
    assert {r["word"]: r["n"] for r in rows} == counted(docs)


def test_counts_are_handed_over(spark, documents, monkeypatch):
    monkeypatch.setattr(sp, "COUNTED", 2)
    docs = [(k, f"alpha beta gamma delta{'e' * (k % 3)}") for k in range(60)]
    rows = sp.count_words(documents(*docs), sp.drop_letters).collect()
    assert {r["word"]: r["n"] for r in rows} == counted(docs)


def test_long_words(group):
    long = "ab" * 3000
    counts = {long: 9, long[:-1]: 3, "x" * 5000: 4, "x" * 5001: 8, "x" * 5002: 16}
    assert group(counts) == brute(counts)


def test_empty_tables(spark, documents, group):
    assert sp.count_words(documents((1, "hello")).limit(0)).count() == 0
    assert group({}) == {}


def test_query_agrees_with_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    got = registry.queries()["op13_spelling"](spark, sf_dir)
    assert found(got) == brute(counted([tuple(r) for r in docs]))
    assert dict(got.dtypes) == {
        "word": "string", "form": "string", "root": "string",
        "n": "bigint", "n_near": "bigint", "form_n": "bigint",
    }
