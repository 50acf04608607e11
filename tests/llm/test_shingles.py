from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from orderflow.llm.shingles import shingle_hashes, shingle_sets, word_hashes

TEXT = st.lists(st.text(st.sampled_from("abAB é\t\n,")), min_size=1, max_size=6)


def _joined(texts):
    encoded = [t.encode() for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in encoded])))
    return np.frombuffer(b"".join(encoded), np.uint8), bounds


def _words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_equal_words_have_equal_hashes(texts):
    hashes, at = word_hashes(*_joined(texts))
    expected = [w for t in texts for w in _words(t)]
    assert np.diff(at).tolist() == [len(_words(t)) for t in texts]
    pairs = set(zip(expected, hashes.tolist(), strict=True))
    assert len(pairs) == len(set(expected)) == len(set(hashes.tolist()))


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 4))
def test_shingles_are_runs_of_words(texts, size):
    hashes, begin = shingle_hashes(*_joined(texts), size)
    expected = []
    for text in texts:
        found = _words(text)
        expected.append([tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1))])
        if not found:
            expected[-1] = []
    assert np.diff(begin).tolist() == [len(e) for e in expected]
    flat = [s for e in expected for s in e]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat))
    assert len(set(hashes.tolist())) == len(set(flat))


def test_a_long_word_and_no_text():
    sets = shingle_sets(*_joined(["x" * 300_000, "", "x" * 300_000]), 5)
    assert sets[0].tolist() == sets[2].tolist() and len(sets[0]) == 1 and not len(sets[1])
