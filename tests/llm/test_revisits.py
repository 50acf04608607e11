from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from orderflow.llm import revisits

SCHEMA = "record_id bigint, url string, time bigint, type string, headers map<string,string>, digest string, part int"


def _resolve(spark, rows):
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    return {
        r["record_id"]: (
            r["response_id"], r["outcome"], r["headers"] and {h["name"]: h["value"] for h in r["headers"]},
            r["digest"],
        )
        for r in revisits.resolve_revisits(frame).collect()
    }


@pytest.mark.parametrize(
    ("url", "canonical"),
    [
        ("HTTP://WWW.Example.ORG:80/a/b/?b=2&utm_source=x&a=1#top", "example.org/a/b?a=1&b=2"),
        ("https://example.org", "example.org"),
        ("https://example.org/?ref=me&", "example.org"),
        ("https://example.org/a?referrer=1", "example.org/a?referrer=1"),
        ("no scheme", ""),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_url(spark, url, canonical):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(revisits.canonical_url(F.col("url"))).first()[0] == canonical


def test_validators_and_headers(spark):
    url = "http://a.org/x"
    rows = [
        (1, url, 1, "response", {"ETag": 'W/"1"', "Last-Modified": "m", "Age": "3", "Content-Type": "t"}, "d1"),
        (2, url + "#f", 2, "revisit", {"etag": '"1"', "age": "4", "Content-Type": "u", "Date": "z"}, None),
        (3, url, 3, "revisit", {"ETag": '"2"'}, None),
        (4, url, 4, "revisit", {"Last-Modified": "m"}, None),
        (5, url, 5, "revisit", {"Last-Modified": "n"}, None),
        (6, url, 6, "revisit", None, None),
        (7, url, 1, "revisit", {}, None),
        (8, None, 9, "revisit", {}, None),
        (9, url, None, "revisit", {}, None),
        (10, "http://b.org/", 9, "revisit", {}, None),
        (11, url, 6, "request", {}, None),
    ]
    found = _resolve(spark, rows)
    stored = {"etag": 'W/"1"', "last-modified": "m", "age": "3", "content-type": "t"}
    assert found == {
        2: (1, "resolved", {**stored, "etag": '"1"', "age": "4", "date": "z"}, "d1"),
        3: (None, "changed", None, None),
        4: (1, "resolved", stored, "d1"),
        5: (None, "changed", None, None),
        6: (1, "unvalidated", stored, "d1"),
        **{k: (None, "missing", None, None) for k in (7, 8, 9, 10)},
    }


def test_one_url_with_most_captures_agrees_with_a_scan(spark):
    rng = random.Random(9)
    rows = []
    for k in range(1500):
        url = "http://hot.org/" if rng.random() < 0.7 else f"http://h{rng.randrange(40)}.org/"
        kind = "response" if rng.random() < 0.02 else "revisit"
        rows.append((k, url, rng.randrange(700), kind, {"etag": str(rng.randrange(2))}, f"d{k}"))
    rows += [rows[3]]
    found = _resolve(spark, rows)
    for record, url, time, kind, headers, _ in rows:
        if kind == "response":
            continue
        before = [(r[2], r[0], r) for r in rows if r[3] == "response" and r[1] == url and r[2] < time]
        if not before:
            assert found[record][:2] == (None, "missing")
        else:
            latest = max(before)[2]
            good = latest[4]["etag"] == headers["etag"]
            want = (latest[0], "resolved") if good else (None, "changed")
            assert found[record][:2] == want


def test_no_records(spark):
    assert _resolve(spark, []) == {}
