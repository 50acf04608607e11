from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import queries, url_filter


@pytest.mark.parametrize("share", [0.0, 0.002, 0.3, 0.9, 1.0])
def test_the_cascade_is_exact(share):
    rng = np.random.default_rng(3)
    one, two = rng.integers(0, 1 << 63, (2, 20_000)).astype(np.uint64)
    listed = rng.random(20_000) < share
    levels = url_filter.cascade_levels(one, two, listed)
    answer, rows = np.zeros(20_000, bool), np.arange(20_000)
    for level, (probes, bits) in enumerate(levels):
        data = np.frombuffer(bits, np.uint8)
        rows = rows[url_filter._hits(data, probes, level, one[rows], two[rows])]
        answer[rows] = level % 2 == 0
    assert (answer == listed).all()
    if 0 < share < 0.01:
        assert len(levels) > 1


@pytest.mark.parametrize(("per_bucket", "sent"), [(1 << 17, 1 << 25), (50, 200)])
def test_membership_over_many_buckets_and_passes(spark, per_bucket, sent):
    keys = spark.range(3000).select(
        F.concat(F.lit("k"), F.col("id") % 1000).alias("key"), (F.col("id") == 1007).alias("listed"),
        F.lit(1).alias("bucket"),
    )
    keys = keys.unionByName(keys.select(F.lit(None).cast("string").alias("key"), "listed", "bucket").limit(1))
    cascade, buckets = url_filter.build_cascade(keys, per_bucket)
    assert buckets == -(-1000 // per_bucket)
    found = url_filter.mark_listed(keys.drop("listed"), cascade, buckets, sent)
    rows = found.collect()
    assert len(rows) == 3001
    assert {r["key"] for r in rows if r["listed"]} == {"k7"}


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://Example.ORG/es/a?x#y": ("example.org", "/es/a", "example.org/es/", "block"),
        "x://a.example.org/en/12": ("a.example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
        "http://a.com/fr/x": ("a.com", "/fr/x", "com/fr/", "allow"),
        "http://spam.a.com/de/://b.org/": ("spam.a.com", "/de/://b.org/", "com/de/", "block"),
        "http://org": ("org", "", None, "allow"),
        "http://spam-farm.net/x": ("spam-farm.net", "/x", None, "block"),
        "http://antispam.net/": ("antispam.net", "/", None, "allow"),
        "http://É.net?q=/fr/": ("É.net", "", None, "allow"),
        "nothing": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
    }
    rows = [(k, url, "host", "rule") for k, url in enumerate(cases)] * 2
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string")
    found = url_filter.judge_pages(pages, queries.URL_RULES, F.col("key").rlike(queries.LISTED_HOST))
    got = {r["page_id"]: tuple(r[c] for c in ("host", "path", "rule", "verdict")) for r in found.collect()}
    assert [got[k] for k in range(len(cases))] == list(cases.values())
    assert found.count() == len(rows)
    assert url_filter.judge_pages(pages.limit(0), queries.URL_RULES, F.lit(True)).count() == 0
