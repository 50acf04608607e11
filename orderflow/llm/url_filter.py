"""URL verdicts: explicit rules first, then exact list membership by a Bloom filter cascade.

The key universe is every key of the corpus.  Level 0 holds the listed keys; a
higher level holds those keys that the level below lets through wrongly, so levels
hold listed and unlisted keys in turn.  The last level lets nothing through
wrongly, so for every key of the universe the cascade's answer is exact.

Keys are split into buckets by hash.  A bucket's cascade is built in one task from
a bounded number of keys, and rows are judged without a join: the cascades are
sent to the tasks, as many buckets at a time as fit ``sent_bytes``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import mix, saved

KEYS_PER_BUCKET = 1 << 17
SENT_BYTES = 32 << 20

_LEVELS = "bucket bigint, level int, probes int, bits binary"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without one."""
    host = F.regexp_extract(url, "(?s)://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """``rule`` and ``verdict`` of the longest rule (verdict, host, path) that fits, or null.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    found = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        value = F.struct(
            F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict")
        )
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def _with_hashes(frame: DataFrame, key: str, buckets: int) -> DataFrame:
    one = F.xxhash64(F.lit(1), F.col(key))
    return frame.withColumns(
        {
            "_one": one,
            "_two": F.xxhash64(F.lit(2), F.col(key)),
            "_bucket": F.pmod(F.xxhash64(F.lit(3), F.col(key)), F.lit(buckets)),
        }
    )


def _places(one: np.ndarray, two: np.ndarray, level: int, probe: int, size: int) -> np.ndarray:
    salt = np.uint64(level * 0x9E3779B97F4A7C15 + 1 & 0xFFFFFFFFFFFFFFFF)
    step = mix(two ^ salt) | np.uint64(1)
    return (mix(one + salt) + np.uint64(probe) * step) % np.uint64(size)


def _hits(bits: np.ndarray, probes: int, level: int, one: np.ndarray, two: np.ndarray):
    hit = np.ones(len(one), bool)
    for probe in range(probes):
        place = _places(one, two, level, probe, 8 * len(bits))
        hit &= bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1 == 1
    return hit


def cascade_levels(one: np.ndarray, two: np.ndarray, listed: np.ndarray) -> list[tuple[int, bytes]]:
    """Probes and bits of each level; keys must differ in ``one`` or ``two``."""
    levels: list[tuple[int, bytes]] = []
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    while len(inside):
        rate = 0.5
        if not levels and len(outside):
            rate = min(0.5, len(inside) / (math.sqrt(2) * len(outside)))
        probes = max(1, round(-math.log2(rate)))
        size = 8 * math.ceil(len(inside) * probes / math.log(2) / 8 + 1)
        bits = np.zeros(size // 8, np.uint8)
        for probe in range(probes):
            place = _places(one[inside], two[inside], len(levels), probe, size)
            mask = np.uint8(1) << (place & np.uint64(7)).astype(np.uint8)
            np.bitwise_or.at(bits, place >> np.uint64(3), mask)
        wrong = outside[_hits(bits, probes, len(levels), one[outside], two[outside])]
        levels.append((probes, bits.tobytes()))
        inside, outside = wrong, inside
    return levels


def _build(group: pd.DataFrame) -> pd.DataFrame:
    levels = cascade_levels(
        group["one"].to_numpy().view(np.uint64),
        group["two"].to_numpy().view(np.uint64),
        group["listed"].to_numpy(),
    )
    return pd.DataFrame(
        [(group["bucket"].iloc[0], k, probes, bits) for k, (probes, bits) in enumerate(levels)],
        columns=["bucket", "level", "probes", "bits"],
    )


def build_cascade(
    keys: DataFrame, keys_per_bucket: int = KEYS_PER_BUCKET
) -> tuple[DataFrame, int]:
    """The cascade's levels by bucket, and the number of buckets.

    ``keys`` has ``key`` and boolean ``listed``, each key as often as it likes; a
    key counts as listed if any row says so.  Null keys are left out.  Equal keys
    are merged before they are shuffled.
    """
    distinct = saved(
        keys.where("key is not null")
        .groupBy("key")
        .agg(F.coalesce(F.bool_or("listed"), F.lit(False)).alias("listed")),
        "keys",
    )
    buckets = max(1, -(-distinct.count() // keys_per_bucket))
    hashed = _with_hashes(distinct, "key", buckets)
    levels = hashed.selectExpr("_bucket bucket", "_one one", "_two two", "listed")
    return saved(levels.groupBy("bucket").applyInPandas(_build, _LEVELS), "cascade"), buckets


def _judge(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two, bucket = (
                batch.column(name).to_numpy(zero_copy_only=False)
                for name in ("_one", "_two", "_bucket")
            )
            one, two = one.view(np.uint64), two.view(np.uint64)
            listed = np.zeros(len(one), bool)
            for which in np.unique(bucket):
                rows = np.flatnonzero(bucket == which)
                # At each level, those that are not let through have their answer.
                for level, (probes, bits) in enumerate(shared.value.get(int(which), [])):
                    data = np.frombuffer(bits, np.uint8)
                    rows = rows[_hits(data, probes, level, one[rows], two[rows])]
                    listed[rows] = level % 2 == 0
            names = batch.schema.names[:-3]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(listed)], [*names, "listed"]
            )

    return run


def mark_listed(
    rows: DataFrame, cascade: DataFrame, buckets: int, sent_bytes: int = SENT_BYTES
) -> DataFrame:
    """``rows`` with ``listed``: whether ``key`` is; exact for keys of the universe.

    A null key is not listed.  ``rows`` must not have ``listed``, ``_one``,
    ``_two`` or ``_bucket``.
    """
    spark = rows.sparkSession
    hashed = _with_hashes(rows, "key", buckets)
    schema = rows.withColumn("listed", F.lit(True)).schema
    sizes = cascade.groupBy("bucket").agg(F.sum(F.length("bits")).alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    passes = min(buckets, -(-total // sent_bytes) or 1)
    out = None
    for k in range(passes):
        low, high = buckets * k // passes, buckets * (k + 1) // passes
        inside = F.col("_bucket").between(low, high - 1)
        levels: dict[int, list[tuple[int, bytes]]] = {}
        part = cascade.where(F.col("bucket").between(low, high - 1))
        for row in sorted(part.collect(), key=lambda r: (r["bucket"], r["level"])):
            levels.setdefault(row["bucket"], []).append((row["probes"], bytes(row["bits"])))
        shared = spark.sparkContext.broadcast(levels)
        judged = hashed.where(inside).mapInArrow(_judge(shared), schema)
        out = judged if out is None else out.unionByName(judged)
    return out


def judge_pages(
    pages: DataFrame, rules: list[tuple[str, str, str]], listed_host: Column
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``listed`` and ``verdict`` of each page.

    ``listed_host`` says of a ``key`` column (a host) whether it is on the block
    list.  A rule that fits decides; else hosts on the list are blocked.  A url
    that is null or has no ``://`` has an empty host and path; an empty host is
    never listed.  Repeated rows give repeated verdicts; other columns are ignored.
    """
    split = pages.select(
        F.col("page_id"), host_of(F.col("url")).alias("key"), path_of(F.col("url")).alias("path")
    )
    keys = split.select("key", ((F.col("key") != "") & listed_host).alias("listed"))
    cascade, buckets = build_cascade(keys)
    found = mark_listed(split, cascade, buckets).withColumnRenamed("key", "host")
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    return found.withColumn("_rule", rule).select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        "listed",
        F.coalesce("_rule.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias(
            "verdict"
        ),
    )
