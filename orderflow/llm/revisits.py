"""Not-modified revisit records of a web archive, resolved to the responses they repeat.

A revisit stands for the latest earlier full response of its canonical URL, if its
validators agree.  Records are dealt by ranges of URL and time, so a URL with very many
captures is spread over several parts; within a part a window finds the latest
response, and what earlier parts end with is carried over, one row for each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import saved
from orderflow.llm.url_filter import host_of, path_of

# Query parameters that do not choose a page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
# A not-modified response must not change these of the stored response (fixed values).
NOT_UPDATED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type",
    "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer",
    "transfer-encoding", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a last slash,
    parameters sorted and without tracking; no scheme, no fragment.  Null stays null."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    parameters = F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)
    )
    joined = F.array_join(F.array_sort(parameters), "&")
    return F.when(
        url.isNotNull(),
        F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise("")),
    )


def _lower_names(headers: Column) -> Column:
    """Header fields as sorted pairs, names in lower case."""
    pairs = F.transform(
        F.map_entries(headers),
        lambda e: F.struct(F.lower(e["key"]).alias("name"), e["value"].alias("value")),
    )
    return F.array_sort(F.coalesce(pairs, F.array().cast("array<struct<name:string,value:string>>")))


def _field(pairs: Column, name: str) -> Column:
    return F.get(F.filter(pairs, lambda p: p["name"] == name), F.lit(0))["value"]


def _tag(pairs: Column) -> Column:
    """The entity tag, compared weakly."""
    return F.regexp_replace(_field(pairs, "etag"), "^W/", "")


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored fields, replaced and added to by those that a 304 may change."""
    allowed = F.filter(update, lambda p: ~p["name"].isin(*NOT_UPDATED))
    names = F.transform(allowed, lambda p: p["name"])
    rest = F.filter(stored, lambda p: ~F.array_contains(names, p["name"]))
    return F.array_sort(F.concat(rest, allowed))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit with the response it stands for.

    ``records`` has ``record_id``, ``url``, ``time`` (whole numbers), ``type``
    (``response`` or ``revisit``; others are ignored), ``headers`` (a map) and
    ``digest`` (of the payload).  Returns ``record_id``, ``canonical_url``,
    ``response_id``, ``outcome``, ``headers`` (sorted pairs) and ``digest``.

    Earlier means a smaller time; of responses at one time the largest id counts.  The
    outcome is ``resolved``; ``unvalidated`` if the revisit names no validator;
    ``changed`` if its entity tag, or without one its modification time, differs from
    the response's; ``missing`` without an earlier response or without url or time.
    Only the first two have a response's id, headers and digest.  Repeated revisits
    give repeated rows; null headers are none; other columns are ignored.
    """
    rows = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").cast("bigint").alias("record_id"),
        canonical_url(F.col("url")).alias("canonical_url"),
        F.col("time").cast("bigint").alias("time"),
        (F.col("type") == "response").alias("full"),
        _lower_names(F.col("headers")).alias("own"),
        F.col("digest").cast("string").alias("own_digest"),
    )
    parts = rows.repartitionByRange("canonical_url", "time")
    parts = saved(parts.withColumn("part", F.spark_partition_id()), "captures")
    usable = F.col("full") & F.col("canonical_url").isNotNull() & F.col("time").isNotNull()
    response = F.when(usable, F.struct("time", "record_id", "own", "own_digest"))
    earlier = (
        Window.partitionBy("canonical_url", "part")
        .orderBy("time")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    before = Window.partitionBy("canonical_url").orderBy("part")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    # One row for each part that a URL is in.
    ends = parts.groupBy("canonical_url", "part").agg(F.max(response).alias("last"))
    carried = ends.withColumn("carried", F.max("last").over(before)).drop("last")
    found = parts.withColumn("within", F.max(response).over(earlier)).where("not full")
    found = found.join(carried, ["canonical_url", "part"], "left")
    # A null url joins nothing and has no response.
    latest = F.when(
        F.col("canonical_url").isNotNull() & F.col("time").isNotNull(),
        F.coalesce("within", "carried"),
    )
    found = found.withColumn("latest", latest)
    stored = F.col("latest.own")
    tag, modified = _tag(F.col("own")), _field(F.col("own"), "last-modified")
    outcome = (
        F.when(F.col("latest").isNull(), "missing")
        .when(
            tag.isNotNull(),
            F.when(tag.eqNullSafe(_tag(stored)), "resolved").otherwise("changed"),
        )
        .when(
            modified.isNotNull(),
            F.when(modified.eqNullSafe(_field(stored, "last-modified")), "resolved").otherwise(
                "changed"
            ),
        )
        .otherwise("unvalidated")
    )
    found = found.withColumn("outcome", outcome)
    good = F.col("outcome").isin("resolved", "unvalidated")
    return found.select(
        "record_id",
        "canonical_url",
        F.when(good, F.col("latest.record_id")).alias("response_id"),
        "outcome",
        F.when(good, merged_headers(stored, F.col("own"))).alias("headers"),
        F.when(good, F.col("latest.own_digest")).alias("digest"),
    )
