"""Not-modified revisits resolved to the full responses that they stand for.

A revisit record (HTTP 304, or an identical payload) is joined as of its date
to the latest earlier full response of the same canonical URL; its validators
are checked, and the headers that a 304 may update are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeguard.session import written

# Headers that a not-modified answer may update (RFC 9110, section 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that say where a visitor came from.
TRACKING = r"^(utm_[^=]*|gclid|fbclid|ref)(=.*)?$"


def canonical_url(url: Column) -> Column:
    """Without scheme, default port, ``www.``, fragment, tracking parameters and final slash; parameters sorted."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), r"(?s)#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/$", "")
    pairs = F.split(F.regexp_extract(rest, r"(?s)\?(.*)$", 1), "&", -1)
    kept = F.array_sort(F.filter(pairs, lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _tag(headers: Column) -> Column:
    """The entity tag, weakly compared."""
    return F.regexp_replace(headers["etag"], r"^W/", "")


def latest_earlier(records: DataFrame, ranges: int | None = None) -> DataFrame:
    """For each revisit of ``records`` (url, date, record_id, is_full) the record_id of the latest earlier full response.

    Rows are range-sorted by URL and date, so that the captures of one URL,
    be they a third of all, lie in many ranges.  Each range is solved by
    itself; what it has to know from the ranges before is the last response of
    its first URL, which comes from one row per URL and range.
    """
    ranges = ranges or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["url", "date", "is_full", "record_id"]  # a response of the same instant is not earlier
    placed = written(
        records.select(*order).repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "captures"
    )
    full = F.when(F.col("is_full"), F.struct("date", "record_id"))
    before = Window.partitionBy("range", "url").orderBy("date", "is_full", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("found", F.last(full, ignorenulls=True).over(before)).filter(~F.col("is_full"))
    last = placed.groupBy("url", "range").agg(F.max(full).alias("last"))
    carried = Window.partitionBy("url").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.withColumn("carried", F.last("last", ignorenulls=True).over(carried)).filter("carried is not null")
    return local.join(carry.select("url", "range", "carried"), ["url", "range"], "left").select(
        "url", "record_id", F.coalesce("found", "carried")["record_id"].alias("refers_to")
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, canonical_url, refers_to, outcome, status, payload_digest, headers.

    ``records`` has record_id (unique), url, date, is_full, status, headers
    (map of lower-case names) and payload_digest.  Outcomes: ``resolved``;
    ``changed``, when a validator that both records have differs (entity tag
    first, then payload digest, then last-modified); ``unproved``, when they
    share none; ``missing``, when there is no earlier full response.  Only
    resolved revisits get the status, digest and headers of the response, with
    the permitted headers of the revisit over them.  A null URL or date is
    never joined: the outcome is ``missing``.  Of responses at one instant the
    largest record_id counts; the rest of ties and repeated rows is kept apart
    by record_id.
    """
    named = records.withColumn("canonical_url", canonical_url(F.col("url")))
    usable = F.col("canonical_url").isNotNull() & F.col("date").isNotNull()
    joined = latest_earlier(named.filter(usable).select(F.col("canonical_url").alias("url"), "date", "record_id", "is_full"))
    revisits = named.filter(~F.col("is_full")).select("record_id", "canonical_url", "headers", "payload_digest")
    fulls = named.filter("is_full").select(
        F.col("record_id").alias("refers_to"),
        F.col("status").alias("full_status"),
        F.col("headers").alias("full_headers"),
        F.col("payload_digest").alias("full_digest"),
    )
    both = revisits.join(joined.select("record_id", "refers_to"), "record_id", "left").join(fulls, "refers_to", "left")
    modified = "last-modified"
    same = F.coalesce(
        _tag(F.col("headers")) == _tag(F.col("full_headers")),
        F.col("payload_digest") == F.col("full_digest"),
        F.col("headers")[modified] == F.col("full_headers")[modified],
    )
    outcome = (
        F.when(F.col("refers_to").isNull(), "missing")
        .when(same, "resolved")
        .when(~same, "changed")
        .otherwise("unproved")
    )
    updates = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter("full_headers", lambda k, _: ~F.map_contains_key(updates, k))
    good = F.col("outcome") == "resolved"
    return both.withColumn("outcome", outcome).select(
        "record_id",
        "canonical_url",
        "refers_to",
        "outcome",
        F.when(good, F.col("full_status")).alias("status"),
        F.when(good, F.col("full_digest")).alias("payload_digest"),
        F.when(good, F.map_concat(kept, updates)).alias("headers"),
    )
