"""URL filters: dated list entries as validity intervals, looked up as of the fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
ALWAYS, EVER = "0002-01-01 00:00:00", "9999-12-31 00:00:00"


def host_of(url: Column) -> Column:
    """Lower-case host without a final dot; null for a null URL or one without a host."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"\.+$", "")
    return F.when(host != "", host)


def domains_of(host: Column) -> Column:
    """The host and all domains above it, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """``domain, valid_from, valid_to, category`` from dated ``entries (domain, at, action, category)``.

    An ``add`` holds until the next entry of its domain, a ``remove`` ends it. Of several entries of one domain and time an ``add`` wins, with the
    least category. A null time is the beginning; entries with a null domain match nothing. Intervals of a domain never overlap.
    """
    at = F.coalesce(F.col("at").cast("timestamp"), F.lit(ALWAYS).cast("timestamp"))
    states = entries.where("domain IS NOT NULL").groupBy(F.lower("domain").alias("domain"), at.alias("valid_from")).agg(
        F.max(F.coalesce(F.col("action") == "add", F.lit(False))).alias("listed"),
        F.min(F.when(F.col("action") == "add", F.col("category"))).alias("category"),
    )
    until = F.lead("valid_from").over(W.partitionBy("domain").orderBy("valid_from"))
    return (
        states.withColumn("valid_to", F.coalesce(until, F.lit(EVER).cast("timestamp"))).where("listed")
        .select("domain", "valid_from", "valid_to", "category")
    )


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """Each capture as struct ``row`` with ``host, matched, listed_since, category, kept``.

    A capture is dropped (``kept`` false) if its host or a domain above it is listed when it is fetched; the longest such domain is named.
    A capture without a host or fetch time matches nothing. Rows repeat as given.

    Captures are first reduced to different (host, time) pairs, combined map-side; each meets the intervals of its few domains by an equi-join
    with the interval as condition, of which at most one per domain holds. The answers join back on the pair, so a hot host is
    spread over its times and split further by adaptive execution.
    """
    rows = captures.select(F.struct("*").alias("row"), host_of(F.col(url)).alias("host"), F.col(fetched).cast("timestamp").alias("at"))
    pairs = rows.select("host", "at").where("host IS NOT NULL AND at IS NOT NULL").distinct()
    named = pairs.select("host", "at", F.explode(domains_of(F.col("host"))).alias("domain"))
    valid = intervals(entries)
    hits = named.join(valid, (named["domain"] == valid["domain"]) & (named["at"] >= valid["valid_from"]) & (named["at"] < valid["valid_to"]))
    best = hits.groupBy("host", "at").agg(
        F.max_by(F.struct(valid["domain"].alias("matched"), "valid_from", "category"), F.length(valid["domain"])).alias("hit")
    )
    return rows.join(best, ["host", "at"], "left").select(
        "row", "host", F.col("hit.matched").alias("matched"), F.col("hit.valid_from").alias("listed_since"),
        F.col("hit.category").alias("category"), F.col("hit").isNull().alias("kept"),
    )
