"""Temporal URL list filters, in DataFrame functions only.

Lists change over time. Dated entries (list, kind, pattern, action, since)
become validity intervals, and an as-of join holds every capture against the
entries that were active when it was fetched. Patterns are hosts, which also
cover their subdomains, or URL prefixes of whole path segments, in lower case as
captures' hosts and paths are for this. A capture is
blocked if the most specific active pattern that covers it comes from a list of
kind `block`; at equal length `allow` wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Intervals that are broadcast, at most, and bytes of their text; more are joined by shuffle, where skewed keys can be split.
BROADCAST_INTERVALS, BROADCAST_BYTES = 200_000, 16 << 20


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user, port and trailing dot; null where there is none."""
    authority = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(F.length(host) > 0, host)


def _parts(text: Column, by: str) -> Column:
    return F.split(text, by, -1)


def host_keys(host: Column, labels: int) -> Column:
    """The host and the domains above it, of at most `labels` labels."""
    own = _parts(host, r"\.")
    first = F.greatest(F.lit(1), F.size(own) - labels + 1)
    return F.transform(F.sequence(first, F.size(own)), lambda i: F.array_join(F.slice(own, i, F.size(own)), "."))


def prefix_keys(url: Column, host: Column, length: int) -> Column:
    """The host followed by the whole-segment prefixes of the path, of at most `length` characters; none for the bare host.

    Of a path only so many characters are looked at, however long it is.
    """
    path = F.regexp_replace(F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1), "/+", "/")
    # a segment that the cut goes through belongs to no short enough prefix
    cut = F.when(F.length(path) > length + 1, F.regexp_replace(F.substring(path, 1, length + 1), r"[^/]*\z", "")).otherwise(path)
    steps = F.filter(_parts(cut, "/"), lambda x: x != "")
    keys = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")))
    return F.when(F.size(steps) > 0, F.filter(keys, lambda k: F.length(k) <= length)).otherwise(F.array().cast("array<string>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, since, until) of dated entries; until is null while an entry still holds.

    `entries` has list, kind (block or allow), pattern, action (add or remove)
    and since. Of entries of one list and pattern with equal dates a removal
    wins. Repeated additions join up. Rows with a null in any of the columns
    are left out. One list's entries for one pattern meet in one group; as
    many as that pattern has changes.
    """
    known = entries.select("list", "kind", F.lower("pattern").alias("pattern"), "action", F.col("since").cast("timestamp").alias("since")).dropna()
    one = known.groupBy("list", "kind", "pattern", "since").agg(F.max(F.col("action") == "remove").alias("removed"))
    w = Window.partitionBy("list", "kind", "pattern").orderBy("since")
    changes = one.withColumn("was", F.lag("removed").over(w)).where("was is null or was <> removed")
    return changes.withColumn("until", F.lead("since").over(w)).where("not removed").select("list", "kind", "pattern", "since", "until")


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "capture_id", url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """One row per capture row: the id, host, blocked, n_active, pattern (the one that decides), lists (names, sorted).

    A capture without a host or time is covered by nothing and not blocked.
    Repeated captures come back repeated; other columns are ignored. URLs may be
    of any length: no key longer than the longest pattern is made of one.
    """
    base = captures.select(F.col(id_col).alias("capture_id"), F.col(url_col).cast("string").alias("url"), F.col(time_col).cast("timestamp").alias("at"))
    base = base.withColumn("host", host_of(F.col("url")))
    active = validity_intervals(entries)
    zero = lambda c: F.coalesce(c, F.lit(0))
    labels = F.size(_parts(F.split_part("pattern", F.lit("/"), F.lit(1)), r"\."))
    size = active.agg(F.count("*").alias("n"), zero(F.sum(F.length("list") + F.length("pattern") + 40)).alias("b"), zero(F.max(F.length("pattern"))).alias("length"), zero(F.max(labels)).alias("labels")).first()
    few = size.n <= BROADCAST_INTERVALS and size.b <= BROADCAST_BYTES
    # equal captures are looked up once, whatever their number
    distinct = base.where("host is not null and at is not null").select("url", "host", "at").distinct()
    keyed = distinct.select("url", "at", F.explode(F.concat(host_keys(F.col("host"), size.labels), prefix_keys(F.col("url"), F.col("host"), size.length))).alias("key"))
    right = F.broadcast(active) if few else active
    hits = keyed.join(right, (F.lower(keyed.key) == right.pattern) & (keyed.at >= right.since) & (right.until.isNull() | (keyed.at < right.until)))
    best = F.struct(F.length("pattern").alias("n"), (F.col("kind") == "allow").alias("allow"), F.col("pattern").alias("pattern"))
    judged = hits.groupBy("url", "at").agg(F.max(best).alias("best"), F.count("*").alias("n_active"), F.array_sort(F.collect_set("list")).alias("lists"))
    judged = judged.select(F.col("url").alias("u"), F.col("at").alias("t"), (~F.col("best.allow")).alias("blocked"), "n_active", F.col("best.pattern").alias("pattern"), "lists")
    out = base.join(judged, (base.url == judged.u) & (base["at"] == judged.t), "left")
    return out.select("capture_id", "host", F.coalesce("blocked", F.lit(False)).alias("blocked"), F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active"), "pattern", F.coalesce("lists", F.array().cast("array<string>")).alias("lists"))
