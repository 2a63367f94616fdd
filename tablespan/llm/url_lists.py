"""URL filters by a temporal list join: was a capture's host listed when it was fetched?

A list is a log of dated entries: a host or domain is added or removed. Entries become validity intervals: an addition
holds from its day until the day of the next removal. A capture is looked up under its host and every parent domain,
and the as-of join finds the interval of each key that contains the day of the fetch. Intervals of one key do not
overlap, so a key gives at most one; of several keys the longest decides.

The join is by key and month, with each interval dealt to the months it covers, so the captures of one very frequent
host spread over the months, and no key's captures are ever ordered or gathered.

Defined results: entries of a key on one day count as one, a removal if any is; entries without key or day are ignored;
a capture without url, host or day is kept and not listed; host names are compared in lower case, without port, user and
final dots; repeated captures are judged one by one; without entries nothing is listed; an empty table gives no rows;
carried columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """The host name of an absolute URL in lower case, or null."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def domains_of(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def validity(entries: DataFrame) -> DataFrame:
    """key, since, until (null: still valid) from entries (key, day, added)."""
    days = entries.filter("key is not null and day is not null and added is not null").groupBy("key", "day").agg(F.min("added").alias("added"))
    order = Window.partitionBy("key").orderBy("day")
    before = F.coalesce(F.lag("added").over(order), F.lit(False))
    changes = days.withColumn("before", before).filter("added <> before")
    return changes.withColumn("until", F.lead("day").over(order)).filter("added").select("key", F.col("day").alias("since"), "until")


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def listed_at_fetch(captures: DataFrame, entries: DataFrame, url: str, day: str) -> DataFrame:
    """row (a record of all capture columns), host, fetched_on, listed, matched (the key that decided) and since."""
    rows = captures.select(F.struct("*").alias("row"), host_of(F.col(url)).alias("host"), F.col(day).cast("date").alias("fetched_on"))
    last = rows.agg(F.max("fetched_on")).first()[0]
    valid = validity(entries).filter(F.col("since") <= F.lit(last).cast("date"))
    until = F.least(F.coalesce("until", F.lit(last).cast("date")), F.lit(last).cast("date"))
    valid = valid.withColumn("month", F.explode(F.sequence(_month(F.col("since")), _month(until))))
    sought = rows.filter("host is not null and fetched_on is not null").select("host", "fetched_on").distinct()
    keys = sought.select("host", "fetched_on", F.explode(domains_of(F.col("host"))).alias("key"), _month(F.col("fetched_on")).alias("month"))
    found = keys.join(valid, ["key", "month"]).filter("since <= fetched_on and (until is null or fetched_on < until)")
    longest = F.max_by(F.struct("key", "since"), F.length("key"))
    found = found.groupBy("host", "fetched_on").agg(longest.alias("hit"))
    out = rows.join(found, ["host", "fetched_on"], "left")
    return out.select("row", "host", "fetched_on", F.col("hit").isNotNull().alias("listed"), F.col("hit.key").alias("matched"), F.col("hit.since").alias("since"))
