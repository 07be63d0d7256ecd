"""URL filters by lists that change over time.

List entries are dated additions and removals of patterns. They become intervals in which a
pattern is listed, and each capture is judged by the entries active when it was fetched,
not by today's list. A pattern is a host (``example.com`` also covers its subdomains) or a
host with the start of a path. Its host is compared as a URL's is, in any case and without
``www.``; its path as written. A capture meets an entry on an equal pattern and month, for
which intervals are cut into months: both sides stay as wide as they are, whatever the number
of changes of a pattern.

Of several changes of a pattern on one day the removal counts. Null or hostless URLs, and
captures without a date, match nothing and pass. Entries without pattern, date or a known
action are left out. Repeated entries count once; repeated captures each get a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.frames import small, staged

FOREVER = "9999-12-31"


def host(url: Column) -> Column:
    """The host of a URL, lower-cased, without user, port and a leading ``www.``; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), r"^www\.|\.$", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def patterns_of(host: Column, path: Column) -> Column:
    """All patterns that cover a URL: its host, the domains above it, and the host with each start of the path."""
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    starts = F.when(F.size(parts) > 0, F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"))))
    return F.when(host != "", F.array_distinct(F.concat(domains, F.coalesce(starts, F.array().cast("array<string>")))))


def listed_pattern(pattern: Column) -> Column:
    """A pattern with its host as ``host`` gives it, and its path as written."""
    place = F.regexp_replace(F.lower(F.regexp_extract(pattern, r"^[^/]*", 0)), r"^www\.|\.$", "")
    return F.concat(place, F.regexp_extract(pattern, r"(?s)^[^/]*(.*)$", 1))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, pattern, valid_from, valid_to`` (exclusive) from ``list, pattern, action, date``."""
    clean = entries.filter(F.col("pattern").isNotNull() & F.col("date").isNotNull() & F.col("action").isin("add", "remove"))
    # Per day one action, the removal if there are both; per run of equal actions its first day.
    daily = clean.groupBy("list", listed_pattern(F.col("pattern")).alias("pattern"), F.col("date").cast("date").alias("date")).agg(F.max("action").alias("action"))
    by_date = Window.partitionBy("list", "pattern").orderBy("date")
    changes = daily.withColumn("before", F.lag("action").over(by_date)).filter(~F.col("action").eqNullSafe(F.col("before")))
    dated = changes.withColumn("valid_to", F.coalesce(F.lead("date").over(by_date), F.to_date(F.lit(FOREVER))))
    return dated.filter(F.col("action") == "add").select("list", "pattern", F.col("date").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, listed: DataFrame, capture_id: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``capture_id, host, fetched, blocked, allowed, list, pattern, listed_since`` of each capture.

    ``list, pattern, listed_since`` name the most specific active entry (the longest pattern,
    then the first list by name). A capture is blocked if that entry is on a list other than ``allow``.
    """
    rows = captures.select(F.col(capture_id).alias("capture_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), F.col(fetched).cast("date").alias("fetched"))
    keys = rows.select("host", "path", "fetched").distinct()
    wanted = staged(
        keys.filter("fetched IS NOT NULL").withColumn("pattern", F.explode(patterns_of(F.col("host"), F.col("path")))).withColumn("month", F.trunc("fetched", "month")),
        "capture-patterns",
    )
    first, last = wanted.agg(F.min("month"), F.max("month")).first()
    if first is None:
        found = listed.filter("false").select(F.lit("").alias("f_host"), F.lit("").alias("f_path"), F.current_date().alias("f_fetched"), F.struct("pattern", "list", F.col("valid_from").alias("since")).alias("best"))
    else:
        # Only months in which captures were fetched.
        begin = F.greatest(F.trunc("valid_from", "month"), F.lit(first))
        until = F.least(F.trunc(F.date_sub("valid_to", 1), "month"), F.lit(last))
        monthly = staged(
            listed.filter(begin <= until).select("list", F.col("pattern").alias("entry"), "valid_from", "valid_to", F.explode(F.sequence(begin, until, F.expr("interval 1 month"))).alias("in_month")),
            "monthly-intervals",
        )
        active = wanted.join(small(monthly, monthly.count(), 50_000), (F.col("pattern") == F.col("entry")) & (F.col("month") == F.col("in_month"))).filter(
            (F.col("valid_from") <= F.col("fetched")) & (F.col("fetched") < F.col("valid_to"))
        )
        found = active.groupBy(F.col("host").alias("f_host"), F.col("path").alias("f_path"), F.col("fetched").alias("f_fetched")).agg(
            F.min_by(F.struct("pattern", "list", F.col("valid_from").alias("since")), F.struct((-F.length("pattern")).alias("n"), F.col("list"), F.col("pattern"))).alias("best")
        )
    found = staged(found, "active-entries")
    same = (F.col("host") == F.col("f_host")) & (F.col("path") == F.col("f_path")) & (F.col("fetched") == F.col("f_fetched"))
    return rows.join(small(found, found.count(), 50_000), same, "left").select(
        "capture_id", "host", "fetched",
        F.coalesce(F.col("best.list") != "allow", F.lit(False)).alias("blocked"),
        F.coalesce(F.col("best.list") == "allow", F.lit(False)).alias("allowed"),
        F.col("best.list").alias("list"), F.col("best.pattern").alias("pattern"), F.col("best.since").alias("listed_since"),
    )


def keep_allowed(captures: DataFrame, listed: DataFrame, capture_id: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``capture_id`` of the captures that no list blocks."""
    return judge(captures, listed, capture_id, url, fetched).filter(~F.col("blocked")).select("capture_id")
