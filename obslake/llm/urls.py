"""URL filters by dated lists.

A list adds and removes entries (a host with all below it, or a host and path prefix) on dates.
Entries become validity intervals, and every capture is judged by the entries active on the day it
was fetched. Captures that share a URL and a day are judged once, and a key (host or prefix) is
looked up once for each day, so a host with a third of all captures costs its days, not its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window


def _plain(url: Column) -> Column:
    """A URL without scheme, user, port, query and fragment; host and www. prefix in lower case."""
    rest = F.regexp_replace(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//", "")
    rest = F.regexp_replace(rest, r"[?#].*\z", "")
    host = F.lower(F.regexp_extract(rest, r"^(?:[^/@]*@)?([^/:]*)", 1))
    host = F.regexp_replace(host, r"\.\z", "")
    path = F.regexp_extract(rest, r"^[^/]*(/.*)?\z", 1)
    return F.struct(host.alias("host"), F.regexp_replace(path, r"/+\z", "").alias("path"))


def with_keys(d: DataFrame) -> DataFrame:
    """d (url, ...) once for each `key` that list entries can name of the URL: its host, every parent
    domain, and the host with every prefix of its path, step by step. None without a host."""
    d = d.withColumn("_p", _plain(F.col("url"))).where("_p.host <> ''") \
        .withColumn("_l", F.split("_p.host", r"\.")).withColumn("_s", F.split("_p.path", "/"))
    domains = F.transform(F.sequence(F.lit(1), F.size("_l")),
                          lambda i: F.array_join(F.slice("_l", i, F.size("_l")), "."))
    prefixes = F.transform(F.filter(F.sequence(F.lit(1), F.size("_s")), lambda i: i > 1),
                           lambda i: F.concat("_p.host", F.array_join(F.slice("_s", 1, i), "/")))
    return d.withColumn("key", F.explode(F.array_distinct(F.concat(domains, prefixes)))).drop("_p", "_l", "_s")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, since, until): when each entry holds, from its date on until the day before
    `until` (null: still). entries: list, key, date, action ('add' or 'remove').

    Of an addition and a removal on one day the addition holds. Repeated additions, and removals of
    what is not listed, change nothing. Rows with a null in a needed column, or another action, are
    no entries. Days of a (list, key) are merged before they are sorted, so its history is as long
    as the calendar at most.
    """
    days = entries.where("list is not null and key is not null and date is not null and action in ('add', 'remove')") \
        .groupBy("list", "key", "date").agg(F.max(F.col("action") == "add").alias("on"))
    own = Window.partitionBy("list", "key").orderBy("date")
    turns = days.withColumn("before", F.coalesce(F.lag("on").over(own), F.lit(False))).where("on <> before")
    return turns.withColumn("until", F.lead("date").over(own)).where("on") \
        .select("list", "key", F.col("date").alias("since"), "until")


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per row of captures (page_id, url, fetched: date): page_id, url, fetched, blocked,
    list, key (the entry that decided: the longest key, then the first list), since.

    A null URL or date, or a URL without a host, is blocked by nothing; repeated rows are judged each;
    other columns are ignored.
    """
    asked = captures.select("page_id", "url", F.col("fetched").cast("date").alias("fetched"))
    once = asked.select("url", "fetched").where("url is not null and fetched is not null").distinct()
    named = with_keys(once)
    days = named.select("key", "fetched").distinct()
    active = days.join(intervals(entries), "key").where("fetched >= since and (until is null or fetched < until)")
    # one entry for each key and day: the first list
    active = active.groupBy("key", "fetched").agg(F.min(F.struct("list", "since")).alias("entry"))
    hits = named.join(active, ["key", "fetched"]).select("url", "fetched", F.struct(
        (-F.length("key")).alias("n"), "entry.list", "key", "entry.since").alias("hit"))
    verdict = hits.groupBy("url", "fetched").agg(F.min("hit").alias("hit"))
    return asked.join(verdict, ["url", "fetched"], "left").select(
        "page_id", "url", "fetched", F.col("hit").isNotNull().alias("blocked"), F.col("hit.list").alias("list"),
        F.col("hit.key").alias("key"), F.col("hit.since").alias("since"))
