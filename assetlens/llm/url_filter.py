"""URL filters by a temporal list join (operator 5, DataFrame functions only).

A list is a log of dated entries (``list_name, pattern, action, day``): a pattern is added to
a list or removed from it. Entries become validity intervals; an as-of join finds, for each
capture, the entries that were active on the day it was fetched. A pattern is a host, a
parent domain of hosts, a host with leading segments of a path, or a whole url with its
query. Patterns are normalised like urls: no scheme, user, port, fragment, outer dots of the
host or trailing slash, and the host in lower case.

The join is on the pattern and the 32-day bucket of the day, so a host with a third of all
captures is spread over time and over its patterns, and adaptive execution splits what is
still large. An interval is repeated once per bucket from its start to its end or the last
capture. Entries are reduced to one per list, pattern and day before the interval window, so
a window holds at most as many rows as there are days.

Defined cases: a null or malformed url matches nothing; entries with a null are ignored; add
and remove on one day: removed; a repeated add renews the entry; repeated capture rows are
one capture; without entries nothing is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DAYS = 32
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*://"
HOST = SCHEME + r"(?:[^/?#]*@)?([^/:?#]+)"
SUPPORTED = r"^[^\s/?#*:@\[\]]+([/?]\S*)?$"
SEGMENT = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+(/[^/?#]+)"


def host_of(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)), r"^\.+|\.+$", "")


def path_and_query(after_scheme: Column) -> tuple[Column, Column]:
    """The path without trailing slashes, and the query with its question mark."""
    rest = F.regexp_extract(after_scheme, r"^[^/?#]*([^#]*)", 1)
    return (F.regexp_replace(F.regexp_extract(rest, r"^([^?]*)", 1), "/+$", ""),
            F.regexp_extract(rest, r"^[^?]*(\?.+)$", 1))


def normal_pattern(pattern: Column) -> Column:
    """A list entry's pattern in the form of the keys of ``patterns_of``."""
    body = F.regexp_replace(F.trim(pattern), SCHEME, "")
    return F.concat(host_of(F.concat(F.lit("x://"), body)), *path_and_query(body))


def unsupported_entries(entries: DataFrame) -> DataFrame:
    """Entries that can match no url, with the reason, for the caller to count: a null field,
    or a pattern without a plain host (wildcards, expressions, bare paths, addresses in
    brackets)."""
    nulls = F.col("list_name").isNull() | F.col("pattern").isNull() | F.col("action").isNull() | F.col("day").isNull()
    return entries.withColumn("problem", F.when(nulls, F.lit("null_field")).when(
        ~normal_pattern(F.col("pattern")).rlike(SUPPORTED), F.lit("unsupported_pattern"))).filter("problem is not null")


def patterns_of(url: Column, labels_most: int, segments_most: int) -> Column:
    """The host, its parent domains of two labels or more, the host with each prefix of whole
    path segments, and with the path and the query; empty for a url without a host. Domains of more
    labels and prefixes of more segments than any listed pattern has can meet none, and are left out."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    widest = F.greatest(F.size(labels) - 1, F.lit(1))
    domains = F.transform(F.sequence(F.least(F.greatest(F.size(labels) - labels_most + 1, F.lit(1)), widest), widest),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path, query = path_and_query(F.regexp_replace(F.coalesce(url, F.lit("")), SCHEME, ""))
    segments = F.split(path, "/")
    prefixes = F.when(path != "", F.transform(
        F.sequence(F.lit(2), F.greatest(F.least(F.size(segments), F.lit(segments_most + 1)), F.lit(2))),
        lambda i: F.concat(host, F.array_join(F.slice(segments, F.lit(1), i), "/")))).otherwise(F.array())
    whole = F.when(query != "", F.array(F.concat(host, path, query))).otherwise(F.array())
    keys = F.concat(domains, prefixes, whole)
    return F.when(host != "", F.array_distinct(keys)).otherwise(F.array().cast("array<string>"))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals list_name, pattern, valid_from, valid_to (exclusive; null: still active)."""
    daily = entries.select("list_name", normal_pattern(F.col("pattern")).alias("pattern"), "action", F.col("day").cast("int").alias("day")).dropna() \
        .groupBy("list_name", "pattern", "day").agg(F.max((F.col("action") == "remove").cast("int")).alias("removed"))
    following = F.lead("day").over(Window.partitionBy("list_name", "pattern").orderBy("day"))
    return daily.withColumn("valid_to", following).filter("removed = 0") \
        .select("list_name", "pattern", F.col("day").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per distinct capture (page_id, url, day): blocked, matches (active entries that
    it meets) and, of the longest pattern among them, list_name, pattern and valid_from."""
    c = captures.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("day").cast("int").alias("day"))
    last = c.agg(F.max("day")).first()[0]
    bucket = lambda day: F.floor(day / BUCKET_DAYS).cast("int")
    horizon = F.lit(0 if last is None else last)
    listed = validity(entries)
    place = F.split(F.element_at(F.split("pattern", r"\?"), 1), "/")
    labels_most, segments_most = listed.agg(F.max(F.size(F.split(F.element_at(place, 1), r"\."))),
                                            F.max(F.size(place) - 1)).first()
    intervals = listed.filter(F.col("valid_from") <= horizon).withColumn("bucket", F.explode(F.sequence(
        bucket(F.col("valid_from")),
        F.greatest(bucket(F.least(F.coalesce(F.col("valid_to") - 1, horizon), horizon)), bucket(F.col("valid_from"))))))
    keyed = c.withColumn("key", F.explode_outer(patterns_of(F.col("url"), labels_most or 1, segments_most or 1))).withColumn("bucket", bucket(F.col("day")))
    met = keyed.join(intervals.withColumnRenamed("bucket", "b"),
                     (F.col("key") == F.col("pattern")) & (F.col("bucket") == F.col("b"))
                     & (F.col("day") >= F.col("valid_from"))
                     & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))), "left")
    best = F.max(F.when(F.col("pattern").isNotNull(),
                        F.struct(F.length("pattern").alias("n"), "pattern", "list_name", "valid_from")))
    return met.groupBy("page_id", "url", "day").agg(
        F.countDistinct("list_name", "pattern").alias("matches"), best.alias("best")).select(
        "page_id", "url", "day", (F.col("matches") > 0).alias("blocked"), "matches",
        F.col("best.list_name").alias("list_name"), F.col("best.pattern").alias("pattern"),
        F.col("best.valid_from").alias("valid_from"))


FIRST_DAY, DAYS = 19_000, 400


def captures_of(pages: DataFrame) -> DataFrame:
    """The table ``pages`` as captures: its ids are dealt over DAYS days."""
    return pages.select("page_id", "url", (F.lit(FIRST_DAY) + F.pmod(F.col("page_id") * 37, F.lit(DAYS)))
                        .cast("int").alias("day"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated lists over the hosts of ``pages``: the table has urls but no lists, so entries
    are drawn from a code ``h`` of each host's letters."""
    url = F.col("url")
    hosts = pages.select(host_of(url).alias("host"),
                         F.regexp_extract(F.coalesce(url, F.lit("")), SEGMENT, 1).alias("segment")) \
        .filter("host <> ''").distinct()
    h = F.expr("ascii(substr(host, 3, 1)) * 31 + ascii(substr(host, 5, 1)) * 7 + length(host)")

    def entry(list_name: str, pattern: Column, action: str, after: Column, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(list_name).alias("list_name"), pattern.alias("pattern"),
                                     F.lit(action).alias("action"), (F.lit(FIRST_DAY) + after).cast("int").alias("day")))

    host, parent = F.col("host"), F.regexp_replace("host", r"^[^.]+\.", "")
    listed = h % 3 == 0
    return hosts.select(F.explode(F.array(
        entry("hosts", host, "add", h % 200, listed),
        entry("hosts", host, "remove", h % 200 + 40, listed & (h % 2 == 0)),
        entry("hosts", host, "add", h % 200 + 90, listed & (h % 5 == 0)),
        entry("domains", parent, "add", h % 300, parent.contains(".") & (h % 7 == 1)),
        entry("paths", F.concat(host, F.col("segment")), "add", F.lit(0),
              (F.col("segment") != "") & ((h + F.length("segment")) % 11 == 0)),
    )).alias("e")).filter("e is not null").select("e.*").distinct()
