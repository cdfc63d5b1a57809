"""URL filters: temporal list join.

Lists are logs of dated entries (list, kind, pattern, action, op, at): a pattern is added or removed at an
instant. ``intervals`` turns them into validity intervals: an added entry holds from its instant up to the next
entry of the same list, kind and pattern. ``evaluate`` joins every capture with the entries active at its fetch
time (valid_from <= fetched_at < valid_to).

Kinds: ``domain`` matches a host and everything below it, ``prefix`` a host with the beginning of a path that
ends at a slash. A capture is looked up under each of its host's suffixes and path's prefixes, as deep as the
lists have patterns, so the join is an equality join on (kind, pattern). Intervals are also cut into time
buckets, which are part of the key: a pattern with a long history is compared by bucket. The join stands alone
between its shuffles, so that adaptive execution can split the captures of a host that has a third of them;
captures with equal url and time are looked up once.

Of several active entries the most specific decides (prefix before domain, longer before shorter), then allow
before block, then the list name.

Defined cases: captures without a url, host or fetch time match nothing and are returned; an entry with a null
in list, kind, pattern, op or time is void; entries of one instant count as removed first, then added; repeated
entries are one; rows that repeat a capture are returned as often; patterns and hosts are compared in lower
case. Empty tables give empty results or no matches. Extra columns of the captures are kept by ``evaluate``, but for
those named like a column that it adds (``ADDED``), which the new one replaces. The history of one pattern of a list is
put in order in one task: it is as long as the log of that list for that pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower

BUCKET_SECONDS = 30 * 86400
KINDS = ("domain", "prefix")
#: Columns that ``evaluate`` adds to the captures.
ADDED = ("host", "action", "list", "pattern", "valid_from", "n_active")


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and final dot; null if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    host = F.regexp_replace(ascii_lower(host), r"\.$", "")
    return F.when(F.length(host) > 0, host)


def path_of(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1)
    return F.when(F.length(path) > 0, path).otherwise(F.lit("/"))


def intervals(entries: DataFrame) -> DataFrame:
    """list, kind, pattern, action, valid_from, valid_to (null: open); one row per added entry."""
    own = (entries.select("list", "kind", ascii_lower(F.col("pattern")).alias("pattern"), "action", "op", "at")
           .dropna(subset=["list", "kind", "pattern", "op", "at"]).distinct())
    w = Window.partitionBy("list", "kind", "pattern").orderBy("at", F.col("op") == "add", "action")
    return (own.withColumn("valid_to", F.lead("at").over(w))
            .where((F.col("op") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("at"))))
            .select("list", "kind", "pattern", "action", F.col("at").alias("valid_from"), "valid_to"))


def _lookups(max_labels: int, max_parts: int) -> Column:
    """(kind, pattern) under which a capture with columns host and path is looked up."""
    labels, parts = F.split("host", r"\."), F.split("path", "/", -1)
    n, m = F.size(labels), F.size(parts)
    none = F.array().cast("array<struct<kind:string,pattern:string>>")
    domains = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(max(1, max_labels)))), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, n - i + 1, i), ".").alias("pattern")))
    prefixes = F.transform(F.sequence(F.lit(1), F.least(m - 1, F.lit(max(1, max_parts)))), lambda i: F.struct(
        F.lit("prefix").alias("kind"),
        F.concat(F.col("host"), ascii_lower(F.array_join(F.slice(parts, 1, i), "/")), F.lit("/")).alias("pattern")))
    return F.when(F.col("host").isNotNull(), F.concat(domains if max_labels else none, prefixes if max_parts else none))


def evaluate(captures: DataFrame, entries: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``captures`` (url, fetched_at in epoch seconds, any other columns) with host, action, list, pattern and
    valid_from of the entry that decides, and n_active, the number of active entries that match."""
    valid = intervals(entries)
    # bounds that hold for every capture and entry: how deep the patterns go, and the buckets captures lie in
    depth = valid.agg(
        F.max(F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\.")))),
        F.max(F.when(F.col("kind") == "prefix", F.size(F.split("pattern", "/")) - 1))).first()
    span = captures.agg(F.min("fetched_at"), F.max("fetched_at")).first()
    distinct = (captures.select(F.col("url").alias("_u"), F.col("fetched_at").alias("_t"))
                .where("_u is not null and _t is not null").distinct())
    bucket = lambda c: F.floor(c / F.lit(bucket_seconds)).cast("long")
    looked = (distinct.withColumns({"host": host_of(F.col("_u")), "path": path_of(F.col("_u"))})
              .select("_u", "_t", bucket(F.col("_t")).alias("bucket"),
                      F.explode(_lookups(depth[0] or 0, depth[1] or 0)).alias("k"))
              .select("_u", "_t", "bucket", "k.kind", "k.pattern"))
    low, high = (span[0] or 0), (span[1] or 0)
    last = F.least(F.coalesce(F.col("valid_to") - 1, F.lit(high)), F.lit(high))
    first = F.greatest(F.col("valid_from"), F.lit(low))
    cut = (valid.where(first <= last).withColumn("bucket", F.explode(F.sequence(bucket(first), bucket(last)))))
    active = (looked.join(cut, ["kind", "pattern", "bucket"])
              .where((F.col("valid_from") <= F.col("_t")) & (F.col("valid_to").isNull() | (F.col("_t") < F.col("valid_to")))))
    rank = F.struct((F.col("kind") == "prefix").alias("k"), F.length("pattern").alias("n"),
                    (F.col("action") == "allow").alias("a"))
    # smallest list name last in rank: two aggregates keep the comparison simple
    best = active.select("_u", "_t", "list", "pattern", "action", "valid_from", rank.alias("rank")).groupBy("_u", "_t").agg(
        F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n_active"),
        F.min(F.struct(-F.col("rank.k").cast("int"), -F.col("rank.n"), -F.col("rank.a").cast("int"), F.col("list"),
                       F.col("pattern"), F.col("valid_from"), F.col("action").alias("action"))).alias("b"))
    best = best.select("_u", "_t", "n_active", F.col("b.action").alias("action"), F.col("b.list").alias("list"),
                       F.col("b.pattern").alias("pattern"), F.col("b.valid_from").alias("valid_from"))
    own = [F.col(f"`{c}`") for c in captures.columns if c not in ADDED]
    return (captures.select(*own).join(best, (F.col("url") == F.col("_u")) & (F.col("fetched_at") == F.col("_t")), "left")
            .select(*own, host_of(F.col("url")).alias("host"), "action", "list", "pattern", "valid_from",
                    F.coalesce("n_active", F.lit(0).cast("long")).alias("n_active")))


#: Captures and lists derived from ``pages``: fetch times spread over a year, entries dated by a hash.
YEAR_START, YEAR_SECONDS, DAY = 1704067200, 366 * 86400, 86400


def captures_of(pages: DataFrame) -> DataFrame:
    """page_id, url, fetched_at of pages; the fetch time is spread over a year by the page_id."""
    return pages.select("page_id", "url", (F.lit(YEAR_START) + F.pmod(F.col("page_id") * 86413, F.lit(YEAR_SECONDS)))
                        .alias("fetched_at"))


def _digits(c: Column, start: int, n: int) -> Column:
    return F.conv(F.substring(F.md5(c), start, n), 16, 10).cast("long")


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list made from the hosts and first path parts of pages: every host is blocked at some day, most
    are removed later, some added anew; parent domains and some prefixes have entries of their own."""
    hosts = pages.select(host_of(F.col("url")).alias("host"),
                         F.regexp_extract(path_of(F.col("url")), r"^(/[^/]+/)", 1).alias("part")).where("host is not null")
    domains = hosts.select(F.lit("blocklist").alias("list"), F.lit("domain").alias("kind"), F.col("host").alias("pattern"))
    parents = hosts.select(F.lit("parents").alias("list"), F.lit("domain").alias("kind"),
                           F.regexp_replace("host", r"^[^.]*\.", "").alias("pattern"))
    prefixes = hosts.where("part <> ''").select(
        F.lit("sections").alias("list"), F.lit("prefix").alias("kind"),
        ascii_lower(F.concat("host", "part")).alias("pattern"))
    rows = domains.unionByName(parents).unionByName(prefixes).distinct()
    added = F.lit(YEAR_START) + DAY * F.pmod(_digits(F.col("pattern"), 1, 6), F.lit(250))
    removed = added + DAY * (1 + F.pmod(_digits(F.col("pattern"), 7, 4), F.lit(90)))
    again = removed + DAY * F.pmod(_digits(F.col("pattern"), 11, 4), F.lit(60))
    action = F.when(F.pmod(_digits(F.col("pattern"), 15, 2), F.lit(4)) == 0, "allow").otherwise("block")
    kind = F.pmod(_digits(F.col("pattern"), 17, 2), F.lit(3))
    events = F.concat(
        F.array(F.struct(F.lit("add").alias("op"), added.alias("at"))),
        F.when(kind > 0, F.array(F.struct(F.lit("remove").alias("op"), removed.alias("at")))).otherwise(F.array().cast("array<struct<op:string,at:bigint>>")),
        F.when(kind > 1, F.array(F.struct(F.lit("add").alias("op"), again.alias("at")))).otherwise(F.array().cast("array<struct<op:string,at:bigint>>")))
    return (rows.withColumn("action", action).withColumn("e", F.explode(events))
            .select("list", "kind", "pattern", "action", "e.op", "e.at"))
