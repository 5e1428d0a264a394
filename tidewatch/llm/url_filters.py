"""URL filters as a temporal list join, in DataFrame functions only.

List entries are dated: from its time on an entry blocks, allows or removes its pattern, until the next entry of that
pattern. An as-of join gives every capture the entry of each of its patterns that was in force at fetch time.

Time is cut into buckets, and keys are (pattern, bucket): entries of a bucket become validity intervals inside it, and a
bucket begins with the state carried over from the last bucket that had entries. So a pattern that a third of all captures
match is spread over its buckets, only captures and entries of one bucket meet, a capture meets exactly one interval of each
pattern, and the one ordered pass over a whole pattern has a row for each bucket, not for each capture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, ALLOW, REMOVE = "block", "allow", "remove"


def host_of(url: Column) -> Column:
    """Lower-case host of a url; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def path_of(url: Column) -> Column:
    """Path segments of a url: no query, no fragment, no empty segments."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def patterns_of(url: Column) -> Column:
    """Every pattern that matches a url: its host, the domains above it, and its host with each prefix of its path.

    A pattern is `domain` or `host/segment/...`. A url without a host matches nothing.
    """
    host = host_of(url)
    labels, segments = F.split(host, r"\."), path_of(url)
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    prefixes = F.when(F.size(segments) > 0, F.transform(
        F.sequence(F.lit(1), F.size(segments)),
        lambda k: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), k), "/")))).otherwise(
        F.array().cast("array<string>"))
    return F.when(host != "", F.concat(domains, prefixes)).otherwise(F.array().cast("array<string>"))


def specificity(pattern: Column) -> Column:
    """Path patterns before domains, then the longer ones."""
    return F.when(F.contains(pattern, F.lit("/")), 1 << 20).otherwise(0) + F.length(pattern)


def intervals(entries: DataFrame, needed: DataFrame, bucket_seconds: int) -> DataFrame:
    """(pattern, bucket, valid_from, valid_to, entry_id, action): for every needed (pattern, bucket), who rules when.

    Of entries with one time the one with the larger entry_id is in force; the others' intervals are empty.
    """
    dated = entries.where("pattern is not null and at is not null").withColumn("bucket", F.floor(F.col("at") / bucket_seconds))
    inside = Window.partitionBy("pattern", "bucket").orderBy("at", "entry_id")
    end = (F.col("bucket") + 1) * bucket_seconds
    own = dated.select("pattern", "bucket", F.col("at").alias("valid_from"),
                       F.coalesce(F.lead("at").over(inside), end).alias("valid_to"), "entry_id", "action")
    last = dated.groupBy("pattern", "bucket").agg(
        F.max_by(F.struct("entry_id", "action"), F.struct("at", "entry_id")).alias("state"), F.min("at").alias("first"))
    marks = last.unionByName(needed.select("pattern", "bucket"), allowMissingColumns=True).groupBy("pattern", "bucket").agg(
        F.any_value("state", ignoreNulls=True).alias("state"), F.min("first").alias("first"))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("state", F.last("state", ignorenulls=True).over(before)).where("state is not null").select(
        "pattern", "bucket", (F.col("bucket") * bucket_seconds).alias("valid_from"),
        F.coalesce("first", end).alias("valid_to"), "state.entry_id", "state.action")
    return own.unionByName(carried).where("valid_from < valid_to")


def judged(captures: DataFrame, entries: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """(capture_id, url, at, entry_id, pattern, action, blocked) for every capture (capture_id, url, at).

    entries: (entry_id, pattern, action, at), times in seconds. Of the patterns in force at fetch time the most specific one
    decides; `remove` ends a pattern. Captures without a match, a url, a host or a time have null entry_id, pattern and
    action, and are not blocked. Entries without a pattern or time are never in force. Repeated captures are judged alike,
    one result a capture_id, url and time; other columns are ignored; empty tables give no rows, or no matches.
    """
    rows = captures.select("capture_id", "url", F.col("at").cast("long").alias("at"))
    listed = entries.select("entry_id", "pattern", "action", F.col("at").cast("long").alias("at"))
    # only patterns that the list has are carried on
    keys = (rows.where("at is not null").select("capture_id", "url", "at", F.explode(patterns_of(F.col("url"))).alias("pattern"))
            .join(listed.select("pattern").distinct(), "pattern", "left_semi")
            .withColumn("bucket", F.floor(F.col("at") / bucket_seconds)))
    ruling = intervals(listed, keys.select("pattern", "bucket").distinct(), bucket_seconds)
    matched = keys.join(ruling, ["pattern", "bucket"]).where(
        "at >= valid_from and at < valid_to").where(F.col("action") != REMOVE)
    found = matched.select("capture_id", "url", "at", F.struct(
        specificity(F.col("pattern")).alias("rank"), "pattern", "entry_id", "action").alias("best"))
    # one row a capture: its own, without a match, and its matches
    empty = rows.withColumn("best", F.lit(None).cast(found.schema["best"].dataType))
    return (found.unionByName(empty).groupBy("capture_id", "url", "at").agg(F.max("best").alias("best"))
            .select("capture_id", "url", "at", "best.entry_id", "best.pattern", "best.action",
                    F.coalesce(F.col("best.action") == BLOCK, F.lit(False)).alias("blocked")))


SECONDS = 366 * 86_400


def _digits(key: Column, salt: str, modulus: int) -> Column:
    """A number below the modulus from the key, the same in every engine that has MD5."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % modulus


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures; the tables have no fetch times, so these follow from the page_id, within a year."""
    return pages.select(F.col("page_id").alias("capture_id"), "url", _digits(F.col("page_id"), ":fetched", SECONDS).alias("at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list that grows with the pages: each page's url is listed once, as host, domain above it, or path prefix."""
    host, path, kind = host_of(F.col("url")), path_of(F.col("url")), _digits(F.col("page_id"), ":kind", 4)
    pattern = (F.when((kind == 0) | (F.size(path) == 0), host)
               .when(kind == 1, F.regexp_replace(host, r"^[^.]*\.", ""))
               .otherwise(F.concat(host, F.lit("/"), F.array_join(F.slice(path, F.lit(1), (kind - 1).cast("int")), "/"))))
    action = F.element_at(F.array(*map(F.lit, (BLOCK, ALLOW, REMOVE))), (_digits(F.col("page_id"), ":act", 3) + 1).cast("int"))
    return pages.where(host != "").select(F.col("page_id").alias("entry_id"), pattern.alias("pattern"), action.alias("action"),
                                          _digits(F.col("page_id"), ":listed", SECONDS).alias("at"))
