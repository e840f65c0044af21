"""Resolution of not-modified captures: which full response does a 304 stand for, and how it reads now.

A revisit belongs to the latest full response of the same canonical URL that is earlier than it.
Records are ranged by (URL, time), so that a URL with very many captures spans several partitions
instead of filling one; the last response before each revisit is found within its partition, and
only URLs that cross a partition's border, at most one per border, take what came before it from
the partitions before. Only keys and times go through this; headers follow by one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import broadcast_within, let, materialize

# Fields that a 304 response may update, and query parameters that name no content.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"^(?:utm_[^=]*|ref|fbclid|gclid|sessionid)(?:=|$)"

HEADERS = "array<struct<name:string,value:string>>"


def canonical(url: Column) -> Column:
    """A URL without scheme, user, leading www, default port, fragment, tracking, final slash.

    The host is in lower case, the remaining parameters are sorted. A null URL stays null.
    """
    plain = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(plain, r"^(?i)[a-z][a-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(host, r"^[^@]*@", "")
    host = F.regexp_replace(F.regexp_replace(host, r":(?:80|443)?$", ""), r"^www\d*\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def fields(headers: Column) -> Column:
    """Header fields with names in lower case, sorted; a null map has none, null values are dropped."""
    entries = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    named = F.transform(entries, lambda e: F.struct(F.lower(F.trim(e["key"])).alias("name"), F.trim(e["value"]).alias("value")))
    return F.array_sort(F.filter(named, lambda e: e["value"].isNotNull()))


def _field(found: Column, name: str) -> Column:
    return F.get(F.filter(found, lambda e: e["name"] == name), F.lit(0))["value"]


def merged(stored: Column, fresh: Column) -> Column:
    """The stored fields, those that the 304 may update and does update taken from it."""
    update = F.filter(fresh, lambda e: e["name"].isin(*PERMITTED))
    return let(
        update,
        lambda u: F.array_sort(
            F.concat(F.filter(stored, lambda e: ~F.exists(u, lambda n: n["name"] == e["name"])), u)
        ),
    )


def verdict(stored: Column, fresh: Column) -> Column:
    """resolved, validator_mismatch or no_validator: entity tags by weak comparison, else the date."""

    def tag(found: Column) -> Column:
        return F.regexp_replace(_field(found, "etag"), "^W/", "")

    def agree(a: Column, b: Column) -> Column:
        return F.when(F.coalesce(a == b, F.lit(False)), "resolved").otherwise("validator_mismatch")

    modified = agree(_field(stored, "last-modified"), _field(fresh, "last-modified"))
    return (
        F.when(tag(fresh).isNotNull(), agree(tag(stored), tag(fresh)))
        .when(_field(fresh, "last-modified").isNotNull(), modified)
        .otherwise("no_validator")
    )


def latest_before(records: DataFrame) -> DataFrame:
    """record_id of each revisit and the response it belongs to, null if there is none.

    ``records`` has url (canonical), ts, record_id and full (is it a full response). A response
    belongs to later revisits only; of several at one time the largest record_id counts. Captures
    without URL or time belong to nothing.
    """
    usable = records.where(F.col("url").isNotNull() & F.col("ts").isNotNull())
    order = ["url", "ts", "full", "record_id"]
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = usable.select(*order).repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")  # the borders are drawn once
    response = F.when(F.col("full"), F.struct("ts", "record_id"))
    local = Window.partitionBy("part", "url").orderBy("ts", "full", "record_id")
    here = F.last(response, ignorenulls=True).over(local.rowsBetween(Window.unboundedPreceding, 0))
    seen = ranged.withColumn("here", here["record_id"]).where(~F.col("full"))

    lasts = ranged.groupBy("url", "part").agg(F.max(response).alias("last"))
    crossing = lasts.groupBy("url").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("url")
    crossing = materialize(crossing, "crossing")
    known = lasts.join(broadcast_within(crossing, crossing.count()), "url", "left_semi")
    earlier = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = materialize(
        known.select("url", "part", F.last("last", ignorenulls=True).over(earlier)["record_id"].alias("before")), "carried"
    )
    return seen.join(broadcast_within(carried, carried.count()), ["url", "part"], "left").select(
        "record_id", F.coalesce("here", "before").alias("refers_to")
    )


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url, refers_to, status, headers (as the response reads now).

    ``records`` has record_id, url, ts, full and headers (map of strings); other columns are not
    read. ``status`` is resolved, no_prior, validator_mismatch or no_validator; only a resolved
    revisit has headers. A record_id names one record: repeated rows are taken once. An empty table
    gives an empty result; rows whose ``full`` is null are ignored.
    """
    known = records.where(F.col("full").isNotNull() & F.col("record_id").isNotNull()).dropDuplicates(["record_id"])
    known = known.select(
        "record_id", "url", "ts", "full", fields(F.col("headers")).alias("headers"), canonical(F.col("url")).alias("key")
    )
    known = materialize(known, "records")
    prior = materialize(latest_before(known.select(F.col("key").alias("url"), "ts", "record_id", "full")), "prior")
    stored = known.where("full").select(F.col("record_id").alias("refers_to"), F.col("headers").alias("stored"))
    revisits = known.where(~F.col("full")).select("record_id", "url", "headers").join(prior, "record_id", "left")
    joined = revisits.join(stored, "refers_to", "left")
    status = F.when(F.col("refers_to").isNull(), "no_prior").otherwise(verdict(F.col("stored"), F.col("headers")))
    return joined.withColumn("status", status).select(
        "record_id",
        "url",
        "refers_to",
        "status",
        F.when(F.col("status") == "resolved", merged(F.col("stored"), F.col("headers"))).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Records that a crawl of ``pages`` would have left, derived from their rows.

    Each page is a full response at minute 10 * page_id, and a later visit, one to a thousand
    minutes on, that found it not modified: under another spelling of its URL, with the fields such
    an answer carries. One in five visits names another entity tag, one in seven of the rest has a
    date alone, one in eleven of the rest no validator.
    """
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"'))
    page = F.col("page_id")

    def stamp(minute: Column) -> Column:
        return F.concat(F.lit("minute "), minute.cast("string"))

    def headers(**values: Column) -> Column:
        pairs = [x for k, v in values.items() for x in (F.lit(k.replace("_", "-").title()), v)]
        return F.create_map(*pairs)

    first, again = page * 10, page * 10 + 1 + page * 7919 % 1000
    full = pages.select(
        (page * 2).alias("record_id"),
        "url",
        first.alias("ts"),
        F.lit(True).alias("full"),
        headers(
            date=stamp(first),
            etag=tag,
            last_modified=stamp(page),
            content_type=F.lit("text/html"),
            content_length=F.length(F.coalesce("html", F.lit(""))).cast("string"),
            cache_control=F.lit("max-age=60"),
        ).alias("headers"),
    )
    other = F.when(page % 5 == 0, F.lit('"changed"')).when((page % 7 == 0) | (page % 11 == 0), F.lit(None).cast("string"))
    seen_tag = F.when(other.isNotNull() | (page % 7 == 0) | (page % 11 == 0), other).otherwise(F.concat(F.lit("W/"), tag))
    visit = pages.select(
        (page * 2 + 1).alias("record_id"),
        F.concat("url", F.lit("#seen")).alias("url"),
        again.alias("ts"),
        F.lit(False).alias("full"),
        headers(
            date=stamp(again),
            etag=seen_tag,
            last_modified=F.when(page % 7 == 0, stamp(page)),
            content_length=F.lit("0"),
            expires=stamp(again + 60),
            set_cookie=F.lit("visited"),
        ).alias("headers"),
    )
    return full.unionByName(visit)
