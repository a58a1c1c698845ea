"""Resolving not-modified revisit records of web archives.

A revisit record says that a server answered "not modified"; its content is that of an earlier capture.
Each revisit is joined as of its time to the latest earlier full response of the same canonical URL. If
the revisit names a validator, it has to agree: entity tags by the weak comparison, else the date of last
modification. The headers of a resolved record are the stored ones, updated by those of the revisit that a
not-modified answer may update; fields about the message itself stay as they were stored.

Captures are ordered in ranges of (URL, time), so one URL with a third of all records spans many
partitions; the last response before a range comes from one row per range and URL.

Status: ``resolved`` (a validator agreed), ``unverified`` (the revisit named none), ``mismatch`` (the latest
response has another validator), ``no_response`` (none is earlier), ``no_url``. Defined results: null and
empty URLs are ``no_url``; of captures at the same time the smaller record id counts as earlier; repeated
rows are all kept; null headers count as none; header names are folded, and of names that differ in case only the
first in byte order counts; an empty table gives an empty result. Pages of any length
are only hashed. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.operators.ordered import last_before

RESPONSE, REVISIT = "response", "revisit"

# Header fields of the message, which a not-modified answer must not update.
FIXED_FIELDS = (
    "connection",
    "content-encoding",
    "content-length",
    "content-md5",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-connection",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)
# Query parameters that only say where a visitor came from.
TRACKING = "^(utm_[a-z]*|fbclid|gclid|ref|mc_cid|mc_eid)(=|\\z)"


def canonical_url(url: Column) -> Column:
    """Host and path of a URL in one spelling; null without a host.

    Scheme, fragment, default ports, a leading ``www.``, a final slash and tracking parameters do not count; the
    host is folded and parameters are sorted.
    """
    bare = F.regexp_replace(F.trim(url), "#.*\\z", "")
    host = F.lower(F.regexp_extract(bare, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)?\\z", ""), "^www[0-9]*\\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), "/+\\z", "")
    query = F.split(F.regexp_extract(bare, "[?](.*)\\z", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, tail))


def opaque(tag: Column) -> Column:
    """An entity tag without its weakness mark."""
    return F.regexp_replace(tag, "^W/", "")


def folded(headers: Column) -> Column:
    """Headers by their names in lower case."""
    lower = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    first = F.filter(lower, lambda e, i: F.array_position(lower["key"], e["key"]) == i + 1)
    return F.map_from_entries(first)


def merged_headers(stored: Column, update: Column) -> Column:
    fresh = F.map_filter(update, lambda k, v: ~k.isin(*FIXED_FIELDS) & v.isNotNull())
    names = F.map_keys(fresh)
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(names, k)), fresh)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit with what it stands for.

    ``records``: ``record_id`` (long), ``url``, ``captured_at``, ``kind`` (``response`` or ``revisit``), ``headers``
    (map, names in any case), ``digest`` of the payload.
    """
    headers = folded(F.coalesce("headers", F.create_map().cast("map<string,string>")))
    keyed = records.select(
        "record_id", "captured_at", "kind", "digest", canonical_url(F.col("url")).alias("canonical"), headers.alias("headers")
    )
    usable = keyed.filter("canonical IS NOT NULL")
    # Maps cannot be compared, so headers travel as arrays of entries.
    placed = last_before(
        usable.withColumn("headers", F.map_entries("headers")),
        "canonical",
        ["captured_at", "record_id"],
        F.when(F.col("kind") == RESPONSE, F.struct("record_id", "digest", "headers")),
        "full",
        "captures",
    ).filter(F.col("kind") == REVISIT)
    placed = placed.withColumn("headers", F.map_from_entries("headers"))
    stored = F.map_from_entries("full.headers")
    tag, dated = F.col("headers")["etag"], F.col("headers")["last-modified"]
    agrees = F.when(tag.isNotNull(), opaque(tag) == opaque(stored["etag"])).otherwise(dated == stored["last-modified"])
    status = (
        F.when(F.col("full").isNull(), "no_response")
        .when(tag.isNull() & dated.isNull(), "unverified")
        .when(F.coalesce(agrees, F.lit(False)), "resolved")
        .otherwise("mismatch")
    )
    usable_out = placed.withColumn("status", status)
    ok = F.col("status").isin("resolved", "unverified")
    found = usable_out.select(
        "record_id",
        "canonical",
        "captured_at",
        "status",
        F.col("full.record_id").alias("response_id"),
        F.when(ok, F.col("full.digest")).alias("digest"),
        F.when(ok, merged_headers(stored, F.col("headers"))).alias("headers"),
    )
    lost = keyed.filter(F.col("canonical").isNull() & (F.col("kind") == REVISIT)).select(
        "record_id",
        "canonical",
        "captured_at",
        F.lit("no_url").alias("status"),
        F.lit(None).cast("long").alias("response_id"),
        F.lit(None).cast("string").alias("digest"),
        F.lit(None).cast("map<string,string>").alias("headers"),
    )
    return found.unionByName(lost)


def archive_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """An archive of ``pages``: per page its capture and up to three later revisits.

    Page ``p`` is captured ``p`` minutes into the crawl; its revisits follow after 1, 2 and 3 days, as many as
    the length of the URL modulo 4. The first names the entity tag (weak), the second the date of
    modification, the third nothing; of every seventh page the first names an outdated tag.
    """
    digest = F.md5(F.coalesce(F.col(html_col), F.lit("")))
    base = pages.select(
        F.col(id_col).cast("long").alias("page"),
        F.col(url_col).alias("url"),
        digest.alias("digest"),
        F.octet_length(F.coalesce(F.col(html_col), F.lit(""))).cast("string").alias("length"),
    )
    visits = F.char_length(F.coalesce("url", F.lit(""))) % 4
    visit = base.select("*", F.explode(F.sequence(F.lit(0), visits)).alias("visit"))
    minutes = F.col("page") + 1440 * F.col("visit")
    tag = F.concat(F.lit('"'), F.col("digest"), F.lit('"'))
    changed = F.concat(F.lit("day "), F.floor(F.col("page") / 1440).cast("string"))
    response = {
        "content-type": F.lit("text/html"),
        "content-length": F.col("length"),
        "etag": tag,
        "last-modified": changed,
        "cache-control": F.lit("max-age=60"),
    }
    revisit_tag = F.when(
        F.col("visit") == 1,
        F.when(F.col("page") % 7 == 0, F.lit('"old"')).otherwise(F.concat(F.lit("W/"), tag)),
    )
    revisit = {
        "etag": revisit_tag,
        "last-modified": F.when(F.col("visit") == 2, changed),
        "cache-control": F.concat(F.lit("max-age="), (60 * F.col("visit")).cast("string")),
        "content-length": F.lit("0"),
        "x-visit": F.col("visit").cast("string"),
    }

    def fields(values: dict[str, Column]) -> Column:
        made = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])
        return F.map_filter(made, lambda k, v: v.isNotNull())

    first = F.col("visit") == 0
    return visit.select(
        (4 * F.col("page") + F.col("visit")).alias("record_id"),
        "url",
        minutes.alias("captured_at"),
        F.when(first, RESPONSE).otherwise(REVISIT).alias("kind"),
        F.when(first, fields(response)).otherwise(fields(revisit)).alias("headers"),
        F.when(first, F.col("digest")).alias("digest"),
    )


def header_lines(headers: Column) -> Column:
    """Headers as sorted lines."""
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.array_join(F.array_sort(lines), "\n")
