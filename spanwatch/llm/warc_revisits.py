"""WARC revisit records of the profile "server not modified", resolved to full responses.

A revisit refers to the latest earlier full response of its canonical URL: an as-of join. It holds
only if the validators agree; then the headers that a 304 answer may update are merged into those
of the response.

The join is a running maximum over (URL, day), whose state is carried from day to day by a window
over one row per URL and day. A URL that holds a third of all captures is thus spread over its
days, and no capture is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanwatch.llm.common import lower_ascii

# Header fields a 304 answer may update, and query parameters without meaning.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref")

CHUNK_SECONDS = 86_400


def canonical_url(uri: Column) -> Column:
    """Without scheme, ``www.``, port 80 or 443, tracking parameters, fragment and last slash."""
    rest = F.regexp_replace(F.trim(uri), r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, r"(?s)#.*$", "")
    host = lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1)
    query = F.array_join(
        F.array_sort(
            F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.split(p, "=")[0].isin(*TRACKING))
        ),
        "&",
    )
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _lowered(headers: Column) -> Column:
    """Names in lower case; of names that differ in case only, the first in order of spelling."""
    pairs = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    names = F.transform(pairs, lambda p: lower_ascii(p["key"]))
    first = F.filter(pairs, lambda p, i: F.array_position(names, lower_ascii(p["key"])) == i + 1)
    return F.map_from_entries(
        F.transform(first, lambda p: F.struct(lower_ascii(p["key"]).alias("key"), p["value"].alias("value")))
    )


def _agreement(mine: Column, theirs: Column) -> Column:
    """True, false, or null where the records have no validator in common. ETags compare weakly."""
    tag = lambda h: F.regexp_replace(F.trim(h["etag"]), "^W/", "")
    date = lambda h: F.trim(h["last-modified"])
    return F.coalesce(tag(mine) == tag(theirs), date(mine) == date(theirs))


def resolve_revisits(records: DataFrame, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """One row per revisit: the columns of ``records`` and ``canonical, response_id, outcome, merged``.

    ``records`` has ``record_id, warc_type, uri, ts`` (seconds), ``status`` and ``headers`` (a map).
    Full responses have the type ``response`` and status 200. "Earlier" is strictly earlier; of
    responses at one time the one with the largest ``record_id`` counts, null ids last.

    ``outcome`` is ``resolved``; ``mismatch`` if the latest response has other validators;
    ``unchecked`` if there is no validator to compare; ``missing`` without an earlier response or
    with a null or empty URI or null time. ``response_id`` and ``merged`` are set only if resolved.
    Null headers are no headers. Repeated revisits each give a row; an empty table gives none.
    Further columns stay; ones named like the four new columns are replaced.
    """
    new = ["canonical", "response_id", "outcome", "merged"]
    plain = records.select(*[F.col(f"`{c}`") for c in records.columns if c not in new])
    revisit = F.col("warc_type") == "revisit"
    keyed = plain.withColumn("canonical", F.nullif(canonical_url(F.col("uri")), F.lit("")))
    placed = F.col("canonical").isNotNull() & F.col("ts").isNotNull()
    full = (F.col("warc_type") == "response") & (F.col("status") == 200)
    with_time = (
        keyed.filter(placed & (revisit | full))
        .withColumn("__day", F.floor(F.col("ts") / chunk_seconds))
        .withColumn("__h", _lowered(F.col("headers")))
        .withColumn("__full", full)
    )
    order = F.when(F.col("__full"), F.struct("ts", "record_id"))
    earlier = Window.partitionBy("canonical", "__day").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    inside = with_time.select(
        "*",
        F.max(order).over(earlier).alias("__at"),
        F.max_by("__h", order).over(earlier).alias("__theirs"),
    ).filter("warc_type = 'revisit'")

    # The last response of each day, carried over the days of a URL.
    days = with_time.groupBy("canonical", "__day").agg(
        F.max(order).alias("at"), F.max_by("__h", order).alias("theirs")
    )
    before = Window.partitionBy("canonical").orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(
        F.col("canonical").alias("__url"),
        F.col("__day").alias("__d"),
        F.last("at", ignorenulls=True).over(before).alias("__at2"),
        F.last(F.when(F.col("at").isNotNull(), F.col("theirs")), ignorenulls=True).over(before).alias("__theirs2"),
    )
    at = F.coalesce("__at", "__at2")
    theirs = F.when(F.col("__at").isNotNull(), F.col("__theirs")).otherwise(F.col("__theirs2"))
    agree = _agreement(F.col("__h"), F.col("__answer"))
    update = F.map_filter("__h", lambda k, v: k.isin(*PERMITTED))
    stored = F.map_filter("__answer", lambda k, v: ~F.map_contains_key(F.col("__update"), k))
    names = plain.columns
    found = (
        inside.join(
            carried, (inside["canonical"] == carried["__url"]) & (inside["__day"] == carried["__d"]), "left"
        )
        .withColumn("__found", at)
        .withColumn("__answer", theirs)
        .withColumn("__update", update)
        .withColumn(
            "outcome",
            F.when(F.col("__found").isNull(), "missing")
            .when(agree.isNull(), "unchecked")
            .when(agree, "resolved")
            .otherwise("mismatch"),
        )
        .withColumn("__ok", F.col("outcome") == "resolved")
        .select(
            *[F.col(f"`{c}`") for c in names],
            "canonical",
            F.when(F.col("__ok"), F.col("__found.record_id")).alias("response_id"),
            "outcome",
            F.when(F.col("__ok"), F.map_concat(stored, "__update")).alias("merged"),
        )
    )
    types = dict(found.dtypes)
    lost = keyed.filter(revisit & ~placed).select(
        *[F.col(f"`{c}`") for c in names],
        "canonical",
        F.lit(None).cast(types["response_id"]).alias("response_id"),
        F.lit("missing").alias("outcome"),
        F.lit(None).cast(types["merged"]).alias("merged"),
    )
    return found.unionByName(lost)


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Capture records of a crawl that visited each page three times, derived from ``page_id, url``.

    The second visit, one to five days later, is a revisit under another spelling of the URL; the
    third is a revisit whose ETag changed for every fourth page and is absent for every seventh.
    The first visit of every tenth page failed, so that its revisits have no full response.
    """
    page, start = F.col("page_id"), F.lit(1_600_000_000) + F.col("page_id") * 7919 % 2_592_000
    later = start + 86_400 * (1 + page % 5)
    last = later + 3_600 * (1 + page % 7)
    tag = lambda n: F.concat(F.lit('"'), page.cast("string"), F.lit(f'-{n}"'))
    head = lambda *kv: F.map_from_arrays(
        F.array(*[F.lit(k) for k, _ in kv]), F.array(*[v for _, v in kv])
    )
    when = lambda t: t.cast("string")

    def record(k, kind, uri, ts, status, headers):
        return F.struct(
            (page * 4 + k).alias("record_id"),
            F.lit(kind).alias("warc_type"),
            uri.alias("uri"),
            ts.cast("long").alias("ts"),
            status.cast("int").alias("status"),
            headers.alias("headers"),
        )

    first = record(
        0,
        "response",
        F.col("url"),
        start,
        F.when(page % 10 == 0, 503).otherwise(200),
        head(
            ("Content-Type", F.lit("text/html")),
            ("ETag", tag(1)),
            ("Cache-Control", F.lit("max-age=60")),
            ("Date", when(start)),
        ),
    )
    second = record(
        1,
        "revisit",
        F.concat(F.col("url"), F.lit("#again")),
        later,
        F.lit(304),
        head(("etag", F.concat(F.lit("W/"), tag(1))), ("Cache-Control", F.lit("max-age=600")), ("Date", when(later))),
    )
    third = record(
        2,
        "revisit",
        F.regexp_replace("url", "^http:", "https:"),
        last,
        F.lit(304),
        F.when(page % 7 == 0, head(("Content-Type", F.lit("text/plain")), ("Date", when(last)))).otherwise(
            head(
                ("ETag", F.when(page % 4 == 0, tag(2)).otherwise(tag(1))),
                ("Content-Type", F.lit("text/plain")),
                ("Date", when(last)),
            )
        ),
    )
    return pages.select("page_id", F.explode(F.array(first, second, third)).alias("r")).select("page_id", "r.*")
