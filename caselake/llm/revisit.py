"""Web captures: resolving not-modified revisits to the response they stand for. Built-in expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.ordered import in_ranges
from caselake.session import stage

# What a 304 response may update (RFC 9110, 15.4.5), and query parameters that name no other page.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"^(utm_[a-z]+|gclid|fbclid)(=|$)"
DEFAULT_PORT = r":(80|443)$"


def canonical_url(url: Column) -> Column:
    """One form for addresses of one page.

    Drops white space around it, the scheme, user data, ``www``, the default
    ports, the fragment, slashes at the end of the path and tracking
    parameters; lower-cases the host and sorts the parameters.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*", 0), r"^.*@", ""))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\d*\.", ""), DEFAULT_PORT, "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(bare, r"^[^?]*\?(.*)$", 1), "&", -1)
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _lower_names(headers: Column) -> Column:
    """Header names in lower case; of names that then agree, the last one counts."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(
        entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"])
    )
    return F.coalesce(F.map_from_entries(last), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def merged_headers(response: Column, revisit: Column) -> Column:
    """The response's headers, with those of the revisit that a 304 may update."""
    new = F.map_filter(_lower_names(revisit), lambda k, _: k.isin(*PERMITTED))
    old = F.map_filter(_lower_names(response), lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(old, new)


def _latest_before(captures: DataFrame) -> DataFrame:
    """``captures`` with ``found``, the last response of the same page captured earlier.

    Rows are cut into ranges by page and time, so captures of one page may
    spread over many tasks. A window looks back within a range; what it can't
    see is the last response of the page with which an earlier range ended, and
    that is one row per range.
    """
    # A revisit of the same moment comes first, so that it doesn't see the response.
    order = ["page", "captured_at", "is_response", "record_id", "tie"]
    ranged = in_ranges(captures, order)
    response = F.when(F.col("is_response"), F.struct("captured_at", "record_id", "etag", "last_modified", "headers", "tie"))
    back = Window.partitionBy("part", "page").orderBy(*[F.col(c).asc_nulls_first() for c in order[1:]])
    seen = ranged.withColumn("seen", F.last(response, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)))

    # The last page of each range and its last response there: one row per range.
    of_page = ranged.groupBy("part").agg(F.max("page").alias("page"))
    ends = ranged.join(F.broadcast(of_page), ["part", "page"]).groupBy("part", "page").agg(
        F.max_by(response, F.when(F.col("is_response"), F.struct("captured_at", "record_id", "tie"))).alias("last")
    )
    so_far = F.last("last", ignorenulls=True).over(Window.partitionBy("page").orderBy("part"))
    ends = ends.withColumn("last", so_far)
    # A range without rows has no entry, so what is carried comes from the one before in the list.
    previous = Window.orderBy("part")
    carried = stage(
        ends.select("part", F.lag("page").over(previous).alias("from_page"), F.lag("last").over(previous).alias("carried"))
    )
    met = seen.join(F.broadcast(carried), "part", "left")
    found = F.coalesce("seen", F.when(F.col("page") == F.col("from_page"), F.col("carried")))
    return met.withColumn("found", found).drop("seen", "from_page", "carried", "part")


def _told_apart(columns: Sequence[str]) -> Column:
    """A hash of a row's values that tells NULL from a value."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c), F.col(c).isNull())])


# What makes a response the one that was found; the payload stands for itself by its hash.
IDENTITY = ("record_id", "url", "captured_at", "etag", "last_modified", "payload")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``record_id, page, status, response_id, headers, payload`` for every revisit in ``records``.

    ``records`` has ``record_id, url, captured_at, kind`` (``response`` or
    ``revisit``), ``etag, last_modified, headers`` (a map) and ``payload``. A
    revisit stands for the latest response of the same canonical address
    captured before it. Its ETag, or without one its Last-Modified date, has
    to be the response's:

    * ``resolved``: it is; ``unchecked``: the revisit has neither. Both get the
      response's payload, and its headers updated by the permitted ones.
    * ``changed``: it is not, and ``missing``: there is no earlier response.
      Both keep their own headers and have no payload.

    Of responses captured at one moment the larger record id counts. Record ids
    may clash: the payload is that of the response found, by its address, time, validators and content. A weak
    ETag equals the strong one. Null addresses and null times have no earlier
    response. Other kinds and other columns are left out, repeated revisits
    stay, repeated responses count once, and an empty table gives an empty one.
    """
    captures = records.filter(F.col("kind").isin("response", "revisit")).select(
        "record_id",
        canonical_url(F.col("url")).alias("page"),
        F.col("captured_at").cast("bigint").alias("captured_at"),
        (F.col("kind") == "response").alias("is_response"),
        F.regexp_replace("etag", r"^W/", "").alias("etag"),
        "last_modified",
        "headers",
        _told_apart(IDENTITY).alias("tie"),
    )
    revisits = stage(_latest_before(captures)).filter(~F.col("is_response"))
    dated = F.col("captured_at").isNotNull() & F.col("page").isNotNull() & F.col("found.captured_at").isNotNull()
    checked = F.when(F.col("etag").isNotNull(), F.col("etag").eqNullSafe(F.col("found.etag"))).when(
        F.col("last_modified").isNotNull(), F.col("last_modified").eqNullSafe(F.col("found.last_modified"))
    )
    status = F.when(~F.coalesce(dated, F.lit(False)), "missing").when(checked.isNull(), "unchecked")
    status = status.when(checked, "resolved").otherwise("changed")
    judged = revisits.withColumn("status", status)
    taken = F.col("status").isin("resolved", "unchecked")
    judged = judged.select(
        "record_id",
        "page",
        "status",
        F.when(taken, F.col("found.record_id")).alias("response_id"),
        F.when(taken, F.col("found.tie")).alias("tie"),
        F.when(taken, merged_headers(F.col("found.headers"), F.col("headers"))).otherwise(_lower_names(F.col("headers"))).alias("headers"),
    )
    judged = stage(judged)
    responses = records.filter("kind = 'response'").select(
        F.col("record_id").alias("response_id"), _told_apart(IDENTITY).alias("tie"), "payload"
    )
    # Only responses that stand for a revisit are moved; the same one may have been recorded twice.
    needed = responses.join(judged.filter("tie IS NOT NULL").select("response_id", "tie").distinct(), ["response_id", "tie"], "left_semi")
    # All three go by the same keys, so payloads are shuffled once.
    payloads = needed.dropDuplicates(["response_id", "tie"])
    out = judged.join(payloads, ["response_id", "tie"], "left")
    return out.select("record_id", "page", "status", "response_id", "headers", "payload")
