"""Not-modified revisits of a web archive, resolved to the response they repeat.

A revisit record (a 304 answer) has headers but no body. It belongs to the latest earlier full
response of the same canonical URL, if the two agree on a validator: entity tags (compared
weakly) if both have one, else modification dates if both have one. Then the record gets that
response's body, and its headers: those of the response, updated by the revisit's except the ones
that describe the body or the connection.

The as-of join is in two steps, so no URL has to be one task's work: time is cut into slices;
within a URL and slice a running maximum finds the latest response, and the latest of all earlier
slices comes from one row per URL and slice. Only times and ids take part in it; headers and
bodies are joined by record id afterwards.

Defined results: no earlier response, a null URL or a null time: ``orphan``; validators differ:
``mismatch``; none in common: ``unvalidated``; only ``resolved`` records get a body and merged
headers, the others keep their own headers and have no body. A response at the same time is not
earlier; of several at one time the one with the largest id counts. Record ids are unique; rows
that repeat one whole are one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = 65_536
# Header fields that an update must not touch (body and connection).
NOT_PERMITTED = (
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Host in lower case without www., m. and default ports, path without a last slash, sorted
    parameters without tracking ones; no scheme, no fragment."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, "^([^/?]*)", 1)), "^(www|m)\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    params = F.filter(F.split(F.regexp_extract(rest, "\\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref)="))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(params), "&"))).otherwise(""))


def _latest_earlier(events: DataFrame) -> DataFrame:
    """(record_id, refers_to) of revisits. ``events``: record_id, curl, ts, full."""
    sliced = events.withColumn("slice", F.floor(F.col("ts") / SLICE))
    mark = F.when(F.col("full"), F.struct("ts", "record_id"))
    per_slice = sliced.groupBy("curl", "slice").agg(F.max(mark).alias("latest"))
    earlier = Window.partitionBy("curl").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select("curl", "slice", F.max("latest").over(earlier).alias("carried"))
    before = Window.partitionBy("curl", "slice").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("local", F.max(mark).over(before)).where(~F.col("full"))
    found = local.join(carried, ["curl", "slice"])
    return found.select("record_id", F.coalesce("local", "carried")["record_id"].alias("refers_to"))


def _lower_names(headers: Column) -> Column:
    """Header names in lower case, without nulls; of names that become equal the last counts."""
    pairs = F.filter(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))), lambda e: e["value"].isNotNull())
    names = F.array_distinct(F.transform(pairs, lambda e: F.lower(e["key"])))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(pairs, lambda e: F.lower(e["key"]) == n), -1)["value"]))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit of ``records`` (record_id, url, ts, kind 'response' or 'revisit',
    headers map<string,string>, body): record_id, url, ts, status, refers_to, headers, body."""
    rows = records.select("record_id", "url", "ts", "kind", _lower_names(F.col("headers")).alias("headers"), "body")
    events = rows.where("url is not null and ts is not null and record_id is not null and kind in ('response', 'revisit')").select(
        "record_id", canonical_url(F.col("url")).alias("curl"), F.col("ts").cast("long").alias("ts"), (F.col("kind") == "response").alias("full")
    )
    refers = _latest_earlier(events).where("refers_to is not null").distinct()
    full = rows.where("kind = 'response'").select(F.col("record_id").alias("refers_to"), F.col("headers").alias("f"), F.col("body").alias("full_body")).dropDuplicates(["refers_to"])
    revisits = rows.where("kind = 'revisit'").drop("kind", "body").join(refers, "record_id", "left").join(full, "refers_to", "left")

    def weak(tag: Column) -> Column:
        return F.regexp_replace(tag, "^W/", "")

    h, f = F.col("headers"), F.col("f")
    tags, dates = [m["etag"] for m in (h, f)], [m["last-modified"] for m in (h, f)]
    agree = F.coalesce(weak(tags[0]) == weak(tags[1]), dates[0] == dates[1])
    status = (
        F.when(F.col("refers_to").isNull(), "orphan").when(agree.isNull(), "unvalidated").when(agree, "resolved").otherwise("mismatch")
    )
    update = F.map_filter(h, lambda k, _: ~k.isin(*NOT_PERMITTED))
    merged = F.map_concat(F.map_filter(f, lambda k, _: ~F.map_contains_key(update, k)), update)
    done = F.col("status") == "resolved"
    return revisits.withColumn("status", status).select(
        "record_id", "url", "ts", "status", "refers_to", F.when(done, merged).otherwise(h).alias("headers"), F.when(done, F.col("full_body")).alias("body")
    )
