"""Not-modified revisits of web captures: as-of join to the latest earlier full response.

A revisit record of a WARC file holds no body: the server said that nothing changed (304). It is
resolved to the latest earlier full response of the same canonical URL, if the validators agree,
and the stored headers are updated by those that a 304 may update.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 86_400
#: Header fields that a not-modified response brings up to date.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """Without scheme, fragment, ``www.``, default port, utm_ parameters and a slash at the path's end; host lower-cased, parameters sorted."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), "^www\\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    kept = F.array_join(F.array_sort(F.filter(F.split(F.regexp_extract(bare, "\\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.startswith("utm_"))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def _header(headers: str, name: str) -> Column:
    return F.get(F.filter(F.col(headers), lambda h: h["name"] == name), F.lit(0))["value"]


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per revisit: rec_id, canonical, ts, outcome, resolved_to, merged (headers), body_digest.

    ``records``: rec_id, url, ts (seconds), kind (response or revisit), status, headers (array of name, value), digest.
    Full responses are those of kind response and status 200. The latest of smaller ts is taken, of equal ones the greatest
    rec_id. ``outcome``: ``resolved``; ``mismatch`` if a validator of the revisit (its ETag; without one, Last-Modified;
    without both, the digest; with none of them nothing is contradicted) differs from the response's; ``no_response`` if
    there is none, or URL or ts are NULL. ``merged`` has the response's headers, those permitted replaced by the revisit's,
    sorted by lower-case name. Repeated revisits are resolved each; empty input gives an empty result; other columns are ignored.

    A hot URL is cut into buckets of time: the latest response inside the bucket comes from a running maximum, the latest of
    earlier buckets from one row per URL and bucket.
    """
    headers = F.array_sort(F.transform(F.coalesce("headers", F.lit(None).cast(HEADERS), F.array().cast(HEADERS)), lambda h: F.struct(F.lower(h["name"]).alias("name"), h["value"].alias("value"))))
    rows = records.select("rec_id", canonical_url(F.col("url")).alias("canonical"), F.col("ts").cast("long").alias("ts"), "kind", "status", headers.alias("headers"), "digest")
    rows = rows.where("kind = 'revisit' OR (kind = 'response' AND status = 200 AND canonical IS NOT NULL AND ts IS NOT NULL)").withColumn("bucket", F.expr(f"ts div {bucket_seconds}"))
    placed = rows.where("canonical IS NOT NULL AND ts IS NOT NULL").withColumn("full", F.when(F.col("kind") == "response", F.struct("ts", "rec_id", "headers", "digest")))
    inside = Window.partitionBy("canonical", "bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("within", F.max("full").over(inside)).where("kind = 'revisit'")
    earlier = Window.partitionBy("canonical").orderBy("bucket").rangeBetween(Window.unboundedPreceding, -1)
    # every bucket of a URL, with the latest response of the buckets before
    carried = placed.groupBy("canonical", "bucket").agg(F.max("full").alias("full")).select("canonical", "bucket", F.max("full").over(earlier).alias("carried"))
    found = within.join(carried, ["canonical", "bucket"]).withColumn("to", F.coalesce("within", "carried")).select("rec_id", "canonical", "ts", "headers", "digest", "to")
    lost = rows.where("kind = 'revisit' AND (canonical IS NULL OR ts IS NULL)").select("rec_id", "canonical", "ts", "headers", "digest", F.lit(None).cast(found.schema["to"].dataType).alias("to"))
    found = found.union(lost).withColumn("stored", F.col("to.headers"))
    etag, modified = _header("headers", "etag"), _header("headers", "last-modified")
    agrees = F.when(etag.isNotNull(), etag.eqNullSafe(_header("stored", "etag"))).when(modified.isNotNull(), modified.eqNullSafe(_header("stored", "last-modified"))).when(
        F.col("digest").isNotNull(), F.col("digest").eqNullSafe(F.col("to.digest"))).otherwise(True)
    fresh = F.filter("headers", lambda h: h["name"].isin(*PERMITTED))
    merged = F.array_sort(F.concat(F.filter("stored", lambda h: ~F.array_contains(F.transform(fresh, lambda f: f["name"]), h["name"])), fresh))
    outcome = F.when(F.col("to").isNull(), "no_response").when(agrees, "resolved").otherwise("mismatch")
    ok = F.col("outcome") == "resolved"
    return found.withColumn("outcome", outcome).select(
        "rec_id", "canonical", "ts", "outcome", F.when(ok, F.col("to.rec_id")).alias("resolved_to"), F.when(ok, merged).alias("merged"), F.when(ok, F.col("to.digest")).alias("body_digest"))


DAY = 86_400


def captures(pages: DataFrame) -> DataFrame:
    """Capture records of crawled pages: three responses of each on consecutive days, and five revisits between and after them.

    The page changes before the second response (odd page_id) and before the third (every third page_id); the second response
    of every fifth is an error. The revisits: an hour after the first response by ETag (of every seventh page a changed one); an
    hour after the second by Last-Modified; an hour after the third by digest (of every eleventh page that of
    the first); two hours after it without a validator; and half a minute before the first by ETag. Times follow
    page_id, a minute a page. Digests are taken of the page's digest and the number of its edition.
    """
    t, p = F.lit(1_600_000_000) + F.col("page_id") * 60, F.col("page_id")
    second = p % 2
    editions = [F.lit(0).cast("long"), second, second + F.when(p % 3 == 0, 1).otherwise(0)]

    def digest(edition: Column) -> Column:
        return F.md5(F.concat("sum", F.lit(":"), edition.cast("string")).cast("binary"))

    def tag(edition: Column) -> Column:
        return F.concat(F.lit('"'), F.substring(digest(edition), 1, 16), F.lit('"'))

    def fields(**kw) -> Column:
        return F.array(*[F.struct(F.lit(k.replace("_", "-")).alias("name"), v.cast("string").alias("value")) for k, v in kw.items()])

    def of(k: int, kind: str, status: Column, ts: Column, h: Column, sum_: Column) -> Column:
        return F.struct((p * 8 + k).alias("rec_id"), F.col("url").alias("url"), ts.alias("ts"), F.lit(kind).alias("kind"), status.cast("int").alias("status"), h.alias("headers"), sum_.alias("digest"))

    none, ok, unchanged = F.lit(None).cast("string"), F.lit(200), F.lit(304)
    responses = [of(v, "response", F.when(p % 5 == 0, 503).otherwise(200) if v == 1 else ok, t + v * DAY,
                    fields(ETag=tag(e), Last_Modified=t + e * DAY, Cache_Control=F.lit("max-age=60"), Content_Type=F.lit("text/html"), Date=t + v * DAY), digest(e)) for v, e in enumerate(editions)]
    after = [t + v * DAY + 3600 for v in range(3)]
    revisits = [
        of(3, "revisit", unchanged, after[0], fields(ETag=F.when(p % 7 == 0, F.lit('"changed"')).otherwise(tag(editions[0])), Cache_Control=F.lit("max-age=600"), Content_Length=F.lit("0"), Date=after[0]), none),
        of(4, "revisit", unchanged, after[1], fields(Last_Modified=t + editions[1] * DAY, Date=after[1]), none),
        of(5, "revisit", unchanged, after[2], fields(Date=after[2], Expires=after[2] + 60), digest(F.when(p % 11 == 0, editions[0]).otherwise(editions[2]))),
        of(6, "revisit", unchanged, after[2] + 3600, fields(Date=after[2] + 3600), none),
        of(7, "revisit", unchanged, t - 30, fields(ETag=tag(editions[0]), Date=t - 30), none)]
    summed = pages.select("page_id", "url", F.md5(F.coalesce("html", F.lit("")).cast("binary")).alias("sum"))
    return summed.select(F.explode(F.array(*responses, *revisits)).alias("r")).select("r.*")
