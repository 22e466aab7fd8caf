"""WARC records, and resolution of not-modified revisits.

A revisit record says that a page was fetched again and had not changed; its content is that of the latest earlier full
response (status 200, not partial) of the same canonical URL. That response is found by an as-of join; the revisit's
validators (entity tag by weak comparison, modification time, payload digest) are checked against it, and the headers
that a not-modified response may update are merged into the stored ones.

The as-of join numbers nothing and gathers nothing by URL: records are cut into time slices, each slice of a URL knows
its last full response, slices pass it on, and only records of one slice of one URL are ordered together. Payloads do
not move at all; only identifiers, validators and headers do.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomgraph.llm.batches import small_batches
from loomgraph.plans.scratch import stored

#: Records of one time slice over all URLs, about: what one task orders if they all have one URL.
SLICE_ROWS = 20_000
#: Payload bytes of a batch of records read from a file.
BATCH_BYTES = 8 << 20
#: Response headers that a not-modified response must not replace (message framing, content, hop-by-hop).
FIXED_HEADERS = ["connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade"]


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, an empty path as ``/``, escapes in upper case,
    query parameters sorted. What is no http or https URL is only trimmed; null stays null."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    part = lambda i: F.regexp_extract(u, r"^([A-Za-z]+)://([^/?]*)([^?]*)(\?.*)?$", i)
    scheme = F.lower(part(1))
    host = F.regexp_replace(F.lower(part(2)), "\\.$", "")
    host = F.when(scheme == "http", F.regexp_replace(host, ":(80)?$", "")).otherwise(F.regexp_replace(host, ":(443)?$", ""))
    path = F.when(part(3) == "", F.lit("/")).otherwise(part(3))
    query = F.array_join(F.array_sort(F.split(F.substring(part(4), 2, 1 << 30), "&")), "&")
    full = F.concat(scheme, F.lit("://"), host, path, F.when(F.length(query) > 0, F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(scheme.isin("http", "https"), full).otherwise(F.trim(url))


def _entity(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row for each revisit among records (record_id, url, ts long, kind, status int, headers map<string,string>
    with names in lower case, digest): record_id, url_key, ts, base_id, base_ts, state, headers.

    state is ``no_base`` (no earlier full response; headers are the revisit's own), ``mismatch`` (a validator that both
    have differs; the base is named, headers stay the revisit's), ``unverified`` (no validator is in both) or
    ``resolved``; in the last two cases headers are the base's with those of the revisit that may be updated. A revisit
    whose profile (an optional column) says that an identical payload came again is a response of its own: its state is
    ``identical_payload``, the latest earlier full response is named, and its own headers stay.
    Earlier means a smaller ts; of several at one ts the largest record_id counts. Records with a null url, ts or
    record_id are no base and, as revisits, have none. Repeated revisit rows give repeated results; a repeated record_id
    of a base counts once, by its largest digest. Null headers are empty. Extra columns are not read.
    """
    empty = F.create_map().cast("map<string,string>")
    profile = F.col("profile").cast("string") if "profile" in records.columns else F.lit(None).cast("string")
    rows = records.select(
        F.coalesce(F.contains(F.lower(profile), F.lit("identical-payload")), F.lit(False)).alias("again"), "record_id", canonical_url(F.col("url")).alias("url_key"), F.col("ts").cast("long").alias("ts"), "kind", F.col("status").cast("int").alias("status"), F.coalesce("headers", empty).alias("headers"), "digest"
    )
    rows = stored(rows, "warc-records")  # narrow: five branches read it
    revisits = rows.where("kind = 'revisit'").select("record_id", "url_key", "ts", "headers", "digest", "again")
    placed = "url_key is not null and ts is not null and record_id is not null"
    full = rows.where("kind = 'response' and status = 200 and record_id is not null and url_key is not null and ts is not null and not map_contains_key(headers, 'content-range')")
    # slices span the bulk of the times; what lies outside, as wrong clocks may, belongs to the first or last one
    span = rows.agg(F.percentile_approx("ts", [0.005, 0.995], 10_000).alias("bulk"), F.count("*").alias("n")).first()
    lo, hi = span.bulk or (0, 0)
    slices = 1 + span.n // SLICE_ROWS
    width = 1 + (hi - lo) // slices
    at = F.expr(f"(least(greatest(ts, {lo}L), {hi}L) - {lo}L) div {width}L")
    last = F.struct("ts", "record_id")
    events = full.select("url_key", "ts", "record_id", F.lit(True).alias("base")).unionByName(revisits.where(placed).select("url_key", "ts", "record_id", F.lit(False).alias("base")).distinct()).withColumn("slice", at)
    ends = events.groupBy("url_key", "slice").agg(F.max(F.when(F.col("base"), last)).alias("last"))
    before = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    passed = ends.select("url_key", "slice", F.max("last").over(before).alias("passed"))
    within = Window.partitionBy("url_key", "slice").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    found = events.withColumn("near", F.max(F.when(F.col("base"), last)).over(within)).where("not base").join(passed, ["url_key", "slice"]).select("record_id", "url_key", "ts", F.coalesce("near", "passed").alias("b"))
    bases = full.groupBy("record_id").agg(F.max_by(F.struct("headers", "digest"), F.struct(F.coalesce("digest", F.lit("")), "ts")).alias("s"))
    named = revisits.where(placed).join(found, ["record_id", "url_key", "ts"]).withColumn("base_id", F.col("b.record_id"))
    # revisits without a base have no key to be joined by: they go around the join
    alone = named.where("base_id is null").unionByName(revisits.where(f"not ({placed})").withColumn("b", F.lit(None).cast(named.schema["b"].dataType)).withColumn("base_id", F.lit(None).cast(named.schema["base_id"].dataType)))
    met = named.where("base_id is not null").join(bases.withColumnRenamed("record_id", "base_id"), "base_id")
    met = met.unionByName(alone.withColumn("s", F.lit(None).cast(bases.schema["s"].dataType)))
    had, new = F.col("s.headers"), F.col("headers")
    pairs = [(_entity(had["etag"]), _entity(new["etag"])), (F.trim(had["last-modified"]), F.trim(new["last-modified"])), (F.col("s.digest"), F.col("digest"))]
    same = [a == b for a, b in pairs]
    state = (
        F.when(F.col("base_id").isNull(), "no_base")
        .when(F.col("again"), "identical_payload")
        .when(F.coalesce(F.array_contains(F.array_compact(F.array(*same)), False), F.lit(False)), "mismatch")
        .when(F.size(F.array_compact(F.array(*same))) == 0, "unverified")
        .otherwise("resolved")
    )
    update = F.map_filter("headers", lambda k, _: ~k.isin(*FIXED_HEADERS))
    merged = F.map_concat(F.map_filter(had, lambda k, _: ~F.map_contains_key(update, k)), update)
    return met.withColumn("state", state).select("record_id", "url_key", "ts", "base_id", F.col("b.ts").alias("base_ts"), "state", F.when(F.col("state").isin("resolved", "unverified"), merged).otherwise(F.col("headers")).alias("headers"))


def parse_warc(data: bytes) -> Iterator[dict]:
    """The records of a WARC file, whole or compressed record by record: version line, named fields, block. Damaged
    data raise ValueError. Compressed data are inflated as they are read: beside the file, one record is in memory."""
    pieces, held, at = _inflated(data), bytearray(), 0

    def filled(n: int) -> bool:
        while len(held) < n:
            more = next(pieces, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        while filled(2) and held[:2] == b"\r\n":
            del held[:2]
        if not held:
            return
        while (end := held.find(b"\r\n\r\n")) < 0 and filled(len(held) + 1):
            pass
        if end < 0 or not held.startswith(b"WARC/"):
            raise ValueError(f"no record {at}")
        head = _fields(bytes(held[:end]).split(b"\r\n")[1:])
        size = end + 4 + int(head.get("content-length", "0"))
        if not filled(size):
            raise ValueError(f"record {at} is cut off")
        yield {"fields": head, "block": bytes(held[end + 4 : size])}
        del held[:size]
        at += 1


def _inflated(data: bytes, piece: int = 1 << 20) -> Iterator[bytes]:
    """The data in pieces, all members of compressed ones one after the other."""
    view = memoryview(data)
    if data[:2] != b"\x1f\x8b":
        yield from (view[i : i + piece] for i in range(0, len(view), piece))
        return
    member, at = zlib.decompressobj(31), 0
    while at < len(view) or member.unconsumed_tail:
        some = member.unconsumed_tail or view[at : at + piece]
        at += 0 if member.unconsumed_tail else len(some)
        try:
            yield member.decompress(some, piece)
        except zlib.error as e:
            raise ValueError(f"damaged compression: {e}") from e
        if member.eof:
            at -= len(member.unused_data)
            member = zlib.decompressobj(31)


def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The response and revisit records of WARC files: the columns that :func:`resolve_revisits` reads, refers_to (the
    record that a revisit names itself, if it does) and payload.

    ts is the WARC date in seconds; a 206 or 304 status is in the block's status line. Spark hands a file over whole, so
    files of 2 GB and more are to be cut first; records leave in batches of ``BATCH_BYTES``.
    """
    schema = "record_id string, url string, ts long, kind string, status int, headers map<string,string>, digest string, profile string, refers_to string, payload binary"
    names = ["record_id", "url", "ts", "kind", "status", "headers", "digest", "profile", "refers_to", "payload"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.string(), pa.string(), pa.string(), pa.binary()]
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, kinds)], names=names)

    def run(batches):
        from datetime import datetime

        for b in batches:
            for content in b.column(0):
                rows, held = [], 0
                for r in parse_warc(content.as_py()):
                    f, kind = r["fields"], r["fields"].get("warc-type")
                    if kind not in ("response", "revisit"):
                        continue
                    head, _, payload = r["block"].partition(b"\r\n\r\n")
                    first, *lines = head.split(b"\r\n")
                    status = re.match(rb"HTTP/\S+ +([0-9]{3})", first)
                    when = f.get("warc-date")
                    rows.append(
                        {
                            "record_id": f.get("warc-record-id"),
                            "url": f.get("warc-target-uri", "").strip("<>") or None,
                            "ts": int(datetime.fromisoformat(when.replace("Z", "+00:00")).timestamp()) if when else None,
                            "kind": kind,
                            "status": int(status[1]) if status else None,
                            "headers": [*_fields(lines).items()],
                            "digest": f.get("warc-payload-digest"),
                            "profile": f.get("warc-profile"),
                            "refers_to": f.get("warc-refers-to"),
                            "payload": payload,
                        }
                    )
                    held += len(payload)
                    if held >= BATCH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    small_batches(spark)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def captures(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) as crawl records, by rules of page_id and html: each page is captured as a response
    at 10 * page_id (every 13th as a partial one), and revisited four times: before that, soon after with the same
    validators, later with other headers and validators (another entity tag where the page is of an even length, none
    where page_id ends in 7), and long after."""
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit("")).cast("binary")), 1, 12), F.lit('"'))
    size = F.length(F.coalesce("html", F.lit(""))).cast("string")
    day = F.concat(F.lit("day "), (F.col("page_id") % 365).cast("string"))
    response = F.struct(
        F.concat(F.lit("r"), F.col("page_id")).alias("record_id"), "url", (F.col("page_id") * 10).alias("ts"), F.lit("response").alias("kind"), F.when(F.col("page_id") % 13 == 0, 206).otherwise(200).alias("status"),
        F.create_map(F.lit("etag"), tag, F.lit("last-modified"), day, F.lit("content-length"), size, F.lit("content-type"), F.lit("text/html"), F.lit("date"), F.col("page_id").cast("string")).alias("headers"), F.lit(None).cast("string").alias("digest"),
    )

    def revisit(n: int, shift: int, etag: Column) -> Column:
        headers = F.map_filter(F.create_map(F.lit("etag"), etag, F.lit("content-length"), F.lit("0"), F.lit("date"), (F.col("page_id") + shift).cast("string"), F.lit("cache-control"), F.lit(f"max-age={n}")), lambda _, v: v.isNotNull())
        return F.struct(F.concat(F.lit(f"v{n}-"), F.col("page_id")).alias("record_id"), F.concat("url", F.lit(f"#{n}")).alias("url"), (F.col("page_id") * 10 + shift).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), headers.alias("headers"), F.lit(None).cast("string").alias("digest"))

    other = F.when(F.length("html") % 2 == 0, F.lit('"0"')).when(F.col("page_id") % 10 != 7, F.concat(F.lit("W/"), tag))
    rows = F.array(response, revisit(1, -1, tag), revisit(2, 1, tag), revisit(3, 25, other), revisit(4, 100_000, tag))
    return pages.select(F.inline(rows))


SHOWN = ["etag", "last-modified", "content-length", "content-type", "date", "cache-control"]


def shown(resolved: DataFrame) -> DataFrame:
    return resolved.select("record_id", "url_key", "ts", "base_id", "base_ts", "state", *(F.col("headers")[h].alias(h.replace("-", "_")) for h in SHOWN))


def oracle() -> str:
    """The rows of the query over pages, with an as-of join of DuckDB."""
    key = """case when regexp_matches(u, '^(?i)https?://') then
      lower(regexp_extract(u, '^([A-Za-z]+)://', 1)) || '://' || regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z]+://([^/?]*)', 1)), '\\.$', ''), case when lower(u) like 'http:%' then ':(80)?$' else ':(443)?$' end, '')
      || case when regexp_extract(u, '^[A-Za-z]+://[^/?]*([^?]*)', 1) = '' then '/' else regexp_extract(u, '^[A-Za-z]+://[^/?]*([^?]*)', 1) end
      || case when strpos(u, '?') > 0 and strpos(u, '?') < length(u) then '?' || array_to_string(list_sort(string_split(substr(u, strpos(u, '?') + 1), '&')), '&') else '' end else u end"""
    tag = "'\"' || substr(md5(coalesce(html, '')), 1, 12) || '\"'"
    other = f"""case when length(html) % 2 = 0 then '"0"' when page_id % 10 <> 7 then 'W/' || {tag} end"""
    visit = lambda n, shift, etag: f"select 'v{n}-' || page_id as record_id, k as url_key, page_id * 10 + {shift} as ts, {etag} as etag, (page_id + {shift})::VARCHAR as date, 'max-age={n}' as cache_control from p"
    return f"""
with p as (select *, {key} as k from (select *, regexp_replace(trim(url), '#.*$', '') as u from pages)),
v as ({' union all '.join((visit(1, -1, tag), visit(2, 1, tag), visit(3, 25, other), visit(4, 100000, tag)))}),
r as (select k, page_id * 10 as ts, max('r' || page_id) as id from p where page_id % 13 <> 0 group by k, page_id * 10),
f as (select k as rk, ts as base_ts, id as base_id, {tag} as b_etag, 'day ' || (page_id % 365) as b_last, length(coalesce(html, ''))::VARCHAR as b_size from r join (select k, page_id, html from p) using (k) where 'r' || page_id = id),
j as (select v.*, f.* from v asof left join f on v.url_key = f.rk and v.ts > f.base_ts),
s as (select *, case when base_id is null then 'no_base' when etag is null then 'unverified' when regexp_replace(etag, '^W/', '') <> b_etag then 'mismatch' else 'resolved' end as state from j)
select record_id, url_key, ts, base_id, base_ts, state, case when state in ('resolved', 'unverified') then coalesce(etag, b_etag) else etag end as etag,
  case when state in ('resolved', 'unverified') then b_last end as last_modified, case when state in ('resolved', 'unverified') then b_size else '0' end as content_length,
  case when state in ('resolved', 'unverified') then 'text/html' end as content_type, date, cache_control from s"""
