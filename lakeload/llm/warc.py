"""WARC archives: pages written as captures, and captures put together from their records.

A capture is a transaction: a request, a response (or a revisit of an equal one), and
metadata. Each is a record of its own, and the records of a capture name each other in
``WARC-Concurrent-To``. They may lie anywhere in the archives, so reading joins them by that
name and gives one nested row for each capture.

Archives are written and read by Spark's text source, which takes any file system, commits
whole files and streams. What separates its "lines" is how a record starts: ``WARC/1.`` on a
new line. Payloads that hold such a line are sent in chunks, a transfer coding of HTTP, cut
inside it. (The empty line before a record is left out of the separator: a separator that
may begin anew inside itself is lost where two splits of a file meet.)
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, join_groups, saved

# Fixed values of the format.
MAGIC = "WARC/1."
VERSION = "WARC/1.1"
BREAK = "\r\n"
BLANK = BREAK + BREAK
START = "\n" + MAGIC  # of every record but a file's first
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
MAIN_TYPES = ("response", "revisit", "resource", "conversion")
OTHER_TYPES = ("request", "metadata")

DATE = "1970-01-01T00:00:00Z"
COPIES_AT_ONCE = 1000  # equal rows that one row is unfolded into before they are dealt out


# --- writing ------------------------------------------------------------------------


def base32(digest: Column) -> Column:
    """Base 32 of a SHA-1 in hexadecimal: 10 digits of it are 8 of the result, in other letters."""
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def payload_digest(payload: Column) -> Column:
    return base32(F.sha1(payload))


def _record_id(kind: str, page_id: Column, url: Column, content: Column, copy: Column) -> Column:
    """A name that depends on the capture alone, so a task that runs again writes the same."""
    parts = [page_id.cast("string"), F.sha2(url, 256), content, copy.cast("string")]
    digest = F.sha2(F.concat_ws(":", F.lit(kind), *[F.coalesce(p, F.lit("-")) for p in parts]), 256)
    groups = [F.substring(digest, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def _header(url: Column) -> Column:
    """The URL as a header may hold it; one with blanks or control characters percent-encoded."""
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), F.url_encode(url)).otherwise(url)


def _chunked(payload: Column) -> Column:
    """The payload in chunks, none of which holds the text that starts a record."""
    parts = F.split(payload, re.escape(MAGIC))

    def chunk(part: Column, place: Column) -> Column:
        before = F.when(place > 0, F.lit(MAGIC[2:])).otherwise(F.lit(""))
        after = F.when(place < F.size(parts) - 1, F.lit(MAGIC[:2])).otherwise(F.lit(""))
        whole = F.concat(before, part, after)
        return F.concat(F.lower(F.hex(F.octet_length(whole).cast("long"))), F.lit(BREAK), whole, F.lit(BREAK))

    return F.concat(F.array_join(F.transform(parts, chunk), ""), F.lit(f"0{BLANK}"))


def _record(headers: dict[str, Column | str], block: Column) -> Column:
    """A record but for the empty line that ends it. Headers that are null are left out."""
    lines = [F.lit(VERSION)]
    for name, value in {**headers, "Content-Length": F.octet_length(block).cast("string")}.items():
        lines.append(F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value))
    return F.concat(F.concat_ws(BREAK, *lines), F.lit(BLANK), block)


def _transaction(captures: DataFrame, kind: str, block: Column, date: str, more: dict[str, Column | str]) -> DataFrame:
    """The three records of each capture (page_id, url, content, copy, sha1), a row each."""
    page_id, url = F.col("page_id"), F.col("url")
    own = [page_id, url, F.col("content"), F.col("copy")]
    main = _record_id("main", *own)
    common = {"WARC-Date": date, "WARC-Target-URI": _header(url)}
    http = "application/http; msgtype="
    uri = F.coalesce(_header(url), F.lit(""))
    host = F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    path = F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    path = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    asked = F.concat(F.lit("GET "), path, F.lit(f" HTTP/1.1{BREAK}Host: "), host, F.lit(BLANK))
    about = F.coalesce(F.concat(F.lit("page_id: "), page_id.cast("string"), F.lit(BREAK)), F.lit(""))
    digest = F.concat(F.lit("sha1:"), F.col("sha1"))
    records = F.array(
        _record(
            {"WARC-Type": kind, "WARC-Record-ID": main, **common, **more, "WARC-Payload-Digest": digest,
             "Content-Type": f"{http}response"}, block,
        ),
        _record(
            {"WARC-Type": "request", "WARC-Record-ID": _record_id("request", *own), **common,
             "WARC-Concurrent-To": main, "Content-Type": f"{http}request"}, asked,
        ),
        _record(
            {"WARC-Type": "metadata", "WARC-Record-ID": _record_id("metadata", *own), **common,
             "WARC-Concurrent-To": main, "Content-Type": "application/warc-fields"}, about,
        ),
    )
    return captures.select(F.explode(records).alias("value"))


def _copies(rows: DataFrame) -> DataFrame:
    """Each row as often as ``rows`` says, numbered in ``copy`` from 0.

    A row with very many copies becomes some rows first, which are dealt out.
    """
    last = F.col("rows") - 1
    few = rows.where(F.col("rows") <= COPIES_AT_ONCE).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    many = rows.where(F.col("rows") > COPIES_AT_ONCE)
    step = F.lit(COPIES_AT_ONCE).cast("long")
    many = many.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), last, step)))
    many = many.repartition("page_id", "content", "start")
    upto = F.least(F.col("start") + step - 1, last)
    return few.unionByName(many.withColumn("copy", F.explode(F.sequence("start", upto))).drop("start"))


def write_archives(pages: DataFrame, path: str, date: str = DATE, compression: str = "gzip") -> None:
    """Write a capture for each row of ``pages`` (page_id, url, html) below ``path``.

    The payload is the html in UTF-8, none for null. Of captures with equal payloads one is
    the response, the others are revisits that refer to it: the response is that of the
    largest page_id, where no id is less than any (then of the largest url; of rows equal in
    all three it is one of them). Each distinct payload is shuffled and written once, however
    many rows hold it; rows equal in all three columns meet as a count. Payloads may be as long as a
    string. Other columns are ignored. An empty table writes archives without records.

    A file is one gzip stream, not one for each record.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html")).withColumn("content", F.sha2("html", 256))
    key = F.struct("page_id", "url")
    top = [F.col("top.page_id"), F.col("top.url")]
    status = f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"

    def sized(size: Column) -> Column:
        return F.concat(F.lit(f"{status}Content-Length: "), size.cast("string"), F.lit(BLANK))

    payload = F.col("html")
    first = keyed.groupBy("content").agg(F.max(key).alias("top"), F.any_value("html").alias("html"))
    first = first.select(
        *top, "content", "html", F.lit(0).cast("long").alias("copy"), payload_digest(payload).alias("sha1")
    )
    breaks = F.concat(F.lit(START[:1]), payload).contains(START)
    coded = F.concat(F.lit(f"{status}Transfer-Encoding: chunked{BLANK}"), _chunked(payload))
    block = F.when(breaks, coded).otherwise(F.concat(sized(F.octet_length(payload)), payload))
    written = _transaction(first, "response", block, date, {})

    # What the other captures need is narrow; their payloads stay behind.
    facts = [F.octet_length("html").cast("long").alias("size"), payload_digest(payload).alias("sha1")]
    narrow = keyed.select("page_id", "url", "content", *facts)
    equal = saved(
        narrow.groupBy("page_id", "url", "content").agg(
            F.count(F.lit(1)).alias("rows"), F.any_value("size").alias("size"), F.any_value("sha1").alias("sha1")
        ),
        "pages",
    )
    groups = equal.groupBy("content").agg(
        F.max(key).alias("top"), F.count(F.lit(1)).alias("members"), F.sum("rows").alias("captures")
    )
    repeated = saved(groups.where("captures > 1"), "repeated-pages")
    members = _copies(join_groups(equal, repeated, "content", "members", equal.row_count))
    is_response = key.eqNullSafe(F.col("top")) & (F.col("copy") == 0)
    more = {
        "WARC-Profile": PROFILE,
        "WARC-Refers-To": _record_id("main", *top, F.col("content"), F.lit(0)),
        "WARC-Refers-To-Target-URI": _header(top[1]),
        "WARC-Refers-To-Date": date,
    }
    visited = _transaction(members.where(~is_response), "revisit", sized(F.col("size")), date, more)
    archives = written.unionByName(visited).write.option("lineSep", BLANK).option("compression", compression)
    archives.option("zlib.compress.level", "BEST_SPEED").text(path)


# --- reading ------------------------------------------------------------------------


def _after(text: str, head: str) -> Column:
    """The bytes behind ``head`` and the empty line that ends it."""
    size = F.octet_length(text)
    return F.substring(F.col(text).cast("binary"), F.octet_length(head) + len(BLANK) + 1, size)


def dechunked(body: bytes) -> bytes:
    """The payload of a body in chunks; of a broken one, what was whole."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        digits = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", digits) or not (size := int(digits, 16)):
            break
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size
    return b"".join(out)


def _joined_chunks(bodies: Column) -> Column:
    """The payloads of bodies in chunks, null for null."""

    @F.pandas_udf("binary")
    def join(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda body: None if body is None else dechunked(bytes(body)))

    return join(bodies)


def _fields(block: Column) -> Column:
    """(name, value) of each ``name: value`` line."""
    lines = F.filter(F.split(block.cast("string"), "\r?\n"), lambda line: F.instr(line, ":") > 0)
    return F.transform(
        lines,
        lambda line: F.struct(
            F.trim(F.substring_index(line, ":", 1)).alias("name"),
            F.trim(F.substring(line, F.instr(line, ":") + 1, F.length(line))).alias("value"),
        ),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives below ``path``.

    record_id, type, target_uri, date, concurrent_to (array), refers_to, declared_digest (bare),
    whole, block, http_head and payload. Names of headers may be in any case. ``block`` is
    as long as Content-Length says; ``whole`` is false where the archive ends, or a record of
    another writer holds the start of a record, before that. ``payload`` is the body of an HTTP
    message, its chunks joined, or the block of other records. A record without an id is named by
    its content. Text before the first record is no record. Archives may be compressed; those that are not are split over tasks.
    """
    lines = spark.read.option("lineSep", START).text(path)
    first = F.col("value").startswith(MAGIC)
    text = F.when(first, F.substring("value", F.lit(len(MAGIC) + 1), F.length("value"))).otherwise(F.col("value"))
    starts = lines.select(text.alias("text")).where(F.substring("text", 1, 20).rlike(r"\A[0-9]+\r\n"))
    parsed = starts.withColumn("head", F.substring_index("text", BLANK, 1)).withColumn("headers", _fields(F.col("head")))

    def values(name: str) -> Column:
        same = F.filter("headers", lambda h: F.lower(h["name"]) == name.lower())
        return F.transform(same, lambda h: h["value"])

    def header(name: str) -> Column:
        found = F.get(values(name), F.lit(0))
        return F.when(found != "", found)

    length = F.coalesce(header("Content-Length").try_cast("long"), F.lit(0).cast("long"))
    fields = parsed.select(
        F.coalesce(header("WARC-Record-ID"), F.concat(F.lit("sha256:"), F.sha2("text", 256))).alias("record_id"),
        F.lower(header("WARC-Type")).alias("type"),
        header("WARC-Target-URI").alias("target_uri"),
        header("WARC-Date").alias("date"),
        values("WARC-Concurrent-To").alias("concurrent_to"),
        header("WARC-Refers-To").alias("refers_to"),
        F.substring_index(header("WARC-Payload-Digest"), ":", -1).alias("declared_digest"),
        F.coalesce(header("Content-Type").startswith("application/http"), F.lit(False)).alias("http"),
        length.alias("length"),
        _after("text", "head").alias("rest"),
    )
    cut = fields.select(
        *[c for c in fields.columns if c not in ("length", "rest")],
        (F.octet_length("rest") >= F.col("length")).alias("whole"),
        F.expr("substring(rest, 1, cast(length as int))").alias("block"),
    )
    text = cut.withColumn("message", F.when(F.col("http"), F.col("block").cast("string")))
    split = text.withColumn("http_head", F.substring_index("message", BLANK, 1)).withColumn(
        "body", F.when(F.col("http"), _after("message", "http_head")).otherwise(F.col("block"))
    )
    chunked = F.col("http") & F.col("http_head").rlike(r"(?im)^Transfer-Encoding:[ \t]*chunked")
    joined = split.withColumn("joined", _joined_chunks(F.when(chunked, F.col("body"))))
    return joined.select(
        "record_id", "type", "target_uri", "date", "concurrent_to", "refers_to", "declared_digest", "whole",
        "block", "http_head", F.coalesce("joined", "body").alias("payload"),
    )


def _owners(links: DataFrame, lost: DataFrame) -> DataFrame:
    """(record_id, capture_id) of requests and metadata that name no main record.

    The main record names them, or they name each other: all names link records, and they belong
    to the least main record they are linked with.
    """
    edges = links.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    parts = saved(components(edges), "transactions").withColumnRenamed("id", "record_id")
    least = links.where("is_main").select("record_id").join(parts, "record_id").groupBy("component")
    least = least.agg(F.min("record_id").alias("main_id"))
    found = lost.join(parts, "record_id", "left").withColumn("component", F.coalesce("component", "record_id"))
    return found.join(least, "component", "left").select("record_id", F.coalesce("main_id", "component").alias("capture_id"))


def captures(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One nested row for each capture of ``read_records``.

    capture_id, type, target_uri, date, refers_to, main (declared_digest, payload_digest,
    payload_bytes, whole, http_head, and the payload unless ``payloads`` is false), requests (record_id,
    http_head), metadata (record_id, fields). capture_id is the name of the main record: a
    response, revisit, resource or conversion. Records of one name are one record, so archives
    read twice count once. Requests and metadata without a main record make a capture whose
    main part is null. Other kinds of records, such as warcinfo, belong to no capture. Without
    records there are no captures.
    """
    is_main = F.col("type").isin(*MAIN_TYPES)
    payload = F.when(is_main, F.col("payload"))
    measures = [
        payload_digest(payload).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    ]
    main = F.struct(
        "type", "target_uri", "date", "refers_to",
        F.struct("declared_digest", *measures, "whole", "http_head", *(["payload"] if payloads else [])).alias("main"),
    )
    beside = F.struct("type", "record_id", "http_head", F.when(F.col("type") == "metadata", _fields(F.col("block"))).alias("fields"))
    stored = saved(
        records.where(F.col("type").isin(*MAIN_TYPES, *OTHER_TYPES)).select(
            "record_id", "concurrent_to", is_main.alias("is_main"),
            F.when(is_main, main).alias("main"), F.when(~is_main, beside).alias("beside"),
        ),
        "records",
    )
    # A record stands with the main record it names, all of which takes one exchange.
    named = F.when(F.col("is_main") | (F.size("concurrent_to") == 0), F.array("record_id")).otherwise(F.col("concurrent_to"))
    together = saved(_together(stored.withColumn("capture_id", F.explode(named))), "captures")
    alone = together.where("main IS NULL").select(F.explode("beside.record_id").alias("record_id"))
    placed = together.where("main IS NOT NULL").select(F.explode("beside.record_id").alias("record_id"))
    lost = saved(alone.distinct().join(placed, "record_id", "left_anti"), "lost-records")
    if lost.row_count:
        owners = _owners(stored.select("record_id", "concurrent_to", "is_main"), lost)
        of_lost = stored.where("NOT is_main").join(owners, "record_id")
        of_main = together.where("main IS NOT NULL").select(
            "capture_id", "main", F.explode_outer("beside").alias("beside")
        )
        together = _together(of_main.unionByName(of_lost.select("capture_id", "main", "beside")))
    else:
        together = together.where("main IS NOT NULL")
    own = lambda kind, *columns: F.transform(
        F.filter("beside", lambda b: b["type"] == kind), lambda b: F.struct(*[b[c].alias(c) for c in ("record_id", *columns)])
    )
    return together.select(
        "capture_id", *[F.col(f"main.{c}").alias(c) for c in ("type", "target_uri", "date", "refers_to", "main")],
        own("request", "http_head").alias("requests"), own("metadata", "fields").alias("metadata"),
    )


def _together(rows: DataFrame) -> DataFrame:
    """A row for each capture_id; a capture's own records are one row by their nature."""
    return rows.groupBy("capture_id").agg(
        F.any_value("main", F.lit(True)).alias("main"), F.array_sort(F.collect_set("beside")).alias("beside")
    )


def page_captures(found: DataFrame) -> DataFrame:
    """What ``write_archives`` wrote, from ``captures``: one row for each page.

    page_id, payload_bytes, payload_digest, record_type and refers_to (a page_id). A revisit
    has its response's payload; if that is missing from the archives its size is null. A page without an id has
    null. The digest of a response is that of the payload as read.
    """
    fields = F.flatten(F.transform("metadata", lambda m: m["fields"]))
    page_id = F.get(F.filter(fields, lambda f: f["name"] == "page_id"), F.lit(0))["value"].try_cast("long")
    rows = saved(
        found.where(F.col("type").isin("response", "revisit")).select(
            "capture_id", "type", "refers_to", page_id.alias("page_id"),
            F.col("main.payload_bytes").alias("bytes"), F.col("main.payload_digest").alias("read"),
            F.col("main.declared_digest").alias("declared"),
        ),
        "captures",
    )
    responses, revisits = rows.where("type = 'response'"), rows.where("type = 'revisit'")
    members = revisits.groupBy("refers_to").agg(F.count(F.lit(1)).alias("members"))
    facts = responses.select(
        F.col("capture_id").alias("refers_to"), F.col("page_id").alias("of_page"), F.col("bytes").alias("of_bytes")
    )
    groups = saved(facts.join(members, "refers_to"), "revisited")
    seen = join_groups(
        revisits.select("refers_to", "page_id", "declared"), groups, "refers_to", "members", rows.row_count, "left"
    )
    null = F.lit(None).cast("long")
    first = responses.select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("read").alias("payload_digest"),
        F.col("type").alias("record_type"), null.alias("refers_to"),
    )
    again = seen.select(
        "page_id", F.col("of_bytes").alias("payload_bytes"), F.col("declared").alias("payload_digest"),
        F.lit("revisit").alias("record_type"), F.col("of_page").alias("refers_to"),
    )
    return first.unionByName(again)
