"""WARC archives: writing, reading back, and an external merge of capture indexes.

Archives are plain WARC/1.1 files, written by Spark's own text writer: a record ends with an empty line, which is the
writer's line separator, so any Hadoop file system and its commit protocol serve.  A payload of at least
``least`` bytes that several pages share is stored once, with the smallest page id; the others are revisit records.
Reading parses records by their content length, recomputes the digests of stored payloads, and emits one
capture run an archive, sorted by URL key and timestamp.  Runs are merged externally: a range exchange gives each
task a slice of the key range from every run, and a loser tree merges the k sorted slices, so the whole result is
globally ordered by (URL key, timestamp, page id).  The number of slices follows the number of captures, and archives have a
bounded size, so no task's memory grows with the input.

Defined results: null html is an empty payload; a null url has the empty URL key and no target header; rows with a
null page id are responses of their own; rows that repeat a page id are records of their own (several with the
smallest id of their payload are all responses); control characters and spaces in URLs are percent-encoded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table, scratch_path, shuffle_width

LEAST_BYTES = 100
#: Bytes of an archive, about (a page larger than that has an archive of its own).
ARCHIVE_BYTES = 32 << 20
#: Largest payloads of the size classes of pages but the last.
SIZE_CLASSES = (1 << 13, 1 << 17, 1 << 23)
#: Captures in a slice of the merge, about.
SLICE_ROWS = 100_000
FIRST_DATE = 1704067200
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def records(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int, chosen: Column | None = None) -> DataFrame:
    """(record): the text of each (chosen) record, without the empty line that ends it; equal payloads have one size, so one class."""
    pages = pages if chosen is None else pages.where(chosen)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"[\x00-\x20\x7F]", "%20").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumns({"n": F.octet_length("html").cast("long"), "digest": F.sha2(F.col("html").cast("binary"), 256)})
    shared = rows.where(F.col("n") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1 and first is not null")
    shared = materialise(shared.select("digest", "first"), "shared")
    joined = rows.join(shared, "digest", "left") if not shared.isEmpty() else rows.withColumn("first", F.lit(None).cast("long"))
    revisit = F.coalesce((F.col("n") >= least) & (F.col("id") > F.col("first")), F.lit(False))
    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, F.lit("")).otherwise(F.col("html")))
    date = F.date_format(F.timestamp_seconds(F.lit(FIRST_DATE) + F.pmod(F.coalesce("id", F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = F.coalesce(F.concat(F.lit("<urn:x-page:"), F.col("id").cast("string"), F.lit(">")), F.concat(F.lit("<urn:x-digest:"), F.col("digest"), F.lit(">")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\nWARC-Record-ID: "), name,
        F.when(F.col("url") != "", F.concat(F.lit("\r\nWARC-Target-URI: "), F.col("url"))).otherwise(""), F.lit("\r\nWARC-Date: "), date,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"), F.lit("\r\nX-Payload-Length: "), F.col("n").cast("string"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:x-page:"), F.col("first").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"),
    )
    return joined.select(F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_BYTES) -> None:
    """Write all pages as WARC files below ``path``."""
    n = F.coalesce(F.octet_length(F.col(html_col).cast("string")), F.lit(0))
    # pages are written by size class, so that an archive has a bounded number of bytes whatever pages follow one another
    edges = [-1, *SIZE_CLASSES]
    classes = [r[0] for r in pages.select(sum((n > e).cast("int") for e in SIZE_CLASSES).alias("c")).distinct().collect()]
    for k in classes or [0]:
        rows = records(pages, id_col, url_col, html_col, least, (n > edges[k]) & (n <= edges[k + 1]) if k + 1 < len(edges) else n > edges[k])
        per_file = ARCHIVE_BYTES // (edges[k + 1] + 700) if k + 1 < len(edges) else 1
        rows.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(f"{path}/class={k}")


def url_key(url: str) -> str:
    """Sort-friendly key: reversed host, then path and query, without scheme, user, port, leading www and fragment."""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host = rest[:cut].rsplit("@", 1)[-1].split(":", 1)[0].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (rest[cut:] or "/") if url else ""


def parse_archive(data: bytes) -> Iterator[dict]:
    """Captures of one archive, in file order; a broken record is an error."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        start, n = end + 4, int(head["Content-Length"])
        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:")
        length = int(head["X-Payload-Length"])
        if kind == "response":
            payload = memoryview(data)[data.index(b"\r\n\r\n", start) + 4 : start + n]
            if hashlib.sha256(payload).hexdigest() != digest or len(payload) != length:
                raise ValueError(f"the payload at byte {start} does not fit its digest")
        if data[start + n : start + n + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        name, refers = head["WARC-Record-ID"], head.get("WARC-Refers-To")
        yield {
            "url_key": url_key(head.get("WARC-Target-URI", "")), "timestamp": head["WARC-Date"], "url": head.get("WARC-Target-URI"),
            "page_id": int(name[12:-1]) if name.startswith("<urn:x-page:") else None, "record_type": kind, "payload_bytes": length,
            "payload_digest": digest, "refers_to": int(refers[12:-1]) if refers else None, "offset": at, "length": start + n + 4 - at,
        }
        at = start + n + 4


_FIELDS = {
    "url_key": pa.string(), "timestamp": pa.string(), "url": pa.string(), "page_id": pa.int64(), "record_type": pa.string(), "payload_bytes": pa.int64(),
    "payload_digest": pa.string(), "refers_to": pa.int64(), "offset": pa.int64(), "length": pa.int64(), "archive": pa.string(), "seq": pa.int64(),
}
RUN_SCHEMA = ", ".join(f"{k} {'string' if t == pa.string() else 'long'}" for k, t in _FIELDS.items())


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """One locally sorted run of captures an archive; ``seq`` is the place in the run."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path).select("path", "content")

    def read(batches):
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                run = sorted(parse_archive(content.as_py()), key=lambda r: (r["url_key"], r["timestamp"], -1 if r["page_id"] is None else r["page_id"], r["offset"]))
                for k, row in enumerate(run):
                    row |= {"archive": "/".join(name.as_py().rsplit("/", 2)[-2:]), "seq": k}
                if run:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in run], t) for k, t in _FIELDS.items()], names=list(_FIELDS))

    return files.mapInArrow(read, RUN_SCHEMA)


def loser_tree_merge(runs: list[list], key) -> Iterator:
    """Merge k sorted lists: each inner node keeps the loser of its match, so a row costs one path of log k matches."""
    k = len(runs)
    if k == 1:
        yield from runs[0]
        return
    at = [0] * k
    done = (1,)
    head = [(0, key(r[0])) if r else done for r in runs]
    losers = [-1] * k

    def settle(player: int) -> int:
        """Play from a leaf to the root; returns the winner (or -1 while the tree is being filled)."""
        node = (player + k) // 2
        while node:
            other = losers[node]
            if other == -1:
                losers[node] = player
                return -1
            if head[other] < head[player]:
                losers[node], player = player, other
            node //= 2
        return player

    winner = -1
    for i in range(k):
        winner = max(winner, settle(i)) if winner == -1 else winner
    while head[winner] != done:
        yield runs[winner][at[winner]]
        at[winner] += 1
        head[winner] = (0, key(runs[winner][at[winner]])) if at[winner] < len(runs[winner]) else done
        winner = settle(winner)


def merge_runs(runs: DataFrame) -> DataFrame:
    """All captures in global order of (URL key, timestamp, page id): ranges in order, each merged by a loser tree.

    A slice has about ``SLICE_ROWS`` captures, so memory does not follow the input; ties are cut by archive and place.
    """
    n = max(1, shuffle_width(runs.sparkSession), -(-runs.count() // SLICE_ROWS))
    key = ["url_key", "timestamp", F.coalesce("page_id", F.lit(-1)), "archive", "seq"]
    # each run's part of a slice comes in its own order
    dealt = runs.repartitionByRange(n, *key).sortWithinPartitions("archive", "seq")
    at = [list(_FIELDS).index(k) for k in ("url_key", "timestamp", "page_id", "archive", "seq")]

    def order(row):
        key, stamp, page, archive, seq = (row[k] for k in at)
        return key, stamp, -1 if page is None else page, archive, seq

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _FIELDS.values(), strict=True)], names=list(_FIELDS))

    def merge(batches):
        slices: list[list[tuple]] = []
        last = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[at[3]] != last:
                    slices.append([])
                    last = row[at[3]]
                slices[-1].append(row)
        out = []
        for row in loser_tree_merge(slices, order) if slices else ():
            out.append(row)
            if len(out) == 10_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    return dealt.select(*_FIELDS).mapInArrow(merge, RUN_SCHEMA)


def archive_history(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """Write the archives, read them back, and return the merged capture history."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, html_col, least)
    return merge_runs(materialise(capture_runs(spark, path), "runs"))


def op5_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_history(read_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(CASE WHEN n >= 100 THEN page_id END) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM f"""
