"""WARC archives: write with payload dedup, read back, and merge the capture index.

Writing: records with equal payloads (by SHA-1 and length) are one group; the
one with the smallest id is a ``response`` with the payload, the others are
``revisit`` records that name it. Spark's text writer stores one record after
another, with the record terminator as its line separator, so files land in
any store that Spark writes to.

Reading: files come back as bytes and are parsed by their headers and
``Content-Length``. Each file gives one capture run, sorted by (URL key,
timestamp, id).

External index merge: runs are cut at common range splitters of that key;
a task gets the pieces of all runs for its range and merges them with a loser
tree of k leaves, which replays one path of log2(k) matches for each record
and yields the globally ordered capture history.
"""
from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise, shared_path

FILE_BYTES = 16 << 20           # bytes of an archive file, before compression; a longer record is a file of its own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"      # fixed value of the format
MERGE_ROWS = 100_000            # index rows that one task merges in memory
BROADCAST_ROWS = 200_000        # rows of about 60 bytes that may be broadcast
TERMINATOR = "\r\n\r\n"
START_OF_TIME = 1_577_836_800   # 2020-01-01: capture time of id 0, for tables without a capture time


def payload_digest(payload: Column) -> Column:
    """SHA-1 of UTF-8 bytes in upper-case base32, from the hex digest's 8 groups of 20 bits."""
    hexed = F.sha1(payload.cast("binary"))
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    bits = lambda i: F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int")                  # noqa: E731
    letter = lambda i, shift: F.substring(letters, (F.shiftright(bits(i), shift).bitwiseAND(F.lit(31)) + 1), F.lit(1))
    return F.concat(*[letter(i, shift) for i in range(8) for shift in (15, 10, 5, 0)])


def url_key(url: Column) -> Column:
    """Sort-friendly key: reversed host labels, ``)``, then path and query; the url itself without ``://``."""
    rest = F.regexp_extract(url, r"^[^:/?#]*://([^#]*)", 1)
    host = F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))
    tail = F.regexp_extract(rest, r"^[^/?]*(.*)$", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail)
    return F.coalesce(F.when(F.contains(url, F.lit("://")), key).otherwise(url), F.lit(""))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload (empty for revisits), bytes, digest, type, refers_to of every row.

    A null payload is empty. Payloads shorter than ``min_bytes`` are always
    responses. Ids should be unique; where an id repeats, the rows of a
    group's smallest id are all responses. A group of rows without ids has no
    first record and stays responses."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": payload_digest(F.col("payload"))})
    # one row for each payload that occurs again, combined before the shuffle. Few of them are broadcast, so that
    # payloads do not move; else a hot payload's rows are split by adaptive execution
    first = (pages.select(F.col(id_col).cast("long").alias("page_id"), payload.alias("payload"))
             .groupBy(payload_digest(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
             .filter((F.col("copies") > 1) & (F.col("bytes") >= min_bytes)).select("digest", "bytes", "first"))
    first = materialise(first, "warc-first")
    if first.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (rows.join(first, ["digest", "bytes"], "left")
            .select("page_id", "url", F.when(revisit, F.lit("")).otherwise(F.col("payload")).alias("payload"), "bytes", "digest",
                    F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("type"),
                    F.when(revisit, F.col("first")).alias("refers_to")))


def _header_value(c: Column) -> Column:
    """A header holds no line break: percent signs and breaks are percent-encoded."""
    return F.replace(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def capture_time(page_id: Column) -> Column:
    """Capture seconds of a table without capture times: they follow the id."""
    return F.lit(START_OF_TIME) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1_000_000_000))


def in_files(found: DataFrame, size_col: str, file_bytes: int) -> DataFrame:
    """``found`` with ``file``: a number that rises within a task whenever ``file_bytes`` are full. Nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, filled = 0, 0
        for batch in batches:
            files = np.empty(batch.num_rows, np.int64)
            for i, size in enumerate(batch.column(size_col).to_pylist()):
                if filled and filled + size > file_bytes:
                    number, filled = number + 1, 0
                filled += size
                files[i] = number
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(files)], names=[*batch.schema.names, "file"])

    return found.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in found.dtypes) + ", file long")


def write(found: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write the records of ``found`` as WARC files under ``path``: each task its own, cut by bytes, so that a run of
    large pages makes many files and none that a reader cannot hold. Nothing is shuffled for it."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "type"),
             F.concat(F.lit("WARC-Date: "), F.date_format(F.timestamp_seconds(capture_time(F.col("page_id"))), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
             F.concat(F.lit("WARC-Record-ID: <urn:"), F.coalesce(F.concat(F.lit("page:"), F.col("page_id").cast("string")),
                                                               F.concat(F.lit("uuid:"), F.uuid())), F.lit(">")),
             F.when(F.col("type") == "revisit", F.lit(f"WARC-Profile: {PROFILE}")),
             F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), _header_value(F.col("url")))),
             F.concat(F.lit("WARC-URL-Key: "), _header_value(url_key(F.col("url")))),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
             F.concat(F.lit("WARC-Payload-Length: "), F.col("bytes").cast("string")),
             F.when(F.col("refers_to").isNotNull(), F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
             F.concat(F.lit("Content-Length: "), F.octet_length("payload").cast("string"))]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit(TERMINATOR), F.col("payload"))
    sized = found.select(record.alias("record")).withColumn("size", F.octet_length("record"))
    (in_files(sized, "size", file_bytes).select("record", "file").write.partitionBy("file")
     .option("lineSep", TERMINATOR).option("compression", "gzip").text(path))


def parse(data: bytes) -> Iterator[tuple[dict, bytes, int]]:
    """Headers, block and offset of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:end].decode("utf-8").split("\r\n")[1:])
        start = end + 4
        stop = start + int(head["Content-Length"])
        yield head, data[start:stop], at
        at = stop + 4


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:"):-1]) if urn and urn.startswith("<urn:page:") else None


RUN_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "url_key string, ts string, run string, offset long")


def read_runs(spark, path: str) -> DataFrame:
    """One sorted run of captures for each archive under ``path``.

    A response's length and digest are taken from its payload (a digest that
    contradicts the header is an error); a revisit's from its header."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                data = zlib.decompress(content, 31) if content[:2] == b"\x1f\x8b" else content
                rows = []
                for head, block, at in parse(data):
                    digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["WARC-Payload-Length"])
                    if head["WARC-Type"] == "response":
                        size = len(block)
                        if digest != base32_sha1(block):
                            raise ValueError(f"{name}: the record at {at} has another payload than its digest says")
                    rows.append((_page(head.get("WARC-Record-ID")), size, digest, head["WARC-Type"], _page(head.get("WARC-Refers-To")),
                                 head["WARC-URL-Key"], head["WARC-Date"], name, at))
                rows.sort(key=lambda r: (r[5], r[6], r[0] is not None, r[0], r[8]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 9, _RUN_TYPES)], names=_RUN_NAMES)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, RUN_SCHEMA)


_RUN_NAMES = [x.split()[0] for x in RUN_SCHEMA.split(", ")]
_RUN_TYPES = [pa.int64() if x.split()[1] == "long" else pa.string() for x in RUN_SCHEMA.split(", ")]


class LoserTree:
    """k-way merge of sorted sequences: inner nodes keep the loser of their match, the root the winner."""

    def __init__(self, runs: list[list]):
        self.runs, self.k = runs, max(1, len(runs))
        self.at = [0] * len(runs)
        self.losers = [-1] * self.k
        self.winner = self._build(1) if runs else -1

    def _less(self, a: int, b: int) -> bool:
        if a < 0 or self.at[a] >= len(self.runs[a]):
            return False
        if b < 0 or self.at[b] >= len(self.runs[b]):
            return True
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or x == y and a < b

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        left, right = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (left, right) if self._less(left, right) else (right, left)
        self.losers[node] = lose
        return win

    def __iter__(self):
        """(run, position in it) in merged order."""
        w = self.winner
        while w >= 0 and self.at[w] < len(self.runs[w]):
            yield w, self.at[w]
            self.at[w] += 1
            node = (w + self.k) // 2
            while node:
                if self._less(self.losers[node], w):
                    w, self.losers[node] = self.losers[node], w
                node //= 2


def merge_runs(runs: DataFrame, partitions: int) -> DataFrame:
    """Rows of all runs in global (url_key, ts, page_id) order, with ``part`` and ``pos``: their place in it.

    Range splitters hold url, time, id and place, so one URL with very many
    captures spreads over tasks. Within a task, rows lie by run, and a loser
    tree merges the runs."""
    key = ["url_key", "ts", "page_id", "run", "offset"]
    dealt = (runs.repartitionByRange(partitions, *key).withColumn("part", F.spark_partition_id())
             .sortWithinPartitions("run", *key[:3], "offset"))
    columns = _RUN_NAMES + ["part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)                    # one range: total rows / partitions, keys and digests only
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        names = table.column("run").to_pylist()
        keys = list(zip(table.column("url_key").to_pylist(), table.column("ts").to_pylist(),
                        [(x is not None, x or 0) for x in table.column("page_id").to_pylist()], table.column("offset").to_pylist()))
        starts = [i for i in range(len(names)) if not i or names[i] != names[i - 1]]
        tree = LoserTree([keys[a:b] for a, b in zip(starts, [*starts[1:], len(names)])])
        order = np.fromiter((starts[r] + i for r, i in tree), np.int64, len(names))
        merged = table.take(pa.array(order)).append_column("pos", pa.array(np.arange(len(order))))
        yield from merged.to_batches(max_chunksize=10_000)

    return dealt.select(*columns).mapInArrow(run, RUN_SCHEMA + ", part int, pos long")


def archive_and_index(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as WARC files under ``path``, read them back and return the merged capture index.

    Every row of ``pages`` gives one row: its id, the payload's length and
    digest, the record type, the response that a revisit refers to, URL key,
    time, archive (run), offset, and place in the order (part, pos). Null
    urls have an empty key. Extra columns are ignored; an empty table gives
    an empty index."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    found = records(pages, **options)
    write(found, path)
    runs = materialise(read_runs(spark, path), "warc-runs")
    return merge_runs(runs, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // MERGE_ROWS)))


def digest_query(pages: DataFrame) -> DataFrame:
    return archive_and_index(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (
  SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((CAST('0x' || substr(sha1(h), 5 * (j // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31) + 1, 1)), '') AS payload_digest
  FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
