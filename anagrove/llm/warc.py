"""WARC archives and an external merge of their indexes.

``write`` stores one record per page: of payloads that are equal and not small,
the page with the largest id is a response and the others revisit it. ``read``
parses the archives back and checks digests; each archive gives a run of index
entries, sorted locally by URL key and time. ``merge`` deals the runs out by key
ranges, and each task merges its parts of the runs with a loser tree, which gives
capture histories in global order.

Archives are gzip files of one member. They are written and read by Spark alone,
so any store that Spark reaches will do.

Defined cases: null payloads and URLs count as empty, null dates as 1970; line
ends in URLs become spaces; a page without an id is a revisit of an equal one, or
a response; repeated rows are records of their own; other columns are ignored;
empty tables give no records.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anagrove.session import materialise, scratch_path

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
RANGE_ROWS = 65_536
NO_ID = "none"

INDEX_SCHEMA = (
    "url_key string, captured string, page_id long, archive string, position long, record_offset long, "
    "record_length long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)
INDEX_FIELDS = [f.split(" ")[0] for f in INDEX_SCHEMA.split(", ")]


def url_key(url: str) -> str:
    """Sortable form of a URL: host labels reversed, then path and query."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return url
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/").lower() + query


def with_record_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Add ``digest``, ``bytes`` and ``refers_to``, the page that a revisit stands for."""
    sized = pages.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn("bytes", F.octet_length("payload"))
    shared = (
        sized.filter(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    revisits = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return sized.join(shared, "digest", "left").withColumn("refers_to", F.when(revisits, F.col("keeper"))).drop("keeper")


def write(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date_col: str = "captured",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> None:
    """Write a WARC record per page into gzip archives below ``path``."""
    named = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\r\n]", " ").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
        F.coalesce(F.col(date_col), F.timestamp_seconds(F.lit(0))).alias("captured"),
    )
    size = named.agg(F.sum(F.octet_length("payload").cast("long")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    per_archive = max(1, ARCHIVE_BYTES * size.n // max(1, size.bytes or 0))
    typed = with_record_types(named, min_bytes)
    is_revisit = F.col("refers_to").isNotNull()

    def urn(number: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(number.cast("string"), F.lit(NO_ID)), F.lit(">"))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(is_revisit, "").otherwise(F.col("payload")))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(is_revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Date: "), F.date_format(F.to_utc_timestamp("captured", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(is_revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(is_revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)
    # The text writer ends each row with the two line ends that end a record.
    ends = {"lineSep": "\r\n\r\n", "compression": "gzip", "maxRecordsPerFile": per_archive}
    typed.select(record).write.options(**ends).text(path)


def _number(urn: str) -> int | None:
    value = urn.strip("<>").rpartition(":")[2]
    return None if value == NO_ID else int(value)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Headers, block, offset and length of each record of an archive's bytes."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:head].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        end = head + 4 + int(headers["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} isn't ended")
        yield headers, data[head + 4 : end], at, end - at
        at = end + 4


def _entries(path: str, content: bytes) -> list[tuple]:
    out = []
    for headers, block, offset, length in records(gzip.decompress(content)):
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = headers["WARC-Type"] == "revisit"
        if not revisit and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {headers['WARC-Record-ID']} in {path} is damaged")
        size = int(http.rpartition(b"Content-Length: ")[2])
        key, date = url_key(headers["WARC-Target-URI"]), headers["WARC-Date"]
        refers = _number(headers["WARC-Refers-To"]) if revisit else None
        out.append((key, date, _number(headers["WARC-Record-ID"]), path, 0, offset, length, size, digest, headers["WARC-Type"], refers))
    return sorted(out, key=_order)


def _order(entry: tuple) -> tuple:
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[3], entry[5]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    longs = {"page_id", "position", "record_offset", "record_length", "payload_bytes", "refers_to"}
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, pa.int64() if f in longs else pa.string()) for f, c in zip(INDEX_FIELDS, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=INDEX_FIELDS)


def read(spark, path: str) -> DataFrame:
    """Index entries of all archives; each archive's are a run, in order of ``position``."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                found = _entries(name.as_py(), content.as_py())
                if found:
                    yield _batch([(*e[:4], i, *e[5:]) for i, e in enumerate(found)])

    return files.mapInArrow(run, INDEX_SCHEMA)


class LoserTree:
    """Merges sorted runs; each inner node keeps the loser of its match.

    After a winner leaves, its run's next entry plays the matches on one path
    from its leaf to the root, a comparison per level.
    """

    def __init__(self, runs: list[list], key: Callable[[tuple], tuple]):
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.heads = [self._head(r) for r in range(len(runs))]
        self.losers = [-1] * max(1, len(runs))
        self.winner = self._play(1)

    def _head(self, run: int) -> tuple:
        rows = self.runs[run]
        at = self.at[run]
        return (0, self.key(rows[at]), run) if at < len(rows) else (1, (), run)

    def _play(self, node: int) -> int:
        """Winner of the matches below a node; leaves are numbered from len(runs)."""
        if node >= len(self.runs):
            return node - len(self.runs)
        one, two = self._play(2 * node), self._play(2 * node + 1)
        if self.heads[two] < self.heads[one]:
            one, two = two, one
        self.losers[node] = two
        return one

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.winner][0] == 0:
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self.heads[run] = self._head(run)
            node = (run + len(self.runs)) // 2
            while node:
                rival = self.losers[node]
                if self.heads[rival] < self.heads[run]:
                    self.losers[node], run = run, rival
                node //= 2
            self.winner = run


def merge(entries: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All runs as one index: partitions hold ascending ranges, each in order.

    ``entries`` must be written. Ranges are cut by URL key, time and page, so a
    URL with many captures is cut as well. ``position`` becomes the place within
    the range, ``range`` the range's number.
    """
    ranges = max(1, -(-entries.count() // range_rows))
    keys = ["url_key", "captured", "page_id", "archive", "record_offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        table = table.sort_by([("archive", "ascending"), ("position", "ascending")])  # gathers the runs' parts
        rows = list(zip(*[c.to_pylist() for c in table.select(INDEX_FIELDS).columns], strict=True))
        archive = table.column("archive").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(archive[1:] != archive[:-1]) + 1).tolist(), len(rows)]
        runs = [rows[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        merged = [(*e[:4], i, *e[5:]) for i, e in enumerate(LoserTree(runs, _order))]
        for at in range(0, len(merged), 10_000):
            yield _batch(merged[at : at + 10_000])

    return entries.repartitionByRange(ranges, *keys).mapInArrow(run, INDEX_SCHEMA).withColumn("range", F.spark_partition_id())


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write pages into archives, read them back and merge their indexes."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archives")
    write(pages, path, **options)
    return merge(materialise(read(spark, path)))
