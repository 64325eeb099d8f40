"""WARC archives of web pages, and the capture index over them.

Records are built by expressions and written by the text writer, whose line separator is the
pair of line breaks that ends a record, so a task that is repeated replaces its own files only.
Equal payloads are written once; the other pages are ``revisit`` records that name it.  Archives
are read back by the lengths in their headers.

The index is sorted by an external merge.  Captures are read in runs that are sorted where they
are; splitting keys, taken from the runs at regular places, cut each run into pieces for ranges
of the order, and the pieces of a range meet in one task, which merges them with a loser tree.
Ranges follow each other, so the whole index is in the order of URL key and time, and a URL that
fills the table is cut into ranges by time like any other stretch of the order.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from sensorspark.llm.common import text_or_empty
from sensorspark.session import cut, fresh_path

MIN_PAYLOAD = 1000
# Bytes of payload in an archive, on average, and captures in a range of the index.
FILE_BYTES = 24 << 20
RANGE_CAPTURES = 250_000
# Splitting keys are chosen among this many candidates at least, in all and from each range.
CANDIDATES = 1_000
PER_RANGE = 16
# Repeated payloads are looked up by broadcast up to this number; 60 bytes each.
BROADCAST_DIGESTS = 200_000
SALTS = 16
KEY_CHARS = 200

# Names of the format.
CRLF = "\r\n"
END = CRLF + CRLF
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_OK = "HTTP/1.1 200 OK"


def _escaped(url: Column) -> Column:
    """``url`` with white space percent-encoded, so that it fits a header line."""
    for c in "\r\n\t ":
        url = F.replace(url, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return url


def keepers(pages: DataFrame, least: int) -> DataFrame:
    """``(digest, keeper, n_same, first_url)`` of the payloads of ``least`` bytes or more that several rows have.

    ``keeper`` is the largest ``page_id``, NULL below all others; ``n_same`` rows have that id,
    the first of them by URL with ``first_url``.
    """
    html = text_or_empty("html")
    long = pages.select("page_id", "url", F.sha1(html).alias("digest"), F.octet_length(html).alias("size")).filter(F.col("size") >= least)
    same = long.groupBy("digest", "page_id").agg(F.count("*").alias("n"), F.min(F.struct("url")).alias("first"))
    last = F.max(F.struct("page_id", "n", "first"))
    found = same.groupBy("digest").agg(last.alias("last"), F.sum("n").alias("copies")).filter("copies > 1")
    return found.select(
        "digest", F.col("last.page_id").alias("keeper"), F.col("last.n").alias("n_same"), F.col("last.first.url").alias("first_url")
    )


def decide(pages: DataFrame, least: int = MIN_PAYLOAD) -> DataFrame:
    """``(page_id, url, payload, digest, copy, kept, repeats, keeper)``: each page, and what it repeats.

    ``repeats`` is true for a page whose payload the page ``keeper`` holds, ``kept`` for the one
    that others repeat.  Rows that share the id of the keeper, URL and payload are numbered by
    ``copy``: the first of them by URL is kept and the others repeat it.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    known = cut(keepers(pages, least))
    html = text_or_empty("html")
    rows = pages.select("page_id", "url", html.alias("payload"), F.sha1(html).alias("digest"), F.lit(0).alias("copy"))
    if known.count() <= BROADCAST_DIGESTS:
        met = rows.join(F.broadcast(known), "digest", "left")
    else:
        # A payload that fills the table is dealt to several tasks; what it is looked up in is copied for them.
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        met = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(
            known.withColumn("salt", salts), ["digest", "salt"], "left"
        )
    own = F.col("n_same").isNotNull() & F.col("page_id").eqNullSafe(F.col("keeper"))
    tied = own & (F.col("n_same") > 1)
    names = ["page_id", "url", "payload", "digest", "copy", "n_same", "keeper", "first_url"]
    if known.filter("n_same > 1").isEmpty():
        rows = met.select(names)
    else:
        # Rows alike in all columns are counted before they are shuffled, and numbered where they are made again.
        alike = met.filter(tied).groupBy("page_id", "url", "digest", "n_same", "keeper", "first_url").agg(
            F.count("*").alias("n"), F.first("payload").alias("payload")
        )
        again = alike.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))))
        rows = met.filter(~tied).select(names).unionByName(again.select(names))
    shared = F.col("n_same").isNotNull()
    first = F.col("page_id").eqNullSafe(F.col("keeper")) & F.col("url").eqNullSafe(F.col("first_url")) & (F.col("copy") == 0)
    return rows.select(
        "page_id", "url", "payload", "digest", "copy", (shared & first).alias("kept"), (shared & ~first).alias("repeats"), "keeper"
    )


def record_id(page_id: Column, *rest: Column) -> Column:
    number = F.coalesce(page_id.cast("string"), F.lit("none"))
    return F.concat(F.lit("<urn:page:"), number, *[x for c in rest for x in (F.lit(":"), c)], F.lit(">"))


def record(date: Column) -> Column:
    """The WARC record of a decided page, without the line breaks that end it.

    A response holds the HTTP header and the payload, a revisit the header alone.
    """
    repeats = F.col("repeats")
    block = F.concat(
        F.lit(f"{HTTP_OK}{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(END),
        F.when(repeats, "").otherwise(F.col("payload")),
    )
    header = lambda name, value: F.concat(F.lit(f"{CRLF}{name}: "), value)
    named = record_id(F.col("page_id"), F.col("digest"))
    single = record_id(F.col("page_id"), F.col("digest"), F.lower(F.hex(F.xxhash64("url"))), F.col("copy").cast("string"))
    target = F.coalesce(header("WARC-Target-URI", _escaped(F.col("url"))), F.lit(""))
    refers = F.when(
        repeats,
        F.concat(
            header("WARC-Refers-To", record_id(F.col("keeper"), F.col("digest"))),
            F.lit(f"{CRLF}WARC-Profile: {PROFILE}"),
        ),
    ).otherwise("")
    return F.concat(
        F.lit(f"{VERSION}{CRLF}WARC-Type: "),
        F.when(repeats, "revisit").otherwise("response"),
        header("WARC-Record-ID", F.when(F.col("kept"), named).otherwise(single)),
        header("WARC-Date", F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        target,
        refers,
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
        block,
    )


def write(pages: DataFrame, path: str, date: Column | None = None, least: int = MIN_PAYLOAD) -> None:
    """Write one record for each row of ``pages`` (``page_id``, ``url``, ``html``) to archives in ``path``.

    ``date`` is an expression over ``page_id`` and ``url``; by default the days since 2020
    count pages, one a second.  A NULL or empty ``html`` is an empty payload; a NULL ``url``
    leaves its header out, and white space in one is percent-encoded.
    """
    if date is None:
        date = F.timestamp_seconds(F.lit(1577836800) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9)))
    seen = Observation()
    decided = decide(pages.observe(seen, F.avg(F.octet_length(text_or_empty("html"))).alias("mean")), least)
    per_file = max(1, int(FILE_BYTES / ((seen.get["mean"] or 0) + 1)))
    lines = decided.select(record(date).alias("value"))
    lines.write.option("lineSep", END).option("maxRecordsPerFile", per_file).mode("errorifexists").text(path)


# --- reading -------------------------------------------------------------------------------

CAPTURE = pa.schema(
    [
        ("url_key", pa.string()),
        ("timestamp", pa.string()),
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("intact", pa.bool_()),
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)
CAPTURE_SQL = (
    "url_key string, timestamp string, record_id string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, intact boolean, file string, offset long, length long"
)


def records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], memoryview]]:
    """The records of an archive: offset, length with the line breaks at the end, header and block.

    A block is as long as its header says, whatever it holds.
    """
    at, whole = 0, memoryview(content)
    while at < len(content):
        head = content.index(END.encode(), at)
        lines = content[at:head].decode().split(CRLF)
        if lines[0] != VERSION:
            raise ValueError(f"no record at byte {at}: {lines[0][:40]!r}")
        header = dict(line.split(": ", 1) for line in lines[1:])
        begin = head + len(END)
        end = begin + int(header["Content-Length"])
        if content[end : end + len(END)] != END.encode():
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield at, end + len(END) - at, header, whole[begin:end]
        at = end + len(END)


def url_key(url: str | None) -> str:
    """A URL as it is sorted: host from its right, without ``www``, then path and query, in lower case."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}".lower()


def _page(record_name: str | None) -> int | None:
    """The page number in a record id."""
    found = re.match(r"<urn:page:(-?\d+)[:>]", record_name or "")
    return int(found[1]) if found else None


def capture(name: str, offset: int, length: int, header: dict[str, str], block: memoryview) -> tuple:
    """A row of ``CAPTURE`` from a record.

    Of a response, size and digest are those of its payload, and ``intact`` tells whether the
    digest is the one in its header; of a revisit they are what its headers say.
    """
    head, _, _ = bytes(block[: 1 << 16]).partition(END.encode())
    http = dict(line.split(": ", 1) for line in head.decode().split(CRLF)[1:])
    payload = block[len(head) + len(END) :]
    stated = header["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = header["WARC-Type"]
    size = int(http["Content-Length"])
    digest = stated if kind == "revisit" else hashlib.sha1(payload).hexdigest()
    url = header.get("WARC-Target-URI")
    return (
        url_key(url),
        re.sub(r"\D", "", header["WARC-Date"]),
        header["WARC-Record-ID"],
        _page(header["WARC-Record-ID"]),
        url,
        kind,
        _page(header.get("WARC-Refers-To")),
        size if kind == "revisit" else len(payload),
        digest,
        digest == stated and (kind == "revisit" or size == len(payload)),
        name,
        offset,
        length,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(CAPTURE)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, CAPTURE)], schema=CAPTURE)


def captures(spark: SparkSession, path: str) -> DataFrame:
    """One row of ``CAPTURE`` for each record of the archives in ``path``, archives in turn, each sorted."""

    def read(batches):
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                archive = content.as_py()
                rows = sorted(capture(name.as_py(), *r) for r in records(archive))
                for i in range(0, len(rows), 10_000):
                    yield _batch(rows[i : i + 10_000])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(read, CAPTURE_SQL)


# --- the index -----------------------------------------------------------------------------


class LoserTree:
    """Merges sorted runs: inner nodes keep the loser of their match, the winner goes up.

    ``runs`` are ranges ``(begin, end)`` of ``keys``.  Iterating gives positions in ``keys`` in
    the order of the keys, equal ones in the order of the runs.
    """

    def __init__(self, keys: list, runs: list[tuple[int, int]]):
        self.keys, self.at, self.end = keys, [a for a, _ in runs], [b for _, b in runs]
        k = self.k = len(runs)
        # Leaves are k .. 2k - 1; node i > 0 has children 2i and 2i + 1.
        winner = [*[0] * k, *range(k)]
        self.loser = [0] * k
        for i in range(k - 1, 0, -1):
            a, b = winner[2 * i], winner[2 * i + 1]
            winner[i], self.loser[i] = (a, b) if self.before(a, b) else (b, a)
        self.top = winner[1] if k > 1 else 0

    def before(self, a: int, b: int) -> bool:
        """Whether the head of run ``a`` comes first; a run that is used up comes last."""
        if self.at[a] == self.end[a] or self.at[b] == self.end[b]:
            return self.at[b] == self.end[b]
        x, y = self.keys[self.at[a]], self.keys[self.at[b]]
        return x < y or (x == y and a < b)

    def __iter__(self) -> Iterator[int]:
        while self.k and self.at[self.top] < self.end[self.top]:
            run = self.top
            yield self.at[run]
            self.at[run] += 1
            i = (run + self.k) // 2
            while i:
                if self.before(self.loser[i], run):
                    run, self.loser[i] = self.loser[i], run
                i //= 2
            self.top = run


ORDER = ("url_key", "timestamp", "record_id", "file", "offset")


def _keys(rows: pa.Table | pa.RecordBatch) -> list[tuple]:
    return list(zip(*[rows.column(c).to_pylist() for c in ORDER]))


def splitters(found: DataFrame, n_ranges: int) -> list[tuple]:
    """About ``n_ranges - 1`` keys that cut the captures into ranges of about one size.

    They are chosen among keys drawn by hash, a few for each range, so what the driver sees is
    bounded by the number of ranges.  URL keys are cut to a length; ranges only need any order.
    """
    total = found.count()
    stride = max(1, total // max(CANDIDATES, PER_RANGE * n_ranges))
    drawn = found.filter(F.pmod(F.xxhash64("record_id", "file", "offset"), F.lit(stride)) == 0)
    rows = drawn.select(F.substring("url_key", 1, KEY_CHARS), *ORDER[1:]).collect()
    keys = sorted(tuple(r) for r in rows)
    return sorted({keys[len(keys) * i // n_ranges] for i in range(1, n_ranges)}) if keys else []


def merge_index(found: DataFrame, range_captures: int = RANGE_CAPTURES, run_captures: int = 1 << 16) -> DataFrame:
    """``found`` (rows of ``CAPTURE``) in order: ``position``, from 0, by URL key, time and record id.

    Captures without a URL come first.  Rows of the result are in order inside a range of the
    index, and ranges are numbered in order; equal captures follow each other.
    """
    spark = found.sparkSession
    total = found.count()
    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // range_captures))
    cuts = splitters(found, n_ranges)

    def deal(batches):
        def pieces(run: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(run)
            keys = _keys(rows)
            order = sorted(range(len(keys)), key=keys.__getitem__)
            ranges = [bisect_right(cuts, keys[i]) for i in order]
            first = [i for i, r in enumerate(ranges) if i == 0 or r != ranges[i - 1]]
            rows = rows.take(pa.array(order, pa.int64())).combine_chunks()
            lists = {
                c: pa.ListArray.from_arrays(pa.array([*first, len(order)], pa.int32()), rows.column(c).combine_chunks())
                for c in rows.column_names
            }
            return pa.record_batch({"range": pa.array([ranges[i] for i in first], pa.int32()), **lists})

        run, size = [], 0
        for batch in batches:
            if batch.num_rows:
                run.append(batch)
                size += batch.num_rows
            if size >= run_captures:
                yield pieces(run)
                run, size = [], 0
        if run:
            yield pieces(run)

    lists = ", ".join(f"{c} array<{t}>" for c, t in (f.split() for f in CAPTURE_SQL.split(", ")))
    path = fresh_path(spark, "index-pieces")
    found.select(CAPTURE.names).mapInArrow(deal, f"range int, {lists}").write.parquet(path)
    dealt = spark.read.parquet(path)

    def merge(group: pa.Table) -> pa.Table:
        columns = {c: group.column(c).combine_chunks() for c in CAPTURE.names}
        sizes = columns["url_key"].value_lengths().to_pylist()
        rows = pa.table({c: v.flatten() for c, v in columns.items()})
        runs, at = [], 0
        for n in sizes:
            runs.append((at, at + n))
            at += n
        order = list(LoserTree(_keys(rows), runs))
        start = group.column("start")[0].as_py() if len(group) else 0
        rows = rows.take(pa.array(order, pa.int64()))
        return rows.append_column("position", pa.array(range(start, start + len(order)), pa.int64())).cast(merged)

    merged = pa.schema([*CAPTURE, ("position", pa.int64())])
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("range").agg(F.sum(F.size("url_key")).alias("n"))
    starts = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return dealt.join(starts, "range").groupBy("range").applyInArrow(merge, f"{CAPTURE_SQL}, position long")


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    """The captures of the archives in ``path``, globally ordered; see ``merge_index``."""
    table = fresh_path(spark, "captures")
    captures(spark, path).write.parquet(table)
    return merge_index(spark.read.parquet(table))
