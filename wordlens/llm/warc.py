"""WARC archives with revisit records, and their index by an external merge.

Writing: every partition of the pages is sorted by (URL key, capture time, page) and becomes one
capture run, a WARC file of gzip members. Spark's writer stores a run as rows (run, offset,
member) in the shared folder, so no task needs a local path: the members of a run in order of
offset are a .warc.gz byte for byte (``archive_bytes``).

Reading: the members are unpacked and parsed; response payloads are hashed again and must match their
digest. Their index entries are as sorted as the runs.

Index: entries are dealt out by ranges of (URL key, time, page), so a range holds a slice of every
run; each task merges its slices by a loser tree (one comparison a level for every entry taken). The
ranges in order are the global capture history. A hot URL spreads over ranges by time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordlens.llm.arrays import texts
from wordlens.session import materialize

MIN_REVISIT_BYTES = 100
#: Index entries of a range, which a task merges in memory.
RANGE_ROWS = 200_000
#: Captures are dated by page_id: so many seconds after this moment (the pages table has no time).
FIRST_CAPTURE = "2020-01-01 00:00:00"
LEVEL = 1


def url_key(url: Column) -> Column:
    """Sort key of a URL: reversed host, port left out, then path and query, lower-cased; '' for a null."""
    plain = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""))
    host = F.regexp_replace(F.regexp_extract(plain, r"^([^/?#]*)", 1), r"^www\d*\.|:\d+$|^[^@]*@", "")
    path = F.regexp_replace(F.regexp_replace(plain, r"^[^/?#]*", ""), "#.*$", "")
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(plain == "", "").otherwise(F.concat(reversed_host, F.lit(")"), F.when(path == "", "/").otherwise(path)))


def captures(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """pages(page_id, url, html) with url_key, captured_at, payload_bytes, payload_digest, record_type and refers_to.

    Of equal payloads of at least ``least`` bytes that with the smallest page_id is the response. The
    search for it moves digests, not payloads."""
    payload = F.coalesce("html", F.lit(""))
    moment = F.expr(f"timestampadd(SECOND, pmod(coalesce(page_id, 0), 1000000000), TIMESTAMP_NTZ'{FIRST_CAPTURE}')")
    own = pages.select(
        F.col("page_id").cast("bigint"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"),
        url_key(F.col("url")).alias("url_key"), F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured_at"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"))
    # a table of its own: a join right above an aggregation can't split a common payload's rows
    first = materialize(own.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
                        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1")
                        .select("payload_digest", "first_id"), "warc_firsts")
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return own.join(first, "payload_digest", "left").select(
        *own.columns, F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("first_id")).alias("refers_to"))


def record(page_id: int | None, url: str, captured_at: str, payload: bytes, digest: str, size: int, kind: str,
           refers_to: int | None) -> bytes:
    """A WARC/1.1 record; a revisit has the headers of its payload only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + payload if kind == "response" else http
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Date: {captured_at}", f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        lines.insert(2, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def pack_member(raw: bytes, level: int = LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, int, bytes]:
    """(headers, HTTP head, payload length by the HTTP head, payload) of a record; raises if it is broken."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(headers["Content-Length"])
    block, end = rest[:size], rest[size:]
    if first != "WARC/1.1" or len(block) != size or end != b"\r\n\r\n":
        raise ValueError("a broken WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if headers["WARC-Type"] == "response" and (
            len(payload) != length or headers["WARC-Payload-Digest"] != f"sha256:{hashlib.sha256(payload).hexdigest()}"):
        raise ValueError("a payload that is not its record's")
    return headers, http, length, payload


def write_archives(found: DataFrame) -> DataFrame:
    """Capture runs of ``captures`` as a written table (run, offset, url_key, member)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, offset = TaskContext.get().partitionId(), 0
        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in batch.schema.names if n != "payload"}
            offsets, members = [], []
            for i, payload in enumerate(texts(batch.column("payload"))):
                members.append(pack_member(record(
                    c["page_id"][i], c["url"][i], c["captured_at"][i], payload, c["payload_digest"][i],
                    c["payload_bytes"][i], c["record_type"][i], c["refers_to"][i])))
                offsets.append(offset)
                offset += len(members[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(members), pa.int32()), pa.array(offsets, pa.int64()), batch.column("url_key"),
                 pa.array(members, pa.binary())], ["run", "offset", "url_key", "member"])

    ordered = found.sortWithinPartitions("url_key", "captured_at", "page_id")
    return materialize(ordered.mapInArrow(run, "run int, offset bigint, url_key string, member binary"), "warc")


def archive_bytes(archives: DataFrame, run: int) -> bytes:
    """One run as a .warc.gz file's bytes (for export and tests; a run is one partition)."""
    return b"".join(r.member for r in archives.where(F.col("run") == run).orderBy("offset").select("member").toLocalIterator())


def read_archives(archives: DataFrame) -> DataFrame:
    """Index entries of all records, checked as they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        urn = lambda s: int(s[10:-1]) if s and s[10:-1] else None  # noqa: E731  <urn:page:N>
        for batch in batches:
            rows = []
            for member in batch.column("member").to_pylist():
                headers, _, length, _ = parse_record(zlib.decompress(member, 31))
                rows.append((urn(headers["WARC-Record-ID"]), headers["WARC-Date"], length,
                             headers["WARC-Payload-Digest"].removeprefix("sha256:"), headers["WARC-Type"],
                             urn(headers.get("WARC-Refers-To"))))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("run"), batch.column("offset"), batch.column("url_key"),
                 *[pa.array(v, t) for v, t in zip(columns, kinds)]],
                ["run", "offset", "url_key", "page_id", "captured_at", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return archives.mapInArrow(run, "run int, offset bigint, url_key string, page_id bigint, captured_at string, "
                                    "payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def loser_tree_merge(runs: list[Iterable[tuple]]) -> Iterator[tuple[tuple, int]]:
    """(entry, its run) of sorted runs in order; at ties the earlier run comes first.

    Inner nodes keep the loser of their match; taking the winner replays only the path from its leaf."""
    k = len(runs)
    sources = [iter(r) for r in runs]
    done = object()
    heads = [next(s, done) for s in sources]

    def beats(a: int, b: int) -> bool:
        if heads[a] is done or heads[b] is done:
            return heads[b] is done and (heads[a] is not done or a < b)
        return (heads[a], a) < (heads[b], b)

    losers = [-1] * max(k, 1)
    winners = [-1] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    winner = winners[1] if k > 1 else 0
    while k and heads[winner] is not done:
        yield heads[winner], winner
        heads[winner] = next(sources[winner], done)
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2


def merge_index(entries: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The entries in global order of (URL key, time, page): ``place`` grows along it, without being gapless, and ``capture``
    counts a URL key's captures from 0. Ranges of about ``range_rows`` entries are merged, each from the runs that reach into it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))  # a range of the index
        if not table.num_rows:
            return
        number = table.column("run").to_numpy()
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(number)]])
        keys = list(zip(table.column("url_key").to_pylist(), table.column("captured_at").to_pylist(),
                        [(x is not None, x or 0) for x in table.column("page_id").to_pylist()], range(len(number))))
        order, capture, before = [], [], None
        for (url_key, _, _, at), _ in loser_tree_merge([keys[a:b] for a, b in zip(bounds[:-1], bounds[1:])]):
            capture.append(capture[-1] + 1 if order and url_key == before else 0)
            order.append(at)
            before = url_key
        of = TaskContext.get().partitionId()
        out = table.take(pa.array(order, pa.int64())).append_column("place", pa.array(np.arange(len(order)) + (of << 40)))
        out = out.append_column("capture", pa.array(capture, pa.int64())).append_column("range", pa.array([of] * len(order), pa.int32()))
        yield from out.to_batches()

    ranges = max(1, -(-entries.count() // range_rows))
    dealt = entries.repartitionByRange(ranges, "url_key", "captured_at", "page_id").sortWithinPartitions(
        "run", "url_key", "captured_at", "page_id")
    schema = ", ".join(f"{c} {t}" for c, t in entries.dtypes) + ", place bigint, capture bigint, range int"
    merged = materialize(dealt.mapInArrow(run, schema), "warc_index")
    # a key that goes on from the range before has its count there added: only a range's first and last keys can
    edges = merged.groupBy("range").agg(F.min("url_key").alias("low"), F.max("url_key").alias("high"))
    lasts = (merged.join(F.broadcast(edges), "range").where((F.col("url_key") == F.col("low")) | (F.col("url_key") == F.col("high")))
             .groupBy("range", "url_key").agg(F.count("*").alias("n")))  # two rows a range at most
    earlier = Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lasts.select("range", "url_key", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("done"))
    return (merged.join(F.broadcast(offsets), ["range", "url_key"], "left")
            .withColumn("capture", F.col("capture") + F.coalesce("done", F.lit(0))).drop("done", "range"))


def capture_histories(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, captured_at, run, offset,
    place, capture) per row of pages(page_id, url, html), as read back from the archives.

    A null html is an empty payload, a null url sorts first, a null page_id is written without a number and
    is no response if an equal payload has one. Equal rows are records of their own. Other columns are ignored;
    an empty table gives an empty one.
    """
    index = read_archives(write_archives(captures(pages, least)))
    return merge_index(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                     "url_key", "captured_at", "run", "offset", "place", "capture")
