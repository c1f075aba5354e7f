"""WARC archives as a table of chunks.

A record is stored as rows (record, chunk, last, block, digest): block holds the bytes of the archive in order, the WARC
header and the first piece of the payload in chunk 0, further pieces after it; a payload above `CHUNK` bytes is never
handled in one piece after it leaves its row. digest is the SHA-1 of the payload up to and including the chunk, carried
from chunk to chunk. Joining the blocks of a record and ending it with two line ends gives a plain WARC record.

Payloads of at least `least` bytes that occur several times are stored once: the record with the largest key is the response, the others
are revisits without payload that name it, its digest and its length. Reading streams the chunks of a record in order,
computes its digest anew and compares it with the stored one.

Null payloads are empty. Rows that share the largest key of their payload are all responses; null keys come before all
others, a group of null keys only has responses. Ids of records are counted by the writer and are unique, also for
repeated rows; the key of a row stands in a header of its own, and a revisit names the page and the address of its response. Empty tables give an archive without records. Other columns are not stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut, fresh_path

CHUNK = 1 << 18
ARROW_ROWS = 256  # so that a batch of chunks stays small


PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value: the format's name for such revisits


def _header(record: int, kind: str, key, url, date: str, digest: str, size: int, refers, refers_url) -> bytes:
    plain = lambda x: str(x if x is not None else "").replace("\r", "").replace("\n", "")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:record:{record}>", f"WARC-Date: {date}", f"WARC-Target-URI: {plain(url)}",
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: text/html; charset=utf-8", f"X-Page-ID: {plain(key)}", f"X-Payload-Length: {size}",
             f"Content-Length: {0 if kind == 'revisit' else size}"]
    if kind == "revisit":
        lines[3:3] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To-Target-URI: {plain(refers_url)}", f"X-Refers-To-Page: {plain(refers)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _fields(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    return dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:]), body


def write(df: DataFrame, path: str, payload: str = "html", key: str = "page_id", url: str = "url", least: int = 1000,
          date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record for each row; `date` is when the pages were captured. Only digests are grouped; payloads travel at most once, beside the few digests that
    occur several times."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = df.select(F.col(key).alias("key"), F.col(url).alias("url"), body.alias("body"))
    rows = rows.withColumns({"sha1": F.sha1("body"), "size": F.octet_length("body").cast("long")})
    same = rows.where(F.col("size") >= least).groupBy(F.col("sha1").alias("of"), F.col("size").alias("bytes"))
    best = F.max(F.struct("key", "url")).alias("m")
    same = same.agg(best, F.count("*").alias("n")).where("n > 1 and m.key is not null")
    same = cut(same.select("of", "bytes", F.col("m.key").alias("first"), F.col("m.url").alias("first_url")))
    rows = rows.join(same, (F.col("sha1") == F.col("of")) & (F.col("size") == F.col("bytes")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    rows = rows.withColumn("refers", F.when(revisit, F.col("first"))).withColumn("record", F.monotonically_increasing_id())
    pieces = F.when(F.col("refers").isNull(), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("size") / CHUNK))).otherwise(F.lit(1).cast("long"))
    rows = rows.withColumn("pieces", pieces).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
    piece = F.expr(f"substring(body, cast(chunk * {CHUNK} + 1 as int), {CHUNK})")
    rows = rows.select("record", "chunk", (F.col("chunk") == F.col("pieces") - 1).alias("last"), "key", "url", "sha1", "size", "refers", "first_url",
                       F.when(F.col("refers").isNull(), piece).otherwise(F.lit(b"")).alias("data"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = hashlib.sha1()
        for whole in batches:
            for at in range(0, whole.num_rows, ARROW_ROWS):
                batch = whole.slice(at, ARROW_ROWS)
                out, digests = [], []
                for r in batch.to_pylist():
                    head = b""
                    if r["chunk"] == 0:
                        sha = hashlib.sha1()
                        kind = "revisit" if r["refers"] is not None else "response"
                        head = _header(r["record"], kind, r["key"], r["url"], date, r["sha1"], r["size"], r["refers"], r["first_url"])
                    sha.update(r["data"])
                    out.append(head + r["data"])
                    digests.append(sha.hexdigest())
                yield pa.RecordBatch.from_arrays([batch["record"], batch["chunk"], batch["last"], batch["key"], pa.array(out, pa.binary()), pa.array(digests)],
                                                 ["record", "chunk", "last", "key", "block", "digest"])

    kind = rows.schema["key"].dataType.simpleString()
    rows.mapInArrow(blocks, f"record long, chunk long, last boolean, key {kind}, block binary, digest string").write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) of each record; fails where a payload does not have
    the digest that its record states."""
    stored = spark.read.parquet(path)
    kind = stored.schema["key"].dataType.simpleString()
    rows = stored.repartition("record").sortWithinPartitions("record", "chunk")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, size, fields, key = hashlib.sha1(), 0, {}, None
        for whole in batches:
            out: list[dict] = []
            for at in range(0, whole.num_rows, ARROW_ROWS):
                for r in whole.slice(at, ARROW_ROWS).to_pylist():
                    data = r["block"]
                    if r["chunk"] == 0:
                        sha, size, key = hashlib.sha1(), 0, r["key"]
                        fields, data = _fields(data)
                    sha.update(data)
                    size += len(data)
                    if not r["last"]:
                        continue
                    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = fields["WARC-Type"] == "response"
                    if response and (sha.hexdigest() != stated or size != int(fields["Content-Length"])):
                        raise ValueError(f"record {fields['WARC-Record-ID']}: the payload does not match its digest")
                    refers = None if response else fields["X-Refers-To-Page"]
                    out.append({"key": key, "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": stated,
                                "record_type": fields["WARC-Type"], "refers_to": refers})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("key", whole.schema.field("key").type), ("payload_bytes", pa.int64()),
                                                 ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())]))

    shape = f"key {kind}, payload_bytes long, payload_digest string, record_type string, refers_to string"
    found = rows.select("record", "chunk", "last", "key", "block").mapInArrow(records, shape)
    return found.withColumn("refers_to", F.col("refers_to").cast(kind))


def round_trip(df: DataFrame, **options) -> DataFrame:
    """Write a new archive into the shared folder and read it back."""
    path = fresh_path(df.sparkSession, "warc")
    write(df, path, **options)
    return read(df.sparkSession, path)
