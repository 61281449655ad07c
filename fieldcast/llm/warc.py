"""Operator 5: a deterministic, sharded WARC writer, and the reader of what it wrote.

Records are sorted by page; a file ends where the compressed size of the records before it
passes a limit, so the shards depend on the records alone and not on Spark's partitions.
Headers, digests and record ids are made anew. Files are written under temporary names, moved
to their final ones, and count only once the manifest, moved last, lists them.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldcast.llm.common import hadoop_fs, write_shared

ROLL = 1 << 20        # compressed bytes after which a file ends, at least
LARGEST_ROLL = 1 << 30  # and at most
FILES = 1000          # files up to which it stays at the least: large corpora have files in proportion
MOVERS = 16           # files moved to their final names at a time
LEAST_BYTES = 0       # smaller payloads are never revisits
HEADER_BYTES = 300    # allowed for the headers of a record
DATE = "2024-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
END = "\r\n\r\n"
READ_ROWS = 500
RECORDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("position", pa.int64()),
    ("payload", pa.string())])
RECORDS_DDL = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
               " refers_to long, file string, position long, payload string")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string's bytes: five hex digits are four letters."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def compressed_bytes(payload: Column) -> Column:
    @F.pandas_udf("long")
    def run(payloads: pd.Series) -> pd.Series:
        return pd.Series([len(zlib.compress(p.encode(), 6)) for p in payloads], dtype="int64")

    return run(payload)


def packed(payload: Column) -> Column:
    """Payloads travel through shuffles compressed, quickly rather than tightly."""
    @F.pandas_udf("binary")
    def run(payloads: pd.Series) -> pd.Series:
        return pd.Series([zlib.compress(p.encode(), 1) for p in payloads], dtype=object)

    return run(payload)


def unpacked(body: Column) -> Column:
    @F.pandas_udf("string")
    def run(bodies: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else zlib.decompress(b).decode() for b in bodies], dtype=object)

    return run(body)


def page_order(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}page_id").asc_nulls_last(), F.col(f"{prefix}url").asc_nulls_last()]


def planned(pages: DataFrame, roll: int, least_bytes: int) -> DataFrame:
    """page_id, url, digest, payload_bytes, record_type, refers_to, shard, position: the plan of
    the archives, one row per page, without payloads.

    The first page (by id, then url; nulls last) of equal payloads is the response.
    """
    slim = write_shared(pages.select(
        "page_id", "url", base32_sha1(F.col("payload")).alias("digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        compressed_bytes(F.col("payload")).alias("packed"), F.monotonically_increasing_id().alias("row")), "records")
    firsts = slim.where(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(F.min(F.struct(
        F.col("page_id").isNull().alias("a"), "page_id", F.col("url").isNull().alias("b"), "url", "row")).alias("f"))
    marked = slim.join(firsts, "digest", "left").select(
        "page_id", "url", "digest", "payload_bytes", "row",
        (F.col("f").isNull() | (F.col("f.row") == F.col("row"))).alias("first"),
        F.col("f.page_id").alias("first_page"), F.col("f.url").alias("first_url"),
        F.when(F.col("f").isNull() | (F.col("f.row") == F.col("row")), F.col("packed")).otherwise(0).alias("packed"))

    def number(batches):
        part, size, n = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            packed = batch.column("packed").to_numpy() + HEADER_BYTES
            ends = size + np.cumsum(packed)
            rows = n + np.arange(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(ends - packed), pa.array(rows)],
                names=[*batch.schema.names, "part", "before", "nth"])
            size, n = int(ends[-1]) if batch.num_rows else size, n + batch.num_rows

    order = [*page_order(), F.col("digest"), F.col("row")]
    ordered = write_shared(
        marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            number, marked.schema.simpleString()[7:-1] + ",part:bigint,before:bigint,nth:bigint"), "ordered")
    totals = sorted(ordered.groupBy("part").agg(  # one row per partition of the sort
        F.max(F.col("before") + F.col("packed") + HEADER_BYTES), F.count("*")).collect())
    starts, size, rows = [], 0, 0
    for part, more, n in totals:
        starts.append((part, size, rows))
        size, rows = size + more, rows + n
    roll = max(roll, min(LARGEST_ROLL, size // FILES))
    begin = pages.sparkSession.createDataFrame(starts, "part long, bytes long, rows long")
    return ordered.join(begin, "part").select(
        "page_id", "url", "digest", "payload_bytes", "first", "first_page", "first_url",
        F.floor((F.col("bytes") + F.col("before")) / F.lit(roll)).cast("long").alias("shard"),
        (F.col("rows") + F.col("nth")).alias("position"))


def record_id(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null; line breaks in a value are escaped."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def record(plan: dict[str, Column], payload: Column | None) -> Column:
    """The text of a record up to its last two line ends."""
    p = plan
    response = payload is not None
    block = F.concat(F.lit(HTTP), payload) if response else F.lit(HTTP)
    head = [
        F.lit("WARC/1.1\r\n"), field("WARC-Type", F.lit("response" if response else "revisit")),
        field("WARC-Record-ID", p["id"]), field("WARC-Date", F.lit(DATE)), field("WARC-Target-URI", p["url"]),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), p["digest"])),
        field("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(block))),
    ]
    if not response:
        head += [
            field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            field("WARC-Refers-To", p["first_id"]), field("WARC-Refers-To-Target-URI", p["first_url"]),
            field("WARC-Refers-To-Date", F.lit(DATE)), field("X-Refers-To-Page-ID", p["first_page"])]
    head += [
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("X-Page-ID", p["page_id"]), field("X-Payload-Length", p["payload_bytes"]),
        field("X-Position", p["position"]), field("Content-Length", F.octet_length(block)), F.lit("\r\n")]
    return F.concat(*head, block)


def write_archives(pages: DataFrame, folder: str, roll: int = ROLL, least_bytes: int = LEAST_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as gzipped WARC files with a manifest into ``folder``.

    Null html is the empty payload; null ids and urls leave their header out; repeated rows are
    records of their own, all but one of them revisits. Other columns play no part. The folder
    must not hold a manifest yet. A payload must fit into memory; nothing larger is gathered.
    """
    spark = pages.sparkSession
    fs, _ = hadoop_fs(spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if fs.exists(path(f"{folder}/manifest.json")):
        raise FileExistsError(f"{folder} holds a manifest")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("payload"))
    plan = write_shared(planned(rows, roll, least_bytes), "plan")
    small = F.col("payload_bytes") < least_bytes
    unique = record_id(F.lit("record"), F.col("page_id"), F.col("url"), F.col("position"))
    of_payload = record_id(F.lit("response"), F.col("digest"))
    columns = {c: F.col(c) for c in plan.columns} | {
        "id": F.when(small | ~F.col("first"), unique).otherwise(of_payload), "first_id": of_payload}
    keys = ["page_id", "url", "digest"]
    responses = plan.where("first")
    bodies = rows.select(
        "page_id", "url", base32_sha1(F.col("payload")).alias("digest"), packed(F.col("payload")).alias("body"))
    same = [bodies[k].eqNullSafe(responses[k]) for k in keys]
    filled = bodies.join(responses, same).select(*[responses[c] for c in plan.columns], bodies["body"])
    placed = filled.unionByName(plan.where("not first").withColumn("body", F.lit(None).cast("binary")))
    once = F.expr("row_number() over (partition by shard, position order by 1)")  # equal rows met equal rows
    whole = placed.repartition("shard").withColumn("nth", once).where("nth = 1").withColumn(
        "payload", unpacked(F.col("body")))
    text = F.when(F.col("first"), record(columns, F.col("payload"))).otherwise(record(columns, None))
    temporary = f"{folder}/_temporary-{uuid.uuid4().hex}"
    whole.sortWithinPartitions("shard", "position").select("shard", text.alias("value")).write.partitionBy(
        "shard").option("lineSep", END).option("compression", "gzip").text(temporary)
    counts = {r["shard"]: r["n"] for r in plan.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # one a file

    def moved(shard: int) -> dict:
        found = [s.getPath() for s in fs.listStatus(path(f"{temporary}/shard={shard}"))]
        found = [p for p in found if p.getName().startswith("part-")]
        if len(found) != 1:
            raise RuntimeError(f"shard {shard}: {len(found)} files")
        name = f"pages-{shard:06d}.warc.gz"
        if not fs.rename(found[0], path(f"{folder}/{name}")):
            raise RuntimeError(f"could not move shard {shard} to {name}")
        return {"file": name, "records": counts[shard], "bytes": fs.getFileStatus(path(f"{folder}/{name}")).getLen()}

    # A call of the file system for each file, whatever its size; side by side, as each mostly waits.
    with ThreadPoolExecutor(MOVERS) as pool:
        manifest = list(pool.map(moved, sorted(counts)))
    out = fs.create(path(f"{temporary}/manifest.json"))
    out.write("".join(json.dumps(m) + "\n" for m in manifest).encode())
    out.close()
    if not fs.rename(path(f"{temporary}/manifest.json"), path(f"{folder}/manifest.json")):
        raise RuntimeError("could not commit the manifest")
    fs.delete(path(temporary), True)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of a folder's archives: see ``RECORDS``; a revisit has no payload. Files that the manifest
    does not list are left out; a wrong digest, length or number of records is an error."""
    listed = spark.read.schema("file string, records long, bytes long").json(f"{folder}/manifest.json")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    wanted = files.select(F.regexp_extract("path", "[^/]*$", 0).alias("file"), "content").join(listed, "file")
    return wanted.select("file", "content", "records").mapInArrow(parse_files, RECORDS_DDL)


def parse_files(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
            held, n = [], 0
            for found in records_of(row["content"]):
                held.append(found | {"file": row["file"]})
                n += 1
                if len(held) >= READ_ROWS:
                    yield pa.RecordBatch.from_pylist(held, schema=RECORDS)
                    held = []
            if n != row["records"]:
                raise ValueError(f"{row['file']} has {n} records, the manifest says {row['records']}")
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=RECORDS)


def records_of(archive: bytes):
    """The records of one gzipped archive, one at a time; payloads are checked against digests."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(archive))
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:80]!r}")
        head = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[name] = value
        block = stream.read(int(head["Content-Length"]))
        if stream.read(len(END)) != END.encode() or digest(block) != head["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
        payload = block.partition(END.encode())[2]
        response = head["WARC-Type"] == "response"
        if response and (digest(payload) != head["WARC-Payload-Digest"]
                         or len(payload) != int(head["X-Payload-Length"])):
            raise ValueError(f"damaged payload {head['WARC-Record-ID']}")
        number = {k: int(head[k]) if k in head else None for k in ("X-Page-ID", "X-Refers-To-Page-ID")}
        yield {
            "page_id": number["X-Page-ID"], "url": head.get("WARC-Target-URI"),
            "payload_bytes": int(head["X-Payload-Length"]),
            "payload_digest": head["WARC-Payload-Digest"].removeprefix("sha1:"),
            "record_type": head["WARC-Type"], "refers_to": number["X-Refers-To-Page-ID"],
            "position": int(head["X-Position"]), "payload": payload.decode() if response else None}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def archived(pages: DataFrame, folder: str, roll: int = ROLL, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, as read back
    from the archives written to ``folder``. Nulls and repeated rows as in ``write_archives``."""
    write_archives(pages, folder, roll, least_bytes)
    return read_archives(pages.sparkSession, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
