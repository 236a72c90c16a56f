"""WARC archives: writing, normalising monolithic gzip, and reading by index.

``write_monolithic`` stores records the way some crawlers do: one gzip stream per
file, which can only be read from its beginning.  ``normalise`` inflates each such
stream once, rewrites every record as a gzip member of its own and puts a sidecar
index of offsets beside the archive.  ``read_indexed`` then fetches records by
range, in parallel also inside one archive.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm.common import cut

END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records with shorter payloads are always stored whole.
LEAST_SHARED_BYTES = 100
INDEX = "file string, offset long, length long, record_id string, record_type string, page_id string"
LEVEL = 4


def _uuid(c: Column) -> Column:
    h = F.md5(c)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def page_records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One column ``value``: the WARC record of each row, without its closing blank lines.

    Of equal payloads of at least 100 bytes the rows with the smallest id are
    ``response``, the others ``revisit`` it without a payload. Which they are is found among
    narrow rows of ids and digests; whole rows shuffle by id and digest together, so a payload
    that a third of all pages share spreads over all tasks.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    digest = F.sha2(payload.cast("binary"), 256)
    narrow = cut(pages.where(F.octet_length(payload) >= LEAST_SHARED_BYTES).select(F.col(id_col).alias("id"), digest.alias("sha")), "warc-digests")
    firsts = narrow.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").drop("n")
    again = narrow.join(firsts, "sha").where(~F.col("first").eqNullSafe(F.col("id"))).distinct()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), digest.alias("digest")) \
        .withColumn("bytes", F.octet_length("payload"))
    known = rows.join(again, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("sha")), "left")
    revisit = F.col("first").isNotNull()
    text = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    first = F.col("first").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _uuid(F.concat(F.lit("page "), text))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _uuid(F.concat(F.lit("page "), first)))),
        F.when(revisit, F.concat(F.lit("X-Refers-To-Page: "), first)),
        F.concat(F.lit("X-Page: "), text),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")))
    return known.withColumn("block", block).select(F.concat(head, F.lit(END), F.col("block")).alias("value"))


def write_monolithic(records: DataFrame, path: str, records_per_file: int = 100_000) -> None:
    """Archives of one gzip stream each, written by Spark to any file system it knows."""
    records.write.option("compression", "gzip").option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


def _place(uri: str):
    """(file system, path) of a URI; a task opens shared storage by it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


@contextmanager
def _committed(uri: str):
    """A stream to a name of its own that becomes ``uri`` when all is written, so a
    repeated or speculative attempt never leaves half a file under the final name."""
    import uuid

    from pyarrow import fs

    system, path = _place(uri)
    folder, _, name = path.rpartition("/")
    attempt = f"{folder}/_attempt-{uuid.uuid4().hex}-{name}"
    with system.open_output_stream(attempt, compression=None) as out:
        yield out
    if system.get_file_info(path).type != fs.FileType.NotFound and not isinstance(system, fs.LocalFileSystem):
        system.delete_file(path)
    system.move(attempt, path)


def inflated(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a gzip stream of one or many members."""
    engine, fresh = zlib.decompressobj(31), True
    while data := stream.read(size):
        while data:
            if engine.eof:
                engine, fresh = zlib.decompressobj(31), True
            out = engine.decompress(data, 4 * size)
            data = engine.unused_data if engine.eof else engine.unconsumed_tail
            fresh = False
            if out:
                yield out
    if not fresh and not engine.eof:
        raise EOFError("the gzip stream ends inside a member")


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record with its closing blank lines); holds one record at a time."""
    mark = END.encode()
    buffer = bytearray()
    for chunk in chunks:
        buffer += chunk
        begin = 0
        while True:
            cut = buffer.find(mark, begin)
            if cut < 0:
                break
            head = headers(bytes(buffer[begin:cut]))
            end = cut + 4 + int(head["content-length"]) + 4
            if len(buffer) < end:
                break
            if buffer[end - 4 : end] != mark:
                raise ValueError(f"record {head.get('warc-record-id')} is longer or shorter than it says")
            yield head, bytes(buffer[begin:end])
            begin = end
        del buffer[:begin]
    if buffer.strip():
        raise EOFError("the archive ends inside a record")


def _member(data: bytes) -> bytes:
    engine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return engine.compress(data) + engine.flush()


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every archive under ``source`` to ``target`` with a gzip member per record.

    Beside each ``<name>.warc.gz`` stands ``<name>.warc.gz.idx``, a line per record:
    offset, length, record id, type and page, separated by tabs. The result holds the
    same rows (and the file). Memory is one record; an archive is one task's work,
    repeated whole if its executor is lost. A damaged archive raises an error.
    """
    system = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(system)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                name = uri.rstrip("/").rpartition("/")[2].split(".")[0] + ".warc.gz"
                out_uri = f"{target}/{name}"
                rows, offset = [], 0
                store, path = _place(uri)
                with store.open_input_stream(path, compression=None) as stream, _committed(out_uri) as out, _committed(out_uri + ".idx") as index:
                    for head, data in records(inflated(stream)):
                        member = _member(data)
                        out.write(member)
                        row = (out_uri, offset, len(member), head.get("warc-record-id", ""), head.get("warc-type", ""), head.get("x-page", ""))
                        index.write(("\t".join(map(str, row[1:])) + "\n").encode())
                        rows.append(row)
                        offset += len(member)
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    names = [x.split()[0] for x in INDEX.split(", ")]
    archives = files.count()
    return cut(files.repartition(max(1, archives)).mapInArrow(run, INDEX), "warc-index")


def read_indexed(index: DataFrame, range_bytes: int = 8 << 20) -> DataFrame:
    """``page, payload_bytes, payload_digest, record_type, refers`` of every indexed record.

    Ranges of an archive are read by different tasks. The digest of a stored payload is
    computed from what was read, and must be the one that the record states; a revisit
    states those of the payload it refers to.
    """

    def run(batches) -> Iterator:
        import hashlib

        import pyarrow as pa

        opened, stream = None, None
        for batch in batches:
            rows = []
            for uri, offset, length in zip(*(batch.column(j).to_pylist() for j in range(3))):
                if uri != opened:
                    store, path = _place(uri)
                    opened, stream = uri, store.open_input_file(path)
                stream.seek(offset)
                record = zlib.decompress(stream.read(length), 31)
                head, _, rest = record.partition(END.encode())
                h = headers(head)
                _, _, payload = rest[: int(h["content-length"])].partition(END.encode())
                digest = h["warc-payload-digest"].removeprefix("sha256:")
                if h["warc-type"] == "response":
                    if hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(h["x-payload-length"]):
                        raise ValueError(f"{uri} at {offset}: the payload is not the one that was written")
                rows.append((h["x-page"] or None, int(h["x-payload-length"]), digest, h["warc-type"], h.get("x-refers-to-page")))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                                             names=["page", "payload_bytes", "payload_digest", "record_type", "refers"])

    return index.select("file", "offset", "length").repartition("file", F.floor(F.col("offset") / range_bytes)) \
        .sortWithinPartitions("file", "offset").mapInArrow(
            run, "page string, payload_bytes long, payload_digest string, record_type string, refers string")


def archive_round_trip(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` to monolithic archives, normalise them, and read every record back:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Null html is an empty payload; null urls have an empty target; rows with the least id
    of a payload, if repeated, are all responses; rows with a null id revisit the least
    id, and are responses if there is none; other columns are not stored. An empty
    table gives empty archives and an empty result.
    """
    from trendlake.session import scratch_path

    spark = pages.sparkSession
    raw, ready = scratch_path(spark, "warc-monolithic"), scratch_path(spark, "warc-members")
    write_monolithic(page_records(pages, id_col=id_col, url_col=url_col, html_col=html_col), raw)
    back = read_indexed(normalise(spark, raw, ready))
    kind = pages.schema[id_col].dataType
    return back.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers").cast(kind).alias("refers_to"))
