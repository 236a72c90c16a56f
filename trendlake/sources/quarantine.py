"""Landing files of any codec, read whole or set aside with a reason.

A compressed file is inflated by a task, in pieces: once to see that it is whole and to
count its lines, and again to hand them on.  So no reader has to skip damaged files, and
no row of one is used.  Plain files have no such ends; what a cut leaves of their last
record is set aside as a record.  Every file below the path is accounted for.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.session import scratch_path, session_conf

# Names of compressed files, and of plain ones.
CODECS = ("gz", "bz2", "zst", "deflate", "lz4", "snappy")
PLAIN = ("json", "jsonl", "ndjson", "txt")
#: Bytes that are inflated at once, bytes that are read for it, and files in one batch.
PIECE, STEP, FILES_PER_BATCH = 1 << 20, 1 << 16, 4


def _engine(codec: str):
    import bz2
    import zlib

    if codec == "gz":
        return zlib.decompressobj(31)
    if codec == "deflate":
        return zlib.decompressobj()
    if codec == "bz2":
        return bz2.BZ2Decompressor()
    if codec == "zst":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj()
    raise ValueError(f"no decoder for {codec}")


def inflated(codec: str, data: bytes) -> Iterator[bytes]:
    """The content of a file of one or more members, in pieces; ``ValueError`` where it is
    damaged, ends early or has no decoder. (Frames written without a checksum show no changed
    bytes that still decode.)"""
    at = 0
    if not data:
        raise ValueError("the file is empty")
    while at < len(data):
        engine = _engine(codec)
        while not engine.eof and at < len(data):
            given = data[at : at + STEP]
            at += len(given)
            while not engine.eof:
                try:
                    out = engine.decompress(given) if codec == "zst" else engine.decompress(given, PIECE)
                except Exception as e:  # each library has its own; all say that the data are damaged
                    raise ValueError(f"{type(e).__name__}: {e}") from e
                if not out:
                    break
                yield out
                given = getattr(engine, "unconsumed_tail", b"")  # what a bounded output left of the input
        if not engine.eof:
            raise ValueError("the stream ends early")
        at -= len(engine.unused_data)


def lines(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The lines of a stream, ended by ``\\n``, ``\\r\\n`` or ``\\r``."""
    held: list[bytes] = []
    for piece in pieces:
        if b"\n" not in piece and b"\r" not in piece:
            held.append(piece)
            continue
        data = b"".join([*held, piece])
        end = max(data.rfind(b"\n"), data.rfind(b"\r", 0, len(data) - 1)) + 1  # a last \r may be half of \r\n
        held = [data[end:]]
        yield from data[:end].splitlines()
    yield from b"".join(held).splitlines()


def _probe(batches) -> Iterator:
    """``file, line, fault, n`` for files of ``path, content``: the lines of whole files, and one
    row with the fault and the lines before it for each other."""
    import pyarrow as pa

    def rows(file, found, fault=None, n=None):
        return pa.RecordBatch.from_arrays([
            pa.array([file] * len(found), pa.string()), pa.array(found, pa.binary()), pa.array([fault] * len(found), pa.string()),
            pa.array([n] * len(found), pa.int64())], names=["file", "line", "fault", "n"])

    for batch in batches:
        for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            codec, data, n = file.rsplit(".", 1)[-1], content.as_py(), 0
            try:
                for _ in lines(inflated(codec, data)):
                    n += 1
            except ValueError as e:
                yield rows(file, [None], str(e), n)
                continue
            part, size = [], 0
            for line in lines(inflated(codec, data)):
                part.append(line)
                size += len(line)
                if size > PIECE or len(part) >= 10_000:
                    yield rows(file, part)
                    part, size = [], 0
            if part:
                yield rows(file, part)


def _files(spark: SparkSession, path: str, names: tuple[str, ...] | None = None) -> DataFrame:
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if names is not None:
        r = r.option("pathGlobFilter", "*.{" + ",".join(names) + "}")
    return r.load(path)


def read_with_quarantine(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)`` of the JSON lines (an object each) below ``path``, when some input
    may be bad.

    Rows come only from whole files and well-formed records, with their ``source_file``.
    ``quarantine`` has ``kind, file, detail, lines``: a row for every file that is damaged, has a
    codec without decoder or a name that says neither codec nor plain text (kind 'file',
    ``lines`` read before the damage), and for every malformed record or one that is not
    UTF-8 (kind 'record', one line). Nothing is dropped but blank lines. A compressed file is
    held by its task and has at most 2 GB; plain files are read as a stream and split.
    """
    probed_path = scratch_path(spark, "landing-probe")
    with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(FILES_PER_BATCH)}):
        _files(spark, path, CODECS).select("path", "content").mapInArrow(_probe, "file string, line binary, fault string, n long") \
            .write.parquet(probed_path)
    probed = spark.read.parquet(probed_path)
    plain = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(PLAIN) + "}").text(path)
    text = plain.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").cast("binary").alias("line")).unionByName(
        probed.where(F.col("fault").isNull()).select(F.col("file").alias("source_file"), "line"))

    kept = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    valid = F.is_valid_utf8(F.col("line").cast("string"))
    value = F.make_valid_utf8(F.col("line").cast("string"))
    read = text.select("source_file", value.alias("value"), valid.alias("valid")).where(F.trim("value") != "") \
        .select("source_file", "value", "valid", F.from_json("value", kept, {"mode": "PERMISSIVE"}).alias("r"))
    good = F.col("valid") & F.col("r").isNotNull() & F.col("r._corrupt_record").isNull()
    rows = read.where(good).select("r.*", "source_file").drop("_corrupt_record")
    records = read.where(~good).select(F.lit("record").alias("kind"), F.col("source_file").alias("file"),
                                       F.coalesce("r._corrupt_record", "value").alias("detail"), F.lit(1).cast("long").alias("lines"))
    damaged = probed.where(F.col("fault").isNotNull()).select(F.lit("file").alias("kind"), "file", F.col("fault").alias("detail"), F.col("n").alias("lines"))
    named = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*CODECS, *PLAIN) & F.col("path").rlike(r"\.[a-z0-9]+$")
    strange = _files(spark, path).select("path").where(~named).select(
        F.lit("file").alias("kind"), F.col("path").alias("file"), F.lit("neither a known codec nor plain text by its name").alias("detail"),
        F.lit(None).cast("long").alias("lines"))
    return rows, damaged.unionByName(strange).unionByName(records)


def landing_report(rows: DataFrame, quarantine: DataFrame) -> DataFrame:
    """``file, kept, malformed, damaged, lines_lost`` for every file that gave or should have given rows."""
    zero = F.lit(0).cast("long")
    kept = rows.select(F.col("source_file").alias("file"), F.lit(1).cast("long").alias("kept"), zero.alias("malformed"), zero.alias("damaged"), zero.alias("lines_lost"))
    is_file = F.col("kind") == "file"
    lost = quarantine.select("file", zero.alias("kept"), (~is_file).cast("long").alias("malformed"), is_file.cast("long").alias("damaged"),
                             F.when(is_file, F.coalesce("lines", zero)).otherwise(zero).alias("lines_lost"))
    return kept.unionByName(lost).groupBy("file").agg(
        F.sum("kept").alias("kept"), F.sum("malformed").alias("malformed"), (F.max("damaged") > 0).alias("damaged"), F.sum("lines_lost").alias("lines_lost"))
