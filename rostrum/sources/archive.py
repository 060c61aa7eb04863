"""Zip archives as DataFrames of documents ``(archive, entry, body)``.

Archives up to a size are read whole by Spark's own file source. A larger one
would keep a single task busy, so its directory is read first and ranges of
entries are handed to as many tasks as its size calls for. Either way entries are
chosen by name before they are decompressed, by the same decoder.
"""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIB = 1 << 20
_DOCUMENT = "archive string, entry string, body string"
_RANGE = (
    "archive string, start bigint, stop bigint,"
    " members array<struct<entry:string,offset:bigint,size:bigint,length:bigint,method:int,flags:int,crc:bigint>>"
)
_BATCH_CHARS = 4 * MIB
# Beyond this many ranges a task reads several of them.
_MOST_TASKS = 20_000
# Fixed values of the zip format: the local header is 30 bytes and the lengths
# of the name and the extra field that follow it stand at byte 26.
_HEADER_BYTES = 30
_LENGTHS_AT = 26


def _batches(rows: Iterator[tuple[str, str, str]]) -> Iterator[pa.RecordBatch]:
    """Pack rows into Arrow batches of bounded text size."""
    held: list[tuple[str, str, str]] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= _BATCH_CHARS:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple[str, str, str]]) -> pa.RecordBatch:
    columns = [pa.array(column, pa.string()) for column in zip(*rows)]
    return pa.RecordBatch.from_arrays(columns, names=["archive", "entry", "body"])


def _text(data: bytes) -> str:
    return data.decode("utf-8-sig")


# Beginnings and ends of the names of wanted entries; none wants all.
Names = Sequence[tuple[str, str]]


def _wanted(info: zipfile.ZipInfo, names: Names) -> bool:
    return not info.is_dir() and (
        not names or any(info.filename.startswith(a) and info.filename.endswith(b) for a, b in names)
    )


def unzip(archives: DataFrame, names: Names = ()) -> DataFrame:
    """Documents of archives held as ``(path, content)``, the columns of ``binaryFile``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, str, str]]:
            for batch in batches:
                for path, content in zip(batch["path"], batch["content"]):
                    with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                        for info in archive.infolist():
                            if _wanted(info, names):
                                yield path.as_py(), info.filename, _text(archive.read(info))

        return _batches(rows())

    return archives.select("path", "content").mapInArrow(read, _DOCUMENT)


# Hadoop's scheme of a store, Arrow's, and where Hadoop keeps what Arrow asks for.
_STORES = {
    "s3a": "s3",
    "s3n": "s3",
    "s3": "s3",
    "gs": "gs",
    "hdfs": "hdfs",
    "abfs": "abfs",
    "abfss": "abfss",
    "file": "file",
}
_S3_OPTIONS = {
    "access_key": "fs.s3a.access.key",
    "secret_key": "fs.s3a.secret.key",
    "session_token": "fs.s3a.session.token",
    "region": "fs.s3a.endpoint.region",
    "endpoint_override": "fs.s3a.endpoint",
}
# The longest file that Spark's binary source can hold in a row.
_LONGEST_WHOLE = (1 << 31) - 1 - 4096


def _options(spark: SparkSession) -> dict[str, str]:
    """The session's own settings of the S3 store, by Arrow's names."""
    settings = spark._jsc.hadoopConfiguration()
    found = {name: settings.get(key) for name, key in _S3_OPTIONS.items()}
    return {name: value for name, value in found.items() if value}


def _open(path: str, options: dict[str, str]) -> pa.NativeFile:
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    if _STORES[scheme] == "s3":
        return fs.S3FileSystem(**options).open_input_file(rest.lstrip("/"))
    files, inner = fs.FileSystem.from_uri(quote(f"{_STORES[scheme]}:{rest}", safe=":/@"))
    return files.open_input_file(inner)


def _list_ranges(range_bytes: int, names: Names, options: dict[str, str]):
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                yield from (
                    pa.RecordBatch.from_pylist([found], schema=_RANGE_ARROW)
                    for found in _ranges_of(path, range_bytes, names, options)
                )

    return ranges


_RANGE_ARROW = pa.schema(
    [
        ("archive", pa.string()),
        ("start", pa.int64()),
        ("stop", pa.int64()),
        (
            "members",
            pa.list_(
                pa.struct(
                    [
                        ("entry", pa.string()),
                        ("offset", pa.int64()),
                        ("size", pa.int64()),
                        ("length", pa.int64()),
                        ("method", pa.int32()),
                        ("flags", pa.int32()),
                        ("crc", pa.int64()),
                    ]
                )
            ),
        ),
    ]
)


def _ranges_of(
    path: str, range_bytes: int, names: Names, options: dict[str, str]
) -> Iterator[dict]:
    """Ranges of the wanted entries; what lies between them is not read."""
    with _open(path, options) as handle, zipfile.ZipFile(handle) as archive:
        infos = sorted(archive.infolist(), key=lambda info: info.header_offset)
        stops = [info.header_offset for info in infos[1:]] + [archive.start_dir]
    current: dict | None = None
    for info, stop in zip(infos, stops):
        if _wanted(info, names):
            if current is None:
                current = {"archive": path, "start": info.header_offset, "members": []}
            current["members"].append(
                {
                    "entry": info.filename,
                    "offset": info.header_offset,
                    "size": info.compress_size,
                    "length": info.file_size,
                    "method": info.compress_type,
                    "flags": info.flag_bits,
                    "crc": info.CRC,
                }
            )
            current["stop"] = stop
        if current is not None and (stop - current["start"] >= range_bytes or not _wanted(info, names)):
            yield current
            current = None
    if current is not None:
        yield current


def _inflate(block: memoryview, at: int, member: dict) -> bytes:
    """A member by the decoder of whole archives: it becomes an archive of its own."""
    name, extra = struct.unpack_from("<HH", block, at + _LENGTHS_AT)
    size = _HEADER_BYTES + name + extra + member["size"]
    written = bytes(block[at + _HEADER_BYTES : at + _HEADER_BYTES + name])
    local = bytes(block[at : at + size])
    crc, packed, length = member["crc"], member["size"], member["length"]
    entry = struct.pack(
        "<4s6H3L5H2L",
        *(b"PK\x01\x02", 63, 63, member["flags"], member["method"], 0, 0, crc, packed, length),
        *(len(written), 0, 0, 0, 0, 0, 0),
    )
    end = struct.pack("<4s4H2LH", b"PK\x05\x06", 0, 0, 1, 1, len(entry) + name, len(local), 0)
    with zipfile.ZipFile(io.BytesIO(local + entry + written + end)) as archive:
        return archive.read(archive.infolist()[0])


def _read_ranges(options: dict[str, str]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, str, str]]:
            for batch in batches:
                for found in batch.to_pylist():
                    with _open(found["archive"], options) as handle:
                        handle.seek(found["start"])
                        block = memoryview(handle.read(found["stop"] - found["start"]))
                    for member in found["members"]:
                        data = _inflate(block, member["offset"] - found["start"], member)
                        yield found["archive"], member["entry"], _text(data)

        return _batches(rows())

    return read


def read_archives(
    spark: SparkSession,
    path: str,
    *,
    names: Names = (),
    whole_up_to: int = 128 * MIB,
    range_bytes: int = 32 * MIB,
) -> DataFrame:
    """The files in the zip archives under ``path`` as ``(archive, entry, body)``.

    ``path`` is anything Spark's file sources take. ``names`` are beginnings and
    ends of wanted entries; others are neither decompressed nor decoded. Archives
    longer than ``whole_up_to`` are opened by the executors through Arrow's file
    systems and read in ranges of about ``range_bytes``; in a store that Arrow
    does not know they are read whole too, as long as Spark can hold them. What a
    task unpacks from whole archives is dealt out anew, so that one archive does
    not keep one task parsing.
    """
    files = spark.read.format("binaryFile").load(path)
    # File listing only: no content is read to learn the lengths.
    scheme = F.when(F.col("path").contains(":"), F.substring_index("path", ":", 1)).otherwise("file")
    known = scheme.isin(*_STORES)
    in_ranges = known & (F.col("length") > whole_up_to)
    listed = files.groupBy(scheme.alias("scheme"), in_ranges.alias("in_ranges")).agg(
        F.sum("length").alias("total"), F.max("length").alias("longest")
    )
    sizes = listed.collect()
    for row in sizes:
        if not row["in_ranges"] and row["longest"] > _LONGEST_WHOLE:
            raise ValueError(f"archives over 2 GiB cannot be read from {row['scheme']}:")
    whole = sum(row["total"] for row in sizes if not row["in_ranges"])
    total = sum(row["total"] for row in sizes if row["in_ranges"])
    documents = unzip(files.where(~in_ranges), names)
    if whole > range_bytes:
        documents = documents.repartition(min(-(-whole // range_bytes), _MOST_TASKS))
    if not total:
        return documents
    options = _options(spark)
    ranges = (
        files.where(in_ranges)
        .select("path")
        .mapInArrow(_list_ranges(range_bytes, names, options), _RANGE)
        .repartition(min(-(-total // range_bytes), _MOST_TASKS))
    )
    return documents.unionByName(ranges.mapInArrow(_read_ranges(options), _DOCUMENT))


def json_documents(documents: DataFrame, prefix: str) -> DataFrame:
    """The JSON documents of one folder of the archives."""
    return documents.where(F.col("entry").startswith(prefix) & F.col("entry").endswith(".json"))


def folder_key(entry: Column) -> Column:
    """Foreign key held in an entry's path: the folder below ``json/``, else the first folder.

    For a file directly in ``json/`` that is the file's own name; without any
    folder it is ``inconnu``.
    """
    parts = F.split(F.btrim(entry, F.lit("/")), "/")
    return (
        F.when(F.size(parts) < 2, F.lit("inconnu"))
        .when(F.get(parts, 0) == "json", F.get(parts, 1))
        .otherwise(F.get(parts, 0))
    )
