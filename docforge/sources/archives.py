"""Members of ZIP archives as rows, each read by ranges: one large archive is the work of many tasks."""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.session import ship

#: Compressed bytes that a task reads of one archive, about.
RUN_BYTES = 16 << 20
#: Largest member that is read, uncompressed; a larger one is a row with an error.
LARGEST = 1 << 30
LOCAL_HEAD, STORED, DEFLATED = 30, 0, 8
#: Members of a table that a task hands on: as many, or as many bytes of content, whichever comes first.
OUT_ROWS, OUT_BYTES = 4096, 4 << 20
MEMBER_OUT = ["path", "member", "content", "error"]
MEMBER = "path string, member string, start long, packed long, size long, method int, crc long, locked boolean, error string"


def file_at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (local, HDFS, S3, GCS), and the path in it."""
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def member_index(archives: DataFrame, suffix: str = ".pdf") -> DataFrame:
    """MEMBER rows of archives (path): what their central directories say of members with a suffix, in any case.

    Only the directories are read. An archive without a sound one is a row with an error and no member.
    """
    ship(archives.sparkSession)
    names = [f.split()[0] for f in MEMBER.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                try:
                    system, place = file_at(path)
                    with system.open_input_file(place) as file, zipfile.ZipFile(file) as archive:
                        found = [(path, i.filename, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC, bool(i.flag_bits & 1), None) for i in archive.infolist() if i.filename.lower().endswith(suffix)]
                except (zipfile.BadZipFile, OSError, NotImplementedError, ValueError) as problem:
                    kind = "BadZipFile" if isinstance(problem, ValueError) else type(problem).__name__
                    found = [(path, None, None, None, None, None, None, None, f"broken archive: {kind}")]
                table = pd.DataFrame(found, columns=names)
                yield table.astype({"start": "Int64", "packed": "Int64", "size": "Int64", "method": "Int32", "crc": "Int64", "locked": "boolean"})

    return archives.select("path").mapInPandas(run, MEMBER)


def read_member(file: object, start: int, packed: int, size: int, method: int, crc: int, locked: bool) -> bytes:
    """A member's bytes, by its local head and its own range alone."""
    if locked:
        raise ValueError("encrypted")
    if method not in (STORED, DEFLATED):
        raise ValueError(f"method {method}")
    if size > LARGEST:
        raise ValueError(f"{size} bytes")
    head = file.read_at(LOCAL_HEAD, start)
    if len(head) < LOCAL_HEAD or head[:4] != b"PK\x03\x04":
        raise ValueError("no local head")
    name, extra = struct.unpack("<HH", head[26:])
    data = file.read_at(packed, start + LOCAL_HEAD + name + extra)
    if method == DEFLATED:
        inflate = zlib.decompressobj(-zlib.MAX_WBITS)
        data = inflate.decompress(data, size + 1)
    if len(data) != size or zlib.crc32(data) != crc:
        raise ValueError("wrong size or checksum")
    return data


def archive_members(archives: DataFrame, suffix: str = ".pdf", run_bytes: int = RUN_BYTES) -> DataFrame:
    """(path, member, content, error) of the members of archives (path) with a suffix.

    Members are dealt by runs of ``run_bytes`` of their archive over all tasks, and read in the order in which they stand.
    A member that can't be read is a row with an error, as is a broken archive; members that repeat a name are rows of
    their own.
    """
    index = member_index(archives, suffix)
    run_of = F.floor(F.col("start") / run_bytes)
    dealt = index.withColumn("_run", run_of).repartition("path", "_run").sortWithinPartitions("path", "start").drop("_run")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, file = None, None
        out, size = [], 0
        for batch in batches:
            for m in batch.itertuples(index=False):
                content, error = None, m.error
                if pd.notna(m.member):
                    try:
                        if m.path != opened:
                            system, place = file_at(m.path)
                            opened, file = m.path, system.open_input_file(place)
                        content = read_member(file, int(m.start), int(m.packed), int(m.size), int(m.method), int(m.crc), bool(m.locked))
                    except (ValueError, OSError, zlib.error) as problem:
                        error = f"broken member: {problem}"
                out.append((m.path, m.member, content, error))
                size += len(content or b"")
                if size >= OUT_BYTES or len(out) >= OUT_ROWS:
                    yield pd.DataFrame(out, columns=MEMBER_OUT)
                    out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=MEMBER_OUT)

    return dealt.mapInPandas(run, "path string, member string, content binary, error string")
