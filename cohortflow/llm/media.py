"""Media columns: payloads in archives, read by a data source of byte ranges (operator 9).

Payloads are stored as 8-bit grey PNG pictures, members of ZIP archives in the shared
folder, one archive for each writing task. The data source plans partitions as byte
ranges of the archives in a directory; a partition's reader looks up the members
that begin in its range in the archive's own directory, reads each by its offset and
yields them as Arrow batches of bounded size. A member that can't be read is tried
again by itself, and at last is returned with its error; no other member suffers.

An archive's own directory has to be read whole. So that this stays a small part of
the work, a range holds at least 16 times the bytes of its archive's directory. A folder's
list has the sizes of directories, so that its ranges are planned once; without a list, ranges
are taken together when they are read: the first of them reads all, the others nothing.
"""

from __future__ import annotations

import hashlib
import lzma
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cohortflow.llm.common import documents, new_path, writing

UNIT = 576
PAD = b"\xff"
#: Sides of a picture in samples: payloads are whole multiples of a row.
WIDTH = UNIT
SIGNATURE = b"\x89PNG\r\n\x1a\n"
RANGE = 16 << 20
BATCH = 4 << 20
TRIES = 3
#: Ranges grow so that a folder has at most about so many of them.
RANGES = 65_536
#: A reader takes at least so many times the bytes of the archive's directory, which it reads too.
SHARE = 16
#: What a damaged, encrypted or foreign member can raise, and only it.
BROKEN = (OSError, zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, RuntimeError, NotImplementedError, ValueError, struct.error, MemoryError)


def pad(text: bytes) -> bytes:
    return text + PAD * (-len(text) % UNIT or (0 if text else UNIT))


def unpadded(payload: bytes) -> bytes:
    """UTF-8 holds no byte 255, so all of them at the end are padding."""
    return payload.rstrip(PAD)


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes, level: int = 1) -> bytes:
    """An 8-bit grey picture, ``WIDTH`` samples wide, whose samples are the payload's bytes."""
    rows = len(payload) // WIDTH
    lines = np.zeros((rows, WIDTH + 1), dtype=np.uint8)  # each line begins with filter 0
    lines[:, 1:] = np.frombuffer(payload, dtype=np.uint8).reshape(rows, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, rows, 8, 0, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + chunk(b"IEND", b"")


def from_png(data: bytes) -> np.ndarray:
    """The samples of an 8-bit grey picture with unfiltered lines, as rows. Checksums are verified."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG picture")
    at, size, body = 8, None, []
    while at < len(data):
        (n,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        part = data[at + 8 : at + 8 + n]
        if len(part) < n or data[at + 8 + n : at + 12 + n] != struct.pack(">I", zlib.crc32(kind + part)):
            raise ValueError(f"chunk {kind!r} is damaged")
        if kind == b"IHDR":
            width, height, *rest = struct.unpack(">IIBBBBB", part)
            if rest != [8, 0, 0, 0, 0]:
                raise ValueError("only plain 8-bit grey pictures are read")
            if not width or not height:
                raise ValueError("the picture is empty")
            size = (height, width)
        elif kind == b"IDAT":
            body.append(part)
        at += 12 + n
    if size is None:
        raise ValueError("the picture has no header")
    lines = np.frombuffer(zlib.decompress(b"".join(body)), dtype=np.uint8).reshape(size[0], size[1] + 1)
    if lines[:, 0].any():
        raise ValueError("only unfiltered lines are read")
    return lines[:, 1:]


def feature(samples: np.ndarray) -> str:
    """Mean, deviation and entropy of the samples, and their histogram in eight bins (per mille)."""
    counts = np.bincount(samples.ravel(), minlength=256)
    n = int(counts.sum())
    p = counts[counts > 0] / n
    levels = np.arange(256)
    mean = float((counts * levels).sum()) / n
    spread = float(np.sqrt(max(0.0, float((counts * levels**2).sum()) / n - mean**2)))
    bins = counts.reshape(8, 32).sum(axis=1) * 1000 // n
    return f"mean={mean:.4f};std={spread:.4f};entropy={float(-(p * np.log2(p)).sum()):.4f};hist={'/'.join(map(str, bins.tolist()))}"


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_archives(folder: str):
    """``doc_id, text`` to one archive for each task; a row for it: ``name, members, directory``, the last the bytes of its directory.

    A task that is tried again writes another archive; only those of successful tasks are named in the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = filesystem(folder)
        name, members = f"{uuid.uuid4().hex}.zip", 0
        with system.open_output_stream(f"{base}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                    key = "null" if doc_id.as_py() is None else str(doc_id.as_py())
                    media = to_png(pad((text.as_py() or "").encode()))
                    archive.writestr(zipfile.ZipInfo(f"{members:09d}/{key}.png"), media)
                    members += 1
            archive.close()
            directory = out.tell() - archive.start_dir
        yield pa.RecordBatch.from_pylist([{"name": name, "members": members, "directory": directory}] if members else [], schema=pa.schema([("name", pa.string()), ("members", pa.int64()), ("directory", pa.int64())]))

    return run


@dataclass
class ArchiveRange(InputPartition):
    uri: str
    start: int
    end: int
    planned: bool = False


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder = options["path"]
        self.listed = options.get("listed", "false") == "true"
        self.range = int(options.get("rangeBytes", RANGE))
        self.tries = int(options.get("tries", TRIES))

    def partitions(self) -> list[ArchiveRange]:
        """Byte ranges of the archives of the folder, or of those in its list. Only names and sizes are looked at."""
        from pyarrow import fs

        system, base = filesystem(self.folder)
        files = [f for f in system.get_file_info(fs.FileSelector(base)) if f.is_file and f.base_name.endswith(".zip")]
        files.sort(key=lambda f: f.base_name)
        size = max(self.range, -(-sum(f.size for f in files) // RANGES))
        if not self.listed:
            out = [ArchiveRange(f"{self.folder}/{f.base_name}", at, at + size) for f in files for at in range(0, f.size, size)]
            return out or [ArchiveRange("", 0, 0)]
        table = pq.read_table(f"{base}/{LIST}", filesystem=system, columns=["name", "directory"])
        listed = dict(zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True))
        files = [f for f in files if f.base_name in listed]
        if len(files) < len(listed):
            raise FileNotFoundError(f"{self.folder} lacks archives: {sorted(listed.keys() - {f.base_name for f in files})[:3]}")
        out = []
        for f in files:
            step = max(size, SHARE * listed[f.base_name])
            out += [ArchiveRange(f"{self.folder}/{f.base_name}", at, at + step, True) for at in range(0, f.size - listed[f.base_name], step)]
        return out or [ArchiveRange("", 0, 0)]

    def member(self, archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> tuple[bytes | None, str | None]:
        for left in reversed(range(self.tries)):
            try:
                return archive.read(info), None
            except BROKEN as e:
                if not left:
                    return None, f"{type(e).__name__}: {e}"
                time.sleep(0.05 * 2 ** (self.tries - left))
        return None, "never tried"

    def read(self, partition: ArchiveRange) -> Iterator[pa.RecordBatch]:
        if not partition.uri:
            return
        system, base = filesystem(partition.uri)
        with system.open_input_file(base) as f:
            together = step = partition.end - partition.start
            if not partition.planned:
                together = -(-SHARE * directory_bytes(f) // step) * step or step
                if partition.start % together:
                    return
            try:
                archive = zipfile.ZipFile(f)
            except BROKEN as e:
                if not partition.start:  # no directory: the archive itself is the one thing to tell
                    yield pa.RecordBatch.from_pylist([{"archive": partition.uri, "error": f"{type(e).__name__}: {e}"}], schema=MEMBERS)
                return
            rows, held = [], 0
            for info in archive.infolist():
                if not partition.start <= info.header_offset < partition.start + together:
                    continue
                data, error = self.member(archive, info)
                rows.append({"archive": partition.uri, "member": info.filename, "offset": info.header_offset, "media": data, "error": error})
                held += len(data or b"")
                if held >= BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema=MEMBERS)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=MEMBERS)


def directory_bytes(f) -> int:
    """The size of an archive's directory, from the record at its end; 0 if there is none, or it is too large for the plain record."""
    size = f.size()
    f.seek(max(0, size - (1 << 16) - 22))
    tail = f.read()
    at = tail.rfind(b"PK\5\6")
    f.seek(0)
    if at < 0 or len(tail) < at + 22:
        return 0
    found = struct.unpack_from("<I", tail, at + 12)[0]
    if found < 0xFFFFFFFF:
        return found
    far = tail.rfind(b"PK\6\6")  # the record for archives over 4 GB
    return struct.unpack_from("<Q", tail, far + 40)[0] if 0 <= far <= len(tail) - 48 else 0


MEMBERS = pa.schema([("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("media", pa.binary()), ("error", pa.string())])


class ArchiveSource(DataSource):
    """``spark.read.format("archive_members").load(folder)``: the members of a folder's ZIP archives."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return "archive string, member string, offset long, media binary, error string"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


#: Where a folder keeps the names of the archives that whole tasks have written.
LIST = "listed.parquet"


def store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write all texts of ``df`` to archives in a new folder of the shared one, with the list of those that count: the folder.

    A null text is an empty one. A null id is kept as such, equal ids as members of their own; other columns are
    not read. An empty table gives a folder with an empty list.
    """
    spark = df.sparkSession
    folder = new_path(spark, "media")
    system, base = filesystem(folder)
    system.create_dir(base, recursive=True)
    sent = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with writing(spark):
        sent.mapInArrow(write_archives(folder), "name string, members long, directory long").write.parquet(f"{folder}/{LIST}")
    return folder


def id_of(member: str | None) -> int | None:
    """The id in a member's name: null for null ids, for names that hold none and for numbers that no id can be."""
    key = (member or "").rpartition("/")[2].removesuffix(".png")
    plain = key.removeprefix("-")
    return int(key) if plain.isascii() and plain.isdigit() and len(plain) < 20 and -(1 << 63) <= int(key) < 1 << 63 else None


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members to their columns: what the payload read back and the stored form are."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            out = {"doc_id": id_of(row["member"]), "error": row["error"]}
            if row["media"] is not None:
                try:
                    samples = from_png(row["media"])
                    payload = samples.tobytes()
                    out |= {
                        "n_bytes": len(unpadded(payload)),
                        "payload_bytes": len(payload),
                        "payload_sha256": hashlib.sha256(payload).hexdigest(),
                        "tail_crc32": zlib.crc32(payload[-32:]),
                        "media_bytes": len(row["media"]),
                        "media_sha256": hashlib.sha256(row["media"]).hexdigest(),
                        "feature": feature(samples),
                    }
                except BROKEN as e:
                    out["error"] = f"{type(e).__name__}: {e}"
            rows.append(out)
        yield pa.RecordBatch.from_pylist(rows, schema=_COLUMNS)


_COLUMNS = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_bytes", "payload_bytes")], ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("error", pa.string())])
COLUMNS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"


def media_columns(spark: SparkSession, folder: str, listed: bool = False, range_bytes: int = RANGE) -> DataFrame:
    """The columns of every member of the folder's archives (or of those in its list): ``COLUMNS``.

    ``error`` is null but for a member that could not be read or decoded, or an archive without a directory, whose
    other columns are then null. ``doc_id`` is null where a member's name is no number; that is no error.
    """
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format("archive_members").option("rangeBytes", range_bytes).option("listed", listed)
    return reader.load(folder).mapInArrow(describe, COLUMNS)


def texts_as_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the texts of ``df`` as media and read them back: ``COLUMNS`` for each row.

    A null or empty text is one unit of padding. Equal texts give equal media; null and equal ids stay
    apart as rows; an empty table gives no rows. A task holds one text and one batch of members at a time.
    """
    return media_columns(df.sparkSession, store(df, id_col, text_col), listed=True)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts_as_media(documents(spark, sf_dir))
