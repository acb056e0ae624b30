"""Bytes of files in order: digests and exact copies at any size, in constant memory.

Spark's own binary reader holds a file whole and stops at 2 GB; lines lose carriage returns and tell nothing of
a missing last line end. Digests like MD5 are sequential, so a file, or the files of a folder that are put
together, are one task's; files are dealt to tasks one by one. Nothing of the bytes passes between tasks.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes held at once.
CHUNK = 4 << 20
#: Tasks that files are dealt to at most.
TASKS = 20_000


def opened(path: str):
    """A file system and the path in it. A path without scheme is a local one. Paths are as listings give them: a ``%`` or a space in a name stands for itself."""
    from pyarrow import fs

    scheme, own = path.split(":", 1) if ":" in path.split("/")[0] else ("file", f"//{path}")
    return fs.FileSystem.from_uri(f"{scheme}:{quote(own, safe='/:@')}")


def chunks(path: str, size: int = 0) -> Iterator[bytes]:
    system, at = opened(path)
    with system.open_input_stream(at) as f:
        while part := f.read(size or CHUNK):
            yield part


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a key together, keys spread over tasks. The number of tasks is stated, else Spark would put rows as short as paths into one, whatever their files hold."""
    n = rows.select(key).distinct().count()
    return rows.repartition(max(1, min(4 * n, TASKS)), key)


def digested(size: int):
    """``path`` to ``path, bytes, md5, error``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                row = {"path": path, "bytes": None, "md5": None, "error": None}
                try:
                    digest, n = hashlib.md5(), 0
                    for part in chunks(path, size):
                        digest.update(part)
                        n += len(part)
                    row |= {"bytes": n, "md5": digest.hexdigest()}
                except OSError as e:
                    row["error"] = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_pylist([row], schema=_DIGESTS)

    return run


_DIGESTS = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("md5", pa.string()), ("error", pa.string())])


def md5_of_files(files: DataFrame, path: str = "path", chunk: int = 0) -> DataFrame:
    """``path, bytes, md5, error`` of each file: read as a stream, so of any size. A file that can't be read has only its error."""
    paths = files.select(F.col(path).cast("string").alias("path")).distinct()
    return dealt(paths, "path").mapInArrow(digested(chunk), "path string, bytes long, md5 string, error string")


def put_in_place(system, staged: str, at: str) -> None:
    """Move a whole file over what stands at ``at``, and drop the checksum file that Hadoop's local file system keeps of the old one."""
    folder, _, name = at.rpartition("/")
    side = f"{folder}/.{name}.crc"
    if system.get_file_info(side).is_file:
        system.delete_file(side)
    system.move(staged, at)


def put_together(paths: list[str], target: str, size: int) -> tuple[int, str]:
    """Copy the files to ``target``, each ending with a line end: how many bytes, and their MD5. No half-written file is left under that name."""
    system, at = opened(target)
    system.create_dir(at.rpartition("/")[0], recursive=True)
    digest, n, staged = hashlib.md5(), 0, f"{at.rpartition('/')[0]}/.{at.rpartition('/')[2]}.{uuid.uuid4().hex}"
    try:
        with system.open_output_stream(staged) as out:
            for path in paths:
                last = b"\n"
                for part in chunks(path, size):
                    out.write(part)
                    digest.update(part)
                    n, last = n + len(part), part[-1:]
                if last != b"\n":
                    out.write(b"\n")
                    digest.update(b"\n")
                    n += 1
        put_in_place(system, staged, at)
    except BaseException:
        if system.get_file_info(staged).is_file:
            system.delete_file(staged)
        raise
    return n, digest.hexdigest()


def merging(size: int):
    """Rows of ``target, path``, a target's together and in order, to ``target, files, bytes, md5, error``: one target at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(target: str, paths: list[str]) -> pa.RecordBatch:
            row = {"target": target, "files": len(paths), "bytes": None, "md5": None, "error": None}
            try:
                n, digest = put_together(paths, target, size)
                row |= {"bytes": n, "md5": digest}
            except OSError as e:
                row["error"] = f"{type(e).__name__}: {e}"
            return pa.RecordBatch.from_pylist([row], schema=_MERGED)

        now, paths = None, []
        for batch in batches:
            for target, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if target != now and paths:
                    yield merged(now, paths)
                    paths = []
                now = target
                paths.append(path)
        if paths:
            yield merged(now, paths)

    return run


_MERGED = pa.schema([("target", pa.string()), ("files", pa.int64()), ("bytes", pa.int64()), ("md5", pa.string()), ("error", pa.string())])


def merge_bytes(files: DataFrame, target: str, path: str, order: str, chunk: int = 0) -> DataFrame:
    """Put the files of each ``target`` together in ``order``: ``target, files, bytes, md5, error``.

    A file that lacks its last line end gets one; all other bytes are kept. A target whose source can't be read
    has an error, and what stood there before stays; the others are not touched by it. The frame writes files when it is
    computed, so compute it once. A task that is run again writes the same file anew and moves it over the old one.
    """
    rows = files.select(F.col(target).alias("target"), F.col(path).alias("path"), F.col(order).alias("_o"))
    rows = dealt(rows, "target").sortWithinPartitions("target", "_o").select("target", "path")
    return rows.mapInArrow(merging(chunk), "target string, files long, bytes long, md5 string, error string")


def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``path`` to ``path, error``: each file is removed; one that is gone already is no error."""
    for batch in batches:
        rows = []
        for path in batch.column(0).to_pylist():
            row = {"path": path, "error": None}
            try:
                system, at = opened(path)
                for file in (at, f"{at.rpartition('/')[0]}/.{at.rpartition('/')[2]}.crc"):
                    if system.get_file_info(file).is_file:
                        system.delete_file(file)
            except OSError as e:
                row["error"] = f"{type(e).__name__}: {e}"
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("error", pa.string())]))


def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``path, to`` to ``to, error``: each file is moved over what is there. A file that a task moved before it was run again is in place already."""
    for batch in batches:
        rows = []
        for path, to in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            row = {"to": to, "error": None}
            try:
                system, source = opened(path)
                at = opened(to)[1]
                if system.get_file_info(source).is_file or not system.get_file_info(at).is_file:
                    system.create_dir(at.rpartition("/")[0], recursive=True)
                    put_in_place(system, source, at)
            except OSError as e:
                row["error"] = f"{type(e).__name__}: {e}"
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("to", pa.string()), ("error", pa.string())]))


def move(files: DataFrame) -> DataFrame:
    """Move each ``path`` to ``to``: ``to, error``. Tasks move files side by side; done when the frame is computed."""
    return files.select("path", "to").mapInArrow(moved, "to string, error string")


def remove_files(files: DataFrame) -> DataFrame:
    """Remove each ``path``: ``path, error``. Done when the frame is computed."""
    return files.select("path").mapInArrow(removed, "path string, error string")


def hashing(kind: str, between: bytes):
    """``key, line`` with a key's rows together and in order to ``key, fingerprint``: the digest of the lines with ``between`` between them, in constant memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.string()), pa.array([digest.hexdigest()])], names=["key", "fingerprint"])

        for batch in batches:
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if digest is None or key != now:
                    if digest is not None:
                        yield told()
                    now, digest = key, hashlib.new(kind)
                elif between:
                    digest.update(between)
                digest.update(line.encode())
        if digest is not None:
            yield told()

    return run


def sha256_of_lines(rows: DataFrame, keys: list[str], line: str, order: str) -> DataFrame:
    """``digest_of_lines`` by SHA-256, with nothing between the lines."""
    return digest_of_lines(rows, keys, line, order, "sha256", "")


def digest_of_lines(rows: DataFrame, keys: list[str], line: str, order: str, kind: str, between: str) -> DataFrame:
    """``keys, fingerprint``: the digest of each key's lines in order. Rows are sorted by Spark, which spills; no key is gathered."""
    key = F.to_json(F.struct(*keys))
    lines = rows.select(key.alias("_key"), F.col(line).alias("_line"), F.col(order).alias("_o")).repartition("_key").sortWithinPartitions("_key", "_o", "_line").select("_key", "_line")
    found = lines.mapInArrow(hashing(kind, between.encode()), "key string, fingerprint string")
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return found.select(F.from_json("key", kinds).alias("k"), "fingerprint").select(*[F.col(f"k.{k}").alias(k) for k in keys], "fingerprint")
