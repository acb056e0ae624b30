"""Versions of tables and of sets of files: a new one is seen whole or not at all, and writers can't overtake each other.

A store is a folder with data, which is only ever added to, and numbered version files, which are created and never changed.
A version names the folders of every table, or the listing of a set. A writer builds on the newest version and
creates the next number; if another writer was first, that fails, and the work is done again on what is there now. Readers
of an older version go on reading it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of additions to a table, after which it is written whole again.
ADDITIONS = 64
#: Times that a writer starts again.
TRIES = 8


class Conflict(RuntimeError):
    """Other writers were first, again and again."""


def _context(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def newest(spark: SparkSession, root: str) -> int:
    """The number of the newest version, 0 for none."""
    at, fs = _context(spark, f"{root}/versions")
    if not fs.exists(at):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return max((int(n) for n in names if n.isdigit()), default=0)


def read_version(spark: SparkSession, root: str, n: int) -> dict:
    return json.loads(spark.read.text(f"{root}/versions/{n:012d}", wholetext=True).head()[0]) if n else {}


def create_version(spark: SparkSession, root: str, n: int, content: dict) -> bool:
    """Create version ``n``; false if it is there already. It is written aside and moved, which fails where the name is taken."""
    at, fs = _context(spark, f"{root}/versions/{n:012d}")
    aside, _ = _context(spark, f"{root}/versions/.{uuid.uuid4().hex}")
    fs.mkdirs(at.getParent())
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        hadoop.FileContext.getFileContext(at.toUri() if at.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()).rename(aside, at, options)
    except Exception as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(e):
            return False
        raise
    return True


def update(spark: SparkSession, root: str, change: Callable[[dict], dict], tries: int = TRIES) -> int:
    """Create the next version from ``change`` of the newest one's content, again on a newer one if another writer was first. Its number."""
    for _ in range(tries):
        n = newest(spark, root)
        content = change(read_version(spark, root, n))
        if create_version(spark, root, n + 1, content):
            return n + 1
    raise Conflict(f"{root}: other writers were first {tries} times")


# Tables. A version holds, for each table, the folders of its rows by study; those of tables without studies under "".


def read_table(spark: SparkSession, version: dict, table: str) -> DataFrame:
    """A table of a version; ``schema`` in the version tells its columns, so that it may be empty."""
    kept = version["tables"][table]
    paths = [p for folders in kept["folders"].values() for p in folders]
    return spark.read.schema(kept["schema"]).parquet(*paths) if paths else spark.createDataFrame([], kept["schema"])


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def write_changes(spark: SparkSession, root: str, change: Callable[[dict[str, DataFrame]], dict[str, tuple[str, DataFrame]]], tries: int = TRIES) -> int:
    """Change the tables of a store: ``change`` gets them and returns, for each table to change, how and with which rows.

    ``("append", rows)``: rows are added. ``("studies", rows)``: the rows of the studies in ``rows`` are replaced; other studies' files are
    not touched. ``("whole", rows)``: all rows are replaced. ``change`` is called again, with the tables as they are then, if another writer was
    first; so numbers that it gives to new rows are never given twice. What a lost try wrote is removed.
    """

    def once(version: dict) -> dict:
        folder = f"{root}/data/{uuid.uuid4().hex}"
        written.append(folder)
        tables = {t: dict(v) for t, v in version.get("tables", {}).items()}
        for table, (how, rows) in change({t: read_table(spark, version, t) for t in tables}).items():
            at = f"{folder}/{table}"
            before = tables.get(table, {"folders": {}})["folders"]
            if how == "studies":
                # A column of its own in the path, so that the files keep theirs.
                rows.withColumn("_study", F.col("study_id")).repartition("_study").write.partitionBy("_study").parquet(at)
                found = [r[0] for r in rows.select("study_id").distinct().collect()]
                folders = before | {s: [f"{at}/_study={s}"] for s in found}
            else:
                rows.write.parquet(at)
                folders = {"": [*(before.get("", []) if how == "append" else []), at]}
            kept = {"schema": _ddl(rows), "folders": folders}
            if len(folders.get("", [])) > ADDITIONS:
                read_table(spark, {"tables": {table: kept}}, table).write.parquet(f"{at}-whole")
                kept["folders"] = {"": [f"{at}-whole"]}
            tables[table] = kept
        return {"tables": tables}

    written: list[str] = []
    try:
        n = update(spark, root, once, tries)
    except Exception:
        _drop(spark, written)
        raise
    _drop(spark, written[:-1])
    return n


def _drop(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        at, fs = _context(spark, folder)
        fs.delete(at, True)


def tables(spark: SparkSession, root: str, n: int | None = None) -> dict[str, DataFrame]:
    """The tables of the newest version, or of the ``n``th."""
    version = read_version(spark, root, newest(spark, root) if n is None else n)
    return {t: read_table(spark, version, t) for t in version.get("tables", {})}


# Sets of files. A version names a listing, a table of ``name, path``; files are never moved.


def publish_set(spark: SparkSession, root: str, files: DataFrame) -> int:
    """Make ``files`` (``name, path``) the store's set of files. The listing is written by tasks; readers see the old set until its version is created.

    Files that an earlier set held and this one does not are in no later reader's view; ``read_set`` of the earlier number still finds them.
    """
    at = f"{root}/data/{uuid.uuid4().hex}/listing"
    files.select("name", "path").write.parquet(at)
    return update(spark, root, lambda _: {"listing": at})


def read_set(spark: SparkSession, root: str, n: int | None = None) -> DataFrame:
    """``name, path`` of the newest set of files, or of the ``n``th; none before the first."""
    version = read_version(spark, root, newest(spark, root) if n is None else n)
    return spark.read.schema("name string, path string").parquet(version["listing"]) if version else spark.createDataFrame([], "name string, path string")
