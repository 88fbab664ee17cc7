"""Versioned tables: data files that never change, and one manifest per version (§2.8).

A table is a folder with ``data/`` and ``versions/``.  A version is a small JSON
file that lists the table's data files with their part (the month of a date), their rows
and the range of their first key.  Writers add data files, then publish the next
version; readers take the newest version and read exactly its files.

* A half-written folder is never read: only a manifest makes files part of the table.
* A version is published by a create that fails if it is there already (a hard
  link on a local disk, a rename without overwriting elsewhere).  A writer that
  loses that race builds on the winner's version and tries again.
* A merge rewrites the files that its batch can match, by part and by key range; all
  others are carried into the next version by reference.
* A writer that dies leaves files that no version lists; ``expire`` removes them.

Only manifests reach the driver: a row per data file, never a row of data.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barwise.operators.upsert import align_to_schema, dedupe_batch, upsert
from barwise.session import delete_folder, scratch, written

#: Attempts to publish before a writer gives up.
ATTEMPTS = 20
PART = "__part"


@dataclass(frozen=True)
class File:
    """One data file: its path below the table, its part, its rows, and its first key's range."""

    path: str
    part: str | None
    rows: int
    low: str | None
    high: str | None


@dataclass
class Version:
    number: int
    schema: StructType
    files: list[File] = field(default_factory=list)

    def json(self) -> str:
        return json.dumps({"number": self.number, "schema": self.schema.jsonValue(), "files": [vars(f) for f in self.files]})


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    fs, p = _fs(spark, f"{table}/versions")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def version(spark: SparkSession, table: str, number: int | None = None) -> Version | None:
    """A version's manifest; the newest one without a number; None for a table without versions."""
    if number is None:
        known = versions(spark, table)
        if not known:
            return None
        number = known[-1]
    text = spark.read.option("wholetext", True).text(f"{table}/versions/{number:012d}.json").first()[0]
    got = json.loads(text)
    return Version(got["number"], StructType.fromJson(got["schema"]), [File(**f) for f in got["files"]])


def exists(spark: SparkSession, table: str) -> bool:
    return bool(versions(spark, table))


def read(spark: SparkSession, table: str, number: int | None = None, part: list[str] | None = None) -> DataFrame:
    """A version of a table, or the files of some of its parts."""
    v = version(spark, table, number)
    if v is None:
        raise ValueError(f"no version of {table}")
    return _rows(spark, table, v.schema, [f for f in v.files if part is None or f.part in part])


def _rows(spark: SparkSession, table: str, schema: StructType, files: list[File]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{table}/{f.path}" for f in files])


def _publish(spark: SparkSession, table: str, new: Version) -> bool:
    """Make ``new`` the newest version; False if another writer has published its number."""
    jvm = spark._jvm
    name = f"{table}/versions/{new.number:012d}.json"
    draft = f"{table}/versions/.{uuid.uuid4().hex}"
    fs, p = _fs(spark, draft)
    out = fs.create(p, False)
    out.write(bytearray(new.json().encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(name)
    try:
        if fs.getUri().getScheme() == "file":
            place = lambda x: jvm.java.io.File(x.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(place(target), place(p))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(p, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception:
        if not fs.exists(target):
            raise
        return False
    finally:
        fs.delete(p, False)


def _added(spark: SparkSession, table: str, rows: DataFrame, keys: list[str], part: Column | None) -> list[File]:
    """Write ``rows`` as new data files, one part each, ordered by the keys."""
    folder = f"data/{uuid.uuid4().hex}"
    if part is None:
        rows.write.parquet(f"{table}/{folder}")
    else:
        spread = rows.withColumn(PART, part).repartitionByRange(PART, *keys).sortWithinPartitions(PART, *keys)
        spread.write.partitionBy(PART).parquet(f"{table}/{folder}")
    fs, p = _fs(spark, f"{table}/{folder}")
    found, it = {}, fs.listFiles(p, True)
    while it.hasNext():
        path = it.next().getPath()
        if path.getName().endswith(".parquet"):
            parent = path.getParent().getName()
            name = f"{parent}/{path.getName()}"
            found[name] = (f"{folder}/{name}", parent.split("=", 1)[1]) if part is not None else (f"{folder}/{path.getName()}", None)
    if not found:
        return []
    key = F.col(keys[0]).cast("string") if keys else F.lit(None).cast("string")
    name = F.array_join(F.slice(F.split(F.input_file_name(), "/"), -2, 2), "/")
    stats = (spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{table}/{folder}")
             .groupBy(name.alias("name")).agg(F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high")).collect())
    return [File(*found[r["name"]], r["rows"], r["low"], r["high"]) for r in stats]


def _advance(spark: SparkSession, table: str, schema: StructType, step: Callable[[Version], list[File]]) -> Version:
    """Publish ``step(newest version)`` as the next version, anew on each lost race."""
    for attempt in range(ATTEMPTS):
        now = version(spark, table) or Version(-1, schema)
        new = Version(now.number + 1, schema, step(now))
        if _publish(spark, table, new):
            return new
        time.sleep(min(2.0, 0.05 * 2 ** attempt))
    raise RuntimeError(f"{table}: lost {ATTEMPTS} races for a new version")


def replace(spark: SparkSession, table: str, rows: DataFrame, keys: list[str] = (), part: Column | None = None) -> Version:
    """A new version that holds ``rows`` alone."""
    files = _added(spark, table, rows, list(keys), part)
    return _advance(spark, table, rows.schema, lambda now: files)


def append(spark: SparkSession, table: str, rows: DataFrame) -> Version:
    """A new version with ``rows`` added."""
    files = _added(spark, table, rows, [], None)
    return _advance(spark, table, rows.schema, lambda now: now.files + files)


def touched(spark: SparkSession, files: list[File], batch: DataFrame, key: str, part: Column) -> list[File]:
    """The files that may hold a key of the batch: same part, and a key inside the file's range."""
    if not files:
        return []
    index = spark.createDataFrame([(i, f.part, f.low, f.high) for i, f in enumerate(files)], "file int, part string, low string, high string")
    wanted = batch.select(part.alias("part"), F.col(key).cast("string").alias("key")).distinct()
    hit = wanted.join(F.broadcast(index), "part").where("key between low and high").select("file").distinct().collect()
    return [files[i] for i in sorted(r["file"] for r in hit)]


def merge(spark: SparkSession, table: str, batch: DataFrame, keys: list[str], update_cols: list[str], date_col: str,
          order_col: str | None = None, insert_defaults: dict[str, Column] | None = None, touch: dict[str, Column] | None = None) -> Version:
    """Keyed upsert of ``batch`` (U1-U6) into a table whose parts are the months of ``date_col``, a key.

    Rows without a date are left out.  Merging one batch twice gives the same rows, so a job that failed may
    simply run again."""
    with scratch(spark):
        rows = written(dedupe_batch(batch.where(F.col(date_col).isNotNull()), keys, order_col), "batch")
        return _merge(spark, table, rows, keys, update_cols, date_col, insert_defaults, touch)


def _merge(spark, table, rows, keys, update_cols, date_col, insert_defaults, touch) -> Version:
    part = F.date_format(date_col, "yyyy-MM")
    extra = {c: v for c, v in (insert_defaults or {}).items() if c not in rows.columns}

    def step(now: Version) -> list[File]:
        hit = touched(spark, now.files, rows, keys[0], part)
        if hit:
            old = _rows(spark, table, now.schema, hit)
            merged = upsert(old, rows, keys, update_cols, touch=touch, insert_defaults=insert_defaults)
        else:
            merged = rows.withColumns(extra)
        made = _added(spark, table, align_to_schema(merged, schema), keys, part)
        return [f for f in now.files if f not in hit] + made

    known = version(spark, table)
    schema = known.schema if known else rows.withColumns(extra).schema
    if not rows.isEmpty() or known is None:
        return _advance(spark, table, schema, step)
    return known


def changes(spark: SparkSession, table: str, since: int, columns: list[str]) -> DataFrame | None:
    """The rows (``columns`` of them) that differ between version ``since`` and the newest, old and new ones; None if
    that version is gone.  Only files that one of the two versions lacks are read."""
    if since not in versions(spark, table):
        return None
    old, new = version(spark, table, since), version(spark, table)
    gone, made = (_rows(spark, table, new.schema, [f for f in a.files if f not in b.files]).select(columns) for a, b in ((old, new), (new, old)))
    return made.exceptAll(gone).union(gone.exceptAll(made))


def expire(spark: SparkSession, table: str, keep: int = 10) -> int:
    """Delete all but the newest ``keep`` versions and the data folders that none of those reads; returns how many
    folders went.  No writer may be at work, as its files are not listed yet."""
    known = versions(spark, table)
    for n in known[:-keep]:
        fs, p = _fs(spark, f"{table}/versions/{n:012d}.json")
        fs.delete(p, False)
    live = {f.path.split("/")[1] for n in known[-keep:] for f in version(spark, table, n).files}
    fs, p = _fs(spark, f"{table}/data")
    gone = [s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName() not in live] if fs.exists(p) else []
    for name in gone:
        delete_folder(spark, f"{table}/data/{name}")
    return len(gone)
