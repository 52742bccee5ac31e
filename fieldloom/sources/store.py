"""Tables in folders: staged CSV, insert-if-absent, versions with a pointer, checkpoints and reports."""

from __future__ import annotations

import json
import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scenes import first_of

#: Types of a source's columns that can be read, by their names there.
TYPES = {"text": T.StringType(), "date": T.DateType(), "smallint": T.ShortType(), "integer": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "real": T.FloatType(), "double precision": T.DoubleType()}


def schema_of(columns: list[tuple[str, str]]) -> T.StructType:
    """A schema from names and source types; an unknown type is an error."""
    unknown = [f"{n}: {t}" for n, t in columns if t not in TYPES]
    if unknown:
        raise ValueError(f"unknown types: {unknown}")
    return T.StructType([T.StructField(n, TYPES[t]) for n, t in columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, null: str = "") -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, nullValue=null, mode="FAILFAST")


def write_csv(table: DataFrame, path: str, null: str = "", single: bool = False) -> None:
    (table.coalesce(1) if single else table).write.csv(path, header=True, nullValue=null, mode="overwrite")


def read_ids(spark: SparkSession, path: str, pattern: str | None = None, repeats: bool = True) -> DataFrame:
    """Ids of a text file, each once, in the order in which they first come (a column place, within one file).

    With a pattern, an id that isn't like it is an error; without `repeats`, one that comes twice is."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("place", "line"))
    ids = lines.select("place", F.trim("line").alias("id")).filter("id != ''").groupBy("id").agg(F.min("place").alias("place"), F.count("*").alias("n"))
    if pattern is not None and (bad := ids.filter(~F.col("id").rlike(pattern)).limit(5).collect()):
        raise ValueError(f"invalid ids: {[r['id'] for r in bad]}")
    if not repeats and (twice := ids.filter("n > 1").limit(5).collect()):
        raise ValueError(f"ids that repeat: {[r['id'] for r in twice]}")
    return ids.select("id", "place").orderBy("place")


def inventory(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, size and region, start, end of every file whose name is like the pattern (three groups)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    parts = [F.regexp_extract("path", pattern, i) for i in (1, 2, 3)]
    return files.filter(F.col("path").rlike(pattern)).select("path", F.col("length").alias("size_bytes"), parts[0].alias("region"), F.to_date(parts[1]).alias("start_date"), F.to_date(parts[2]).alias("end_date"))


def inventory_faults(files: DataFrame, keys: list[str], grid: str) -> DataFrame:
    """Keys with more than one file, and keys whose file has another grid than most of its first key's files (ties: the smaller grid)."""
    twice = files.groupBy(*keys).agg(F.count("*").alias("n"), F.min(grid).alias("_grid"))
    usual = first_of(files.groupBy(keys[0], grid).agg(F.count("*").alias("_n")), [keys[0]], F.desc("_n"), F.col(grid)).select(keys[0], F.col(grid).alias("_usual"))
    t = twice.join(usual, keys[0])
    return t.select(*keys, "n", F.when(F.col("n") > 1, "duplicate").when(~F.col("_grid").eqNullSafe(F.col("_usual")), "grid").alias("fault")).filter("fault is not null")


def with_scenes(listing: DataFrame, scenes: DataFrame, name: str, group: str, every: bool = True) -> DataFrame:
    """Files found in a folder with what the catalogue says of them; a file of several groups stays in all of them, or in the first only."""
    known = scenes if every else first_of(scenes, [name], F.col(group))
    return listing.join(known, name, "left")


def staged(rows: DataFrame, keys: list[str], texts: list[str], *order: Column) -> DataFrame:
    """Rows with trimmed texts and no blank key, the first of each key."""
    clean = rows.select(*(F.trim(c).alias(c) if c in texts else F.col(c) for c in rows.columns))
    for k in keys:
        clean = clean.filter(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    return first_of(clean, keys, *order)


def absent(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows, those whose key the target lacks: what an insert would add."""
    return rows.join(target.select(*keys), keys, "left_anti")


def append_absent(rows: DataFrame, path: str, keys: list[str], partitions: list[str]) -> None:
    """Insert if absent into a partitioned Parquet table."""
    spark = rows.sparkSession
    if exists(spark, path):
        rows = absent(rows, spark.read.parquet(path), keys)
    rows.write.mode("append").partitionBy(*partitions).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_part(rows: DataFrame, path: str, checkpoints: str, key: dict[str, str], expected: int | None = None) -> bool:
    """Load a part once: write its rows to a folder of their own, count them there, then append a checkpoint row.

    A part with a checkpoint row is passed over; one that was cut off before it is written anew over what it left.
    key: run_id, sensor and part, which name the folder too.  Returns whether the part was loaded."""
    spark = rows.sparkSession
    same = " and ".join(f"{k} = '{v}'" for k, v in key.items())
    if exists(spark, checkpoints) and spark.read.parquet(checkpoints).filter(same).limit(1).count():
        return False
    to = "/".join([path.rstrip("/"), *(f"{k}={v}" for k, v in key.items())])
    rows.write.mode("overwrite").parquet(to)
    n = spark.read.parquet(to).count()
    if expected is not None and n != expected:
        raise ValueError(f"{to} has {n} rows, not {expected}")
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in key.items()), F.lit("done").alias("status"), F.lit(n).cast("long").alias("n_rows"))
    row.coalesce(1).write.mode("append").parquet(checkpoints)
    return True


def append_json(rows: DataFrame, path: str) -> None:
    """Rows as lines of JSON, added to a folder."""
    rows.write.mode("append").json(path)


def write_described(table: DataFrame, path: str, about: dict[str, str]) -> None:
    """A Parquet table whose columns carry what is said about the table; described() reads it back."""
    table.select(*(F.col(c).alias(c, metadata={"about": json.dumps(about, sort_keys=True)}) for c in table.columns)).write.mode("errorifexists").parquet(path)


def described(spark: SparkSession, path: str) -> dict[str, str]:
    return json.loads(spark.read.parquet(path).schema.fields[0].metadata.get("about", "{}"))


def version_token(name: str) -> str:
    slug = re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")
    return f"{slug[:24]}_{hashlib.sha256(name.encode()).hexdigest()[:8]}"


class Versions:
    """Versions of a table in folders below one root, and a view that names the current one."""

    def __init__(self, spark: SparkSession, root: str, view: str):
        self.spark, self.root, self.view = spark, root.rstrip("/"), view

    def write(self, table: DataFrame, name: str, partitions: list[str] | None = None) -> str:
        path = f"{self.root}/{version_token(name)}"
        writer = table.write.mode("errorifexists").option("compression", "zstd")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
        return path

    def swap(self, path: str, expected_rows: int | None = None) -> None:
        """Point the view at a version, after its rows are counted."""
        table = self.spark.read.parquet(path)
        if expected_rows is not None and (n := table.count()) != expected_rows:
            raise ValueError(f"{path} has {n} rows, not {expected_rows}")
        pointed = self.spark.range(1).select(F.current_timestamp().alias("at"), F.lit(path).alias("path"))
        pointed.coalesce(1).write.mode("append").parquet(f"{self.root}/pointer")  # one file, there or not: the swap itself
        table.createOrReplaceTempView(self.view)

    def current(self) -> DataFrame:
        """The version that the last swap named, in this session or another; the view names it too."""
        last = self.spark.read.parquet(f"{self.root}/pointer").agg(F.max_by("path", "at").alias("path")).first()["path"]
        table = self.spark.read.parquet(last)
        table.createOrReplaceTempView(self.view)
        return table


def pending(tasks: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Tasks without a checkpoint row."""
    return tasks.join(done.filter("status = 'done'").select(*keys).distinct(), keys, "left_anti")


def report(rows: DataFrame) -> str:
    """A small table as JSON."""
    return json.dumps([r.asDict(recursive=True) for r in rows.collect()], default=str, sort_keys=True)


def content_hash(table: DataFrame) -> DataFrame:
    """A digest that does not depend on the order of rows."""
    return table.agg(F.count("*").alias("n_rows"), F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)")).alias("digest"))


def standardised(tables: list[DataFrame], texts: list[str], whole: list[str]) -> DataFrame:
    """All rows of tables whose columns differ: texts first, whole numbers next, the rest by name as doubles."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    rest = sorted(c for c in out.columns if c not in {*texts, *whole})
    return out.select(*(F.col(c).cast("string") for c in texts), *(F.col(c).cast("long") for c in whole), *(F.col(c).cast("double") for c in rest))
