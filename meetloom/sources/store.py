"""Keyed writes over immutable Parquet versions: upsert, replace, stale delete, backfill.

Each function is a pure DataFrame rewrite; Store keeps the results as versions and names them in a numbered pointer file
last, so a reader sees all tables of a commit or none. A pointer's number is taken by one writer only: whoever comes second raises.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meetloom.functions.exprs import date_iso
from meetloom.functions.names import free

#: Buckets of a table that is merged in parts.
BUCKETS = 16


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns; missing ones are null."""
    return df.select(*[(df[f.name].cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def last_per_key(batch: DataFrame, key: Sequence[str], position: str) -> DataFrame:
    """The batch with one row per key: the last by position wins."""
    row = free("row", batch.columns)
    others = [c for c in batch.columns if c not in (*key, position)]
    return batch.groupBy(*key).agg(F.max_by(F.struct(*others), position).alias(row)).select(*key, f"{row}.*")


def upsert(base: DataFrame, batch: DataFrame, key: Sequence[str], update: Sequence[str] | None = None) -> DataFrame:
    """base with batch (one row per key) merged in. Rows that match take the batch's values in `update` (all of its columns by
    default) and keep the rest; new rows take all. Columns that the batch lacks are kept, or null in new rows."""
    at, was_, is_ = free("at", base.columns, batch.columns), free("was", base.columns, batch.columns), free("is", base.columns, batch.columns)
    there, here = F.col(f"{was_}.{at}").isNotNull(), F.col(f"{is_}.{at}").isNotNull()
    old, new = base.withColumn(at, F.lit(1)).alias(was_), batch.withColumn(at, F.lit(1)).alias(is_)
    on = [F.col(f"{was_}.{k}") == F.col(f"{is_}.{k}") for k in key]
    out = []
    for c in base.columns:
        was = F.col(f"{was_}.{c}")
        if c in key:
            out.append(F.coalesce(was, F.col(f"{is_}.{c}")).alias(c))
        elif c not in batch.columns:
            out.append(was.alias(c))
        else:
            takes = here if update is None or c in update else here & ~there
            out.append(F.when(takes, F.col(f"{is_}.{c}")).otherwise(was).alias(c))
    return old.join(new, on, "full_outer").select(*out)


def stale_children(existing: DataFrame, batch: DataFrame, parent: str, child: str) -> DataFrame:
    """Keys of existing children that a batch no longer holds, for the parents in that batch only."""
    return existing.join(batch.select(parent).distinct(), parent, "left_semi").join(batch.select(parent, child), [parent, child], "left_anti").select(parent, child)


def without(table: DataFrame, gone: DataFrame, key: str | list[str]) -> DataFrame:
    return table.join(gone, key, "left_anti")


def replace_children(existing: DataFrame, batch: DataFrame, key: str, unique: Sequence[str]) -> DataFrame:
    """All rows of the batch's keys replaced by the batch's. Repeated `unique` values raise and name themselves."""
    twice = [tuple(r) for r in batch.groupBy(*unique).count().where("count > 1").select(*unique).limit(5).collect()]
    if twice:
        raise ValueError(f"repeated {', '.join(unique)}: {twice}")
    return without(existing, batch.select(key).distinct(), key).unionByName(batch)


def backfill_dates(table: DataFrame, display: str = "meeting_date", iso: str = "meeting_date_iso") -> DataFrame:
    """iso recomputed from display, with `changed`; an unparseable display empties it."""
    made = free("made", table.columns)
    return table.withColumn(made, date_iso(F.col(display))).withColumns({"changed": ~F.nullif(F.col(iso), F.lit("")).eqNullSafe(F.col(made)), iso: F.col(made)}).drop(made)


def upsert_stamped(base: DataFrame, batch: DataFrame, key: Sequence[str], now: Column) -> DataFrame:
    """Upsert of a table with created_at and updated_at by change: a new row gets both, a row that differs from the stored one in any
    column of the batch keeps created_at and gets updated_at, an equal one keeps both stamps. Rows are compared as a whole, nulls as equal."""
    stamps = ("created_at", "updated_at")
    old, row = free("old", base.columns, batch.columns), free("given", base.columns, batch.columns)
    given = [c for c in base.columns if c in batch.columns and c not in (*key, *stamps)]
    held = base.select(*key, F.struct(*[c for c in base.columns if c not in key]).alias(old))
    new = batch.select(*key, F.struct(*given).alias(row))
    merged = held.join(new, list(key), "full_outer")
    known, sent = F.col(old).isNotNull(), F.col(row).isNotNull()
    differs = sent & ~(known & F.struct(*[F.col(f"{old}.{c}") for c in given]).eqNullSafe(F.struct(*[F.col(f"{row}.{c}") for c in given])))
    out = []
    for c in base.columns:
        was = F.col(c) if c in key else F.col(f"{old}.{c}")
        if c in given:
            was = F.when(differs, F.col(f"{row}.{c}")).otherwise(was)
        elif c == "created_at":
            was = F.coalesce(was, F.when(sent, now))
        elif c == "updated_at":
            was = F.when(differs, now).otherwise(was)
        out.append(was.alias(c))
    return merged.select(*out)


class Store:
    """Tables as versions below one root; the pointer of all of them is swapped at once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.fs = spark._jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _numbers(self) -> list[int]:
        """Numbers of the pointers, the newest last."""
        if not self.fs.exists(self._path("")):
            return []
        names = [f.getPath().getName() for f in self.fs.listStatus(self._path(""))]
        return sorted(int(n[8:-5]) for n in names if n.startswith("pointer-") and n.endswith(".json"))

    def _pointer(self, number: int) -> dict[str, list[str]]:
        source = self.fs.open(self._path(f"pointer-{number:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def pointers(self) -> dict[str, list[str]]:
        """Folders of each table's current version."""
        numbers = self._numbers()
        return self._pointer(numbers[-1]) if numbers else {}

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """The current version; an absent table is an empty one."""
        at = self.pointers().get(name)
        return conform(self.spark.read.parquet(*[f"{self.root}/{x}" for x in at]), schema) if at else self.spark.createDataFrame([], schema)

    def staged(self, df: DataFrame) -> DataFrame:
        """df written once beside the tables and read back, for steps that need it several times. The next vacuum removes it."""
        path = f"{self.root}/staged/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self, tables: Mapping[str, DataFrame], added: Mapping[str, DataFrame] | None = None) -> None:
        """Write all new versions, and what is only added to tables, then name them in the next pointer: a failure before the last step
        changes nothing for readers. A table that another writer has committed meanwhile raises, since this batch was made from the version before."""
        numbers = self._numbers()
        before, made = self._pointer(numbers[-1]) if numbers else {}, {}
        for name, df in (dict(tables) | dict(added or {})).items():
            path = f"{name}/{uuid.uuid4().hex}"
            df.write.parquet(f"{self.root}/{path}")
            made[name] = [*before.get(name, []), path] if name in (added or {}) else [path]
        self._publish(before, made)

    def _publish(self, before: Mapping[str, list[str]], made: Mapping[str, list[str]]) -> None:
        while True:
            numbers = self._numbers()
            now = self._pointer(numbers[-1]) if numbers else {}
            if moved := [n for n in made if now.get(n) != before.get(n)]:
                raise RuntimeError(f"committed by another writer meanwhile: {', '.join(moved)}")
            if self._named((numbers[-1] if numbers else 0) + 1, {**now, **made}):
                return

    def merge(self, name: str, schema: T.StructType, batch: DataFrame, key: Sequence[str], change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Rewrite the buckets of a table that a batch touches, and commit; how many there were. Rows lie in BUCKETS buckets by a hash of their
        key; change(old rows of those buckets, batch) gives their new rows. Other buckets are neither read nor written."""
        bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")
        touched = {r["b"] for r in batch.select(bucket.alias("b")).distinct().collect()}
        before = self.pointers()
        held = before.get(name, [])
        if any("=" not in p for p in held):  # written as a whole: it becomes buckets now
            touched = set(range(BUCKETS))
        mine = [p for p in held if "=" not in p or int(p.rpartition("=")[2]) in touched]
        old = conform(self.spark.read.parquet(*[f"{self.root}/{p}" for p in mine]), schema) if mine else self.spark.createDataFrame([], schema)
        folder, at = f"{name}/{uuid.uuid4().hex}", free("b", schema.names)
        conform(change(old, batch), schema).withColumn(at, bucket).write.partitionBy(at).parquet(f"{self.root}/{folder}")
        made = [f.getPath().getName() for f in self.fs.listStatus(self._path(folder))]
        self._publish(before, {name: [p for p in held if p not in mine] + [f"{folder}/{m}" for m in sorted(made) if "=" in m]})
        return len(touched)

    def _named(self, number: int, tables: Mapping[str, list[str]]) -> bool:
        """Put the pointer in place by a rename that replaces nothing; False if another writer has taken its number."""
        staged, target = self._path(f"next-{uuid.uuid4().hex}.json"), self._path(f"pointer-{number:012d}.json")
        out = self.fs.create(staged, True)
        out.write(bytearray(json.dumps(dict(tables), sort_keys=True), "utf-8"))
        out.close()
        jvm, kind = self.spark._jvm, getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration()).rename(staged, target, how)
        except Py4JJavaError as e:
            self.fs.delete(staged, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def vacuum(self, keep: int = 2) -> int:
        """Remove versions that none of the last `keep` pointers names, and what is staged; how many folders went. Not while others read or write."""
        numbers = self._numbers()
        used = {"/".join(x.split("/")[:2]) for n in numbers[-keep:] for paths in self._pointer(n).values() for x in paths}
        tables = {x.split("/")[0] for n in numbers for paths in self._pointer(n).values() for x in paths}
        gone = 0
        for folder in (*sorted(tables), "staged"):
            if self.fs.exists(self._path(folder)):
                for f in self.fs.listStatus(self._path(folder)):
                    if f"{folder}/{f.getPath().getName()}" not in used:
                        gone += bool(self.fs.delete(f.getPath(), True))
        for n in numbers[:-keep]:
            self.fs.delete(self._path(f"pointer-{n:012d}.json"), False)
        return gone
