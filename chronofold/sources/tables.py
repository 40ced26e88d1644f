"""Catalog tables on Parquet: declared schemas, conforming writes, overwrite and upsert.

Tables live in the session catalog under a database ``{dataset}_{schema}``.  An unpartitioned table
is replaced by writing a new version folder and pointing the table at it, so readers never see a
half-written table and a job may read what it replaces.  A partitioned table is changed by
rewriting only the partitions a batch touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.session import written

# Column type names of the declared schemas.
TYPE_NAMES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}


#: Partition column of a table with hash buckets.
BUCKET = "key_bucket"

#: Keys of a batch that the planner may broadcast; more are joined by sorting, so that they never pass through the driver.
BROADCAST_KEYS = 100_000


def type_named(name: str) -> T.DataType:
    """Spark type of a declared type name; ``list<x>`` nests, anything else is an error."""
    if name.startswith("list<") and name.endswith(">"):
        return T.ArrayType(type_named(name[5:-1]))
    if name not in TYPE_NAMES:
        raise ValueError(f"unsupported column type: {name}")
    return TYPE_NAMES[name]


def struct(required: dict[str, str], optional: dict[str, str] | None = None, order: Sequence[str] = ()) -> T.StructType:
    """Schema from type names; ``order`` rearranges the columns when the groups interleave."""
    fields = {n: T.StructField(n, type_named(t), False) for n, t in required.items()}
    fields |= {n: T.StructField(n, type_named(t), True) for n, t in (optional or {}).items()}
    return T.StructType([fields[n] for n in (order or fields)])


@dataclass(frozen=True)
class TableSpec:
    """What a table holds and how it is laid out."""

    schema: T.StructType
    keys: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    #: (column, descending) pairs for the order of rows inside files.
    sort_by: Sequence[tuple[str, bool]] = ()
    #: Partition columns computed from others, for layouts such as "by day of a timestamp".
    derived: dict[str, Column] = field(default_factory=dict)
    #: Partitions by a hash of the keys, so that an upsert rewrites only those that its keys fall into.  Choose about the
    #: table's size over the size of a file worth rewriting; 0 is none.
    buckets: int = 0

    def __post_init__(self) -> None:
        if self.buckets and not self.keys:
            raise ValueError("buckets need keys")

    def stored_schema(self) -> T.StructType:
        extra = [T.StructField(name, T.DateType()) for name in self.derived]
        if self.buckets:
            extra.append(T.StructField(BUCKET, T.IntegerType()))
        return T.StructType([*self.schema.fields, *extra])

    @property
    def parts(self) -> list[str]:
        """All partition columns."""
        return [*self.partition_by, *([BUCKET] if self.buckets else [])]

    def computed(self) -> dict[str, Column]:
        """Columns that the table adds to its rows."""
        return {**self.derived, **({BUCKET: self.bucket_of(*(F.col(k) for k in self.keys))} if self.buckets else {})}

    def bucket_of(self, *keys: Column) -> Column:
        types = [self.schema[k].dataType for k in self.keys]
        return F.pmod(F.xxhash64(*(k.cast(t) for k, t in zip(keys, types, strict=True))), F.lit(self.buckets)).cast("int")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in schema order, extras dropped, values cast; a missing column is an error and a
    null in a required column stops the write."""
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")
    columns = []
    for f in schema:
        value = F.col(f"`{f.name}`").cast(f.dataType)
        if not f.nullable:
            problem = F.raise_error(F.lit(f"null in required column {f.name}")).cast(f.dataType)
            value = F.coalesce(value, problem)
        columns.append(value.alias(f.name))
    return df.select(*columns)


class TableStore:
    """Tables of one dataset and schema, e.g. ``TableStore(spark, root, "ranks", "clean", specs)``."""

    def __init__(self, spark: SparkSession, root: str, dataset: str, schema: str, specs: dict[str, TableSpec]):
        self.spark, self.root, self.specs = spark, root.rstrip("/"), specs
        self.namespace = f"{dataset}_{schema}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.namespace}` LOCATION '{self.root}/{self.namespace}'")

    def full_name(self, table: str) -> str:
        if table not in self.specs:
            raise KeyError(f"undeclared table: {table}")
        return f"`{self.namespace}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(table))

    def create_if_absent(self, table: str) -> None:
        if self.exists(table):
            return
        spec = self.specs[table]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.stored_schema())
        layout = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in spec.parts)})" if spec.parts else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.full_name(table)} ({columns}) USING parquet {layout} "
            f"LOCATION '{self._new_location(table)}'"
        )

    def schema_of(self, table: str) -> T.StructType:
        return self.spark.table(self.full_name(table)).schema

    def scan(
        self,
        table: str,
        columns: Sequence[str] | None = None,
        where: Column | None = None,
        **equal,
    ) -> DataFrame:
        """Rows matching ``where`` and every ``column=value``; ``None`` values are ignored.

        Values of all keys lead to the one bucket of a table that has buckets."""
        spec = self.specs[table] if table in self.specs else TableSpec(T.StructType())
        if spec.buckets and all(equal.get(k) is not None for k in spec.keys):
            equal = {**equal, BUCKET: spec.bucket_of(*(F.lit(equal[k]) for k in spec.keys))}
        conditions = [F.col(c) == (v if isinstance(v, Column) else F.lit(v)) for c, v in equal.items() if v is not None]
        if where is not None:
            conditions.insert(0, where)
        df = self.spark.table(self.full_name(table))
        if conditions:
            df = df.where(reduce(lambda a, b: a & b, conditions))
        return df.select(*columns) if columns else df.drop(BUCKET)

    def register_views(self) -> list[str]:
        """Temp view per existing table under its bare name, for ad-hoc ``spark.sql``."""
        present = [t for t in self.specs if self.exists(t)]
        for table in present:
            self.spark.table(self.full_name(table)).createOrReplaceTempView(table)
        return present

    def write(self, table: str, df: DataFrame, mode: str = "append") -> None:
        """Conform ``df`` to the table and append, overwrite or upsert it."""
        self.create_if_absent(table)
        spec = self.specs[table]
        shaped = conform(df, spec.schema).withColumns(spec.computed())
        writers = {"append": self._append, "overwrite": self._overwrite, "upsert": self._upsert}
        if mode not in writers:
            raise ValueError(f"unsupported write mode: {mode}")
        writers[mode](table, spec, shaped)

    # -- writing ------------------------------------------------------------------------------

    def _append(self, table: str, spec: TableSpec, df: DataFrame) -> None:
        _laid_out(df, spec).select(*self.schema_of(table).names).write.insertInto(self.full_name(table))

    def _overwrite(self, table: str, spec: TableSpec, df: DataFrame) -> None:
        """A new version folder, to which the table is then pointed; the version before the last one is removed.

        The table exists at every moment, and a reader that began with the last version can finish.  Partitions are added, moved and dropped in three catalog calls:
        between them a reader may see a partition of the last version beside new ones, never a part of one.
        """
        name, location = self.full_name(table), self._new_location(table)
        writer = _laid_out(df, spec).write
        if spec.parts:
            writer = writer.partitionBy(*spec.parts)
        writer.parquet(location)
        before = self._versions(table)
        if spec.parts:
            fresh = f"`{self.namespace}`.`{table}_{uuid.uuid4().hex[:8]}`"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.stored_schema())
            layout = ", ".join(f"`{c}`" for c in spec.parts)
            self.spark.sql(f"CREATE TABLE {fresh} ({columns}) USING parquet PARTITIONED BY ({layout}) LOCATION '{location}'")
            try:
                self.spark.sql(f"MSCK REPAIR TABLE {fresh}")
                self._point_partitions(table, fresh)
            finally:
                self.spark.sql(f"DROP TABLE {fresh}")
        self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        self.spark.catalog.refreshTable(name)
        # Upserts and appends go to the folder of a partition, so folders of older versions are dropped only with everything in them replaced.
        for old in before[:-1]:
            self._remove(old)

    def _point_partitions(self, table: str, fresh: str) -> None:
        """Gives the table the partitions of ``fresh``, a table over the new folder, in bulk calls to the catalog."""
        jvm, state = self.spark._jvm, self.spark._jsparkSession.sessionState()
        catalog, every = state.catalog(), jvm.scala.Option.empty()
        own, other = (state.sqlParser().parseTableIdentifier(n.replace("`", "")) for n in (self.full_name(table), fresh))
        before, after = (set(filter(None, catalog.listPartitionNames(t, every).mkString("\n").split("\n"))) for t in (own, other))
        parts = catalog.listPartitions(other, every)
        catalog.createPartitions(own, parts, True)
        catalog.alterPartitions(own, parts)
        if before - after:
            parse = jvm.org.apache.spark.sql.execution.datasources.PartitioningUtils.parsePathFragment
            gone = jvm.scala.jdk.javaapi.CollectionConverters.asScala([parse(name) for name in sorted(before - after)]).toSeq()
            catalog.dropPartitions(own, gone, True, False, True)

    def _versions(self, table: str) -> list[str]:
        """Version folders of the table, the oldest first, without the newest, which is being written."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{self.namespace}/{table}")
        system = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not system.exists(folder):
            return []
        found = [(f.getModificationTime(), f.getPath().toString()) for f in system.listStatus(folder) if f.getPath().getName().startswith("version-")]
        return [path for _, path in sorted(found)][:-1]

    def _remove(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)

    def _upsert(self, table: str, spec: TableSpec, df: DataFrame) -> None:
        """Replace rows with the batch's keys and add the rest; repeating a batch changes nothing."""
        keys = [*spec.keys]
        # The batch is used several times below; a written copy makes every use see the same rows.
        batch = written(df, "upsert")
        if batch.groupBy(*keys).count().where("count > 1").limit(1).count():
            raise ValueError(f"duplicate keys {keys} in the batch for {table}")
        target = self.spark.table(self.full_name(table))
        parts = spec.parts
        if not parts:
            self._overwrite(table, spec, merged(target, batch, keys))
            return
        known = key_rows(batch, keys)
        touched = batch.select(*parts)
        if not set(parts) <= {*keys, BUCKET}:
            # A key may have moved: the partition that holds its old row has to be rewritten too.
            touched = touched.unionByName(target.join(known, keys, "left_semi").select(*parts))
        touched = written(touched.distinct(), "touched")
        old = _in_partitions(target, touched, parts)
        rest = old.join(known, keys, "left_anti")
        # Dynamic overwrite leaves a partition alone when the result has no row for it; these lose their last row.
        emptied = _without_partitions(touched, rest.unionByName(batch).select(*parts).distinct(), parts).collect()
        columns = self.schema_of(table).names
        previous = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            _laid_out(rest.unionByName(batch), spec).select(*columns).write.insertInto(self.full_name(table), overwrite=True)
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)
        if emptied:
            clauses = ", ".join(f"PARTITION ({', '.join(f'`{p}` = {_literal(row[p])}' for p in parts)})" for row in emptied)
            self.spark.sql(f"ALTER TABLE {self.full_name(table)} DROP IF EXISTS {clauses} PURGE")
            self.spark.catalog.refreshTable(self.full_name(table))

    def _new_location(self, table: str) -> str:
        return f"{self.root}/{self.namespace}/{table}/version-{uuid.uuid4().hex}"


def merged(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the batch's keys, plus the batch."""
    return target.join(key_rows(batch, keys), [*keys], "left_anti").unionByName(batch)


def key_rows(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of a written batch as the side of a join that may be broadcast, but only up to :data:`BROADCAST_KEYS` of them."""
    chosen = batch.select(*keys)
    return chosen if batch.count() <= BROADCAST_KEYS else chosen.hint("merge")


def _same_partition(left: DataFrame, right: DataFrame, parts: Sequence[str]) -> tuple[DataFrame, Column]:
    renamed = right.withColumnsRenamed({p: f"_part_{p}" for p in parts})
    return renamed, reduce(lambda a, b: a & b, [left[p].eqNullSafe(renamed[f"_part_{p}"]) for p in parts])


def _in_partitions(target: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of the touched partitions.

    A join on the partition columns, so that a plan of any number of partitions stays small and only their folders are read
    (dynamic pruning); partitions of a null value are few and found apart.
    """
    some_null = reduce(lambda a, b: a | b, [F.col(p).isNull() for p in parts])
    plain = target.join(touched.where(~some_null), [*parts], "left_semi").select(*target.columns)
    odd = target.where(some_null)
    renamed, same = _same_partition(odd, touched.where(some_null), parts)
    return plain.unionByName(odd.join(renamed, same, "left_semi"))


def _without_partitions(touched: DataFrame, present: DataFrame, parts: Sequence[str]) -> DataFrame:
    renamed, same = _same_partition(touched, present, parts)
    return touched.join(renamed, same, "left_anti")


def _literal(value) -> str:
    """A partition value as SQL."""
    if value is None:
        return "null"
    if isinstance(value, (bool, int, float)):
        return str(value)
    if isinstance(value, (date, datetime)):
        return f"{'TIMESTAMP' if isinstance(value, datetime) else 'DATE'} '{value}'"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _laid_out(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of a partition together and sorted inside files, nulls last.

    Only the rebalance hint is used: adaptive execution splits a partition that is too big for
    one file, so a partition holding a third of the rows does not end in one task.
    """
    if spec.parts:
        df = df.hint("rebalance", *spec.parts)
    if spec.sort_by:
        order = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in spec.sort_by]
        df = df.sortWithinPartitions(*spec.parts, *order)
    return df
