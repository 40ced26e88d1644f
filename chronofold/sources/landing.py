"""Landed files: hive-style paths, JSON snapshots, mixed formats and exports."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


#: Folders of an open path part that are followed one by one.
OPEN_FOLDERS = 1000


class RecordNotFound(LookupError):
    """No landed object matches the requested partition."""


class LandingZone:
    """Folder of declared tables partitioned by ``name=value`` paths."""

    def __init__(self, spark: SparkSession, root: str, tables: Sequence[str]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tuple(tables)
        #: Folders that were listed on the way to partitions.
        self.listed: list[str] = []

    def table_path(self, table: str) -> str:
        if table not in self.tables:
            raise KeyError(f"undeclared table: {table}")
        return f"{self.root}/{table}"

    def partition_path(self, table: str, **parts) -> str:
        return "/".join([self.table_path(table), *[f"{k}={v}" for k, v in parts.items()]])

    def layout(self, table: str) -> list[str]:
        """Names of the path parts in their order, from one folder of each level."""
        names, folder = [], self.table_path(table)
        while child := next((c for c in self._children(folder) if "=" in c), None):
            names.append(child.split("=", 1)[0])
            folder = f"{folder}/{child}"
        return names

    def paths(self, table: str, **parts) -> list[str]:
        """The folders below which all rows with the given path parts lie.

        Known leading parts lead straight to their folder.  A folder is listed only where an open part comes before a known one, or where the value
        is spelled otherwise (``01``); with more than :data:`OPEN_FOLDERS` folders there, what follows is left to the filter of the scan.
        """
        known = {k: v for k, v in parts.items() if v is not None}
        found = [self.table_path(table)]
        names = self.layout(table) if known else []
        depth = max((n + 1 for n, name in enumerate(names) if name in known), default=0)
        for name in names[:depth]:
            if name in known:
                found = [f"{folder}/{child}" for folder in found for child in self._matching(folder, name, known[name])]
            else:
                wider = [f"{folder}/{child}" for folder in found for child in self._children(folder) if child.startswith(f"{name}=")]
                if len(wider) > OPEN_FOLDERS:
                    break
                found = wider
        return found

    def _matching(self, folder: str, name: str, value) -> list[str]:
        wanted = str(value).lower() if isinstance(value, bool) else str(value)
        escaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(wanted)
        if not isinstance(value, int) and self._exists(f"{folder}/{name}={escaped}"):
            return [f"{name}={escaped}"]
        same = lambda text: text == escaped or isinstance(value, int) and re.fullmatch(r"-?\d+", text) and int(text) == value
        return [c for c in self._children(folder) if c.startswith(f"{name}=") and same(c.split("=", 1)[1])]

    def _system(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _exists(self, folder: str) -> bool:
        path, system = self._system(folder)
        return system.exists(path)

    def _children(self, folder: str) -> list[str]:
        """Names of the folders right below a folder."""
        self.listed.append(folder)
        path, system = self._system(folder)
        return sorted(f.getPath().getName() for f in system.listStatus(path) if f.isDirectory()) if system.exists(path) else []

    def scan(self, table: str, schema: T.StructType | str | None = None, file_format: str = "parquet",
             pattern: str | None = None, multiline: bool = False, **parts) -> DataFrame:
        """Rows of a table; ``parts`` are equality filters on path parts, omitted ones are open.

        Only what lies below :meth:`paths` is listed.
        """
        reader = self.spark.read.option("basePath", self.table_path(table))
        if schema is not None:
            reader = reader.schema(schema)
        reader = reader.option("pathGlobFilter", pattern or f"*.{file_format}")
        if file_format == "json" and multiline:
            reader = reader.option("multiLine", True)
        # Without a folder the table is read as a whole, for its columns and no rows.
        below = self.paths(table, **parts) or [self.table_path(table)]
        df = reader.format(file_format).load([re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in below])
        conditions = [F.col(k) == F.lit(v) for k, v in parts.items() if v is not None]
        return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df

    def store(self, table: str, df: DataFrame, file_format: str = "parquet", mode: str = "append", **parts) -> bool:
        """Write a batch into one partition folder; nothing is written for an empty batch."""
        if file_format not in ("parquet", "json"):
            raise ValueError(f"unsupported file format: {file_format}")
        if df.isEmpty():
            return False
        df.write.mode(mode).format(file_format).save(self.partition_path(table, **parts))
        return True

    def landed(self, table: str, *parts: str, **known) -> DataFrame:
        """Distinct values of the path parts that hold at least one file, below the ``known`` parts if some are given.

        The parts come from the paths, so only file names are read, and only below :meth:`paths`.
        """
        below = self.paths(table, **known)
        if not below:
            return self.spark.createDataFrame([], ", ".join(f"`{p}` string" for p in parts))
        below = [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in below]
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(below)
        return path_parts(files.select("path"), *parts).select(*parts).distinct()

    def require(self, table: str, **parts) -> None:
        """Raise :class:`RecordNotFound` unless the partition, its parts in the order of :meth:`store`, holds a file.

        Only its own folder is listed."""
        path = self.partition_path(table, **parts)
        try:
            found = not self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").isEmpty()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            found = False
        if not found:
            raise RecordNotFound(path)


def path_parts(df: DataFrame, *names: str, path: str = "path") -> DataFrame:
    """Columns for ``name=value`` parts of a path column, null where a part is absent."""
    value = lambda n: F.nullif(F.regexp_extract(path, rf"(?:^|/){n}=([^/]+)", 1), F.lit(""))
    return df.withColumns({n: value(n) for n in names})


def object_name(path: Column) -> Column:
    """File name without folders and extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def read_object(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet or JSON file by extension; anything else is an error."""
    extension = path.rsplit(".", 1)[-1].lower()
    if extension not in ("parquet", "json"):
        raise ValueError(f"unsupported file extension: {extension}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", True).json(path) if extension == "json" else reader.parquet(path)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | str, ordinal: str = "_ordinal") -> DataFrame:
    """JSON-array file(s) as rows with their position.

    A snapshot file is one JSON document, which one task reads in document order whatever its size.  Files follow
    each other by path.
    """
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row"))
    # One row per file: numbering them in one task is cheap.
    files = placed.select("_file").distinct().withColumn("_number", F.row_number().over(Window.orderBy("_file")))
    in_task = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(files, "_file").withColumn(ordinal, F.col("_number").cast("long") * (1 << 33) + in_task).drop("_file", "_number", "_row")


_WIDENING = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


def common_type(one: T.DataType, two: T.DataType) -> T.DataType:
    """Smallest type both convert to: the wider number, otherwise string."""
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    if one in _WIDENING and two in _WIDENING:
        return _WIDENING[max(_WIDENING.index(one), _WIDENING.index(two))]
    return T.StringType()


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name after casting to common types; absent columns become null."""
    types: dict[str, T.DataType] = {}
    for frame in frames:
        for f in frame.schema:
            types[f.name] = common_type(types[f.name], f.dataType) if f.name in types else f.dataType
    cast = [f.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in f.columns]) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def by_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose key is in a key table.  The planner broadcasts the keys only while their
    measured size is under the session threshold."""
    return df.join(keys.select(column).distinct(), column, "left_semi")


def head(df: DataFrame, columns: Sequence[str], order: Sequence[str], count: int) -> DataFrame:
    """First rows of a column subset in a stated order."""
    return df.select(*columns).orderBy(*order).limit(count)


def flatten_entries(pages: DataFrame, entries: str = "entries") -> DataFrame:
    """One row per entry of a page; an entry's own fields win over the page's."""
    entry = pages.schema[entries].dataType.elementType
    rows = pages.withColumn("_entry", F.explode(entries)).drop(entries)
    outer = [c for c in rows.columns if c != "_entry"]
    own = entry.fieldNames()
    kept = [F.coalesce(F.col(f"_entry.{c}"), F.col(c)).alias(c) if c in own else F.col(c) for c in outer]
    return rows.select(*kept, *[F.col(f"_entry.{c}").alias(c) for c in own if c not in outer])


def landed_query(df: DataFrame, *, where: Column | None = None, join: DataFrame | None = None,
                 join_on: Sequence[str] = (), group_by: Sequence[str] = (), aggregates: Sequence[Column] = (),
                 fields: Sequence[Column | str] = ("*",), order_by: Sequence[Column | str] = (),
                 limit: int | None = None, offset: int = 0) -> DataFrame:
    """The clauses of the wiki's query interface on a landed table."""
    if join is not None:
        df = df.join(join, [*join_on])
    if where is not None:
        df = df.where(where)
    df = df.groupBy(*group_by).agg(*aggregates) if group_by else df.select(*fields)
    if order_by:
        df = df.orderBy(*order_by)
    if offset:
        df = df.offset(offset)
    return df if limit is None else df.limit(limit)
