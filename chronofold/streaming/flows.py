"""The batch operators run incrementally with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chronofold.operators.select import last_per_key
from chronofold.plans.timeline import sort_type
from chronofold.sources.tables import TableStore, conform
from chronofold.streaming.state import FirstWithin, ItemReplay

#: Groups that the keys of :func:`first_within` are dealt to.
FIRST_BUCKETS = 1024

#: Groups that the owners of :func:`replayed_items` are dealt to.
OWNER_BUCKETS = 1024

#: Remembered events of an owner that are stored as one.
REMEMBERED_BLOCK = 32


def landing_stream(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
    *, pattern: str | None = None, files_per_trigger: int | None = None,
) -> DataFrame:
    """Files of a landing folder as a stream; each file is taken once.

    ``files_per_trigger`` bounds a micro-batch and with it the rows of one key in a batch.
    """
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(file_format).load(path)


def to_files(stream: DataFrame, path: str, checkpoint: str, *, mode: str = "append") -> StreamingQuery:
    """Process everything that has landed into Parquet files, exactly once, then stop."""
    return (
        stream.writeStream.outputMode(mode).format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def to_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand every micro-batch of what has landed to ``handle``, then stop."""
    return (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str, lateness: str) -> DataFrame:
    """First arrival per key while its repeats are at most ``lateness`` apart."""
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark([*keys])


def first_within(
    stream: DataFrame, keys: Sequence[str], event_time: str, lateness: timedelta, *, order: Sequence[str] = (), kept_late: timedelta = timedelta(days=365)
) -> DataFrame:
    """Every row with ``late`` and ``first``, so that late rows can be kept and counted instead of being dropped unseen.

    A row is late if its event time is more than ``lateness`` before the largest of the batches before; ``first`` if it is in time and no row counted as first within
    ``lateness`` before it.  Rows of a batch are taken by event time, then ``order``; a null event time is neither late nor first.  Rows beyond ``kept_late``
    are dropped by Spark itself.  A key's state is one number, evicted as the watermark passes it.  Keys are called and stored by bucket, whose number the checkpoint keeps.
    """
    slack = kept_late - lateness
    if slack < timedelta(0):
        raise ValueError("kept_late must be at least the lateness")
    columns = stream.columns
    # Whole numbers travel as zero instead of null, with the nulls marked by bits, since pandas would turn a column with nulls into doubles.
    whole = [f.name for f in stream.schema if isinstance(f.dataType, T.IntegralType)]
    if len(whole) > 63:
        raise ValueError("at most 63 columns of whole numbers")
    bits = [F.when(F.col(f"`{c}`").isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(whole)]
    timed = stream.withWatermark(event_time, f"{int(kept_late.total_seconds())} seconds")
    rows = timed.select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(stream.schema[c].dataType)).alias(c) if c in whole else F.col(f"`{c}`") for c in columns],
        F.unix_millis(F.col(event_time).cast("timestamp")).alias("ev_at"), reduce(Column.__add__, bits, F.lit(0).cast("long")).alias("ev_nulls"),
        F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]), {"ignoreNullFields": "false"}).alias("ev_key"),
        *[F.col(f"`{o}`").isNotNull().alias(f"ev_has_{o}") for o in order], F.pmod(F.xxhash64(*keys), F.lit(FIRST_BUCKETS)).alias("ev_bucket"))
    kept = [*(f for f in stream.schema.fields), T.StructField("ev_nulls", T.LongType())]
    schema = T.StructType([*kept, T.StructField("late", T.BooleanType()), T.StructField("first", T.BooleanType())])
    millis = [int(x.total_seconds() * 1000) for x in (lateness, slack)]
    places = [c for o in order for c in (f"ev_has_{o}", o)]
    marked = rows.groupBy("ev_bucket").transformWithStateInPandas(FirstWithin([f.name for f in kept], places, *millis), schema, "Append", "EventTime")
    given = lambda c: F.when(F.col("ev_nulls").bitwiseAND(F.lit(1 << whole.index(c)).cast("long")) == 0, F.col(f"`{c}`")).alias(c)
    return marked.select(*[given(c) if c in whole else F.col(f"`{c}`") for c in columns], "late", "first")


def late_and_first(marked: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rows of :func:`first_within` into two folders, ``late=true`` for what came too late and ``late=false`` for what counted first; then stops."""
    kept = marked.where("late or first").drop("first")
    with state_in_rocksdb(marked.sparkSession):
        return (
            kept.writeStream.outputMode("append").format("parquet").partitionBy("late").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )


def upsert_sink(
    store: TableStore, table: str, order: Sequence[str], shape: Callable[[DataFrame], DataFrame] = lambda df: df
) -> Callable[[DataFrame, int], None]:
    """Batch handler that keeps the latest record per key, over all batches.

    The ``order`` columns are stored with the row, so that a late older record does not replace a newer one.
    Replaying a batch after a failure writes the same rows again, so the table ends up the same.
    """
    spec = store.specs[table]
    keys, lacking = [*spec.keys], set(order) - set(spec.schema.names)
    if lacking:
        raise ValueError(f"{table} must store the order columns {sorted(lacking)}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        store.create_if_absent(table)
        fresh = conform(shape(batch), spec.schema)
        known = store.scan(table, spec.schema.names).join(fresh.select(*keys).distinct(), keys, "left_semi")
        store.write(table, last_per_key(fresh.unionByName(known), keys, *order), "upsert")

    return handle


def window_counts(
    stream: DataFrame, event_time: str, width: str, lateness: str, by: Sequence[str]
) -> DataFrame:
    """Rows per tumbling window and ``by``; rows later than ``lateness`` are dropped.

    Counts are partially aggregated before the exchange, so one busy key stays cheap.
    """
    window = F.window(event_time, width)
    counted = stream.withWatermark(event_time, lateness).groupBy(window, *by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")


def replayed_items(
    stream: DataFrame, output: str, checkpoint: str, *, owner: Sequence[str], tick: str, kind: str, item: str, ordinal: str, ended: str,
    event_time: str | None = None, lateness: str = "0 seconds", idle: timedelta | None = None,
) -> StreamingQuery:
    """Item counters of every owner, carried across micro-batches, in the columns of :func:`item_changes`; processes what has landed, then stops.

    Each owner has state of its own, of which a batch reads and writes only what its events touch (:class:`ItemReplay`); owners without events cost
    nothing.  An owner is closed, and its state dropped, by an event whose ``ended`` column is true, or once the watermark of ``event_time``
    is ``idle`` past its last event; events after that start anew.  Events must arrive in order of ``tick`` per owner; those of one batch
    are put in the timeline's order, an event of an earlier tick counts where it arrives.  Owners are called and stored by bucket, whose number the checkpoint keeps.
    """
    if idle is not None and event_time is None:
        raise ValueError("an idle time needs an event time")
    moment = F.unix_millis(F.col(event_time).cast("timestamp")) if event_time else F.lit(None).cast("long")
    types = {f.name: f.dataType for f in stream.select(*owner, F.col(ordinal)).schema}
    # Whole numbers travel as zero instead of null, with the nulls marked, since pandas would turn a column with nulls into doubles.
    whole = [o for o in owner if isinstance(types[o], T.IntegralType)]
    filled = lambda c: F.coalesce(F.col(c), F.lit(0).cast(types[c])) if isinstance(types[c], T.IntegralType) else F.col(c)
    bits = [F.when(F.col(o).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, o in enumerate(whole)]
    tick_of = F.col(tick).cast("long")
    columns = [
        *[filled(o).alias(o) for o in owner], reduce(Column.__add__, bits, F.lit(0).cast("long")).alias("ev_nulls"),
        F.coalesce(tick_of, F.lit(0).cast("long")).alias("ev_t"), tick_of.isNotNull().alias("ev_has_t"), F.col(kind).alias("ev_kind"),
        F.col(item).cast("long").cast("string").alias("ev_item"), filled(ordinal).alias("ev_ord"), F.col(ordinal).isNotNull().alias("ev_has_ord"),
        sort_type(F.col(kind), F.col(item)).alias("ev_type"), F.coalesce(F.col(ended), F.lit(False)).alias("ev_ended"), moment.alias("ev_at"),
        F.to_json(F.struct(*[F.col(o).cast("string").alias(o) for o in owner]), {"ignoreNullFields": "false"}).alias("ev_key"),
        F.pmod(F.xxhash64(*owner), F.lit(OWNER_BUCKETS)).alias("ev_bucket"),
    ]
    timed = stream.withWatermark(event_time, lateness) if event_time else stream
    rows = timed.select(*columns, *([event_time] if event_time else []))
    schema = T.StructType([
        *(T.StructField(o, types[o]) for o in owner), T.StructField("ev_nulls", T.LongType()), T.StructField("ev_t", T.LongType()),
        T.StructField("ev_has_t", T.BooleanType()), T.StructField("ev_type", T.StringType()), T.StructField("ev_ord", types[ordinal]),
        T.StructField("ev_has_ord", T.BooleanType()), T.StructField("step", T.IntegerType()), T.StructField("ev_item", T.StringType()),
        T.StructField("change", T.LongType()), T.StructField("held", T.LongType()),
    ])
    replay = ItemReplay([*owner], idle=int(idle.total_seconds() * 1000) if idle is not None else None, block=REMEMBERED_BLOCK)
    marked = rows.groupBy("ev_bucket").transformWithStateInPandas(replay, schema, "Append", "EventTime" if event_time else "None")
    present = lambda o: F.when(F.col("ev_nulls").bitwiseAND(F.lit(1 << whole.index(o)).cast("long")) == 0, F.col(o)).alias(o)
    changes = marked.select(
        *[present(o) if o in whole else F.col(o) for o in owner], F.when(F.col("ev_has_t"), F.col("ev_t")).alias(tick), F.col("ev_type").alias("sort"),
        F.when(F.col("ev_has_ord"), F.col("ev_ord")).alias(ordinal), "step", F.col("ev_item").cast("long").alias(item), "change", "held")
    with state_in_rocksdb(stream.sparkSession):
        return to_files(changes, output, checkpoint)


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, which named state of several kinds needs; the session's setting comes back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def require_current(today: date, start: date, end: date, name: str = "this source") -> None:
    """Refuse to fetch a past window of a source that only shows the present."""
    if not start <= today < end:
        raise ValueError(f"{name} has no history: today {today} is outside [{start}, {end})")


def run_partition(
    source: DataFrame, store: TableStore, table: str, build: Callable[[DataFrame], DataFrame], **partition
) -> None:
    """One incremental batch: the rows of a partition, built and upserted."""
    chosen = source
    for column, value in partition.items():
        chosen = chosen.where(F.col(column) == F.lit(value))
    store.write(table, build(chosen), "upsert")
