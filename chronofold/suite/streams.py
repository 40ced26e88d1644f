"""Queries that run the event table through Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronofold.operators.replay import final_items
from chronofold.sources.tables import TableSpec, struct
from chronofold.streaming.flows import (
    deduplicated, first_within, landing_stream, late_and_first, replayed_items, to_batches, to_files, upsert_sink, window_counts,
)
from chronofold.suite.base import REGISTRY, Tables, query
from chronofold.suite.stores import store_for
from chronofold.suite.tracks import ITEM_KINDS


#: Times that events land; a stream is drained after each.
LANDINGS = 3
#: Seconds of a tick of the item replay; landings along time never part one.
TICK = 1800


def drained_over(t: Tables, start: Callable[[DataFrame], StreamingQuery], in_order: bool = True) -> None:
    """Lands the event table in parts and lets ``start`` process each as it has landed, as a stream with a zoned event time ``at``.

    ``in_order`` parts along time; otherwise every part has events of the whole time, so late ones come in each.  Events without a time or an id land first.
    A part is as many files as its tasks write."""
    folder = t.scratch("landed")
    tick = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (TICK * 1_000_000))
    low, span = t.events.select(F.min(tick), F.max(tick) - F.min(tick) + 1).first()
    turn = F.floor((tick - low) * LANDINGS / F.lit(span)) if in_order else F.pmod("event_id", F.lit(LANDINGS))
    for n in range(LANDINGS):
        t.events.where(F.coalesce(turn, F.lit(0)) == n).write.mode("append").parquet(folder)
        stream = landing_stream(t.spark, folder, t.events.schema).withColumn("at", F.col("ts").cast("timestamp"))
        start(stream).awaitTermination()


def drained(t: Tables, shape: Callable[[DataFrame], DataFrame], name: str, in_order: bool = True) -> DataFrame:
    """Rows of a shaped stream after it has taken everything that landed."""
    path, checkpoint = t.scratch(name), t.scratch(f"{name}-checkpoint")
    drained_over(t, lambda stream: to_files(shape(stream), path, checkpoint), in_order)
    return t.spark.read.parquet(path)


@query("K1", "SELECT event_id, user_id, event_type FROM events")
def stream_ingested(t: Tables) -> DataFrame:
    """Everything that has landed, taken once."""
    return drained(t, lambda stream: stream.select("event_id", "user_id", "event_type"), "ingest")


@query("K2", "SELECT DISTINCT user_id, event_type FROM events")
def stream_deduplicated(t: Tables) -> DataFrame:
    """First arrival per key inside the lateness bound."""
    def shape(stream: DataFrame) -> DataFrame:
        return deduplicated(stream, ["user_id", "event_type"], "at", "40 days").select("user_id", "event_type")

    return drained(t, shape, "dedup", in_order=False)


@query("K2", """
WITH RECURSIVE e AS (SELECT event_id, user_id, event_type, epoch_ms(ts) AS ms, event_id % 3 AS turn FROM events),
marks AS (SELECT turn, max(max(ms)) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 10 * 86400000 AS mark FROM e GROUP BY turn),
judged AS (SELECT e.*, coalesce(ms < mark, false) AS late FROM e JOIN marks USING (turn)),
rows_in_time AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY turn, ms, event_id) AS n FROM judged WHERE NOT late),
walk AS (
  SELECT user_id, event_type, 0::BIGINT AS n, -1::BIGINT AS event_id, false AS first, -1::BIGINT AS until FROM rows_in_time GROUP BY ALL
  UNION ALL
  SELECT w.user_id, w.event_type, r.n, r.event_id, r.ms > w.until, CASE WHEN r.ms > w.until THEN r.ms + 10 * 86400000 ELSE w.until END
  FROM walk w JOIN rows_in_time r ON r.user_id = w.user_id AND r.event_type = w.event_type AND r.n = w.n + 1)
SELECT event_id, false AS late FROM walk WHERE first UNION ALL SELECT event_id, true FROM judged WHERE late
""")
def stream_first_seen(t: Tables) -> DataFrame:
    """First events per user and kind under a bound of 10 days that acts on 30 days of data, and the late events it turned away."""
    path, checkpoint = t.scratch("first"), t.scratch("first-checkpoint")

    def start(stream: DataFrame) -> StreamingQuery:
        events = stream.select("event_id", "user_id", "event_type", "at")
        return late_and_first(first_within(events, ["user_id", "event_type"], "at", timedelta(days=10), order=["event_id"]), path, checkpoint)

    drained_over(t, start, in_order=False)
    return t.spark.read.parquet(path).select("event_id", F.col("late").cast("boolean").alias("late"))


@query("K3 K2 K7", """
SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def stream_upserted(t: Tables) -> DataFrame:
    """Latest event per user kept in a table by an upserting stream whose batches all hold late events."""
    spec = TableSpec(struct({"user_id": "long"}, {"event_id": "long", "value": "double", "ts": "timestamp"}), keys=("user_id",), buckets=8)
    store = store_for(t, {"latest": spec})
    sink = upsert_sink(store, "latest", ["ts", "event_id"])
    checkpoint = t.scratch("upsert-checkpoint")
    drained_over(t, lambda stream: to_batches(stream, sink, checkpoint), in_order=False)
    return store.scan("latest", ["user_id", "event_id", "value"])


@query("K5", """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events
WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) GROUP BY 1, 2
""")
def stream_daily_counts(t: Tables) -> DataFrame:
    """Events per closed day and kind."""
    def shape(stream: DataFrame) -> DataFrame:
        return window_counts(stream, "at", "1 day", "10 minutes", ["event_type"]).select(F.to_date("start").alias("day"), "event_type", "n")

    return drained(t, shape, "windows")


@query("K4 E9", REGISTRY["items_held"].sql)
def stream_items_held(t: Tables) -> DataFrame:
    """Items held at the end of a stateful replay that spans micro-batches."""
    kinds = F.create_map(*[F.lit(x) for pair in ITEM_KINDS.items() for x in pair])
    out, checkpoint = t.scratch("replay"), t.scratch("replay-checkpoint")

    def start(stream: DataFrame) -> StreamingQuery:
        events = stream.select(
            "user_id", "event_id", F.floor(F.unix_micros("at") / (TICK * 1_000_000)).alias("tick"), F.lit(False).alias("ended"),
            F.element_at(kinds, F.col("event_type")).alias("kind"), (F.get_json_object("props", "$.k").cast("int") % 5).alias("item"))
        return replayed_items(events, out, checkpoint, owner=["user_id"], tick="tick", kind="kind", item="item", ordinal="event_id", ended="ended")

    drained_over(t, start)
    return final_items(t.spark.read.parquet(out), by=["user_id"], tick="tick", item="item", ordinal="event_id")
