"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from chronofold.session import get_session
from chronofold.suite import REGISTRY
from chronofold.suite.base import Tables
from chronofold.suite.timelines import match_documents, timeline_documents

HEADLINE = (
    "user_snapshot", "asof_purchase_click", "nearest_click_to_error", "filled_forward", "interval_event_counts",
    "items_held", "stratified_orders", "timeline_events_built", "inventories_replayed", "events_with_player_state",
    "enriched_events_built", "match_snapshot", "experience_samples", "entity_aliases", "games_with_series",
    "candidates", "linked_orders", "grounded_documents", "names_found", "ladder_cleaned", "ladder_latest",
    "upserted_twice", "stream_daily_counts", "price_by_quantity",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["kinds_counted"].run(spark, folder).collect()  # starts the JVM's scan path
    tables = Tables(spark, folder)
    match_documents(tables)  # the documents land before the clock starts
    timeline_documents(tables)
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    size = folder.rstrip("/").rsplit("sf", 1)[-1]
    rows = {name: spark.read.parquet(f"{folder}/{name}.parquet").count() for name in ("events", "orders", "customer", "documents")}
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": size, "table_rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main()
