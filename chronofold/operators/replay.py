"""Item state replay over flat event tables of any size.

``timeline.replay`` folds the item events of one document.  Here the events lie in a table and one
owner may hold a large share of them, so the same rules are expressed as running sums that a
:class:`Lane` can slice:

* what an UNDO takes back is bracket matching: every event remembered raises a depth, every UNDO
  lowers it, and an UNDO matches the latest remembered event that reached its depth;
* a purchase absorbs the destructions right before it on the same tick, so it counts as one;
* a counter that stops at zero equals its running sum minus the lowest sum so far (if negative).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronofold.operators.lanes import DEFAULT_MAX_ROWS, HEAVY, SLICE, Lane, last_known, preceding, running_min, running_sum
from chronofold.session import written
from chronofold.plans.timeline import DESTROYED, PURCHASED, SOLD, UNDO, sort_type


def floored(total: Column, lowest: Column) -> Column:
    """Counter that stops at zero, from its running sum and running minimum."""
    return total - F.least(F.lit(0), lowest)


def item_changes(
    events: DataFrame,
    *,
    by: Sequence[str],
    tick: str,
    kind: str,
    item: str,
    ordinal: str,
    max_rows: int = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Every counter change: ``by``, tick, sort, ordinal, step, item, change and held count after it.

    Events of one tick are taken in the timeline's order (kind, consumables first or last), then by
    ``ordinal``, which must be unique per owner.  One exchange on the owner serves every step; the
    steps only re-sort.  With heavy owners present the rows are written out between steps.
    """
    rows = events.where(F.col(kind).isin(PURCHASED, SOLD, DESTROYED, UNDO)).select(
        *by, F.col(tick).alias("_t"), F.col(kind).alias("_kind"), F.col(item).cast("long").alias("_item"),
        F.col(ordinal).alias("_ord"), sort_type(F.col(kind), F.col(item)).alias("_type"),
    )
    order = ["_t", "_type", "_ord"]
    lane = Lane(by, order, max_rows=max_rows).measured(rows)
    settle = (lambda df: df) if lane.bounded else (lambda df: written(df, "replay"))
    rows = settle(lane.slice(rows))

    # Destructions directly before a purchase on its tick.  A slice never divides a tick.
    on_tick = Window.partitionBy(*lane.keys, "_t").orderBy(*order[1:])
    earlier = on_tick.rowsBetween(Window.unboundedPreceding, -1)
    other = F.count_if(F.col("_kind") != DESTROYED)
    rows = rows.withColumn("_group", F.coalesce(other.over(earlier), F.lit(0)))
    in_group = Window.partitionBy(*lane.keys, "_t", "_group").orderBy("_type", "_ord")
    destroyed = F.collect_list(F.when(F.col("_kind") == DESTROYED, F.col("_item")))
    run = destroyed.over(in_group.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_run", F.when(F.col("_kind") == PURCHASED, F.coalesce(run, F.array().cast("array<bigint>"))))

    step = (
        F.when(F.col("_kind") == UNDO, -1).when(F.col("_kind") == PURCHASED, 1 - F.size("_run")).otherwise(1)
    ).cast("long")
    rows = settle(lane.scan(rows, _sum=running_sum(step)))
    rows = settle(lane.scan(rows, _low=running_min(F.col("_sum"))))
    rows = rows.withColumn("_depth", floored(F.col("_sum"), F.col("_low")))
    rows = settle(lane.scan(rows, _prev=preceding(F.col("_depth"))))
    was = F.coalesce(F.col("_prev._depth"), F.lit(0))
    rows = rows.withColumn("_level", F.when(F.col("_kind") == UNDO, was).otherwise(F.col("_depth"))).drop("_prev", "_sum", "_low")

    remembered = F.when(F.col("_kind") != UNDO, F.struct("_kind", "_item", "_run"))
    rows = settle(lane.split("_level").scan(rows, _taken=last_known(remembered)))
    taken = F.when((F.col("_kind") == UNDO) & (F.col("_level") > 0), F.col("_taken"))
    rows = rows.withColumn("_taken", taken)

    change = lambda i, n: F.struct(i.alias("_item"), F.lit(n).cast("long").alias("change"))
    back = F.transform(F.col("_taken._run"), lambda i: change(i, 1))
    changes = (
        F.when(F.col("_kind") == PURCHASED, F.array(change(F.col("_item"), 1)))
        .when(F.col("_kind").isin(SOLD, DESTROYED), F.array(change(F.col("_item"), -1)))
        .when(F.col("_taken._kind") == PURCHASED, F.concat(F.array(change(F.col("_taken._item"), -1)), back))
        .when(F.col("_taken._kind") == SOLD, F.array(change(F.col("_taken._item"), 1)))
    )
    marks = [] if lane.bounded else [SLICE, HEAVY]
    bumps = rows.select(
        *by, *marks, "_t", "_type", "_ord", F.posexplode(changes).alias("_sub", "_c")
    ).select("*", "_c._item", "_c.change").drop("_c")
    per_item = replace(lane, order=[*order, "_sub"]).split("_item")
    bumps = settle(per_item.scan(bumps, _sum=running_sum(F.col("change"))))
    bumps = per_item.scan(bumps, _low=running_min(F.col("_sum")))
    return bumps.select(
        *by, F.col("_t").alias(tick), F.col("_type").alias("sort"), F.col("_ord").alias(ordinal), F.col("_sub").alias("step"),
        F.col("_item").alias(item), "change", floored(F.col("_sum"), F.col("_low")).alias("held"),
    )


def final_items(changes: DataFrame, *, by: Sequence[str], tick: str, item: str, ordinal: str) -> DataFrame:
    """Items still held at the end, from :func:`item_changes`."""
    last = changes.groupBy(*by, item).agg(F.max_by("held", F.struct(tick, "sort", ordinal, "step")).alias("held"))
    return last.where(F.col("held") > 0)
