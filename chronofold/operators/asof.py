"""As-of and nearest joins as one ordered scan over the union of both sides.

No pair of rows is ever formed: the right side's payload travels down the lane, so the cost is one
exchange and one sort of ``left + right`` whatever the match counts are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronofold.operators.lanes import DEFAULT_MAX_ROWS, Lane, last_known, next_known
from chronofold.operators.select import dealt

_SIDE = "_side"
_PAYLOAD = "_payload"


def neighbours(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    on: str,
    payload: Sequence[str],
    right_on: str | None = None,
    tie: Sequence[str] = (),
    run: str = "last",
    max_rows: int = DEFAULT_MAX_ROWS,
    bounded: bool = False,
    before: str | None = "before",
    after: str | None = "after",
) -> DataFrame:
    """Left rows with the structs of the closest right row at or before, and after, ``on``.

    Each struct holds ``at`` (the right side's position) and the ``payload`` columns.  ``tie``
    orders right rows of one position; ``run`` says which of them stands for the position.
    Right rows equal to the left position count as *before*.  Passing ``None`` for ``before`` or
    ``after`` skips that direction.
    """
    ties = [f"_tie_{i}" for i, _ in enumerate(tie)]
    packed = right.select(
        *by,
        F.col(right_on or on).alias(on),
        *[F.col(c).alias(name) for c, name in zip(tie, ties)],
        F.struct(F.col(right_on or on).alias("at"), *payload).alias(_PAYLOAD),
        F.lit(0).alias(_SIDE),
    )
    # As in SQL a null key equals nothing: such right rows go, such left rows find nothing.
    packed = packed.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (on, *by)]))
    rows = left.withColumn(_SIDE, F.lit(1)).unionByName(packed, allowMissingColumns=True)

    lane = Lane(by, [on, _SIDE, *ties], max_rows=max_rows, bounded=bounded).measured(rows)
    # Three times as finely as rows without keys, which cannot be dealt evenly.
    rows = dealt(lane.slice(rows), 3 * lane.rows, *lane.keys)
    if run == "first" and tie:
        same = Window.partitionBy(*lane.keys, on).orderBy(_SIDE, *ties)
        rows = rows.withColumn(
            _PAYLOAD, F.when(F.col(_SIDE) == 0, F.first(_PAYLOAD).over(same)).otherwise(F.col(_PAYLOAD))
        )
    steps = {}
    if before:
        steps[before] = last_known(F.col(_PAYLOAD))
    if after:
        steps[after] = next_known(F.col(_PAYLOAD))
    found = lane.release(lane.scan(rows, **steps))
    placed = F.col(on).isNotNull()
    found = found.withColumns({name: F.when(placed, F.col(name)) for name in steps})
    return found.where(F.col(_SIDE) == 1).drop(_SIDE, _PAYLOAD, *ties)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    on: str,
    payload: Sequence[str],
    right_on: str | None = None,
    tie: Sequence[str] = (),
    tolerance: Column | None = None,
    matched_at: str | None = None,
    max_rows: int = DEFAULT_MAX_ROWS,
    bounded: bool = False,
) -> DataFrame:
    """Left rows with the payload of the latest right row at or before ``on`` (left outer).

    Of several right rows at one position the last by ``tie`` wins.  ``tolerance`` discards
    matches further away than it; ``matched_at`` names a column for the right position.
    """
    found = neighbours(
        left, right, by=by, on=on, payload=payload, right_on=right_on, tie=tie,
        max_rows=max_rows, bounded=bounded, before="_hit", after=None,
    )
    hit = F.col("_hit")
    if tolerance is not None:
        hit = F.when(F.col(on) - F.col("_hit.at") <= tolerance, hit)
        found = found.withColumn("_hit", hit)
    return _spread(found, "_hit", payload, matched_at)


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    on: str,
    payload: Sequence[str],
    right_on: str | None = None,
    tie: Sequence[str] = (),
    matched_at: str | None = None,
    max_rows: int = DEFAULT_MAX_ROWS,
    bounded: bool = False,
) -> DataFrame:
    """Left rows with the payload of the right row whose numeric ``on`` is closest (left outer).

    Equal distances go to the earlier position, equal positions to the first by ``tie`` - the
    order a stable sort on the distance would give.
    """
    found = neighbours(
        left, right, by=by, on=on, payload=payload, right_on=right_on, tie=tie, run="first",
        max_rows=max_rows, bounded=bounded, before="_b", after="_a",
    )
    backward = F.col("_a").isNull() | (F.col(on) - F.col("_b.at") <= F.col("_a.at") - F.col(on))
    found = found.withColumn("_hit", F.when(backward & F.col("_b").isNotNull(), F.col("_b")).otherwise(F.col("_a")))
    return _spread(found.drop("_a", "_b"), "_hit", payload, matched_at)


def _spread(df: DataFrame, struct: str, payload: Sequence[str], matched_at: str | None) -> DataFrame:
    columns = {c: F.col(f"{struct}.{c}") for c in payload}
    if matched_at:
        columns[matched_at] = F.col(f"{struct}.at")
    return df.withColumns(columns).drop(struct)
