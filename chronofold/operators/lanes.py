"""Ordered scans per key that survive a key holding a large share of all rows.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task.  A :class:`Lane`
measures the keys first and cuts only the heavy ones into slices along the ordering column:

1. rows per key are counted with a partial aggregate; keys above ``max_rows`` are heavy.  There
   can be at most ``rows / max_rows`` of them, which bounds the broadcast that marks the rows;
2. the window runs per ``(key, slice)`` - one exchange, one sort;
3. each slice of a heavy key is summarised in one row, the summaries are scanned per key, and
   what a slice inherits from its neighbours is joined back on ``(key, slice)``, the partitioning
   the rows already have.

:meth:`Lane.run` counts first and leaves out the slicing when no key is heavy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

SLICE = "_slice"
HEAVY = "_heavy"

#: A heavy key is cut into this many times more slices than an even spread would need, so a
#: stretch eight times denser than the key's average still stays within ``max_rows``.  Denser
#: stretches are cut a second time.
OVERCUT = 8
#: Room for the second cut in a slice number.
FINE_CUTS = 1 << 24
DEFAULT_MAX_ROWS = 2_000_000
#: Keys that may be marked as heavy at once; they are broadcast.
MOST_MARKS = 100_000


@dataclass(frozen=True)
class Step:
    """One value computed along a lane; build it with the functions below."""

    kind: str
    value: Column


def running_sum(value: Column) -> Step:
    """Sum from the start of the lane up to and including the row."""
    return Step("sum", value)


def running_min(value: Column) -> Step:
    """Minimum from the start of the lane up to and including the row."""
    return Step("min", value)


def last_known(value: Column) -> Step:
    """Latest non-null value up to and including the row (forward fill)."""
    return Step("last", value)


def last_known_at(value: Column) -> Step:
    """Latest non-null value up to all rows at the row's position (first order column)."""
    return Step("at", value)


def next_known(value: Column) -> Step:
    """Earliest non-null value from the row on (backward fill)."""
    return Step("next", value)


def known_after(value: Column) -> Step:
    """Earliest non-null value strictly after the row."""
    return Step("after", value)


def following(*columns: Column) -> Step:
    """Struct of the columns of the next row, null on the last row."""
    return Step("lead", F.struct(*columns))


def preceding(*columns: Column) -> Step:
    """Struct of the columns of the previous row, null on the first row."""
    return Step("lag", F.struct(*columns))


@dataclass(frozen=True)
class Lane:
    """Rows that share ``by``, in ascending ``order``.

    ``order`` must be total for reproducible results; its first column has to be numeric, a date
    or a timestamp, since heavy keys are cut along it.  ``bounded=True`` states that a key cannot
    be large (all its rows come out of one input document) and skips the measuring.
    """

    by: Sequence[str]
    order: Sequence[str]
    max_rows: int = DEFAULT_MAX_ROWS
    bounded: bool = False
    within: Sequence[str] = field(default=())
    #: Rows counted by :meth:`measured`.
    rows: int = 0

    @property
    def keys(self) -> list[str]:
        return [*self.by, *([] if self.bounded else [SLICE]), *self.within]

    def split(self, *columns: str) -> Lane:
        """Lane of the same rows, further divided by ``columns``; keeps slices and exchange."""
        return replace(self, within=[*self.within, *columns])

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def slice(self, df: DataFrame) -> DataFrame:
        """Mark every row with its slice.

        A heavy key is cut evenly along the order column; a slice that is still heavy, because the
        key's rows come in bursts, is cut evenly once more.
        """
        if self.bounded:
            return df
        coarse = self._cut(df, [*self.by], "_coarse")
        fine = self._cut(coarse, [*self.by, "_coarse"], "_fine")
        whole = F.coalesce("_coarse", F.lit(0))
        return (
            fine.withColumn(SLICE, whole * FINE_CUTS + F.coalesce("_fine", F.lit(0)))
            .withColumn(HEAVY, F.col("_coarse").isNotNull())
            .drop("_coarse", "_fine")
        )

    def _cut(self, df: DataFrame, keys: list[str], name: str) -> DataFrame:
        """Number of the even cut a row of a heavy key falls in, null for other keys."""
        position = _position(df, self.order[0])
        heavy = (
            df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_rows"), F.min(position).alias("_from"), F.max(position).alias("_to"))
            .where(F.col("_rows") > self.max_rows)
            .select(
                *keys,
                "_from",
                (F.col("_to") - F.col("_from")).alias("_span"),
                F.least(F.ceil(F.col("_rows") / self.max_rows) * OVERCUT, F.lit(FINE_CUTS - 1)).alias("_cuts"),
            )
        )
        # Rows without a position come first in the order, so they are a slice before all others.
        cut = F.floor((position - F.col("_from")) * F.col("_cuts") / F.col("_span")).cast("long") + 1
        marked = _null_safe(df, F.broadcast(heavy), keys)
        place = F.when(position.isNull(), F.lit(0).cast("long")).when(F.col("_span") > 0, cut).otherwise(F.lit(1).cast("long"))
        return marked.withColumn(name, F.when(F.col("_cuts").isNotNull(), place)).drop("_from", "_span", "_cuts")

    def measured(self, df: DataFrame) -> Lane:
        """This lane, marked ``bounded`` if a count finds no heavy key.

        Runs one narrow job, an aggregate of the key columns.  A scan of an unbounded lane reads its
        input once more for the marks and once for the summaries, so nothing pays for slices
        unless some key needs them.  With several scans in a row and a lane that stays unbounded, write the
        rows out in between: the plan grows with each.
        """
        if self.bounded:
            return self
        sizes = df.groupBy(*self.by).agg(F.count(F.lit(1)).alias("_rows"))
        most, total = sizes.agg(F.coalesce(F.max("_rows"), F.lit(0)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
        if most <= self.max_rows:
            return replace(self, bounded=True, rows=total)
        # The marks are broadcast: with more rows a slice may hold more, so that their number stays bounded.
        return replace(self, max_rows=max(self.max_rows, total // MOST_MARKS), rows=total)

    def scan(self, df: DataFrame, **steps: Step) -> DataFrame:
        """Add one column per step to a frame already marked by :meth:`slice`."""
        local = df.withColumns({name: self._local(step) for name, step in steps.items()})
        if self.bounded:
            return local
        summary = (
            df.where(HEAVY)
            .groupBy(*self.keys)
            .agg(*[self._summary(step).alias(f"_own_{name}") for name, step in steps.items()])
        )
        along = Window.partitionBy(*self.by, *self.within)
        inherited = summary.select(
            *self.keys,
            *[_inherited(step, F.col(f"_own_{name}"), along).alias(f"_in_{name}") for name, step in steps.items()],
        )
        joined = _null_safe(local, inherited, self.keys)
        return joined.withColumns(
            {name: _combine(step, F.col(name), F.col(f"_in_{name}")) for name, step in steps.items()}
        ).drop(*[f"_in_{name}" for name in steps])

    def number(self, df: DataFrame, name: str) -> DataFrame:
        """Number the rows of each lane from 1."""
        return self.run(df, **{name: running_sum(F.lit(1).cast("long"))})

    def release(self, df: DataFrame) -> DataFrame:
        """Drop the helper columns of :meth:`slice`."""
        return df.drop(SLICE, HEAVY)

    def run(self, df: DataFrame, **steps: Step) -> DataFrame:
        """``measured``, ``slice``, ``scan`` and ``release`` in one call."""
        lane = self.measured(df)
        return lane.release(lane.scan(lane.slice(df), **steps))

    def _local(self, step: Step) -> Column:
        window = self.window()
        so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # Looking ahead is looking back in the opposite order: a frame that ends at the last row
        # would be evaluated anew for every row.
        ahead = Window.partitionBy(*self.keys).orderBy(*[F.col(c).desc() for c in self.order])
        from_here = ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        up_to_position = Window.partitionBy(*self.keys).orderBy(self.order[0]).rangeBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        later = ahead.rowsBetween(Window.unboundedPreceding, -1)
        return {
            "sum": lambda v: F.sum(v).over(so_far),
            "min": lambda v: F.min(v).over(so_far),
            "last": lambda v: F.last(v, ignorenulls=True).over(so_far),
            "at": lambda v: F.last(v, ignorenulls=True).over(up_to_position),
            "next": lambda v: F.last(v, ignorenulls=True).over(from_here),
            "after": lambda v: F.last(v, ignorenulls=True).over(later),
            "lead": lambda v: F.lead(v).over(window),
            "lag": lambda v: F.lag(v).over(window),
        }[step.kind](step.value)

    def _summary(self, step: Step) -> Column:
        position = F.when(step.value.isNotNull(), F.struct(*self.order))
        return {
            "sum": lambda v: F.sum(v),
            "min": lambda v: F.min(v),
            "last": lambda v: F.max_by(v, position),
            "at": lambda v: F.max_by(v, position),
            "next": lambda v: F.min_by(v, position),
            "after": lambda v: F.min_by(v, position),
            "lead": lambda v: F.min_by(v, position),
            "lag": lambda v: F.max_by(v, position),
        }[step.kind](step.value)


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which null keys are equal to each other."""
    renamed = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_key_{k}"]) for k in keys])
    return left.join(renamed, same, "left").drop(*[f"_key_{k}" for k in keys])


def _position(df: DataFrame, column: str) -> Column:
    """The order column as a double, monotone in the original value."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        value = F.unix_micros(value.cast("timestamp"))
    elif not isinstance(kind, T.NumericType):
        raise TypeError(f"{column}: the first order column must be numeric, a date or a timestamp")
    return value.cast("double")


def _inherited(step: Step, own: Column, along: WindowSpec) -> Column:
    before = along.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    after = along.orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    return {
        "sum": lambda v: F.sum(v).over(before),
        "min": lambda v: F.min(v).over(before),
        "last": lambda v: F.last(v, ignorenulls=True).over(before),
        "at": lambda v: F.last(v, ignorenulls=True).over(before),
        "next": lambda v: F.last(v, ignorenulls=True).over(after),
        "after": lambda v: F.last(v, ignorenulls=True).over(after),
        "lead": lambda v: F.last(v, ignorenulls=True).over(after),
        "lag": lambda v: F.last(v, ignorenulls=True).over(before),
    }[step.kind](own)


def _combine(step: Step, local: Column, inherited: Column) -> Column:
    if step.kind == "sum":
        return F.coalesce(local + inherited, local, inherited)
    if step.kind == "min":
        return F.least(local, inherited)
    return F.coalesce(local, inherited)
