"""Second and later loads: only what is new is read, only what it touches is made anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.operators import daily as DY


def high_water(stored: DataFrame, by: str, at: str) -> DataFrame:
    """``by, mark, rows`` of a stored table: how far each of its parts has been loaded."""
    return stored.groupBy(by).agg(F.max(at).alias("mark"), F.count("*").alias("rows"))


def after_marks(source: DataFrame, marks: DataFrame, by: str, at: str) -> DataFrame:
    """Rows of the source beyond the mark of their part; a part without a mark is new as a whole."""
    side = marks.select(F.col(by).alias("_by"), F.col("mark").alias("_mark"))
    return source.join(side, F.col(by).eqNullSafe(F.col("_by")), "left").filter(F.col("_mark").isNull() | (F.col(at) > F.col("_mark"))).drop("_by", "_mark")


def tail_state(daily: DataFrame, group, order: str, window: int = 30, before: Column | None = None) -> DataFrame:
    """The last ``window`` rows of every group, which is all that later trailing baselines need of the past."""
    rows = daily if before is None else daily.filter(before)
    newest = Window.partitionBy(*group).orderBy(F.col(order).desc())
    return rows.withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= window).drop("_back")


def continued(tail: DataFrame, new: DataFrame, make, group, order: str) -> DataFrame:
    """``make`` over the kept tail and the new rows, of which only the new ones are returned.

    ``make`` may look back over no more rows than the tail holds; the new rows
    come after those of the tail.
    """
    marked = tail.select(*new.columns, F.lit(False).alias("_new")).unionByName(new.withColumn("_new", F.lit(True)))
    return make(marked).filter("_new").drop("_new")


def trailing_baseline(tail: DataFrame, new: DataFrame, group, order: str, value: str, window: int = 30) -> DataFrame:
    """:func:`beaconry.operators.daily.trailing_baseline` of new rows from the carried tail of each group."""
    return continued(tail, new, lambda rows: DY.trailing_baseline(rows, group, order, value, window), group, order)


def updated_daily(old: DataFrame, incidents: DataFrame, arrived: DataFrame, grain=DY.GRAIN, group=DY.LIMIT_GROUP, order: str = "incident_date",
                  by: str = "incident_year", window: int = 30, **limits) -> DataFrame:
    """The rows of the stored daily table that change, whole parts of ``by``, after new incidents have arrived.

    ``incidents`` are all incidents and ``arrived`` the new ones among them.
    Days that got incidents are counted anew, from the incidents of those days
    alone.  Limits are made again from the first such day of each group on, with
    the ``window`` rows before it; all other rows are taken over.  To be written
    over the same parts of the stored table.
    """
    days = arrived.select(*grain).distinct()
    fresh = DY.derived_metrics(DY.daily_performance(incidents.join(days, grain, "left_semi"), grain))
    base = [c for c in fresh.columns if c in old.columns]
    first = days.groupBy(*group).agg(F.min(order).alias("_from"))
    rows = old.join(days, grain, "left_anti").select(*base).unionByName(fresh.select(*base)).join(first, list(group), "left")
    later = F.col("_from").isNotNull() & (F.col(order) >= F.col("_from"))
    tail = tail_state(rows, group, order, window, F.col("_from").isNotNull() & (F.col(order) < F.col("_from")))
    made = continued(tail.drop("_from"), rows.filter(later).drop("_from"), lambda r: DY.control_limits(r, group, order, window=window, **limits), group, order)
    parts = rows.filter(later).select(by).distinct()
    same = old.join(first, list(group), "left").filter(F.col("_from").isNull() | (F.col(order) < F.col("_from"))).drop("_from").join(parts, by, "left_semi")
    return same.select(*old.columns).unionByName(made.select(*old.columns))
