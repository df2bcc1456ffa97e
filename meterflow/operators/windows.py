"""Time-series operators that stay balanced whatever key or instant the rows crowd on.

A window partitioned by device alone would put all rows of a busy device into one task. Here

* rows are first aggregated to one row per key and instant, so copies collapse on the map side, and
* windows are partitioned by key and a time cell of 10 s. With microsecond clocks a cell has at most ten million
  instants per key, which bounds the group by the clock and not by the data;
* what a cell needs from the cells before it travels separately: as one row per cell (``neighbours``), or as the
  instants of the one cell before it (``trailing``).

All frames start at UNBOUNDED PRECEDING, which Spark updates row by row: cost is linear in the rows, where a
sliding RANGE frame adds up the whole frame again for every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.session import ensure_checkpoints

CELL_US = 10_000_000


def _cell(ts: str, width_us: int) -> Column:
    return F.floor(F.unix_micros(F.col(ts)) / F.lit(width_us)).cast("long")


def neighbours(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    carried: list[Column],
    following: bool = False,
    cell_us: int = CELL_US,
) -> DataFrame:
    """One row per key and instant with ``neighbour``, the instant of that key before (or after) it.

    ``carried`` are aggregates over the rows of the instant. ``keys`` may be empty: one global series.
    """
    instants = rows.groupBy(*keys, ts).agg(*carried).withColumn("_cell", _cell(ts, cell_us))
    edge = F.min(ts) if following else F.max(ts)
    step = F.lead if following else F.lag

    within = Window.partitionBy(*keys, "_cell").orderBy(ts)
    # One row per key and cell, however many rows there are.
    cells = rows.groupBy(*keys, _cell(ts, cell_us).alias("_cell")).agg(edge.alias("_edge"))
    across = Window.partitionBy(*keys).orderBy("_cell")
    carry = cells.select(*keys, "_cell", step("_edge").over(across).alias("_carry"))

    return (
        instants.withColumn("_inner", step(ts).over(within))
        .join(carry, [*keys, "_cell"], "left")
        .withColumn("neighbour", F.coalesce("_inner", "_carry"))
        .drop("_cell", "_inner", "_carry")
    )


def gap_to_previous(rows: DataFrame, keys: list[str], ts: str, seq: str) -> DataFrame:
    """All rows with ``gap_sec``: seconds since the row before it in (``ts``, ``seq``) order, 0 for the first.

    ``seq`` tells rows of one instant apart. All but the first of them have gap 0, so the gaps are joined on
    (keys, ts, seq), which is unique on both sides and cannot be skewed.
    """
    first = neighbours(rows.select(*keys, ts, seq), keys, ts, [F.min(seq).alias(seq)])
    us = F.unix_micros(F.col(ts)) - F.unix_micros(F.col("neighbour"))
    gaps = first.select(*keys, ts, seq, (us / F.lit(1e6)).alias("_gap"))
    return (
        rows.join(gaps, [*keys, ts, seq], "left")
        .withColumn("gap_sec", F.coalesce("_gap", F.lit(0.0)))
        .drop("_gap")
    )


def trailing(
    base: DataFrame,
    keys: list[str],
    ts: str,
    value: Column,
    window_us: int,
    probes: DataFrame | None = None,
    include_current: bool = True,
    center: float = 0.0,
) -> DataFrame:
    """Statistics of the ``base`` rows in [t - window, t] (or [t - window, t) ) for each instant t.

    The instants are those of ``probes``, or of ``base`` itself. Result: keys, ts, n, mean, sd, low, high, last.

    With cells as wide as the window, a window is a head of its own cell and a tail of the cell before. Every
    instant is therefore sent to two cells: to its own, and moved by one window into the next, where the tail is
    what lies at or after t. Nothing is subtracted from a running sum. ``center`` should be near the values: the
    variance is taken from sums of squares around it, and is exactly 0 where all values are the same. NaN and null
    do not count.
    """
    v = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    d = v - F.lit(center)
    instants = base.groupBy(*keys, ts).agg(
        F.count(v).alias("n"),
        F.sum(d).alias("s"),
        F.sum(d * d).alias("q"),
        F.min(v).alias("low"),
        F.max(v).alias("high"),
    )
    stats = ["n", "s", "q", "low", "high"]
    at = F.unix_micros(F.col(ts))
    cell = _cell(ts, window_us)
    own = F.struct(cell.alias("cell"), at.alias("at"), F.lit(False).alias("moved"), F.lit(probes is None).alias("probe"))
    moved = F.struct(
        (cell + 1).alias("cell"), (at + window_us).alias("at"), F.lit(True).alias("moved"), F.lit(False).alias("probe")
    )
    placed = instants.select(*keys, *stats, at.alias("src"), F.explode(F.array(own, moved)).alias("p")).select(
        *keys, "p.*", "src", *stats
    )
    if probes is not None:
        asked = probes.select(*keys, ts).distinct().select(
            *keys, cell.alias("cell"), at.alias("at"), F.lit(False).alias("moved"), F.lit(True).alias("probe")
        )
        placed = placed.unionByName(asked, allowMissingColumns=True)

    here = Window.partitionBy(*keys, "cell")
    head = here.orderBy(F.col("at")).rangeBetween(Window.unboundedPreceding, 0 if include_current else -1)
    tail = here.orderBy(F.col("at").desc()).rangeBetween(Window.unboundedPreceding, 0)

    def both(fn, name: str, combine) -> Column:
        return combine(
            fn(F.when(~F.col("moved"), F.col(name))).over(head), fn(F.when(F.col("moved"), F.col(name))).over(tail)
        )

    def add(a: Column, b: Column) -> Column:
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))

    summed = placed.select(
        *keys,
        "at",
        "probe",
        both(F.sum, "n", add).alias("n"),
        both(F.sum, "s", add).alias("s"),
        both(F.sum, "q", add).alias("q"),
        both(F.min, "low", F.least).alias("low"),
        both(F.max, "high", F.greatest).alias("high"),
        both(F.max, "src", F.greatest).alias("last"),
    ).where("probe")
    n, s, q = F.col("n"), F.col("s"), F.col("q")
    variance = F.try_divide(q - F.try_divide(s * s, n), n - 1)
    return summed.select(
        *keys,
        F.timestamp_micros("at").alias(ts),
        n,
        (F.try_divide(s, n) + F.lit(center)).alias("mean"),
        F.when(n < 2, None).when(F.col("low") == F.col("high"), 0.0)
        .otherwise(F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("sd"),
        "low",
        "high",
        F.timestamp_micros("last").alias("last"),
    )


def rolling_mean(readings: DataFrame, window_sec: float = 10.0, center: float = 120.0) -> DataFrame:
    """All readings with the mean voltage of their device over the window that ends with them."""
    means = trailing(
        readings, ["device_id"], "timestamp", F.col("voltage_v"), int(window_sec * 1e6), center=center
    ).select("device_id", "timestamp", F.col("n").alias("readings"), F.col("mean").alias("rolling_voltage"))
    return readings.join(means, ["device_id", "timestamp"])


def spikes(
    readings: DataFrame, k: float = 3.0, min_n: int = 5, window_sec: float = 10.0, center: float = 120.0
) -> DataFrame:
    """Readings more than ``k`` standard deviations off the window before them.

    The instant itself is left out of its baseline: with it, no reading can be further than (n-1)/sqrt(n) off.
    """
    baseline = (
        trailing(
            readings, ["device_id"], "timestamp", F.col("voltage_v"), int(window_sec * 1e6),
            include_current=False, center=center,
        )
        .where((F.col("n") >= max(min_n, 2)) & (F.col("sd") > 0))
        .select("device_id", "timestamp", F.col("n").alias("baseline_n"), F.col("mean").alias("baseline_mean"),
                F.col("sd").alias("baseline_sd"))
    )
    off = F.abs(F.nanvl(F.col("voltage_v"), F.lit(None)) - F.col("baseline_mean"))
    return readings.join(baseline, ["device_id", "timestamp"]).where(off > F.lit(float(k)) * F.col("baseline_sd"))


def cadence_gaps(readings: DataFrame, longer_than_sec: float = 0.1) -> DataFrame:
    """Where a device was silent for longer than its interval."""
    gap = (F.unix_micros("timestamp") - F.unix_micros("neighbour")) / F.lit(1e6)
    return (
        neighbours(readings.select("device_id", "timestamp"), ["device_id"], "timestamp", [F.count("*").alias("readings")])
        .select("device_id", F.col("neighbour").alias("silent_from"), F.col("timestamp").alias("silent_to"),
                gap.alias("gap_sec"))
        .where(F.col("gap_sec") > longer_than_sec)
    )


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key: an aggregate with map-side combine, for which each task sorts its rows by key."""
    others = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_r")).select(
        *keys, *[F.col(f"_r.{c}").alias(c) for c in others]
    )


def first_per_key(rows: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows per key. Spark keeps only n rows per key and task before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def positions(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All rows with their 1-based ``position`` within their key, exact for keys of any size.

    A global sort splits even a single key over many tasks. The row ids of the sorted frame hold the partition
    in the upper bits and the row in the lower 33, so one row per key and partition (its first id and its count)
    is enough to number the rows of each key. The sorted frame is checkpointed, as ids and counts must come from
    the same sort.
    """
    ensure_checkpoints(rows.sparkSession)
    ids = rows.orderBy(*keys, *order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    ids = ids.withColumn("_part", F.shiftright("_id", 33))
    pieces = ids.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(*keys, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        ids.join(starts, [*keys, "_part"])
        .withColumn("position", F.col("_start") + F.col("_id") - F.col("_first") + 1)
        .drop("_id", "_part", "_start", "_first")
    )
