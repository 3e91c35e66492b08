"""Global order positions without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY moves every row to one
task. Here rows are range-partitioned on the order, sorted inside each
partition, numbered locally, pinned, and shifted by the running count of the
partitions before them. Only one row per partition reaches the small offset
table, which is broadcast: its size is bounded by the partition count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import estimate_partitions, materialize

_PID_SHIFT = 33  # monotonically_increasing_id keeps the partition index above bit 33


def global_positions(
    df: DataFrame,
    order: list[str | Column],
    pos_col: str = "_pos",
    num_partitions: int | None = None,
    pin: str = "table",
) -> DataFrame:
    """Add a 0-based position of each row in the total order ``order``.

    Rows equal on ``order`` get distinct, adjacent positions in arbitrary order.
    Add a tiebreak column to ``order`` to make positions deterministic. The
    number of range partitions follows the data size (``estimate_partitions``);
    the broadcast offset table has one row per partition.
    """
    spark = df.sparkSession
    n = num_partitions or estimate_partitions(df)
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Both the partition counts and the final numbering read this frame: pin it.
    ranged = materialize(ranged, pin)
    pid = F.shiftright(F.col("_mid"), _PID_SHIFT)
    counts = ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), _PID_SHIFT)
    return (
        ranged.withColumn("_pid", pid)
        .join(F.broadcast(offsets), "_pid")
        .withColumn(pos_col, F.col("_off") + local)
        .drop("_pid", "_off", "_mid")
    )


def dense_ids(
    df: DataFrame,
    order: list[str | Column],
    id_col: str = "id",
    offset: int = 0,
    num_partitions: int | None = None,
    pin: str = "table",
) -> DataFrame:
    """Dense ids ``offset+1 .. offset+n`` following ``order`` (distributed)."""
    out = global_positions(df, order, "_pos", num_partitions, pin)
    return out.withColumn(id_col, (F.col("_pos") + F.lit(offset + 1)).cast("bigint")).drop("_pos")


SKETCH_ACCURACY = 10_000
MAX_COLLECTED = 100_000  # distinct values inside the brackets that the driver may sort


def _below(x: Column, v) -> Column:
    return F.coalesce(F.sum(F.when(x < F.lit(v), 1).otherwise(0)), F.lit(0)).cast("long")


def _narrowed(frame: DataFrame, spans: list[dict], accuracy: int) -> list[dict]:
    """One bracket of values around each wanted rank, from one bounded sketch per span of values.

    A span is {lo, hi, below, n, ranks}: values lo..hi hold the ranks below..below + n - 1.
    """
    x, aggs = F.col("_v"), []
    for i, s in enumerate(spans):
        inside = F.when((x >= F.lit(s["lo"])) & (x <= F.lit(s["hi"])), x)
        # a sketch answers within n / accuracy ranks; two of these on each side bracket the rank
        grid = [min(1.0, max(0.0, (r - s["below"]) / max(1, s["n"] - 1) + d * 2.0 / accuracy)) for r in s["ranks"] for d in (-1, 1)]
        aggs.append(F.percentile_approx(inside, grid, accuracy).alias(f"a{i}"))
    row = frame.agg(*aggs).first()
    out = []
    for i, s in enumerate(spans):
        for j, r in enumerate(s["ranks"]):
            lo, hi = row[f"a{i}"][2 * j:2 * j + 2]
            at = (r - s["below"]) / max(1, s["n"] - 1)
            lo = s["lo"] if at - 2.0 / accuracy <= 0 else lo
            hi = s["hi"] if at + 2.0 / accuracy >= 1 else hi
            out.append({"lo": lo, "hi": hi, "ranks": [r], "span": s})
    return out


def _counted(frame: DataFrame, brackets: list[dict]) -> list[dict]:
    """The brackets with ``below`` and ``n`` counted in one scan; one that misses its rank becomes its span again."""
    x = F.col("_v")
    aggs = []
    for i, b in enumerate(brackets):
        aggs += [_below(x, b["lo"]).alias(f"b{i}"),
                 F.coalesce(F.sum(F.when((x >= F.lit(b["lo"])) & (x <= F.lit(b["hi"])), 1)), F.lit(0)).cast("long").alias(f"n{i}")]
    row = frame.agg(*aggs).first()
    out = []
    for i, b in enumerate(brackets):
        below, n = row[f"b{i}"], row[f"n{i}"]
        if below <= b["ranks"][0] < below + n:
            out.append({"lo": b["lo"], "hi": b["hi"], "below": below, "n": n, "ranks": b["ranks"]})
        else:
            out.append({**b["span"], "ranks": b["ranks"]})
    return out


def values_at_ranks(values: DataFrame, ranks: list[int], n: int, lo, hi, accuracy: int = SKETCH_ACCURACY,
                    max_collected: int = MAX_COLLECTED) -> dict:
    """Exact values of 0-based ``ranks`` in the order of column ``_v`` (no nulls, ``n`` rows, from ``lo`` to ``hi``).

    Selection instead of a sort: a bounded sketch brackets each rank, one scan counts what lies below and
    inside the brackets, and only the distinct values inside are sorted. While those are more than
    ``max_collected`` (at least one per wanted rank), the brackets are narrowed again, each time by about
    ``accuracy / 4``. Nothing but
    the values inside the brackets is shuffled, and equal values count once.
    """
    whole = {"lo": lo, "hi": hi, "below": 0, "n": n, "ranks": sorted(set(ranks))}
    spans, size = [whole], n
    while True:
        spans = _counted(values, _narrowed(values, spans, accuracy))
        now = sum(s["n"] for s in spans)
        if 2 * now > size:  # too coarse a sketch for what is left; one finer than the rows is exact
            accuracy = min(accuracy * 8, (1 << 31) - 1)
        size = now
        x = F.col("_v")
        inside = None
        for s in spans:
            hit = (x >= F.lit(s["lo"])) & (x <= F.lit(s["hi"]))
            inside = hit if inside is None else inside | hit
        counts = values.where(inside).groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
        found = counts.limit(max(max_collected, len(whole["ranks"])) + 1).collect()
        if len(found) <= max(max_collected, len(whole["ranks"])):
            break
    found.sort(key=lambda r: (r["_v"] != r["_v"], r["_v"]))  # not-a-number is the largest value, as in Spark
    out = {}
    for s in spans:
        at = s["below"]
        todo = list(s["ranks"])
        for r in found:
            v = r["_v"]
            if not ((v >= s["lo"] or v != v) and (v <= s["hi"] or s["hi"] != s["hi"])):
                continue
            at += r["_n"]
            while todo and todo[0] < at:
                out[todo.pop(0)] = v
    return out


def exact_quantiles(
    df: DataFrame,
    value_col: str,
    quantiles: list[float],
    num_partitions: int | None = None,
    pin: str = "table",
    return_values: bool = False,
):
    """Exact quantiles with linear interpolation between closest ranks, by selection (``values_at_ranks``).

    The column is pinned once (in ``num_partitions`` parts, if given) and scanned; it is neither sorted nor
    shuffled. Returns one value per quantile (None when there are no non-null values); with
    ``return_values`` also the pinned values (column ``_v``).
    """
    v = df.select(F.col(value_col).alias("_v")).where(F.col("_v").isNotNull())
    values = materialize(v.coalesce(num_partitions) if num_partitions else v, pin)
    ends = values.agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).first()
    n = ends["n"]
    if n == 0:
        return ([None] * len(quantiles), values) if return_values else [None] * len(quantiles)
    plan = []
    for q in quantiles:
        rn = (n - 1) * float(q)
        lo, hi = int(rn // 1), int(-(-rn // 1))
        plan.append((lo, hi, rn - lo))
    at = values_at_ranks(values, [r for lo, hi, _ in plan for r in (lo, hi)], n, ends["lo"], ends["hi"])
    out = []
    for lo, hi, d in plan:
        a, b = at[lo], at[hi]
        out.append(a if lo == hi or a == b else a + (b - a) * d)
    return (out, values) if return_values else out
