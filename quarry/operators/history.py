"""Per-key ordered history (lag, moving averages of previous rows or seconds), skew-safe.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task, so a
ticker holding a third of the data becomes a third of the job in one task.
Here each key is cut into chunks of event time (calendar days by default; the
tick jobs use ``chunk="auto"``: borders of equal depth from each large key's own
histogram, see ``quarry.operators.chunks``; without large keys a plain window):

1. one window pass per ``(key, chunk)`` computes in-chunk lags, in-chunk sums
   and counts of the previous ``rows`` values, and the row's rank in its chunk;
2. the last ``rows`` rows of every chunk ("tails", at most ``rows`` per chunk)
   are ordered per key; for the first tail row of each chunk they give the
   history that precedes the chunk (a "halo": one row per chunk);
3. every row is left-joined to its chunk's halo on ``(key, chunk)`` - the big
   side is already hash-partitioned on those columns by step 1, so it is not
   shuffled again - and the first ``rows`` rows of each chunk take the missing
   history from the halo.

Only step 1 shuffles the data. Step 2 shuffles at most ``rows`` rows per chunk.
With ``chunk=None`` a plain per-key window is used.

``with_time_history`` covers averages over the previous N seconds in linear time:
every row enters a running sum at its time and leaves it N seconds later, as a
second, negative record in the same sorted pass. Chunks of any length work: a
chunk starts from the totals of the chunks before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.chunks import border_tables, with_chunks

# Chunk units tried by ``auto_chunk``, coarsest first, with their length in seconds.
CHUNK_UNITS = (("month", 31 * 86400), ("week", 7 * 86400), ("day", 86400), ("hour", 3600),
               ("minute", 60), ("second", 1), ("millisecond", 0.001))
TARGET_ROWS_PER_CHUNK = 2_000_000


def auto_chunk(df: DataFrame, keys: list[str], ts: str, target_rows: int = TARGET_ROWS_PER_CHUNK) -> str:
    """Coarsest unit whose chunks hold at most ``target_rows`` rows of the densest key at its mean rate.

    For jobs that want one calendar unit for all keys; ``chunk="auto"`` does not depend on a mean rate.

    One aggregate (partial per task, one row per key after the shuffle) gives
    each key's rows per second over its own time span.
    """
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), ((F.max(t) - F.min(t)) / 1e6).alias("span")
    )
    rate = per_key.agg(F.max(F.col("n") / F.greatest(F.col("span"), F.lit(1.0)))).first()[0] or 0.0
    for unit, secs in CHUNK_UNITS:
        if rate * secs <= target_rows:
            return unit
    return CHUNK_UNITS[-1][0]


def chunk_expr(chunk: str | Column | None, ts: str) -> Column | None:
    if chunk is None or isinstance(chunk, Column):
        return chunk
    if chunk == "day":
        return F.to_date(F.col(ts))
    return F.date_trunc(chunk, F.col(ts))


def _keyed(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Add ``_gk`` (the keys as a struct, so that null keys are equal) and ``_t`` (time in microseconds)."""
    return df.withColumn("_gk", F.struct(*[F.col(k) for k in keys])).withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))


def with_history(
    df: DataFrame,
    key: str | list[str],
    order: list[str],
    lags: dict[str, str] | None = None,
    moving_avgs: dict[str, str] | None = None,
    rows: int = 10,
    chunk: str | Column | None = "day",
    target_rows: int = TARGET_ROWS_PER_CHUNK,
) -> DataFrame:
    """Add ``lags`` (out -> column: previous row's value) and ``moving_avgs``
    (out -> column: average of the previous ``rows`` non-null values, current
    row excluded, null when there is none), per ``key`` in ``order``.

    ``order`` must be a total order inside a key (add a tiebreak column).
    ``chunk`` must not decrease along ``order``: a unit for ``date_trunc``, "day",
    "auto" (borders of equal depth, at most ``target_rows`` rows a chunk but for
    rows of one instant), a Column, or None.
    """
    keys = [key] if isinstance(key, str) else list(key)
    lags = dict(lags or {})
    moving_avgs = dict(moving_avgs or {})
    if rows < 1:
        raise ValueError("rows must be >= 1")
    tables = None
    if isinstance(chunk, str) and chunk == "auto":
        df = _keyed(df, keys, order[0])
        tables = border_tables(df, target_rows)
        if not tables:  # no large key: one chunk each
            df, chunk = df.drop("_gk", "_t"), None
    ch = None if tables else chunk_expr(chunk, order[0])
    if ch is None and not tables:
        w = Window.partitionBy(*keys).orderBy(*order)
        frame = w.rowsBetween(-rows, -1)
        out = df
        for name, c in lags.items():
            out = out.withColumn(name, F.lag(c).over(w))
        for name, c in moving_avgs.items():
            out = out.withColumn(name, F.avg(c).over(frame))
        return out

    # Group on non-nullable structs: equality of structs is null-safe (a null
    # key or chunk is a group like any other), no IsNotNull is inferred, and the
    # halo join below is a plain equi-join on the columns the window already
    # hash-partitioned by, so Spark neither reshuffles the big side nor breaks
    # the reuse of its exchange in the tails branch.
    part = ["_gk", "_chunk"]
    w = Window.partitionBy(*part).orderBy(*order)
    frame = w.rowsBetween(-rows, -1)
    # The key lives only inside `_gk` until the end, so both branches below
    # project the same columns and share one exchange (columns a caller
    # carries beyond key, order and value columns make the tails branch
    # narrower; results stay right but the tails then shuffle separately).
    if tables:
        cut = with_chunks(df, tables).drop("_t")
    else:
        cut = df.withColumn("_gk", F.struct(*[F.col(k) for k in keys])).withColumn("_chunk", F.struct(ch.alias("c")))
    base = (
        cut.drop(*keys)
        .withColumn("_rn", F.row_number().over(w))
        .withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy(*part)))
    )
    for name, c in lags.items():
        base = base.withColumn(name, F.lag(c).over(w))
    for name, c in moving_avgs.items():
        base = base.withColumn(f"_s_{name}", F.sum(F.col(c).cast("double")).over(frame))
        base = base.withColumn(f"_c_{name}", F.count(c).over(frame))

    # Halo: history before each chunk, from the tails of earlier chunks.
    wt = Window.partitionBy("_gk").orderBy("_chunk", *order)
    tails = base.where(F.col("_rn") > F.col("_cnt") - rows)
    halo_cols = []
    for name, c in lags.items():
        halo_cols.append(F.lag(c).over(wt).alias(f"_h_{name}"))
    for name, c in moving_avgs.items():
        hist = F.collect_list(F.struct(F.col(c).cast("double").alias("v"))).over(
            wt.rowsBetween(-rows, -1)
        )
        halo_cols.append(hist.alias(f"_h_{name}"))
    first_tail = F.col("_rn") == F.greatest(F.col("_cnt") - rows + 1, F.lit(1))
    halo = tails.select(*part, first_tail.alias("_first"), *halo_cols).where("_first").drop("_first")

    out = base.join(halo, part, "left")
    head = F.col("_rn") <= rows
    for name in lags:
        out = out.withColumn(
            name, F.when(F.col("_rn") == 1, F.col(f"_h_{name}")).otherwise(F.col(name))
        )
    for name in moving_avgs:
        hist = F.coalesce(F.col(f"_h_{name}"), F.array().cast("array<struct<v:double>>"))
        need = F.lit(rows + 1) - F.col("_rn")  # history rows missing from the chunk
        start = F.greatest(F.size(hist) - need + 1, F.lit(1))
        extra = F.slice(hist, start, F.greatest(need, F.lit(0)))
        extra_sum = F.aggregate(extra, F.lit(0.0), lambda a, x: a + F.coalesce(x["v"], F.lit(0.0)))
        extra_cnt = F.size(F.filter(extra, lambda x: x["v"].isNotNull()))
        s = F.coalesce(F.col(f"_s_{name}"), F.lit(0.0))
        n = F.col(f"_c_{name}")
        s = F.when(head, s + extra_sum).otherwise(s)
        n = F.when(head, n + extra_cnt).otherwise(n)
        out = out.withColumn(name, F.when(n > 0, s / n))
    out = out.select(*[F.col(f"_gk.{k}").alias(k) for k in keys], "*")
    drop = ["_gk", "_chunk", "_rn", "_cnt"]
    drop += [f"_h_{x}" for x in list(lags) + list(moving_avgs)]
    drop += [f"_{p}_{x}" for x in moving_avgs for p in ("s", "c")]
    return out.drop(*drop)


def _channels(kind: T.DataType, v: Column) -> dict[str, Column]:
    """What is summed over a frame: the values' sum and count, and what a sum of doubles cannot take back.

    Whole numbers and decimals are summed exactly. Doubles below 1e15 are summed as decimals with 18 places,
    so that a value that left the frame leaves no rounding error behind; larger ones as doubles, and
    not-a-number and infinities are counted.
    """
    one = F.when(v.isNotNull(), F.lit(1).cast("long"))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return {"s": v.cast("long"), "n": one}
    if isinstance(kind, T.DecimalType):
        return {"s": v, "n": one}
    x = v.cast("double")
    small = ~F.isnan(x) & (F.abs(x) < 1e15)
    big = ~F.isnan(x) & (F.abs(x) >= 1e15) & (F.abs(x) < float("inf"))
    return {"s": F.when(small, x).cast("decimal(38,18)"), "n": one, "big": F.when(big, x),
            "nan": F.when(F.isnan(x), one), "up": F.when(x == float("inf"), one), "down": F.when(x == float("-inf"), one)}


def _average(got: dict[str, Column]) -> Column:
    total = got["s"].cast("double")
    if "big" not in got:
        return F.when(got["n"] > 0, total / got["n"])
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    return (F.when(got["n"] <= 0, F.lit(None).cast("double"))
            .when((got["nan"] > 0) | ((got["up"] > 0) & (got["down"] > 0)), nan)
            .when(got["up"] > 0, inf).when(got["down"] > 0, -inf)
            .otherwise((total + got["big"]) / got["n"]))


def with_time_history(
    df: DataFrame,
    key: str | list[str],
    ts: str,
    moving_avgs: dict[str, str],
    range_seconds: float,
    chunk: str | None = "auto",
    target_rows: int = TARGET_ROWS_PER_CHUNK,
) -> DataFrame:
    """Average of each column over the previous ``range_seconds`` of the same key,
    current instant excluded (rows with ``ts`` in ``[t - range, t)``), null when empty.

    Linear in the rows, however many of them a range holds: each row is a record that adds
    its value at its time and one that takes it back ``range_seconds`` later, and a row's sum is that
    of all records before its time. Skew-safe for ranges of any length: records are cut into
    chunks (``"auto"``: borders of equal depth; a unit of ``date_trunc``; None: one per key), sums run
    inside a chunk, and the totals of a key's earlier chunks, one row per chunk, are added. One shuffle
    of the data. Rows without a time have no average and count in none.
    """
    keys = [key] if isinstance(key, str) else list(key)
    range_us = int(round(range_seconds * 1_000_000))
    if range_us < 1:
        raise ValueError("range_seconds must be positive")
    src = _keyed(df, keys, ts)
    channels = {(out, name): expr for out, c in moving_avgs.items() for name, expr in _channels(df.schema[c].dataType, F.col(c)).items()}
    cols = {k: f"_v{i}" for i, k in enumerate(channels)}
    timed = F.col("_t").isNotNull()
    leaves = F.explode(F.when(timed, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = src.select("_gk", "_t", F.struct(*[F.col(c) for c in df.columns]).alias("_row"),
                      *[F.when(timed, e).alias(cols[k]) for k, e in channels.items()], leaves.alias("_out"))
    own = F.col("_out") == 0
    records = rows.select(
        "_gk", (F.col("_t") + F.col("_out").cast("long") * F.lit(range_us)).alias("_t"), F.when(own, F.col("_row")).alias("_row"),
        *[F.when(own, F.col(c)).otherwise(-F.col(c)).alias(c) for c in cols.values()])
    if chunk is None:
        tables = []
    elif chunk == "auto":
        tables = border_tables(records, target_rows)
    if chunk is None or (chunk == "auto" and not tables):
        cut, part = records, ["_gk"]
    else:
        part = ["_gk", "_chunk"]
        cut = with_chunks(records, tables) if chunk == "auto" else records.withColumn(
            "_chunk", F.struct(F.date_trunc(chunk, F.timestamp_micros("_t")).alias("c")))
    before = Window.partitionBy(*part).orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    sums = {c: F.coalesce(F.sum(c).over(before), F.lit(0)) for c in cols.values()}
    out = cut.select("*", *[e.alias(f"_s{c}") for c, e in sums.items()])
    if len(part) > 1:
        totals = cut.groupBy(*part).agg(*[F.sum(c).alias(c) for c in cols.values()])
        earlier = Window.partitionBy("_gk").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        starts = totals.select(*part, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_b{c}") for c in cols.values()])
        out = out.join(starts, part, "left")
        got = {k: F.col(f"_s{c}") + F.col(f"_b{c}") for k, c in cols.items()}
    else:
        got = {k: F.col(f"_s{c}") for k, c in cols.items()}
    averages = [F.when(F.col("_t").isNotNull(), _average({n: got[o, n] for o, n in got if o == name})).alias(name) for name in moving_avgs]
    return out.where(F.col("_row").isNotNull()).select(*[F.col("_row")[c].alias(c) for c in df.columns if c not in moving_avgs], *averages)
