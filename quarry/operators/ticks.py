"""Price series jobs: tick-to-tick change, percentile thresholds, anomaly rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.change import abs_pct_change, pct_change
from quarry.functions.json import to_json_value
from quarry.operators.history import with_history, with_time_history
from quarry.operators.ranks import exact_quantiles

# The quantiles of the thresholding report and their labels.
QUANTILES = (0.95, 0.99, 0.995, 0.9995, 0.99995)
QUANTILE_LABELS = ("95th", "99th", "99.5th", "99.95th", "99.995th")
# The report's column headers.
REPORT_COLUMNS = (
    "Percentile of % change in stock price",
    "Value of % change in stock price",
    "Number of trades exceeding this value",
)
# Anomaly thresholds (percent), history length and labels.
PRICE_PCT = 0.5
VOLUME_PCT = 2.0
VOLUME_ROWS = 10
ANOMALY_LABELS = ("Price+Volume", "Price", "Volume", "None")
VOLUME_WARNING = "Traded Volume more than 2% of its average"


def price_changes(
    ticks: DataFrame,
    key: str = "stock_ticker",
    ts: str = "timestamp",
    price: str = "close",
    tiebreak: tuple[str, ...] = ("event_id",),
    chunk: str | Column | None = "auto",
) -> DataFrame:
    """Absolute % change of ``price`` from the previous tick of the same key.

    The first tick of every key has no previous one and is dropped; a previous
    price of 0 gives a null change instead of a division error.
    """
    h = with_history(ticks, key, [ts, *tiebreak], lags={"prev_close": price}, rows=1, chunk=chunk)
    return h.where(F.col("prev_close").isNotNull()).withColumn(
        "pct_change", abs_pct_change(F.col(price), F.col("prev_close"))
    )


def threshold_summary(
    changes: DataFrame,
    col: str = "pct_change",
    quantiles=QUANTILES,
    labels=QUANTILE_LABELS,
    exact: bool = True,
    accuracy: int = 10_000,
    names=("percentile", "value", "n_exceeding"),
    certify: bool = False,
) -> DataFrame:
    """One row per quantile: label, threshold value, count of rows strictly above.

    ``exact`` selects the values at the wanted ranks (``quarry.operators.ranks``); otherwise
    ``percentile_approx`` with ``accuracy``, one bounded sketch per task.
    Exceedances for all thresholds come from one conditional aggregate. ``certify``
    adds ``n_below``, ``n_equal`` and ``within_bound`` from the same aggregate: the quantile's rank lies within
    ``n / accuracy`` rows of the ranks the value takes (``accuracy`` is not used by the exact form: no tolerance).
    """
    if len(labels) != len(quantiles):
        raise ValueError("one label per quantile")
    x = F.col(col)
    if exact:
        # The values are pinned once; the counts below read them instead
        # of recomputing the upstream plan (nulls never exceed a threshold).
        values, pinned = exact_quantiles(changes, col, list(quantiles), return_values=True)
        changes, x = pinned, F.col("_v")
    else:
        row = changes.agg(F.percentile_approx(x, list(quantiles), accuracy).alias("p")).first()
        values = list(row["p"]) if row["p"] is not None else [None] * len(quantiles)
    aggs = [
        F.coalesce(F.sum(F.when(x > F.lit(v), 1).otherwise(0)), F.lit(0)).cast("bigint").alias(f"n{i}")
        for i, v in enumerate(values)
    ]
    if certify:
        for i, v in enumerate(values):
            aggs += [F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(f"{c}{i}")
                     for c, test in (("b", x < F.lit(v)), ("e", x == F.lit(v)))]
        aggs.append(F.count(x).alias("n"))
    counts = changes.agg(*aggs)
    value = [f"CAST({repr(float(v)) if v is not None else 'NULL'} AS DOUBLE)" for v in values]
    cols = [[f"'{lab}'", value[i], f"n{i}"] for i, lab in enumerate(labels)]
    out_names = list(names)
    if certify:
        slack = "0" if exact else f"n / {float(accuracy)}"
        for i, q in enumerate(quantiles):
            # linear interpolation lies between two neighbouring ranks, hence one row on each side
            rank = f"(n - 1) * {float(q)!r}D"
            cols[i] += [f"b{i}", f"e{i}", f"n = 0 OR (b{i} - 1 - {slack} <= {rank} AND {rank} <= b{i} + e{i} + {slack})"]
        out_names += ["n_below", "n_equal", "within_bound"]
    pairs = ", ".join(", ".join(c) for c in cols)
    return counts.selectExpr(f"stack({len(values)}, {pairs}) AS ({', '.join(f'`{c}`' for c in out_names)})")


def detect_anomalies(
    ticks: DataFrame,
    key: str = "stock_ticker",
    ts: str = "timestamp",
    tiebreak: tuple[str, ...] = ("event_id",),
    price_pct: float = PRICE_PCT,
    volume_pct: float = VOLUME_PCT,
    rows: int = VOLUME_ROWS,
    chunk: str | Column | None = "auto",
    volume_window_seconds: float | None = None,
) -> DataFrame:
    """Price and volume rules on every bar.

    Price: |% change from the previous close| > ``price_pct``. Volume: % above
    the average of the previous ``rows`` volumes > ``volume_pct`` (one-sided);
    with ``volume_window_seconds`` the average covers that much time instead.
    Bars without history are not anomalies; a previous close of 0 is not one
    either. Adds prev_minute_close, avg_10min_volume, price_change_pct,
    volume_change_pct, is_price_anomaly, is_volume_anomaly, anomaly_type,
    is_anomaly.
    """
    if volume_window_seconds is None:
        h = with_history(
            ticks, key, [ts, *tiebreak],
            lags={"prev_minute_close": "close"},
            moving_avgs={"avg_10min_volume": "volume"},
            rows=rows, chunk=chunk,
        )
    else:
        # the average covers the previous `volume_window_seconds` instead of `rows` bars
        h = with_history(ticks, key, [ts, *tiebreak], lags={"prev_minute_close": "close"}, rows=1, chunk=chunk)
        h = with_time_history(h, key, ts, {"avg_10min_volume": "volume"}, volume_window_seconds,
                              chunk if isinstance(chunk, str) or chunk is None else "auto")
    return apply_rules(h, price_pct, volume_pct)


def apply_rules(h: DataFrame, price_pct: float = PRICE_PCT, volume_pct: float = VOLUME_PCT) -> DataFrame:
    """Rule columns from ``prev_minute_close`` and ``avg_10min_volume`` (batch or stream)."""
    prev = F.col("prev_minute_close")
    avg = F.col("avg_10min_volume")
    has_avg = avg.isNotNull() & (avg > 0)
    h = h.withColumns({
        "price_change_pct": F.when(prev.isNotNull(), pct_change(F.col("close"), prev)).otherwise(F.lit(0.0)),
        "volume_change_pct": F.when(has_avg, pct_change(F.col("volume").cast("double"), avg)).otherwise(F.lit(0.0)),
    })
    p = F.coalesce(prev.isNotNull() & (F.abs(F.col("price_change_pct")) > price_pct), F.lit(False))
    v = F.coalesce(avg.isNotNull() & (F.col("volume_change_pct") > volume_pct), F.lit(False))
    both, price_only, volume_only, none = ANOMALY_LABELS
    label = (
        F.when(p & v, F.lit(both)).when(p, F.lit(price_only)).when(v, F.lit(volume_only)).otherwise(F.lit(none))
    )
    return h.withColumns({
        "is_price_anomaly": p,
        "is_volume_anomaly": v,
        "anomaly_type": label,
        "is_anomaly": p | v,
    })


# The columns of the anomaly report.
ANOMALY_REPORT = [
    "stock_ticker", "timestamp", "close", "volume", "prev_minute_close",
    "avg_10min_volume", "price_change_pct", "volume_change_pct", "anomaly_type",
]


def anomalies(flagged: DataFrame) -> DataFrame:
    """Anomalous bars with the report columns."""
    return flagged.where(F.col("is_anomaly")).select(*ANOMALY_REPORT)


def alert_messages(flagged: DataFrame, ts_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> DataFrame:
    """Volume alerts as keyed JSON messages (``key``, ``value`` strings).

    Stays distributed: write the result with a topic or file sink. Key is the
    ticker so a keyed topic keeps one ticker's alerts in order.
    """
    vol = flagged.where(F.col("is_volume_anomaly"))
    body = (
        F.col("stock_ticker").cast("string").alias("stock_ticker"),
        F.date_format("timestamp", ts_format).alias("timestamp"),
        F.col("volume"),
        F.col("avg_10min_volume").alias("avg_volume"),
        F.col("volume_change_pct"),
        F.lit(VOLUME_WARNING).alias("warning"),
    )
    return vol.select(
        F.col("stock_ticker").cast("string").alias("key"),
        to_json_value(*body).alias("value"),
    )
