"""Type-2 slowly changing dimension merge written in Spark SQL.

Same rows as ``quarry.operators.scd2.scd2_merge``. Frames are passed to
``spark.sql`` as parameters, so no global view names are taken. Ids use the
same distributed numbering as the DataFrame form, written in SQL: a
``REPARTITION_BY_RANGE`` hint, ``SORT BY`` inside partitions, per-partition
counts and a broadcast offset table. The numbered rows are pinned between the
two statements so both read the same partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.operators.scd2 import SENTINEL, raise_bad_keys
from quarry.session import estimate_partitions, materialize


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def scd2_merge_sql(
    spark: SparkSession,
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    tracked: list[str],
    id_col: str = "record_id",
    as_of: str = None,
    start_col: str = "effective_start_date",
    end_col: str = "effective_end_date",
    sentinel: str = SENTINEL,
    on_bad_keys: str = "error",
    num_partitions: int | None = None,
    pin: str = "table",
) -> DataFrame:
    if as_of is None:
        raise ValueError("as_of is required")
    keys, tracked = list(keys), list(tracked)
    tcols, scols = target.columns, source.columns
    ts_type = target.schema[end_col].dataType.simpleString()
    id_type = target.schema[id_col].dataType.simpleString()
    sent = f"CAST('{sentinel}' AS {ts_type})"
    asof = f"CAST('{as_of}' AS {ts_type})"
    if on_bad_keys not in ("error", "drop", "ignore"):
        raise ValueError(f"unknown on_bad_keys {on_bad_keys!r}")
    null = " OR ".join(f"{_q(k)} IS NULL" for k in keys)
    by = ", ".join(_q(k) for k in keys)
    active = spark.sql(f"SELECT * FROM {{target}} WHERE {_q(end_col)} <=> {sent}", target=target)
    max_id = spark.sql(f"SELECT COALESCE(MAX({_q(id_col)}), 0) AS m FROM {{target}}", target=target).first()["m"]

    on = " AND ".join(f"t.{_q(k)} = s.{_q(k)}" for k in keys)
    same = " AND ".join(f"t.{_q(c)} <=> s.{_q(c)}" for c in tracked) or "TRUE"
    t_sel = ", ".join(f"t.{_q(c)} AS {_q('t__' + c)}" for c in tcols)
    s_sel = ", ".join(f"s.{_q(c)} AS {_q('s__' + c)}" for c in scols)
    checked = on_bad_keys != "ignore"
    t_rows, s_rows = (f"SELECT *, COUNT(*) OVER (PARTITION BY {by}) AS _n{more} FROM {{{name}}} WHERE NOT ({null})" if checked
                      else f"SELECT *, 1 AS _n{more and ', 1 AS _r'} FROM {{{name}}}"
                      for name, more in (("active", ""), ("source", f", ROW_NUMBER() OVER (PARTITION BY {by} ORDER BY {by}) AS _r")))
    classified = f"""
        SELECT {t_sel}, {s_sel}, t._n IS NOT NULL AS _in_t,
               CASE WHEN t._n > 1 THEN 'untouched'
                    WHEN t._n IS NULL THEN CASE WHEN s._n > 1 THEN 'left_out' ELSE 'insert' END
                    WHEN s._n IS NULL OR s._n > 1 THEN 'delete'
                    WHEN {same} THEN 'keep' ELSE 'change' END AS _kind, t._n AS _tn, s._n AS _sn
        FROM ({t_rows}) t FULL OUTER JOIN (SELECT * FROM ({s_rows}) WHERE _r = 1) s ON {on}"""
    if checked:  # rows without a key take no part in the join
        no_t, no_s = (", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {_q(x + f.name)}" for f in df.schema)
                      for df, x in ((target, "t__"), (source, "s__")))
        classified += f"""
        UNION ALL SELECT {t_sel}, {no_s}, TRUE, 'untouched', 2, CAST(NULL AS BIGINT) FROM {{active}} t WHERE {null}
        UNION ALL SELECT {no_t}, {s_sel}, FALSE, 'left_out', CAST(NULL AS BIGINT), 2 FROM {{source}} s WHERE {null}"""

    # Pinned once: both the numbering and the final union read it.
    classified_df = materialize(spark.sql(classified, active=active, source=source), pin)
    if on_bad_keys == "error":
        raise_bad_keys(classified_df, keys)
    n = num_partitions or estimate_partitions(classified_df)
    new_cols = [c for c in tcols if c in scols and c not in (id_col, start_col, end_col)]
    order = ", ".join(["_grp"] + [_q(k) for k in keys])
    fresh_sql = f"""
        SELECT *, monotonically_increasing_id() AS _mid FROM (
          SELECT /*+ REPARTITION_BY_RANGE({n}, {order}) */
                 {", ".join(f"{_q('s__' + c)} AS {_q(c)}" for c in new_cols)},
                 CASE WHEN _kind = 'change' THEN 0 ELSE 1 END AS _grp
          FROM {{classified}} j WHERE _kind IN ('change', 'insert')
          SORT BY {order})"""
    ranked = materialize(spark.sql(fresh_sql, classified=classified_df), pin)

    def out_col(c: str, closing: bool) -> str:
        if c == end_col and closing:
            return f"CASE WHEN _kind IN ('change', 'delete') THEN {asof} ELSE {_q('t__' + c)} END AS {_q(c)}"
        return f"{_q('t__' + c)} AS {_q(c)}"

    def new_col(c: str) -> str:
        if c == id_col:
            return f"CAST(o._off + (r._mid - shiftleft(o._pid, 33)) + {int(max_id) + 1} AS {id_type}) AS {_q(c)}"
        if c == start_col:
            return f"{asof} AS {_q(c)}"
        if c == end_col:
            return f"{sent} AS {_q(c)}"
        if c in new_cols:
            return f"r.{_q(c)}"
        return f"CAST(NULL AS {target.schema[c].dataType.simpleString()}) AS {_q(c)}"

    final = f"""
        WITH counts AS (SELECT shiftright(_mid, 33) AS _pid, COUNT(*) AS _n FROM {{ranked}} GROUP BY 1),
        offs AS (SELECT _pid, COALESCE(SUM(_n) OVER (ORDER BY _pid ROWS BETWEEN UNBOUNDED PRECEDING
                                                    AND 1 PRECEDING), 0) AS _off FROM counts)
        SELECT {", ".join(_q(c) for c in tcols)} FROM {{target}} WHERE NOT ({_q(end_col)} <=> {sent})
        UNION ALL
        SELECT {", ".join(out_col(c, True) for c in tcols)} FROM {{classified}} j WHERE _in_t
        UNION ALL
        SELECT /*+ BROADCAST(o) */ {", ".join(new_col(c) for c in tcols)}
        FROM {{ranked}} r JOIN offs o ON shiftright(r._mid, 33) = o._pid"""
    return spark.sql(final, target=target, classified=classified_df, ranked=ranked)
