from pyspark.sql import functions as F

from quarry.functions.change import pct_change
from quarry.functions.json import parse_json
from quarry.functions.text import file_stem, line_count, parent_dir, report_line
from quarry.functions.time import hour_of, time_bucket


def reference_bucket(t):
    # The click job's own rule, for integers it can parse.
    h = int(t.split(":")[0])
    if 0 <= h < 6:
        return "0-6"
    if 6 <= h < 12:
        return "6-12"
    if 12 <= h < 18:
        return "12-18"
    return "18-24"


def test_time_bucket_edges(spark):
    cases = ["0:00:00", "5:59:59", "6:00", "11:59", "12:00", "17:59", "18:00", "23:59", "24:00", "-1:00", "07:30", "99"]
    df = spark.createDataFrame([(c,) for c in cases] + [(None,), ("x",), ("",), ("1.5:00",)], "t string")
    got = dict(df.select("t", time_bucket(hour_of(F.col("t"))).alias("b")).collect())
    for c in cases:
        assert got[c] == reference_bucket(c), c
    assert got[None] is None and got["x"] is None and got[""] is None and got["1.5:00"] is None


TEXTS = [
    "", "a", "a\n", "a\nb", "a\r\nb\r\n", "a\rb", "\n", "\n\n", "a\x0bb\x0cc", "a\x1cb\x1dc\x1ed",
    "a\x85b", "a b c", "x\r", "x\r\n\r", "no break at all", "trail ",
    "mixed\n\r\n\r\x0b\x0c\x1c\x1d\x1e\x85  end",
]


def test_line_count_matches_splitlines(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = dict(df.select("i", line_count(F.col("t")).alias("n")).collect())
    for i, t in enumerate(TEXTS):
        assert got[i] == len(t.splitlines()), repr(t)


def test_path_helpers(spark):
    df = spark.createDataFrame([("/data/images/cats/img1.jpg",), ("/data/AAPL.csv",)], "p string")
    got = df.select(parent_dir(F.col("p")).alias("d"), file_stem(F.col("p")).alias("s"),
                    report_line(F.col("p"), F.lit(3)).alias("r")).collect()
    assert got[0]["d"] == "cats" and got[1]["s"] == "AAPL"
    assert got[1]["r"] == "Number of lines in /data/AAPL.csv: 3"


def test_pct_change_zero_previous_is_null(spark):
    df = spark.createDataFrame([(10.0, 0.0), (11.0, 10.0), (1.0, None)], "c double, p double")
    got = [r[0] for r in df.select(pct_change(F.col("c"), F.col("p"))).collect()]
    assert got[0] is None and abs(got[1] - 10.0) < 1e-12 and got[2] is None


def test_parse_json_rejects(spark):
    from pyspark.sql.types import IntegerType, StructField, StructType

    df = spark.createDataFrame([(1, '{"k": 5}'), (2, "{not json"), (3, None), (4, '{"k": "x"}'), (5, "[1]")],
                               "id int, v string")
    good, bad = parse_json(df, "v", StructType([StructField("k", IntegerType())]), ["id"])
    assert [tuple(r) for r in good.orderBy("id").collect()] == [(1, 5)]
    assert sorted(r["id"] for r in bad.collect()) == [2, 3, 4, 5]
