import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators import linecount

FILES = {
    "a.txt": b"one\ntwo\nthree",
    "b.txt": b"one\r\ntwo\r\n",
    "c.txt": "x\x0by\x0cz w v\x85u".encode(),
    "d.txt": b"\n\n\n",
    "e.txt": b"",
    "bad.txt": b"ok\n\xff\xfe\n",
}


def make_dir():
    d = tempfile.mkdtemp(prefix="quarry-lc-")
    for name, data in FILES.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    return d


def test_exact_counts_and_rejects(spark):
    d = make_dir()
    good, bad = linecount.count_file_lines(linecount.read_files(spark, d))
    got = {os.path.basename(r["path"]): r["n_lines"] for r in good.collect()}
    for name, data in FILES.items():
        if name in ("bad.txt", "e.txt"):
            continue
        assert got[name] == len(data.decode().splitlines()), name
    assert [os.path.basename(r["path"]) for r in bad.collect()] == ["bad.txt"]


def test_manifest_reports_empty_files(spark):
    d = make_dir()
    manifest = spark.createDataFrame([(f"file:{os.path.join(d, n)}",) for n in FILES], "path string")
    got = {os.path.basename(r["path"]): r["n_lines"] for r in
           linecount.line_counts(spark, d, manifest=manifest).collect()}
    assert got["e.txt"] == 0 and got["a.txt"] == 3


EDGES = {
    "open vt.txt": b"a\x0b", "nel.txt": "one\ntwo\x85".encode(), "100%.txt": b"a\r\nb\r\n", "a+b.txt": b"a\rb\r", "cr.txt": b"x\n\r",
    "blank.txt": b"\n\n", "ls.txt": "p\u2028q".encode(), "bom.txt": b"\xef\xbb\xbfa\nb\x0c", "long.txt": b"line\r\nother\x0bthird\n" * 400 + b"end\x1d",
    "bad one.txt": b"fine\n" * 300 + b"\xff\xfe\n",
}


def test_one_exact_count_for_every_size_and_split(spark):
    d = tempfile.mkdtemp(prefix="quarry-lc-")
    for n, data in EDGES.items():
        with open(os.path.join(d, n), "wb") as f:
            f.write(data)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("128m", "700b", "64b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            counts, rejected = linecount.count_lines(spark, d)
            got = {r["path"]: r["n_lines"] for r in counts.collect()}
            assert got == {os.path.join(d, n): len(x.decode("utf-8-sig").splitlines()) for n, x in EDGES.items() if n != "bad one.txt"}
            assert [r["path"] for r in rejected.collect()] == [os.path.join(d, "bad one.txt")]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    manifest = spark.createDataFrame([(f"file:{d}/{n}",) for n in ("bad one.txt", "100%.txt", "empty.txt")], "path string")
    got = {r["path"]: r["n_lines"] for r in linecount.line_counts(spark, d, manifest=manifest).collect()}
    assert got == {f"file:{d}/100%.txt": 2, f"file:{d}/empty.txt": 0}


def test_bare_buckets_under_a_root(spark):
    files = spark.createDataFrame([("gs://bkt/a b.txt", b"x\ny"), ("gs://other/a.txt", b"z")], "path string, content binary")
    ev = spark.createDataFrame([('{"bucket": "bkt", "file": "a b.txt"}',), ('{"bucket": "bkt", "file": "no.txt"}',)], "value string")
    counts, rejected = linecount.line_counts_from_events(ev, files, root="gs://")
    assert [tuple(r) for r in counts.collect()] == [("gs://bkt/a b.txt", 2)]
    assert [(r["path"], r["reason"]) for r in rejected.collect()] == [("gs://bkt/no.txt", "missing")]


def test_events_route_malformed_and_missing(spark):
    d = make_dir()
    ev = spark.createDataFrame([
        (f'{{"bucket": "{d}", "file": "a.txt"}}',),
        (f'{{"bucket": "{d}/", "file": "/b.txt"}}',),
        (f'{{"bucket": "{d}", "file": "nope.txt"}}',),
        ("{broken",),
        (f'{{"bucket": "{d}", "file": "bad.txt"}}',),
    ], "value string")
    counts, rej = linecount.line_counts_from_events(ev, linecount.read_files(spark, d))
    got = {os.path.basename(r["path"]): r["n_lines"] for r in counts.collect()}
    assert got == {"a.txt": 3, "b.txt": 2}
    reasons = sorted(r["reason"] for r in rej.collect())
    assert reasons == ["invalid utf-8", "malformed", "missing"]


def test_report_line(spark):
    df = spark.createDataFrame([("/data/in/input.txt", 4)], "path string, n_lines long")
    assert linecount.with_report(df).first()["report"] == "Number of lines in /data/in/input.txt: 4"


def test_events_open_matched_files_only(spark):
    """No content in an exchange or a join, and a file that no event names is not read."""
    d = tempfile.mkdtemp(prefix="quarry-ev-")
    for i in range(6):
        with open(os.path.join(d, f"f {i}.txt"), "w") as f:
            f.write("a\n" * i)
    os.chmod(os.path.join(d, "f 5.txt"), 0)
    ev = spark.createDataFrame([(f'{{"bucket": "{d}", "file": "f {i}.txt"}}',) for i in (1, 2, 2, 9)], "value string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts, rejected = linecount.line_counts_from_events(ev, linecount.read_files(spark, d))
        plan = counts._jdf.queryExecution().executedPlan().toString()
        files = sum(f.rdd.getNumPartitions() for f in [counts])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "Exchange" not in plan and "Join" not in plan
    assert "PartitionFilters" in plan or "file_path" in plan
    assert files <= 2 and sorted((os.path.basename(r["path"]), r["n_lines"]) for r in counts.collect()) == [("f 1.txt", 1), ("f 2.txt", 2)]
    assert [(os.path.basename(r["path"]), r["reason"]) for r in rejected.collect()] == [("f 9.txt", "missing")]


def test_many_events_limit_one_scan_by_a_bitmap(spark, monkeypatch):
    """names beyond the limit give one scan, with the same counts and rejects as names one by one."""
    d = tempfile.mkdtemp(prefix="quarry-bm-")
    for i in range(40):
        with open(os.path.join(d, f"f {i}.txt"), "wb") as f:
            f.write(b"a\n" * i if i % 10 else b"\xff")
    ev = spark.createDataFrame([(f'{{"bucket": "{d}", "file": "f {i}.txt"}}',) for i in (*range(20), 3, 90)] + [("{",)], "value string")

    def run():
        counts, rejected = linecount.line_counts_from_events(ev, linecount.read_files(spark, d))
        plan = counts._jdf.queryExecution().optimizedPlan().toString()
        return plan, sorted(tuple(r) for r in counts.collect()), sorted(map(str, rejected.collect()))

    _, *few = run()
    monkeypatch.setattr(linecount, "FILES_PER_SCAN", 3)
    plan, *many = run()
    assert many == few and len(few[0]) == 18 and len(few[1]) == 4
    assert "Union" not in plan


def test_bitmap_holds_every_name_and_few_others(spark):
    names = spark.range(30_000).select(F.concat(F.lit("file:/d/"), "id").alias("n"))
    held = linecount._in_bitmap(F.col("n"), *linecount._bitmap(names.where("n like '%7'"), "n"))
    assert names.where("n like '%7'").where(~held).count() == 0
    assert names.where("n not like '%7'").where(held).count() < 27_000 * 0.03
