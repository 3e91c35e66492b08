import os
import tempfile

import pytest

from quarry.operators import linecount
from quarry.sources import files as source

NAMES = ["a.txt", "b [1].txt", "c{x}.txt", "d/1.txt", "d/2.txt", "d/bad.txt", "e=1/x/1.txt", "e=1/x/2%20.txt", "e=1/y/3.txt", "e=1/y/4.txt", "e=1/y/5.txt",
         "e=1/top.txt", "f [2]/1.txt", "f [2]/2 +.txt", "_g=1/1.txt", "_hidden/1.txt", ".h/1.txt", "_own.txt", "d/other.csv", "z/1.txt"]


@pytest.fixture
def tree(monkeypatch):
    """A folder of folders, of which no group holds more than four files; (folder, the files that Spark lists)."""
    monkeypatch.setattr(source, "FILES_PER_FRAME", 2)
    monkeypatch.setattr(source, "FILES_PER_GROUP", 4)
    d = tempfile.mkdtemp(prefix="quarry-fg-")
    for i, n in enumerate(NAMES):
        os.makedirs(os.path.dirname(os.path.join(d, n)), exist_ok=True)
        with open(os.path.join(d, n), "wb") as f:
            f.write(b"ok\n\xff" if "bad" in n else b"line\n" * i + b"open")
    return d


def told(frames):
    return [sorted((tuple(r) for r in f.collect()), key=repr) for f in frames]


def test_groups_hold_every_file_once_and_few_at_a_time(spark, tree):
    groups, n = source.file_groups(spark, tree, 4)
    assert len(groups) >= 4 and n == len(NAMES)
    whole = {r["path"] for r in linecount.read_files(spark, tree, "*.txt").select("path").collect()}
    parts = [[r["path"] for r in linecount.read_files(spark, g, "*.txt").select("path").collect()] for g in groups]
    assert sorted(p for x in parts for p in x) == sorted(whole) and len(whole) == 16
    assert max(map(len, parts)) <= 4
    assert source.file_groups(spark, f"{tree}/d", 4) == ([[f"{tree}/d"]], 4)
    assert source.file_groups(spark, f"{tree}/*.txt", 4)[0] == [[f"{tree}/*.txt"]]


def test_whole_files_counted_by_groups(spark, tree):
    """no frame lists more files than a group; counts and rejects are those of one frame."""
    seen, plain = [], linecount._checked

    def checked(files, *args):
        seen.append(len(files.inputFiles()))
        return plain(files, *args)

    want = told(linecount.count_file_lines(linecount.read_files(spark, tree, "*.txt"), r"/z/"))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(linecount, "_checked", checked)
        got = told(linecount.count_file_lines(linecount.read_file_groups(spark, tree, "*.txt"), r"/z/"))
    assert got == want and len(want[0]) == 14 and len(want[1]) == 1
    assert len(seen) >= 4 and max(seen) <= 4
    few = linecount.count_file_lines(linecount.read_file_groups(spark, f"{tree}/z"))[0]
    assert "binaryFile" in few._jdf.queryExecution().optimizedPlan().toString()


def test_settings_of_the_session_stay(spark, tree):
    before = {k: spark.conf.get(k) for k in source._MANY_FILES}
    linecount.count_file_lines(linecount.read_file_groups(spark, tree, "*.txt"))
    assert {k: spark.conf.get(k) for k in before} == before


def test_text_scan_by_groups(spark, tree, monkeypatch):
    """the exact scan has the same counts, rejects and manifest rows by groups."""
    manifest = spark.createDataFrame([(f"file:{tree}/{n}",) for n in ("a.txt", "b [1].txt", "d/bad.txt", "e=1/x/2%20.txt", "none.txt")], "path string")

    def run():
        return told([*linecount.count_lines(spark, tree, "*.txt"), linecount.line_counts(spark, tree, "*.txt", manifest)])

    seen, plain = [], linecount.text_rows
    with pytest.MonkeyPatch.context() as m:
        m.setattr(linecount, "text_rows", lambda lines: seen.append(len(lines.inputFiles())) or plain(lines))
        got = run()
    assert len(seen) >= 8 and max(seen) <= 4
    monkeypatch.setattr(source, "FILES_PER_FRAME", 5_000)
    monkeypatch.setattr(source, "FILES_PER_GROUP", 50_000)
    assert got == run() and [len(x) for x in got] == [15, 1, 4]


EVENTS = ["a.txt", "/b [1].txt", "d/bad.txt", "d/1.txt", "d/1.txt", "e=1/x/2%20.txt", "f [2]/2 +.txt", "e=1/y/3.txt", "e=1/y/4.txt", "none.txt", "d/none.txt"]


@pytest.mark.parametrize("names", [5_000, 1])
def test_events_matched_by_groups(spark, tree, monkeypatch, names):
    """groups give the counts and rejects of one frame, and open no other group's files."""
    monkeypatch.setattr(linecount, "FILES_PER_SCAN", names)  # 1: limited by bitmaps
    os.chmod(os.path.join(tree, "z/1.txt"), 0)
    ev = spark.createDataFrame([(f'{{"bucket": "{tree}/", "file": "{n}"}}',) for n in EVENTS] + [("{",), (None,)], "value string")
    seen, plain = [], linecount._listed
    with pytest.MonkeyPatch.context() as m:
        m.setattr(linecount, "_listed", lambda files: seen.append(len(files.inputFiles())) or plain(files))
        got = told(linecount.line_counts_from_events(ev, linecount.read_file_groups(spark, tree, "*.txt")))
    assert len(seen) >= 4 and max(seen) <= 4
    want = told(linecount.line_counts_from_events(ev, linecount.read_files(spark, tree, "*.txt")))
    assert [sorted(map(str, x)) for x in got] == [sorted(map(str, x)) for x in want] and len(got[0]) == 7
    nothing = told(linecount.line_counts_from_events(ev.where("value like '%none%'"), linecount.read_file_groups(spark, tree, "*.txt")))
    assert nothing[0] == [] and [r[2] for r in nothing[1]] == ["missing", "missing"]


def test_file_events_name_the_written_files(spark, monkeypatch):
    """the messages are those of the files there are, without a listing of them."""
    from conftest import SF0
    from quarry.plans import queries as Q

    monkeypatch.setattr(Q, "_FILES_PER_FOLDER", 30)
    root, events = Q._file_events(spark, SF0)
    bucket = root.replace("file:", "").replace("///", "/")
    there = {os.path.relpath(os.path.join(d, f), bucket) for d, _, fs in os.walk(bucket) for f in fs if f.endswith(".txt")}
    named = [r["f"] for r in events.selectExpr("get_json_object(value, '$.file') f", "get_json_object(value, '$.bucket') b").where(f"b = '{bucket}' and f like 'folder%'").collect()]
    assert sorted(named) == sorted(there) and len({f.split("/")[0] for f in named}) > 2


def test_stream_holds_no_listing_of_all_files(spark, tree, monkeypatch):
    """files are listed by groups and scanned in chunks, with the counts and rejects of the batch scan, each once."""
    from quarry.session import scratch_path
    from quarry.streaming import linecount as stream

    listed, scanned, plain, text = [], [], linecount.read_files, stream._read_text
    monkeypatch.setattr(linecount, "read_files", lambda s, p, g=None: listed.append(len(plain(s, p, g).inputFiles())) or plain(s, p, g))
    monkeypatch.setattr(stream, "_read_text", lambda s, p: scanned.append(len(p)) or text(s, p))
    ck, out, bad = (scratch_path(spark, f"t-fg-{x}") for x in ("ck", "out", "bad"))

    def run():
        q = stream.line_counts_stream(spark, tree, ck, out, glob="*.txt", exclude=r"/z/", max_files_per_trigger=6, rejects_path=bad,
                                      trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None

    run()
    assert len(listed) >= 4 and max(listed) <= 4 and max(scanned) <= 4 and sum(scanned) == 15
    run()
    assert sum(scanned) == 15
    with open(os.path.join(tree, "e=1/new.txt"), "w") as f:
        f.write("1\n2")
    run()
    assert sum(scanned) == 16
    counts, rejected = (x.where("path not like '%/z/%'") for x in linecount.count_lines(spark, tree, "*.txt"))
    got = spark.read.parquet(out)
    assert told([got.select("path", "n_lines"), spark.read.parquet(bad).select("path", "reason")]) == told([counts, rejected])
    assert {r["batch_id"]: r["n"] for r in got.groupBy("batch_id").agg({"*": "count"}).toDF("batch_id", "n").collect()}[0] <= 6


def test_stream_that_goes_on_lists_new_files(spark):
    """a stream without an end takes files that come while it runs."""
    import time

    from quarry.session import scratch_path
    from quarry.streaming.linecount import line_counts_stream

    d = tempfile.mkdtemp(prefix="quarry-go-")
    ck, out = (scratch_path(spark, f"t-go-{x}") for x in ("ck", "out"))
    q = line_counts_stream(spark, d, ck, out, trigger={"processingTime": "200 milliseconds"})
    try:
        for i in range(2):
            with open(os.path.join(d, f"f{i}.txt"), "w") as f:
                f.write("a\n" * (i + 1))
            end = time.time() + 60
            while time.time() < end and len(rows_of(spark, out)) <= i:
                time.sleep(0.5)
        assert q.isActive
    finally:
        q.stop()
    assert rows_of(spark, out) == [("f0.txt", 1), ("f1.txt", 2)]


def rows_of(spark, out):
    done = [os.path.join(out.replace("file:", "", 1), x) for x in os.listdir(out.replace("file:", "", 1))]
    done = [x for x in done if os.path.exists(os.path.join(x, "_SUCCESS"))]
    read = spark.read.schema("path string, n_lines long").parquet(*done).collect() if done else []
    return sorted((os.path.basename(r["path"]), r["n_lines"]) for r in read)


def test_stream_goes_on_with_a_checkpoint_of_the_file_source(spark):
    """files counted by the file source's checkpoint are not counted again."""
    from quarry.session import scratch_path
    from quarry.streaming import linecount as stream

    d = tempfile.mkdtemp(prefix="quarry-old-")
    ck, out = (scratch_path(spark, f"t-old-{x}") for x in ("ck", "out"))
    for i, start in enumerate((stream._start_plain, stream.line_counts_stream)):
        with open(os.path.join(d, f"f{i}.txt"), "w") as f:
            f.write("a\n" * (i + 1))
        start(spark, d, ck, out, None, None, None, {"availableNow": True}, None).awaitTermination()
    assert rows_of(spark, out) == [("f0.txt", 1), ("f1.txt", 2)]
