"""The pipeline against its operators, the registered queries against DuckDB."""

import duckdb

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF0
from quarry.llm import packing, queries
from quarry.llm.oracle import ORACLE
from quarry.sources.tables import load_table


def test_names():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in E.queries() and set(queries.QUERIES) <= set(E.queries())
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "substring_dedup", "packing"]


def test_queries_equal_duckdb(spark):
    con = duckdb.connect()
    for table in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF0}/{table}.parquet')")
    for name, sql in ORACLE.items():
        rel = con.sql(sql)
        want = sorted(map(tuple, rel.fetchall()))
        assert sorted(tuple(r) for r in E.queries()[name](spark, SF0).select(*rel.columns).collect()) == want, name


def test_stages_take_effect(spark, tmp_path):
    docs = load_table(spark, SF0, "documents")
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF0).write.parquet(str(tmp_path / str(k)))
        seen.append(spark.read.parquet(str(tmp_path / str(k))))
    for d in seen[1:-1]:
        assert d.dtypes == docs.dtypes and d.where("n_chars != char_length(text)").count() == 0
    n = [d.count() for d in seen]
    assert n[0] > n[1] == n[2] >= n[3] == n[4]
    assert seen[2].join(seen[1], "doc_id").where(seen[2]["text"] != seen[1]["text"]).count() > 0
    pieces = seen[-1].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"})
    assert pieces.where("`sum(length)` != `max(doc_tokens)`").count() == 0 and pieces.count() == n[4]
    assert seen[-1].groupBy("sequence_id").sum("length").where(f"`sum(length)` > {packing.Limits().tokens}").count() == 0


def test_run_and_empty_table(spark, tmp_path):
    empty = load_table(spark, SF0, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF0)
        assert empty.count() == 0
    out = corpus_pipeline.run(spark, SF0)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_stages_on_messy_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows and ids, extra columns: each stage keeps the columns and whole rows."""
    prose = " ".join(f"Sentence number {k} tells a small story about item {k * 7} in the old town." for k in range(12))
    long = " ".join(f"word{i % 977}x{i}" for i in range(20_000))
    texts = [(1, prose), (2, prose), (2, prose), (None, prose), (3, None), (4, ""), (5, " \n "), (6, long), (7, long + " tail"), (None, None),
             (8, "shared heading of many\n" + prose.replace("story", "tale")), (9, "Shared Heading of many \n" + prose.replace("town", "village")),
             (10, "own words only " * 3), (11, "日本語 テキスト " * 40), (12, prose + " " + prose)]
    rows = [(i, t, None if k % 3 else "en", None if k % 2 else "src", None if t is None else len(t), k, "x") for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size long, kept string").repartition(3)
    seen = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen, SF0).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert out.dtypes == docs.dtypes, name
            before, after = ({r["size"] for r in d.select("size").collect()} for d in (seen, out))
            assert after <= before and out.count() == len(after), name  # rows are kept or dropped, not repeated
            seen = out
    left = {r["size"]: r["text"] for r in seen.collect()}
    assert left[0] == prose and left[1] == left[2] == ""  # copies lose their line, the smallest id keeps it
    assert not any(texts[k][0] in (3, 4, 5) or texts[k][1] is None for k in left)  # nothing without words passes the rules
    assert not {7, 8} <= set(left)  # one of a pair of near copies at most
    pieces = {(r["doc_id"], r["start"]): r["length"] for r in out.collect()}
    assert {i for i, _ in pieces} == {texts[k][0] for k in left}
