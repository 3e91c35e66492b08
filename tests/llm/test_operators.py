"""Every operator on messy rows, an empty table and brute-force versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import ROOT, SF0
from quarry.llm import exact_dedup, html_extract, jaccard_join, line_dedup, lm_scoring, packing, pieces, quality, sharding, substring_dedup
from quarry.llm import textkernel as K
from quarry.llm.common import blocks_of, loosen, rows_of
from quarry.llm.components import components
from quarry.llm.pieces import MARK
from quarry.llm.queries import QUERIES, byte_bpe, piece_model
from quarry.llm.tokens import Encoder
from quarry.sources.tables import load_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
PROSE = "The quick brown fox jumps over the lazy dog while seven wizards quietly brew some potions in the old stone tower near town."
SCHEMA = "doc_id long, text string, kept string, size long, id string, component long, h1 long"


def messy_rows():
    """Nulls, empty and white texts, a very long text, ties, repeated rows, non-ASCII, clashing extra columns."""
    texts = [
        (1, PROSE), (2, PROSE), (3, PROSE.replace(" ", "  ")), (3, PROSE.replace(" ", "  ")), (4, None), (5, ""), (6, " \n\t "),
        (7, LONG), (8, LONG + " tail"), (None, PROSE), (None, None), (9, "línea común de prueba\nuno"), (10, "uno\n  LÍnea común de prueba \nuno"),
        (11, "Línea común de prueba"), (12, "a b c"), (13, "A B C"), (14, "\n\n"), (15, "日本語 🎉 text | with # symbols"),
        (16, "x y z " * 400), (17, "shared line of text\nown seventeen"), (18, "own eighteen\nSHARED LINE of text  "), (18, "other text of eighteen"),
    ]
    return [(i, t, "no", 7, "x", 1, 2) for i, t in texts]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_chunks_cut_rows_not_texts():
    import pyarrow as pa

    texts = ["a b", None, "", "long " * 50, "é ü", "z"]
    got = []
    for rows, data, offs in K.text_chunks(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), limit=10):
        s, e, woff = K.words(data, offs)
        got += [[data[s[k]:e[k]].tobytes().decode() for k in range(woff[i], woff[i + 1])] for i in range(rows.num_rows)]
    assert got == [WORD.findall(t or "") for t in texts]


# ---- sharding

def test_sharding(messy, nothing):
    got = sharding.shard(messy, 4).collect()
    assert len(got) == messy.count() and {r["law"] for r in got} == {"bytes"}
    for r in got:
        assert 0 <= r["shard"] < 4 and r["grown_shard"] is None
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    for rows in by.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    flat = [r["doc_id"] for s in sorted(by) for r in sorted(by[s], key=lambda r: r["slot"])]
    assert flat == sorted(flat, key=lambda i: -1 if i is None else i)  # contiguous in id order, nulls first
    sizes = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    assert sizes == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
                            for i, t in ((r["doc_id"], r["text"]) for r in messy.collect()))
    assert sharding.shard(nothing, 4).count() == 0


def test_shards_are_balanced(spark):
    docs = load_table(spark, SF0, "documents", ["doc_id", "text"])
    got = sharding.shard(docs, 5).groupBy("shard").sum("size").collect()
    total, largest = sum(r[1] for r in got), max(len(r["text"].encode()) + 16 for r in docs.collect())
    assert len(got) == 5 and all(abs(r[1] - total / 5) <= largest for r in got)


# ---- extraction

def test_extraction_of_pages(spark):
    import html

    pages = load_table(spark, SF0, "pages", ["page_id", "url", "html"])
    trees = html_extract.fit(pages)

    def want(source):
        body = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S).group(1)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", body))
        return " ".join(x for x in parts if x)

    source = {r["page_id"]: r["html"] for r in pages.collect()}
    got = html_extract.extract(pages, trees).collect()
    assert all(r["text"] == want(source[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in got)

    text = "".join(f"<p>Seven wizards brew potion number {i} in the old stone tower near the quiet town.</p>" for i in range(6))
    kinds = ["<header><h2>Site</h2></header>", "<nav><a href=1>A</a></nav>", "<div class='cookie-notice'><p>We use cookies here.</p></div>",
             "<aside class='sidebar'><p>Popular stories of this week.</p></aside>", "<form><p>Subscribe</p></form>",
             "<section id=comments><p>I liked this article about wizards a lot.</p></section>", "<div class=ad>Buy</div>",
             "<footer>&copy; us</footer>", "<script>var a = '<p>no</p>';</script>", "<style>p{}</style>", "<!-- <p>no</p> -->"]
    for wrap in ("<article>%s</article>", "<main>%s</main>", "<div class='post-content'>%s</div>"):
        for kind in kinds:
            for source in (kind + wrap % text, wrap % text + kind):
                page = html_extract.Page(f"<html><body>{source}</body></html>")
                said = page.text(page.decode(trees.odds(page.features())))
                assert said.startswith("Seven wizards brew potion number 0") and said.endswith("5 in the old stone tower near the quiet town."), source


def test_extraction_edges(spark):
    rows = [(1, "u", None, 1), (2, "u", "", 1), (3, "u", "a &lt; b &amp c", 1), (4, None, "<article><p>one<br>two<p>th<b>ree</b>", 1), (None, "u", "<p>x</p><", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.extract(pages, None).collect()}
    assert got == {1: ("", 0), 2: ("", 0), 3: ("a < b & c", 9), 4: ("one two three", 13), None: ("x <", 3)}
    assert html_extract.fit(pages.limit(0)) is None
    assert html_extract.extract(pages.limit(0), None).count() == 0


def test_embedded_elements_drop_only_themselves(spark):
    cases = [
        ("<p>one <svg class='a'/> two</p><p>three</p>", "one two three"),
        ("<p>one <math/> two</p><p>three</p>", "one two three"),
        ("<p>one</p><svg><g><svg><path d='x'/></svg><text>no</text></g><title/></svg><p>two</p><svg></svg><p>three</p>", "one two three"),
        ("<p>one</p><svg/><p>two</p><svg><text>no</text></svg><p>three</p>", "one two three"),
        ("<p>one <math><mi>x</mi><mo>=</mo><mn>2</mn></math> two</p>", "one x=2 two"),
        ("<p>one <button>press</button> two</p><p>three</p>", "one press two three"),
        ("<p>one <button> two</p><p>three</p>", "one two three"),
        ("<p>one <object data=x> two</p><p>three</p><object>no</object><p>four</p>", "one two three four"),
        ("<p>one</p><video src=x><p>two</p>", "one two"),
        ("<p>one</p><video src=x><p>no</p></video><select><option>no</select><p>two</p>", "one two"),
        ("<p>one</p><iframe src='a>b'><!-- </iframe> -->no</iframe><p>two</p>", "one two"),
        ("<p>one</p><style>p{}</style><script>'<svg>'</script><p>two</p><script>no", "one two"),
    ]
    pages = spark.createDataFrame([(k, "u", f"<article>{x}</article>") for k, (x, _) in enumerate(cases)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages, None).collect()}
    assert got == {k: want for k, (_, want) in enumerate(cases)}
    html_extract.Page("<object><p>" * 100_000 + "</object>")  # no closing tag is searched twice


def test_decoding_is_consistent():
    page = html_extract.Page("<div><p>a</p><p>b</p></div><div><p>c</p></div>")
    kept = page.decode(np.array([0, -5.0, 1.0, 1.0, -1.0, 3.0]))
    assert kept.tolist() == [True, False, False, False, True, True]


# ---- pieces

def test_piece_ids_equal_the_library(spark, messy):
    import sentencepiece as S
    from sentencepiece import sentencepiece_model_pb2 as pb

    table = pieces.piece_table(spark, piece_model()).cache()
    sp = S.SentencePieceProcessor(model_file=piece_model())
    turns = load_table(spark, SF0, "conversations", ["text"]).union(messy.where("length(text) < 5000 or text is null").select("text"))
    got = pieces.decode(pieces.encode(turns, table, method="bpe"), table).collect()
    assert len(got) == turns.count()
    for r in got:
        assert (r["ids"] is None and r["decoded"] is None) if r["text"] is None else (r["ids"] == sp.encode(r["text"]) and r["decoded"] == r["text"])

    # The library's own Viterbi over the same pieces: the model file with its type switched.
    proto = pb.ModelProto()
    proto.ParseFromString(open(piece_model(), "rb").read())
    proto.trainer_spec.model_type = 1
    unigram = S.SentencePieceProcessor(model_proto=proto.SerializeToString())
    words = sorted({w for r in got if r["text"] for w in r["text"].split() if w.isascii()})[:1500]
    best = pieces.encode(spark.createDataFrame([(w,) for w in words], "text string"), table).collect()
    assert all(r["ids"] == unigram.encode(r["text"]) for r in best)
    assert pieces.encode(turns.limit(0), table).count() == 0


def test_registered_pieces_cover_documents_and_turns(spark):
    import sentencepiece as S

    sp = S.SentencePieceProcessor(model_file=piece_model())
    rows = QUERIES["op3_sentencepiece"](spark, SF0).collect()
    docs = {r["doc_id"]: r["text"] for r in load_table(spark, SF0, "documents", ["doc_id", "text"]).collect()}
    turns = load_table(spark, SF0, "conversations", ["conv_id", "turn"]).count()
    got = {r["doc_id"]: r for r in rows if r["conv_id"] is None}
    assert len(rows) == len(docs) + turns and set(got) == set(docs) and all(r["round_trip"] for r in rows)
    assert all(got[i]["ids"] == sp.encode(t) and got[i]["viterbi_ids"] for i, t in docs.items() if t)


def test_long_words_fold_as_short_ones_do(spark):
    import sentencepiece as S

    table = pieces.piece_table(spark, piece_model()).cache()
    sp = S.SentencePieceProcessor(model_file=piece_model())
    texts = ["antidisestablishmentarianism", "a  b ", " ", MARK, "x" + MARK + MARK + "y", "日本語🎉", "of the\nnew", "internationalisation ofthe"]
    long = ["the" * 20 + "é🎉", "abcdefgh" * 200]
    df = spark.createDataFrame([(t,) for t in texts + long], "text string")
    both = {r["text"]: r for r in pieces.encode_all(df, table, {"ids": "bpe", "best": "viterbi"}, blocks=2).collect()}
    assert all(both[t]["ids"] == sp.encode(t) for t in texts + long[:1] if MARK not in t)
    assert len(both) == len(texts) + 2 and len(both[long[1]]["best"]) >= 100
    edges = lambda w: {(a, b): -float(b - a) ** 0.5 for a in range(len(w)) for b in range(a + 1, min(len(w), a + 4) + 1)}
    for n in range(1, 12):
        edge, score = edges("x" * n), np.full((1, n + 1, n + 1), -np.inf)
        for (a, b), v in edge.items():
            score[0, a, b] = v
        for short, one in pieces._FOLDS.values():
            assert np.flatnonzero(short(score)[0]).tolist() == one(n, edge)


def test_piece_lengths_travel_not_ids(spark):
    table = pieces.piece_table(spark, piece_model())
    texts = spark.createDataFrame([("some words of the text",), (None,), ("",)], "text string")
    got = pieces.encode_all(texts, table, {"ids": "bpe"}, blocks=2)
    assert [r["ids"] for r in got.where("text = '' or text is null").orderBy("text").collect()] == [None, []]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "bpe_lengths" in plan and "collect_list" not in plan


def test_words_and_ids_are_handled_whole_blocks_at_a_time():
    """The words of a block are an Arrow array: of 350,000 words a list of strings alone takes over 20 MB."""
    import tracemalloc

    texts = ["a b", None, "", " ", "  x", "y ", "a  b", MARK, "x" + MARK + "y z", "é 日本 🎉\nx"] * 3
    flat, count = pieces._split(pa.array(texts, pa.string()))
    words, ends = flat.to_pylist(), np.cumsum(count).tolist()
    assert [words[a:b] for a, b in zip([0, *ends], ends)] == [pieces.words_of(t) for t in texts]
    empty, at = pieces._asked(pieces._split(pa.array([None, ""], pa.string()))[0].unique(), 3)
    assert len(empty) == 0 and at.tolist() == [0] * 4

    big = pa.array([" ".join(f"w{i}é{i * 7919}" for i in range(k, k + 50)) for k in range(0, 350_000, 50)])
    tracemalloc.start()
    words, at = pieces._asked(pieces._split(big)[0].unique(), 7)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(words) == at[-1] == 350_000 and held < 20e6
    assert all(words[a:b].to_pylist() == sorted(words[a:b].to_pylist()) for a, b in zip(at, at[1:]))

    known = pieces._Vocabulary(pa.array(["a", MARK + "a", "日本"]), np.array([5, 6, 7], np.int32), np.arange(1000, 1256, dtype=np.int32), None)
    of = pieces._ids(pa.array(["a", "", "aé日本", "🎉"]), np.array([2, 1, 2, 1, 2, 1, 1]), known)
    byte = lambda x: [1000 + b for b in x.encode()]
    assert of.to_pylist() == [[6], byte(MARK), [6, *byte("é"), 7], byte(MARK) + byte("🎉")]


def test_lattice_cuts_no_piece_off(spark):
    table = spark.createDataFrame([(p, i, -float(i), None) for i, p in enumerate(["a", "ab", "abc", "abcd", "abcdefg", "cd", "bcdx", "g"])],
                                  "piece string, id int, score double, byte int")
    words = ["abcdefgh", "abcdx", "ab", "xbc", "abcdef", "a"]
    df = spark.createDataFrame([(0, k, w) for k, w in enumerate(words)], "shard int, w int, word string")
    got = {(r["w"], r["start"], r["end"], r["id"]) for r in pieces.lattice(df, table).collect()}
    ids = {r["piece"]: r["id"] for r in table.collect()}
    assert got == {(k, a, b, ids.get(w[a:b], -1)) for k, w in enumerate(words) for a in range(len(w)) for b in range(a + 1, len(w) + 1)
                   if w[a:b] in ids or b == a + 1}


def test_decoding_joins_bytes_and_skips_other_ids(spark):
    table = spark.createDataFrame([(MARK + "a", 3, -1.0, None), ("b", 5, -2.0, None), *((None, 10 + b, None, b) for b in range(256))],
                                  "piece string, id int, score double, byte int")
    byte = [10 + b for b in (MARK + "é").encode()]
    lists = [[3, 5, 3], [], None, byte, [3, None, 99999, -7, 4, 5], [*byte[:3], *byte[:3], 5]]
    got = pieces.decode(spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, ids array<int>"), table).orderBy("k").collect()
    assert [r["decoded"] for r in got] == ["ab a", "", None, "é", "ab", " b"]
    none = pieces.encode(spark.createDataFrame([(None,), ("",)], "text string").coalesce(1), table).collect()
    assert sorted(str(r["ids"]) for r in none) == ["None", "[]"]


def test_each_shard_of_words_has_a_task_of_its_own(spark):
    table = pieces.piece_table(spark, piece_model())
    texts = spark.createDataFrame([(" ".join(f"w{i}" for i in range(900)),)], "text string")
    plan = pieces.encode_all(texts, table, {"ids": "bpe"}, blocks=9)._jdf.queryExecution().executedPlan().toString()
    by_shard = [line for line in plan.splitlines() if "Exchange" in line and "shard#" in line]
    assert by_shard and all("direct_shuffle_partition_id(shard#" in line for line in by_shard)  # by hash some tasks got several


# ---- packing

def _check_packing(rows, texts, limits):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(byte_bpe()[0])
    tk.encode_special_tokens = True
    want = Counter()
    for i, t in texts:
        want[i, zlib.crc32(np.asarray(tk.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())] += 1
    got, open_ = Counter(), defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.asarray(r["ids"], "<u4").tobytes())
        open_[r["doc_id"], r["doc_tokens"]].append(r)
    for (i, n), group in open_.items():
        starts = defaultdict(list)
        for r in group:
            starts[r["start"]].append(r)
        while starts[0]:
            ids, at = [], 0
            while at < n:
                r = starts[at].pop()
                ids += r["ids"]
                at += r["length"]
            got[i, zlib.crc32(np.asarray(ids, "<u4").tobytes())] += 1
    assert got == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append(r)
    for group in seqs.values():
        at = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= limits.tokens and len(group) <= limits.segments
    return sum(r["length"] for r in rows) / (limits.tokens * len(seqs))


def test_packing(spark, messy, nothing):
    docs = messy.where("doc_id is null or doc_id not in (3)")  # a repeated row's pieces cannot be told apart
    rows = packing.pack(docs, *byte_bpe(), with_ids=True).collect()
    _check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], packing.Limits())
    assert packing.pack(nothing, *byte_bpe()).count() == 0
    docs = load_table(spark, SF0, "documents", ["doc_id", "text"])
    full = _check_packing(packing.pack(docs, *byte_bpe(), with_ids=True).collect(), [tuple(r) for r in docs.collect()], packing.Limits())
    assert full > 0.97


def test_added_tokens_in_texts_equal_the_library(spark):
    from tokenizers import Tokenizer

    tk, enc, mark = Tokenizer.from_file(byte_bpe()[0]), Encoder(*byte_bpe()), "<|endoftext|>"
    texts = [f"a {mark} b", mark, mark * 3, f"one two{mark}three", f"  {mark}  \n{mark}\n x", f"x\n\n{mark}", "<|endoftext|", f"<{mark}>", "", PROSE + mark + PROSE]
    for t in texts:
        assert np.frombuffer(enc.ids(t), "<u4").tolist() == tk.encode(t, add_special_tokens=False).ids, t
    assert np.frombuffer(enc.ids(texts[0]), "<u4").tolist() == [64, 220, 50256, 275]
    got = packing.pack(spark.createDataFrame([(1, texts[0])], "doc_id long, text string"), *byte_bpe(), with_ids=True).collect()
    assert [r["ids"] for r in got] == [[64, 220, 50256, 275, 1]] and got[0]["doc_tokens"] == 5


def test_packing_holds_all_three_limits(spark):
    rows = [(i, "say " * (i % 9), "yes indeed " * (i % 40 + 1)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, prompt string, text string").coalesce(1)
    lim = packing.Limits(tokens=128, segments=3, loss_tokens=70)
    got = packing.pack(docs, *byte_bpe(), limits=lim, prompt_col="prompt", pool=16).collect()
    enc = Encoder(*byte_bpe())
    prompt = {i: len(enc.ids(p)) // 4 for i, p, _ in rows}
    seqs = defaultdict(lambda: [0, 0, 0])
    for r in got:
        s = seqs[r["sequence_id"]]
        s[0] += r["length"]
        s[1] += 1
        s[2] += max(0, r["start"] + r["length"] - max(r["start"], prompt[r["doc_id"]]))
    assert all(a <= 128 and b <= 3 and c <= 70 for a, b, c in seqs.values())
    assert sum(r["length"] for r in got) == sum({r["doc_id"]: r["doc_tokens"] for r in got}.values())


# ---- n-gram Jaccard join

def _components_by_brute_force(rows):
    sets = defaultdict(list)
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        s = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        if i is not None:
            sets[i].append(s)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= 80 * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_jaccard_join_equals_brute_force(spark, messy, nothing):
    got = jaccard_join.join(messy).collect()
    want = _components_by_brute_force([(r["doc_id"], r["text"]) for r in messy.collect()])
    assert len(got) == messy.count()
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else want[r["doc_id"]])
    assert jaccard_join.join(nothing).count() == 0
    docs = load_table(spark, SF0, "documents", ["doc_id", "text"])
    base = [r for r in docs.collect()]
    rng = np.random.default_rng(4)
    words = base[3]["text"].split()[:120]
    edits = []
    for k in range(60):  # a group of near copies whose links form chains
        w = list(words)
        for _ in range(int(rng.integers(0, 6))):
            w[rng.integers(len(w))] = f"edit{rng.integers(10_000)}"
        edits.append((10_000 + k, " ".join(w)))
    rows = [tuple(r) for r in base] + edits
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _components_by_brute_force(rows)


def test_prefix_bound():
    for n in range(1, 400):
        p = jaccard_join.prefix_length(n)
        assert p == n - math.ceil(0.8 * n - 1e-9) + 1 and jaccard_join._need(n, n) == math.ceil(1.6 * n / 1.8 - 1e-9)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 75)] + [(200, k) for k in range(201, 260)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 50, 75: 50, 50: 50, **{k: 200 for k in range(200, 260)}}


# ---- exact dedup

@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 60)), max_size=300))
def test_cuckoo_bucket_equals_a_dict(steps):
    bucket, held = exact_dedup.Bucket(), {}
    for add, k in steps:
        d = hashlib.sha256(str(k).encode()).digest()
        if add:
            bucket.insert(d, k)
            held[d] = held.get(d, 0) + 1
        else:
            assert bucket.delete(d) == (held.pop(d, None) is not None)
    assert {k: v[1] for k, v in bucket.keys.items()} == held and all(k in bucket.filter for k in held)
    again = exact_dedup.CuckooFilter.from_bytes(bucket.filter.to_bytes())
    assert all(k in again for k in held)


def test_cuckoo_resizes_from_stored_keys():
    bucket = exact_dedup.Bucket()
    keys = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(3000)]
    for i, k in enumerate(keys):
        bucket.insert(k, i)
    assert bucket.resizes > 3 and all(bucket.find(k) == [i, 1] for i, k in enumerate(keys))
    strangers = [hashlib.sha256(f"s{i}".encode()).digest() for i in range(3000)]
    assert sum(s in bucket.filter for s in strangers) < 30 and not any(bucket.find(s) for s in strangers)


def test_exact_dedup(spark, messy, nothing):
    got = exact_dedup.dedup(messy).collect()
    norm = [(r["doc_id"], re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")) for r in messy.collect()]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    want = Counter((i, min((x for x in groups[t] if x is not None), default=None), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)
    assert exact_dedup.dedup(nothing).count() == 0


def test_index_takes_insertions_and_deletions(spark):
    def keyed(ids):
        return exact_dedup.digests(spark.createDataFrame([(i, f"text {i % 7}") for i in ids], "doc_id long, text string"))

    index = exact_dedup.insert(None, keyed(range(10)), 3)
    index = exact_dedup.insert(index, keyed(range(20, 40)), 3)
    index = exact_dedup.delete(index, keyed([0, 3]), 3)
    got = {r["sha"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.keys(index).collect()}
    want = defaultdict(list)
    for i in [*range(10), *range(20, 40)]:
        if i % 7 not in (0, 3):
            want[hashlib.sha256(f"text {i % 7}".encode()).hexdigest()].append(i)
    assert got == {k: (min(v), len(v)) for k, v in want.items()}


# ---- substring dedup

def _units(text):
    out, at = [], 0
    for line in re.split("(\n)", text):
        for m in re.finditer(r".+?(?:[.!?](?=[\x20\x09-\x0D]|$)|$)", line, re.S):
            w = WORD.findall(m.group().translate(LOW))
            if w:
                out.append((at + m.start() + WORD.search(m.group()).start(), at + m.start() + [x.end() for x in WORD.finditer(m.group())][-1], tuple(w)))
        at += len(line)
    return out


def test_substring_dedup_equals_brute_force(spark, messy, nothing):
    passage = " ".join(f"Sentence {k} of the shared passage says something about item {k}." for k in range(8))
    rows = [(100 + k, f"Own start {k} here. {passage} Own end {k} there.\nAnother line {k}.") for k in range(5)]
    rows += [(200, "First.\n" + passage + "\nLast."), (201, passage.upper()), (202, "Only. " + passage[:60])]
    rows += [(r["doc_id"], r["text"]) for r in messy.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r["doc_id"], tuple((s["start"], s["end"]) for s in r["removed"]), r["n_units"]) for r in substring_dedup.dedup(docs).collect())
    place = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for k, u in enumerate(_units(t or "")):
                place[u[2]].add((i, t, k))
    first = {u: min((i, k) for i, t, k in v) for u, v in place.items()}
    want = Counter()
    for i, t in rows:
        us, cut, run = _units(t or ""), [], []
        again = [i is not None and len(place[u[2]]) > 1 and (i, k) != first[u[2]] for k, u in enumerate(us)] + [False]
        for k, on in enumerate(again):
            if on:
                run.append(k)
            else:
                while run and len(us[run[0]][2]) < 3:
                    run.pop(0)
                while run and len(us[run[-1]][2]) < 3:
                    run.pop()
                if run and sum(len(us[x][2]) for x in run) >= 30:
                    cut.append((us[run[0]][0], us[run[-1]][1]))
                run = []
        want[i, tuple(cut), len(us)] += 1
    assert got == want
    texts = {r["doc_id"]: r["text"] for r in substring_dedup.dedup_texts(docs.where("doc_id >= 100")).collect()}
    assert passage in texts[100] and all("shared passage" not in texts[i].lower() for i in (101, 104, 200, 201)) and texts[202].startswith("Only. Sentence 0")
    kept = substring_dedup.dedup_texts(messy)
    assert kept.columns == messy.columns and kept.count() == messy.count()
    assert substring_dedup.dedup(nothing).count() == 0


def test_passages_inside_sentences_go(spark):
    rng = np.random.default_rng(4)
    fill = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, n))
    shared = [fill(n) for n in (30, 50, 86, 151)]
    rows, want = [], {}
    for k, p in enumerate(shared):
        rows.append((k, f"{fill(40)} {p} {fill(25)}"))
        for j in (10 + k, 20 + k):  # begins and ends inside a text without stops
            head = fill(13 + j)
            rows.append((j, f"{head} {p.upper()} {fill(9)}"))
            want[j] = [(len(head) + 1, len(head) + 1 + len(p))]
    rows += [(30, f"{fill(20)} {' '.join(shared[2].split()[:29])} {fill(20)}"), (31, f"{fill(60)}"), (32, "x y z " * 400)]
    twice = fill(60)
    rows.append((33, f"{twice} {fill(5)} {twice}"))
    want[33] = [(len(rows[-1][1]) - len(twice), len(rows[-1][1]))]
    rows.append((20, rows[0][1]))  # the same id with another text
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = defaultdict(list)
    for r in substring_dedup.dedup(docs, inside=True).collect():
        got[r["doc_id"]].append([(s["start"], s["end"]) for s in r["removed"]])
    assert all(sorted(got[i], key=len)[-1] for i in want) and len(got[20]) == 2
    assert all(got[i] == [want[i]] for i in want if i != 20) and want[20] in got[20]
    assert all(got[i] == [[]] for i in (0, 1, 2, 3, 30, 31)) and got[32][0][0][0] >= 6 * 10
    texts = {r["doc_id"]: r["text"] for r in substring_dedup.dedup_texts(docs.where("doc_id != 20"), inside=True).collect()}
    assert all(p in texts[k] and p.upper() not in texts[10 + k] for k, p in enumerate(shared))
    assert substring_dedup.dedup(docs.limit(0), inside=True).count() == 0


# ---- line dedup

def test_line_dedup_both_ways(spark, messy, nothing):
    owner = defaultdict(set)
    strip = " \t\n\x0b\x0c\r"
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    for i, t in rows:
        if i is not None:
            for x in (t or "").split("\n"):
                owner[x.strip(strip).translate(LOW)].add(i)
    want = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(k := x.strip(strip).translate(LOW)) < 10 or len(owner[k]) < 2 or min(owner[k]) == i]
        want[i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()] += 1
    for limit in (line_dedup.BROADCAST_BYTES, -1):
        got = line_dedup.dedup(messy, broadcast_bytes=limit).collect()
        assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got) == want
        kept = line_dedup.dedup_texts(messy, broadcast_bytes=limit)
        assert kept.columns == messy.columns and kept.count() == messy.count()
        assert line_dedup.dedup(nothing, broadcast_bytes=limit).count() == 0


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    h1, h2 = rng.integers(0, 1 << 63, (2, 5000), dtype=np.uint64)
    ph = line_dedup.PerfectHash.from_rows(line_dedup.PerfectHash.build(h1, h2).to_rows())
    assert sorted(ph.find(h1, h2)) == list(range(5000))
    assert line_dedup.PerfectHash.build(h1[:0], h2[:0]).find(h1, h2).max() == -1


# ---- language-model scores

@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores_equal_brute_force(spark, messy, nothing, order):
    docs = messy.where("doc_id is not null").select("doc_id", "text").dropDuplicates(["doc_id"])
    rows = [tuple(r) for r in docs.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = {i: WORD.findall(t or "") for i, t in rows}
    count = Counter(tuple(w[k:k + n]) for w in words.values() for n in range(1, order + 1) for k in range(len(w) - n + 1))
    total = sum(map(len, words.values()))

    def s(g):
        if len(g) == 1:
            return count[g] / total
        return count[g] / count[g[:-1]] if count[g] >= 2 else 0.4 * s(g[1:])

    got = {r["doc_id"]: r for r in lm_scoring.score(docs, order=order, blocks=3).collect()}
    for i, w in words.items():
        want = sum(math.log(s(tuple(w[max(0, k - order + 1):k + 1]))) for k in range(len(w)))
        assert got[i]["n_words"] == len(w) and math.isclose(got[i]["log_score"], want, rel_tol=1e-9, abs_tol=1e-9)
        assert (got[i]["perplexity"] is None) == (not w)
    assert lm_scoring.score(nothing).count() == 0 and lm_scoring.score(messy).count() == messy.count()


def test_scores_use_trigrams_and_wide_counts(spark):
    docs = spark.createDataFrame([(k, "a b c x b d " * (k + 1)) for k in range(4)], "doc_id long, text string")
    by_default = sorted(map(tuple, lm_scoring.score(docs).collect()))
    assert by_default == sorted(map(tuple, lm_scoring.score(docs, order=3).collect()))
    assert by_default != sorted(map(tuple, lm_scoring.score(docs, order=2).collect()))
    gram, size = np.array([7, 9, 7], np.uint64), np.array([1, 2, 1], np.uint8)
    assert lm_scoring._totals(gram, np.array([3_000_000_000, 1, 3_000_000_000]), size, 2).tolist() == [6_000_000_000, 0, 6_000_000_000]
    _, place, grams = lm_scoring._grams(["a b c a"], 3)
    assert lm_scoring._distinct(grams, place, 3, 2)[1].dtype.itemsize == 8


def test_a_block_sends_its_ngrams_in_few_bytes(spark, messy):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, 500)) for _ in range(200)]
    sent, (_, place, grams) = lm_scoring._sent(texts, 3, 3), lm_scoring._grams(texts, 3)
    u, c, o, _ = lm_scoring._distinct(grams, place, 3, 3)
    raw = [sent[k].to_pylist() for k in ("gram", "count", "single")]
    assert sum(len(x) for col in raw for x in col) < 8 * len(u) < len(u) * (u.itemsize + c.itemsize + o.itemsize) / 2
    n = sent["n"].to_pylist()
    assert np.concatenate([np.cumsum(loosen(x, k, "<u8"), dtype=np.uint64) for x, k in zip(raw[0], n)]).tolist() == u.tolist()
    assert np.concatenate([loosen(x, k, "<i8") for x, k in zip(raw[1], n)]).tolist() == c.tolist()
    # Texts travel once, in compressed blocks: the join of blocks and counts reads the exchange that the counting read.
    scored = lm_scoring.score(messy, blocks=3)
    scored.collect()
    plan = scored._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1


def test_blocks_hold_all_rows_and_columns(spark, messy):
    packed = blocks_of(messy, "text", 1000).collect()
    assert len({r["block"] for r in packed}) == len(packed) > 3
    rows = [tuple(x.values()) for r in packed for x in rows_of(r["rows"]).to_pylist()]
    assert Counter(rows) == Counter(map(tuple, messy.collect()))


# ---- quality rules

def _counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i:i + 8])].append(i)
    covered = {j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_cases(spark, messy, nothing):
    got = quality.apply_rules(messy, None).collect()
    want = Counter((r["doc_id"], *_counts(r["text"])) for r in messy.collect())
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) and r["kept"] == (not r["base_failed"])
    assert quality.keep_good(messy, None).columns == messy.columns
    assert sorted(map(str, (r["doc_id"] for r in quality.keep_good(messy, None).collect()))) == sorted(str(r["doc_id"]) for r in got if r["kept"])
    assert quality.apply_rules(nothing, None).count() == 0
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality long")
    assert quality.fit(messy, labels) is None


def test_quality_fits_without_python_workers(spark, monkeypatch):
    """Fitting reads stored vectors: a stage with a second Python step would hold two workers a core."""
    from pyspark.ml.classification import LogisticRegression

    seen, plain = [], LogisticRegression.fit

    def fit(self, data, *args):
        seen.append((data._jdf.queryExecution().toString(), data.select("features").collect()))
        return plain(self, data, *args)

    monkeypatch.setattr(LogisticRegression, "fit", fit)
    texts = {i: (f"{PROSE} Day {i}." if i % 2 else f"win cash {i} now " * 9) for i in range(60)}
    model = quality.fit(spark.createDataFrame(list(texts.items()), "doc_id long, text string"),
                        spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality long"))
    assert model is not None and not any(x in seen[0][0] for x in ("EvalPython", "MapInArrow", "pythonUDF"))
    vectors = [r["features"] for r in seen[0][1]]
    assert 40 <= len(vectors) < 60 and all(v.size == 2 * quality.DIMS for v in vectors)
    for v in vectors:  # words, then trigrams, each SHARE in sum
        assert (np.diff(v.indices) > 0).all()
        for part in (v.indices < quality.DIMS, v.indices >= quality.DIMS):
            assert math.isclose(v.values[part].sum(), quality.SHARE)


def test_pipeline_workers_load_no_pandas():
    import subprocess
    import sys

    code = ("import sys; from quarry.llm import jaccard_join, line_dedup, packing, quality, substring_dedup; "
            "print('pandas' in sys.modules or 'pyspark.ml' in sys.modules)")
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.strip() == "False"


def test_quality_model_on_held_out_labels(spark):
    sf = SF0.replace("0.001", "0.1")
    docs = load_table(spark, sf, "documents", ["doc_id", "text"])
    labels = load_table(spark, sf, "labels", ["doc_id", "quality"])
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"), max_rows=1500)
    held = quality.apply_rules(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    good = [r for r in held if r["quality"] == 1]
    junk = [r for r in held if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.995 * len(good) and sum(not r["kept"] for r in junk) >= 0.85 * len(junk)
