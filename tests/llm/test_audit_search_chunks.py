"""Filter audit, ranked search and chunked BPE on messy rows, empty tables and against brute force."""

import hashlib
import itertools
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import bpe_chunks, filter_audit, ranked_search
from quarry.llm import textkernel as K
from quarry.llm.queries import byte_bpe
from quarry.llm.tokens import Encoder

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
PROSE = " ".join(f"word{i % 89}" for i in range(120))
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


# ---- filter audit -------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_adjacent_swaps_reach_every_order_once(n):
    order, seen = list(range(n)), [tuple(range(n))]
    for k in filter_audit.adjacent_swaps(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.append(tuple(order))
    assert len(seen) == len(set(seen)) == math.factorial(n)


def brute_steps(letters, masks):
    """``order_steps`` by walking every order over every mask."""
    out, removed_in_all = [], Counter()
    rows = [({letters[i] for i in range(len(letters)) if m >> i & 1}, *w) for m, w in masks.items()]
    for order in map("".join, itertools.permutations(letters)):
        for step, x in enumerate(order, 1):
            gone_before = [r for r in rows if r[0] & set(order[:step - 1])]
            here = [r for r in rows if x in r[0] and not r[0] & set(order[:step - 1])]
            kept = sum(r[1] for r in rows if not r[0] & set(order[:step]))
            removed_in_all[x] += sum(r[1] for r in here)
            out.append([order, step, kept, sum(r[1] for r in here), sum(r[1] for r in gone_before if x in r[0]),
                        sum(r[1] for r in rows if r[0] == {x}), sum(r[2] for r in here), sum(r[3] for r in here)])
    return sorted(tuple(r) + (removed_in_all[r[0][r[1] - 1]],) for r in out)


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 4), st.data())
def test_diagrams_equal_brute_force(n, data):
    letters = "ABCD"[:n]
    weights = st.tuples(st.integers(0, 9), st.integers(0, 5), st.integers(0, 5))
    masks = data.draw(st.dictionaries(st.integers(0, 2 ** n - 1), weights))
    assert sorted(filter_audit.order_steps(letters, masks)) == brute_steps(letters, masks)


def brute_masks(docs, labels):
    """{part: {mask: (docs, good, toxic)}} of (id, text, lang) rows."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = {}
    for i, t, lang in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t]]
        m = sum(f << k for k, f in enumerate(fails))
        cell = out.setdefault(lang or "", {}).setdefault(m, [0, 0, 0])
        for k, x in enumerate((1, i is not None and i in good, i is not None and i in toxic)):
            cell[k] += x
    return {p: {m: tuple(w) for m, w in x.items()} for p, x in out.items()}


AUDIT_DOCS = [
    (1, PROSE, "en"), (2, PROSE, "fr"), (2, PROSE, "fr"), (1, PROSE, None), (None, PROSE, "en"), (3, None, None), (4, "", "en"), (5, " \n\t ", ""),
    (6, "UPPER CASE TEXT", "en"), (7, "with | sign", "en"), (8, "x y " * 200, "en"), (9, "é日本 " * 300 + "A#", "fr"),
    (10, " ".join(f"u{i}" for i in range(150)), "en"), (11, " ".join(f"u{i}" for i in range(150)), "fr"), (12, "Ab cd" * 20_000, "fr"),
    (None, None, None), (13, "a\x0bb\x0cc\x1cd", "en"),
]
AUDIT_LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (6, None, 1), (10, 1, None), (None, 1, 1), (99, 1, 1)]


def test_audit_on_messy_rows(spark):
    docs = spark.createDataFrame([(*r, 7, "m") for r in AUDIT_DOCS], "doc_id long, text string, lang string, n long, mask string").repartition(3)
    labels = spark.createDataFrame(AUDIT_LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit_documents(docs, labels).collect()
    want = {p: brute_steps("ABCDE", m) for p, m in brute_masks(AUDIT_DOCS, AUDIT_LABELS).items()}
    assert {r["part"] for r in got} == set(want)
    for part, steps in want.items():
        assert sorted(tuple(r)[1:] for r in got if r["part"] == part) == steps


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert filter_audit.audit_documents(docs, spark.createDataFrame(AUDIT_LABELS, "doc_id long, quality int, toxic int")).collect() == []
    with pytest.raises(ValueError):
        filter_audit.audit(spark.createDataFrame([], "part string, mask int, good boolean, toxic boolean, n long"), "AA")


# ---- ranked search ------------------------------------------------------------------------------

def terms_of(text):
    return TERM.findall((text or "").translate(AZ))


def brute_ranks(docs, items, k):
    """[(item, rank, id, score)] by scoring every document."""
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in queries.items():
        scored = []
        for i, c, n in held:
            m = 50 + (50 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in terms if t in c)
            if s > 0:
                scored.append((-s, i is None, i if i is not None else 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 1 << 62), max_size=50))
def test_variable_length_integers(values):
    raw, at = ranked_search._varints(np.array(values, np.int64))
    assert at[-1] == len(raw)
    if values:
        assert ranked_search._from_varints(raw).tolist() == values


def segments_of(docs, size):
    for i in range(0, len(docs), size):
        part = docs[i:i + size]
        h = [ranked_search.hashed_terms(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[0] for _, t in part]
        yield ranked_search.build_segment([i for i, _ in part], np.concatenate(h), np.array([len(x) for x in h], np.int64))


def test_bounds_reject_blocks_and_lose_nothing():
    rng = np.random.default_rng(5)
    vocab = [f"t{i}" for i in range(400)]
    p = 1 / np.arange(1, 401) ** 1.1
    docs = [(int(i), " ".join(rng.choice(vocab, int(rng.integers(1, 120)), p=p / p.sum()))) for i in rng.permutation(6000)]
    docs += [(7000 + i, "t250 t260 t270 t0 t1 t2") for i in range(20)]
    items = [(1, "t250 t260 t270 t0 t1 t2"), (2, "t0"), (3, "t399 T5 t5 t0 t1 t2 t3 t4"), (4, "nothing here")]
    rows = list(segments_of(docs, 3000))
    terms = [np.unique(ranked_search.hashed_terms(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]) for _, t in items]
    wanted = np.unique(np.concatenate(terms))
    n_docs, total = sum(r["with_terms"] for r in rows), sum(r["length"] for r in rows)
    df = np.zeros(len(wanted), np.int64)
    for r in rows:
        t, c = np.frombuffer(r["terms"], "<u8"), np.frombuffer(r["dfs"], "<i8")
        for j, w in enumerate(wanted):
            df[j] += c[t == w].sum()
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    heaps, read, there = ranked_search.search_rows(iter(rows), [np.searchsorted(wanted, t) for t in terms], wanted, weights, n_docs, total, 10)
    got = [(item, r, int(i), int(s)) for (item, _), h in zip(items, heaps) for r, (s, i) in enumerate(zip(h.score, h.ids), 1)]
    assert sorted(got, key=repr) == brute_ranks(docs, items, 10)
    only = ranked_search.search_rows(iter(rows), [np.searchsorted(wanted, terms[0])], wanted, weights, n_docs, total, 10)
    blocks = sum(math.ceil(df_in / ranked_search.BLOCK) for r in rows for j in np.searchsorted(wanted, terms[0])
                 for df_in in np.frombuffer(r["dfs"], "<i8")[np.frombuffer(r["terms"], "<u8") == wanted[j]])
    assert only[1] < 0.7 * blocks  # frequent terms' blocks are mostly rejected by their bounds


def test_search_on_messy_rows(spark):
    docs = [(1, "Apple pie apple"), (2, "apple"), (2, "apple"), (None, "apple pie"), (3, None), (4, ""), (5, "!!! ... --"), (6, "日本 apple ÉCLAIR éclair"),
            (7, "pie " * 30_000), (8, "x" * 70_000 + " pie"), (9, "PIE\x7fpie\x00pie"), (10, "no such words"), (11, "apple pie"), (12, "apple pie")]
    items = [(1, "Apple PIE"), (1, "apple"), (2, None), (3, "éclair"), (4, "zzz"), (None, "pie"), (5, ""), (6, "apple")]
    frame = spark.createDataFrame([(*d, "no", 1) for d in docs], "doc_id long, text string, item_id string, rank int").repartition(4)
    queries = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, score int")
    for k in (3, 50):
        got = [tuple(r) for r in ranked_search.search_documents(frame, queries, k).collect()]
        assert sorted(got, key=repr) == brute_ranks(docs, items, k)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "apple")], "item_id long, text string")
    assert ranked_search.search_documents(none, items).collect() == []
    out = ranked_search.search_documents(spark.createDataFrame([(1, "apple")], none.schema), items.limit(0))
    assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_index_lies_compressed_in_small_row_groups(spark, monkeypatch):
    """Spark holds whole row groups of the index in memory, so they are small and their arrays compressed."""
    import glob

    import pyarrow.parquet as pq

    monkeypatch.setattr(ranked_search, "SEGMENT_DOCS", 40)
    monkeypatch.setitem(ranked_search._WRITTEN, "parquet.block.size", 4000)
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(f"w{int(x) % 300}" for x in rng.integers(1, 4000, 1200))) for i in range(300)]
    index = ranked_search.pin_index(ranked_search.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)))
    files = [pq.ParquetFile(f) for d in index.inputFiles() for f in glob.glob(d.replace("file:", "", 1))]
    groups = [f.metadata.row_group(i).num_rows for f in files for i in range(f.metadata.num_row_groups)]
    assert len(groups) == sum(groups) >= 4
    rows = index.toArrow()
    stored = sum(len(x.as_py()) for c in ranked_search._COLUMNS for x in rows[c])
    back = list(ranked_search._unpacked_rows(iter(rows.to_batches())))
    assert stored < 0.6 * sum(len(r[c]) for r in back for c in ranked_search._COLUMNS)
    held = [np.frombuffer(r["ids"], "<i8").tolist() for r in back]
    assert sorted(i for ids in held for i in ids) == list(range(300))
    for r, ids in zip(back, held):
        want, = segments_of([docs[i] for i in ids], len(ids))
        assert {k: v if isinstance(v, int) else bytes(v) for k, v in r.items()} == want


# ---- chunked BPE --------------------------------------------------------------------------------

def ids_of(text):
    return np.asarray(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


PIECES = st.sampled_from([" ", "  ", "\n", "\t ", " ", "　", " ", "a", "word", "don't", "'re", "é", "日本", "🎉", "12", "!?", "<|endoftext|>",
                          "<|endof", "text|>", "\x1c", "\x85", "\r\n", "'", "ll", "x" * 90, "the quick brown fox "])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=60).map("".join), min_size=1, max_size=4))
def test_parts_and_joins_equal_the_whole_text(texts):
    encoder = Encoder(*byte_bpe())
    for _, data, offs in K.text_chunks(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])):
        s, e = bpe_chunks.inner_parts(data, offs, average=24)
        raw, poff = data.tobytes(), np.searchsorted(s, offs)
        for i, text in enumerate(texts):
            a, b = poff[i], poff[i + 1]
            assert all(offs[i] <= x and y <= offs[i + 1] for x, y in zip(s[a:b], e[a:b]))
            ids = b""
            for x, y in zip([offs[i], *e[a:b]], [*s[a:b], offs[i + 1]]):
                ids += bpe_chunks._ids(encoder, raw[x:y])
                if y in s[a:b]:
                    ids += bpe_chunks._ids(encoder, raw[y:e[a:b][list(s[a:b]).index(y)]])
            assert ids == ids_of(text)


def test_chunks_follow_the_content():
    passage = "".join(f"sentence {i * 7919 % 1000} of a passage that several texts share. " for i in range(200))
    found = []
    for text in (passage, "other words before it, " + passage, "é 日本 " * 50 + passage + " and after"):
        raw = np.frombuffer(text.encode(), np.uint8)
        s, e = bpe_chunks.inner_parts(raw, np.array([0, len(raw)]))
        found.append(set(bpe_chunks._keys(raw.tobytes(), s, e)[0]))
    assert len(found[0]) > 5
    assert len(found[0] & found[1]) >= len(found[0]) - 2 and len(found[0] & found[2]) >= len(found[0]) - 3


def test_encoding_of_messy_rows(spark):
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    shared = "".join(f"passage sentence {i} that is shared. " for i in range(120))
    texts = [(1, shared), (2, "before " + shared), (2, "before " + shared), (3, shared + "after"), (None, shared), (4, None), (5, ""), (6, " \n "),
             (7, long), (8, long + " tail"), (9, "a <|endoftext|> b"), (10, "日本語　" * 3000), (11, "x" * 50_000), (12, shared.replace(" that", " <|endoftext|> that")),
             (13, shared.replace(" that", " <|endoftext|> that") + "!")]
    docs = spark.createDataFrame([(*t, "no", "k") for t in texts], "doc_id long, text string, ids string, key string").repartition(4)
    path, pattern = byte_bpe()
    got = bpe_chunks.decode(bpe_chunks.encode(docs, path, pattern), path).collect()
    key = lambda r: (r[0] is not None, r[0], hashlib.sha1(r[1]).digest())
    want = [(i, ids_of(t or ""), t or "") for i, t in texts]
    assert sorted((tuple(r) for r in got), key=lambda r: (str(r[0]), r[1], r[2])) == sorted(want, key=lambda r: (str(r[0]), r[1], r[2]))


def test_encoding_of_nothing(spark):
    path, pattern = byte_bpe()
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_chunks.decode(bpe_chunks.encode(none, path, pattern), path).collect() == []


def test_decoding_takes_any_ids(spark):
    path, _ = byte_bpe()
    half = TOKENIZER.encode("日", add_special_tokens=False).ids[:1]  # an incomplete character
    rows = [(1, np.asarray(half, "<u4").tobytes()), (2, None), (3, b""), (4, np.asarray([50256, 64], "<u4").tobytes())]
    got = bpe_chunks.decode(spark.createDataFrame(rows, "n int, ids binary"), path).collect()
    assert [r["decoded"] for r in got] == [TOKENIZER.decode(half, skip_special_tokens=False), None, "", "<|endoftext|>a"]


# ---- pages with attributes of their own

def test_pages_own_attributes_are_no_marks(spark):
    from quarry.llm import html_extract

    body = "<article>%s</article>" % "".join(f"<p>Seven wizards brew potion number {i} in the old tower.</p>" for i in range(5))
    rows = [(i, f"<div data-y{v} class=x><nav data-y=1>menu</nav>{body}</div>") for i, v in
            enumerate(['="top"', '=""', "=1.5", "=0", "=1", "", "='x>y'", '="9999999999999999999999"'])]
    pages = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string")
    trees = html_extract.fit(pages)
    for model in (trees, None):
        got = [r["text"] for r in html_extract.extract(pages, model).collect()]
        assert len(set(got)) == 1 and got[0].startswith("Seven wizards brew potion number 0") and got[0].endswith("tower.")


def test_exact_dedup_buckets_grow_with_the_rows():
    from quarry.llm.exact_dedup import BUCKET_KEYS, bucket_count

    assert bucket_count(0, 8) == bucket_count(8 * BUCKET_KEYS, 8) == 8
    assert bucket_count(10**12, 8) == 10**12 // BUCKET_KEYS
