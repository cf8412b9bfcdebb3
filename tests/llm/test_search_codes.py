"""Nearest neighbours, ranked search and product codes against plain definitions."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import hostile_rows, prose
from shrinkfx.llm import nra as NR
from shrinkfx.llm import product_codes as PC
from shrinkfx.llm import stable_search as SS
from shrinkfx.llm import textkit as K
from shrinkfx.llm.queries import op11_stable_projections, op12_nra_ranked_search, op13_grid_cell_codes

SF001 = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<double>, label int, score string, id string, cell string, code string"


def vectors(n=600, width=12, seed=5):
    """Clustered vectors; a third of them are copies of one; hostile rows besides."""
    r = np.random.default_rng(seed)
    centres = r.standard_normal((9, width)) * 2
    rows = [(i, (centres[i % 9] + r.standard_normal(width)).tolist(), i % 4 or None) for i in range(n)]
    rows += [(n + i, rows[3][1], 7) for i in range(n // 3)]
    nan, inf = float("nan"), float("inf")
    rows += [(9000, None, 1), (9020, [0.0] * width, 1), (9040, [1.0] * (width - 1) + [nan], 1), (9060, [inf] + [1.0] * (width - 1), 1),
             (9080, [], 2), (9100, [1.0] * (width - 1), 2), (9120, [None] + [1.0] * (width - 1), None), (None, [1.0] * width, 2),
             (9140, [1e30] + [0.5] * (width - 1), 3), (9140, [1e30] + [0.5] * (width - 1), 3), (9160, [-0.0] * (width - 1) + [1e-300], 3)]
    return [(i, v, l, "mine", "mine", "mine", "mine") for i, v, l in rows]


def usable(v, width):
    return v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)


def nearest(rows, width, k, every=20):
    good = sorted({i: v for i, v, *_ in rows if i is not None and usable(v, width) and any(v)}.items())
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, q in good:
        if i % every == 0:
            s = SS.in_order(x, np.array(q))
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


@pytest.mark.parametrize("cell_rows", [40, 10_000])
def test_search_against_brute_force(spark, cell_rows):
    rows = vectors()
    want = nearest(rows, 12, 20)
    # nearly sure neighbours: the result must be the brute force's, ties and order included
    s = SS.Search(dims=4, confidence=1 - 1e-12, cell_rows=cell_rows, query_rows=7)
    got = SS.search(spark.createDataFrame(rows, VEC).repartition(5), F.col("id") % 20 == 0, s=s)
    assert got.columns == ["query_id", "rank", "id", "score"]
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.id, r.score))
        assert len(found[r.query_id]) == r["rank"]
    assert found == want


def test_search_recall_and_scores_at_production_settings(spark):
    got = op11_stable_projections(spark, SF001).collect()
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    want = nearest(table, len(table[0][1]), 20)
    score = {q: dict(v) for q, v in nearest(table, len(table[0][1]), 10_000).items()}
    assert {r.query_id for r in got} == set(want) and len(got) == sum(map(len, want.values()))
    assert all(r.score == score[r.query_id][r.vec_id] for r in got)
    hit = sum(r.vec_id in dict(want[r.query_id]) for r in got)
    assert hit >= 0.98 * len(got)


def test_stopping_test_holds_its_confidence():
    """The chance that a neighbour is missed follows the chi-square law of the projections."""
    assert abs(SS.chi2_cdf(SS.chi2_quantile(0.99, 10), 10) - 0.99) < 1e-12
    assert abs(SS.chi2_quantile(0.95, 2) + 2 * math.log(0.05)) < 1e-9
    # over many projections: a single one is a fixed matrix, whose ratios lean one way
    x, met = np.random.default_rng(1).standard_normal((60, 31)), []
    for seed in range(300):
        a = SS._projection(30, SS.Search(seed=seed))
        met.append((((x @ a) ** 2).sum(1) / (x ** 2).sum(1) < SS.chi2_quantile(0.9, 10)).mean())
    assert abs(np.mean(met) - 0.9) < 0.01


def test_search_edges(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1, "", "", "", ""), (20, [2.0, 0.0], 1, "", "", "", ""), (3, None, 1, "", "", "", "")], VEC)
    got = [(r.query_id, r["rank"], r.id, r.score) for r in SS.search(few, F.col("id") % 20 == 0).orderBy("query_id").collect()]
    assert got == [(0, 1, 20, 2.0), (20, 1, 0, 2.0)]
    for rows in (spark.createDataFrame([], VEC), few.where("vec_id = 0"), few.where("vec_id = 3")):
        assert SS.search(rows, F.col("id") % 20 == 0).count() == 0


# ---------------------------------------------------------------- ranked search ----

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, k=20):
    terms = [(i, Counter(TERM.findall((t or "").translate(LOW)))) for i, t in docs]
    terms = [(i, c, sum(c.values())) for i, c in terms if c]
    n_docs, words = len(terms), sum(n for *_, n in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    out = {}
    for item, text in items:
        query, scored = Counter(TERM.findall((text or "").translate(LOW))), []
        for i, c, n in terms:
            m = 100 - 25 + (25 * n * n_docs) // words
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in query.items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        if scored:
            out[item] = [(i, -s) for s, _, _, i in sorted(scored)[:k]]
    return out


def corpus():
    docs = [(i, t) for i, t, *_ in hostile_rows()]
    docs += [(1000 + i, prose(i % 40, 30 + i % 70)) for i in range(300)]        # groups of equal scores
    docs += [(5000 + i, "common " * (i % 9 + 1) + prose(900 + i, 20)) for i in range(200)]
    items = [(i, prose(i, 40)) for i in range(30)] + [(100, None), (101, "  ,;"), (102, "common COMMON É é one"), (103, "nowhere")]
    return docs, items


@pytest.mark.parametrize("reader", [NR.Reader(), NR.Reader(first_step=1, shard_postings=300, block_items=7)])
def test_ranked_search_against_brute_force(spark, reader):
    docs, items = corpus()
    d = spark.createDataFrame([(i, t, "mine", 1) for i, t in docs], "doc_id long, text string, score string, rank int").repartition(4)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = {}
    for r in NR.rank(d, q, reader=reader).orderBy("item_id", "rank").collect():
        found.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert len(found[r.item_id]) == r["rank"]
    assert found == ranked(docs, items)


def test_terms_are_those_of_the_pattern():
    import pyarrow as pa
    texts = ["", "Ab-c É9_x\x7fy z", "no\x00break", "ÄÖ ünd", None, "a", "b"]
    h, n = NR.terms(*K.flat(pa.array(texts)))
    words = [TERM.findall((t or "").translate(LOW)) for t in texts]
    assert n.tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len(set(h.tolist())) == len(set(flat)) and len(h) == len(flat)


def test_reading_stops_before_the_lists_end():
    """With one outstanding document the interval test settles the result early."""
    rng = np.random.default_rng(2)
    n, terms = 5000, 6
    tf = rng.integers(1, 3, (n, terms))
    tf[77] = 500
    sizes, words = np.full(n, terms), int(tf.sum())
    shard = NR.Shard(tf.sum(1), sizes, np.tile(np.arange(terms), n), tf.ravel(), terms, n, words)
    read = []

    class Spy(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray) and at.dtype == np.int64:
                read.append(len(at))
            return np.asarray(self)[at]

    shard.doc = shard.doc.view(Spy)
    docs, scores = shard.best(np.arange(terms), np.full(terms, 700), 1, np.arange(n), 16)
    m = 75 + (25 * int(tf[77].sum()) * n) // words
    assert docs.tolist() == [77] and scores[0] == sum(700 * ((10**9 * 500) // (1000 * 500 + 12 * m)) for _ in range(terms))
    assert sum(read) < n * terms / 20


def test_ranked_search_edges(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b c")], "item_id long, text string")
    got = sorted((r.item_id is None, r["rank"], r.doc_id) for r in NR.rank(docs, items).collect())
    # one document holds both terms: its weight is floor(1000 ln(4/3))
    assert got == [(False, 1, 1), (True, 1, 1)]
    assert NR.rank(docs.limit(0), items).count() == 0 and NR.rank(docs, items.limit(0)).count() == 0
    assert NR.rank(docs.where("doc_id = 2"), items).count() == 0


def test_ranked_search_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    found = {}
    for r in op12_nra_ranked_search(spark, SF001).orderBy("item_id", "rank").collect():
        found.setdefault(r.item_id, []).append((r.doc_id, r.score))
    assert found == ranked(docs, items)


# ---------------------------------------------------------------- product codes ----

def coded(rows, width, c):
    top = 1 << 26
    good = sorted(((i is None, i or 0, v, i, l) for i, v, l, *_ in rows if usable(v, width)))
    z = [[max(-top, min(top, math.floor(c.scale * x))) for x in v] + [0] * (-width % c.parts) for _, _, v, _, _ in good]
    w = len(z[0]) // c.parts
    parts = [[row[p * w:(p + 1) * w] for row in z] for p in range(c.parts)]
    books = [[list(x) for x in part[:c.entries]] for part in parts]

    def assign(p):
        out = []
        for x in parts[p]:
            d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(c.rounds):
        for p in range(c.parts):
            mine = assign(p)
            for e in range(len(books[p])):
                xs = [x for x, (k, _) in zip(parts[p], mine) if k == e]
                if xs:
                    books[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
    found = [assign(p) for p in range(c.parts)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    rows = [(g[3], "".join(f"{found[p][n][0]:02x}" for p in range(c.parts)), sum(found[p][n][1] for p in range(c.parts)), g[4])
            for n, g in enumerate(good)]
    per = Counter()
    for _, _, e, l in rows:
        per[l] += e
    return [(i, code, e, per[l], digest) for i, code, e, l in rows]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("width,c", [(12, PC.Coder(entries=20)), (10, PC.Coder(entries=5, cell_bits=9, rounds=2, max_cells=3))])
def test_codes_against_brute_force(spark, width, c):
    rows = vectors(150, width)
    got = PC.encode(spark.createDataFrame(rows, VEC).repartition(4), coder=c)
    assert got.columns == ["id", "code", "error", "label_error", "codebooks_sha256"]
    assert order(tuple(r) for r in got.collect()) == order(coded(rows, width, c))


def test_cells_drop_no_nearest_entry():
    r = np.random.default_rng(8)
    for bits, spread in ((3, 60), (6, 300), (9, 5000)):
        book, x = r.integers(-spread, spread, (64, 5)), r.integers(-spread, spread, (700, 5))
        book[40], x[:100] = book[7], book[r.integers(0, 64, 100)]  # equal entries, and points on entries
        code, error = PC.Cells(book, bits, 10).nearest(x)
        d = ((x[:, None] - book) ** 2).sum(2)
        assert (code == d.argmin(1)).all() and (error == d.min(1)).all()


def test_cells_leave_most_entries_out():
    r = np.random.default_rng(9)
    cells = PC.Cells(r.integers(-600, 600, (256, 16)), 5, 10_000)
    cells.nearest(r.integers(-600, 600, (300, 16)))
    assert np.mean([len(c) for c in cells.cache.values()]) < 40


def test_codes_query_and_empty(spark):
    got = [tuple(r) for r in op13_grid_cell_codes(spark, SF001).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256").collect()]
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in sorted(rows, key=lambda r: r.vec_id)], np.float64)
    assert len(got) == len(x) and len({g[4] for g in got}) == 1 and all(len(g[1]) == 8 for g in got)
    assert PC.encode(spark.createDataFrame([], VEC)).count() == 0
