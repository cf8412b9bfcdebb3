import numpy as np
import pytest

from brute import near_components, repeated, shingles
from samples import hostile_rows, prose
from shrinkfx.llm import minhash as MH
from shrinkfx.llm import suffix_dedup as SD
from shrinkfx.llm import textkit as K
from shrinkfx.llm.components import components
from shrinkfx.llm.queries import op5_suffix_dedup


def distinct_ids():
    seen, out = set(), []
    for i, t, *_ in hostile_rows():
        if i is not None and i not in seen:
            seen.add(i)
            out.append((i, t))
    return out


def near_copies(n=60):
    """A hub with copies of one to six edits, and pairs on both sides of the threshold."""
    import random
    base, rows = prose(77, 140).split(), [(1000, " ".join(prose(77, 140).split()))]
    r = random.Random(4)
    for k in range(n):
        ws = list(base)
        for _ in range(1 + k % 6):
            ws[r.randrange(len(ws))] = f"edit{r.randrange(10**6)}"
        rows.append((1001 + k, " ".join(ws)))
    for k in range(20):
        ws = prose(200 + k, 100).split()
        rows.append((2000 + 2 * k, " ".join(ws)))
        rows.append((2001 + 2 * k, " ".join(ws[: 100 - k])))
    return rows


def test_components_against_union_find(spark):
    import random
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)]
    edges += [(500, 500)] + [(600, 601 + i) for i in range(50)]
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up if top(x) != x}


def test_sketch_fills_every_bin_and_estimates_similarity():
    rng = np.random.default_rng(0)
    for n in (1, 2, 30, 3000):
        a = rng.integers(0, 1 << 52, n, dtype=np.uint64)
        s = MH.fast_sketch(a, np.array([n]), 192, 3)
        assert (s != np.iinfo(np.uint64).max).all()
    common, own = rng.integers(0, 1 << 52, 800, dtype=np.uint64), rng.integers(0, 1 << 52, 200, dtype=np.uint64)
    a, b = np.concatenate([common, own[:100]]), np.concatenate([common, own[100:]])
    s = MH.fast_sketch(np.concatenate([a, b]), np.array([900, 900]), 192, 3)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.12
    assert (MH.fast_sketch(a[::-1].copy(), np.array([900]), 192, 3)[0] == s[0]).all()


def test_shingle_sets_against_brute_force():
    texts = [t or "" for _, t in distinct_ids()]
    data = "".join(texts).encode()
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    grams, counts = MH.shingle_sets(np.frombuffer(data, np.uint8), offs, 5)
    assert counts.tolist() == [len(shingles(t)) for t in texts]
    assert K.row_of(counts).shape == grams.shape


@pytest.mark.parametrize("rows", [distinct_ids(), near_copies()], ids=["hostile", "hub"])
def test_near_duplicates_against_brute_force(spark, rows):
    want, sets = near_components(rows)
    got = MH.judge(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.id: (r.component_id, r.n_shingles, r.kept) for r in got} == {
        i: (c, len(sets[i]), c == i) for i, c in want.items()}


def test_contested_pairs_find_links_without_the_center(spark):
    """a and c miss the hub b but are linked to each other: the second step must see it."""
    rows = near_copies(40)
    want, _ = near_components(rows)
    one_band = MH.Sketch(bands=64, rows=2)  # buckets full of unlike sets
    got = MH.judge(spark.createDataFrame(rows, "doc_id long, text string"), one_band).collect()
    assert {r.id: r.component_id for r in got} == want


def test_near_duplicates_edges(spark, hostile, nothing, all_null):
    kept = MH.keep_smallest(hostile)
    assert kept.columns == hostile.columns
    rows = kept.collect()
    assert {r.kept for r in rows} == {"mine"}
    assert {r.doc_id for r in rows} >= {3, 10, 15, 16, 17, 19} and not {r.doc_id for r in rows} & {11, 14, 20, 25}
    assert MH.judge(nothing).collect() == [] and MH.keep_smallest(nothing).collect() == []
    assert [(r.n_shingles, r.component_id) for r in MH.judge(all_null).collect()] == [(0, None)] * 2


def passages():
    """Repeats across rows, inside one row, overlapping, at edges, and periodic text."""
    p, q = prose(31, 60), prose(32, 45)
    rows = distinct_ids() + [
        (100, prose(40, 50) + p + prose(41, 50)), (101, p), (102, q + p + q), (103, p[:99]), (104, p[:100]),
        (105, p[20:140] + prose(42, 9) + p[100:260]), (106, "ab" * 700), (107, "ab" * 60), (108, "z" * 250),
        (109, prose(43, 200) + "\n" + prose(43, 200)), (-5, p[-150:]), (110, "é" * 300)]
    return rows


def test_repeated_spans_against_brute_force(spark, tmp_path):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in op5_suffix_dedup(spark, str(tmp_path)).collect()}
    assert got == repeated(rows)


def test_repeated_spans_in_small_chunks(spark, monkeypatch):
    """A text longer than a chunk is anchored piece by piece; results do not change."""
    monkeypatch.setattr(SD, "CHUNK", 512)
    from brute import repeated as brute
    rows = [(i, t) for i, t in passages() if len(t or "") < 20000]
    texts = [t or "" for _, t in rows]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    prefix = K.prefix_hash(data)
    places = {}
    for r in SD.runs_of(data, offs, prefix, 100, 50):
        run, start = SD._windows(r)
        for k, s in zip(run, start):
            w = data[s: s + 100].tobytes()
            # equal windows have equal anchors at equal distances
            assert places.setdefault(w, int(r.anchor[k] - s)) == r.anchor[k] - s
            assert r.row[k] == np.searchsorted(offs, s, "right") - 1
    windows = {t.encode()[k:k + 100] for t in texts for k in range(len(t.encode()) - 99)}
    assert set(places) == windows and brute(rows)


def test_repeated_spans_edges(spark, hostile, nothing, all_null):
    assert SD.repeated_spans(nothing).collect() == []
    assert [(r.n_bytes, r.spans, bytes(r.kept)) for r in SD.repeated_spans(all_null).collect()] == [(0, [], b"")] * 2
    # rows without an id come first, so the base text of the others goes
    got = SD.repeated_spans(hostile).collect()
    assert len(got) == len(hostile_rows())
    by = {r.id: r for r in got if r.id in (10, 11)}
    assert all(len(bytes(r.kept)) == 0 for r in by.values())


def test_rows_without_id_go_by_their_sets(spark):
    text, alone = prose(61, 80), prose(62, 80)
    rows = [(5, text), (None, text.replace(" ", "\t")), (None, text.replace("b", "B")), (None, alone), (None, alone.replace(" ", "\t")), (None, alone + " more"),
            (None, None), (None, " "), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, None if r.text is None else " ".join(r.text.split())) for r in MH.keep_smallest(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, [
        (5, " ".join(text.split())), (None, " ".join(alone.split())), (None, " ".join(alone.split()) + " more"),
        (None, None), (None, ""), (6, None)]))


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_texts_of_one_id_are_one_document_and_lose_no_link(spark, parts):
    a, b = prose(700, 100).split(), prose(701, 100).split()
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(a + ["word"])), (3, " ".join(b + ["word"])), (4, prose(702, 90))]
    got = MH.judge(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    assert {(r.id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_shingle_hashes_are_whole():
    import pyarrow as pa
    grams, counts = MH.shingle_sets(*K.flat(pa.array([prose(1, 4000), prose(2, 50)])), 5)
    assert (grams >> np.uint64(52)).max() > 4000 and counts.sum() == len(grams)
    for part in np.split(grams, np.cumsum(counts)[:-1]):
        assert (part[1:] > part[:-1]).all()
