import math
import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import crc, unigrams, words
from samples import hostile_rows, prose
from shrinkfx.llm import langid as LI
from shrinkfx.llm import queries as Q
from shrinkfx.llm import suffix_lm as SL

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def test_features_against_brute_force():
    texts = ["Abc é", "", "xyzxyz", "日本語 ok"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    first, bins, counts = LI.features(data, offs)
    alone = []
    for i, t in enumerate(texts):
        low = "".join(c.lower() if c.isascii() else c for c in t)
        grams = [low[k:k + n] for n in (1, 2, 3) for k in range(len(low) - n + 1)]
        assert counts[first[i]: first[i + 1]].sum() == len(grams)
        assert first[i + 1] - first[i] == len(set(grams))
        one = LI.features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        alone.append(one)
        assert (one[1] == bins[first[i]: first[i + 1]]).all()
    assert first[-1] == len(bins)


def test_ftrl_is_sparse_and_separates():
    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        y = k % 3
        bins = np.unique(np.concatenate([[y], rng.integers(10, 400, 5)]))
        rows.append((y, bins, np.full(len(bins), len(bins) ** -0.5)))
    w = LI.fit_ftrl(rows, 3, 400, LI.Training(l1=0.5))
    assert (w[:, :3].argmax(axis=0) == [0, 1, 2]).all()
    assert (w == 0).mean() > 0.5
    assert (LI.fit_ftrl(rows, 3, 400, LI.Training(l1=5.0)) != 0).sum() < (w != 0).sum()


def test_temperature_recovers_a_known_scale():
    rng = np.random.default_rng(1)
    z = rng.normal(size=(3, 6000))
    p = LI._softmax(z)
    y = (rng.random(6000)[None] > p.cumsum(axis=0)).sum(axis=0)
    assert LI.fit_temperature(z * 4, y) == pytest.approx(4, rel=0.1)
    assert LI.fit_temperature(np.zeros((3, 0)), np.zeros(0, int)) == 1.0


def test_langid_held_out_accuracy(spark):
    got = Q.op3_langid_ftrl(spark, SF01)
    truth = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_langid_edges(spark, hostile, nothing, all_null):
    model = LI.train(hostile)
    assert model.languages == ("aa", "bb")
    rows = LI.identify(hostile, model).collect()
    assert len(rows) == len(hostile_rows())
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1 and r.kept == "mine"
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 25}) == 1
    assert LI.identify(nothing, model).collect() == []
    assert {r.lang_pred for r in LI.identify(all_null, model).collect()} == {"und"}
    untrained = LI.train(nothing)
    assert untrained.languages == () and {r.lang_pred for r in LI.identify(hostile, untrained).collect()} == {"und"}
    wide = spark.createDataFrame([(1, "日本"), (2, "１２ …"), (3, "ß")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred == "und" for r in LI.identify(wide, model).collect()} == {1: False, 2: True, 3: False}


def test_langid_never_reads_the_label(spark):
    """The answer for a text is the same whatever its language, source or id say."""
    train = spark.createDataFrame([(i, prose(i, 60) if i % 2 else "alpha beta gamma " * 20, "aa" if i % 2 else "bb")
                                   for i in range(60)], "doc_id long, text string, lang string")
    model = LI.train(train)
    ask = spark.createDataFrame([(1, prose(500, 50), "bb"), (2, prose(500, 50), "aa")], "doc_id long, text string, lang string")
    a, b = LI.identify(ask, model).collect()
    assert (a.lang_pred, a.score) == (b.lang_pred, b.score) and a.lang_pred == "aa"


def test_lm_counts_and_base_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    c = unigrams(r.text for r in docs if crc(r.doc_id) % 10 != 0)
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in Q.op8_suffix_tree_scores(spark, SF001).collect()}
    assert len(got) == len(docs)
    for r in docs:
        ws, g = words(r.text, True) + [b" "], got[r.doc_id]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (
            crc(r.doc_id) % 10 == 0, len(ws), sum(c[w] > 0 for w in ws), n)
        assert g.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel=1e-9)


def test_rare_words_take_the_joined_path_with_equal_results(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").limit(60).cache()
    shape = SL.Shape(depth=0)
    all_frequent, few = [
        {r.doc_id: r for r in SL.score(docs, *SL.train(docs, shape=s), shape=s).collect()}
        for s in (shape, SL.Shape(depth=0, head_rows=40))]
    for i, r in all_frequent.items():
        assert (few[i].n_tokens, few[i].n_known) == (r.n_tokens, r.n_known)
        assert few[i].base_score == pytest.approx(r.base_score, rel=1e-9)
        # without contexts the model is its root
        assert few[i].score == pytest.approx(few[i].base_score, rel=1e-9)


def test_model_is_a_distribution_and_uses_long_contexts(spark):
    """Next-word probabilities of a state sum to one over known words and the unknown."""
    texts = ["the cat sat on the mat"] * 40 + ["a dog sat on a log"] * 40 + [prose(k, 30) for k in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shape = SL.Shape(bits_per_edge=2.0, least_edge=2)
    tree, counts = SL.train(docs, shape=shape)
    assert [len(x.states) > 0 for x in tree.levels] == [True] * 3
    prefix = np.frombuffer(b"cat sat on", np.uint8)
    tokens, _, _ = SL.token_stream(prefix, np.array([0, len(prefix)]))
    for n_before in range(4):
        history = tokens[:n_before]
        total = 0.0
        unknown = np.array([np.uint64(12345)])
        for w in [*tree.words.keys, unknown[0]]:
            s = np.append(history, w).astype(np.uint64)
            _, base, model, _ = SL._scores(tree, s, np.arange(len(s)))
            root = 0.1 / (tree.tokens + 0.1 * (tree.distinct + 1)) if w == unknown[0] else 1.0
            total += root * 10.0 ** model[-1]
        assert total == pytest.approx(1, abs=1e-6)
    rows = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "mat the on sat cat the")], "doc_id long, text string")
    got = {r.doc_id: r for r in SL.score(rows, tree, counts, shape=shape).collect()}
    assert got[1].base_score == pytest.approx(got[2].base_score) and got[1].score > got[2].score + 3
    assert got[1].score > got[1].base_score


def test_lm_improves_held_out_text(spark):
    held = [r for r in Q.op8_suffix_tree_scores(spark, SF01).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_edges(hostile, nothing, all_null):
    tree, counts = SL.train(hostile)
    rows = SL.score(hostile, tree, counts).collect()
    assert len(rows) == len(hostile_rows()) and all(math.isfinite(r.score) and r.kept == "mine" for r in rows)
    assert len({r.score for r in rows if r.doc_id == 25}) == 1
    assert SL.score(nothing, tree, counts).collect() == []
    assert {r.n_tokens for r in SL.score(all_null, tree, counts).collect()} == {1}
    empty, none = SL.train(nothing)
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score)
               for r in SL.score(hostile, empty, none).collect())


def test_rare_contexts_count_at_any_corpus_size(spark):
    """Contexts and next words seen twice are in the tree however large the rest is, and the
    joined path gives what the broadcast one gives."""
    twice = " ".join(f"zig{i} zag{i} zug{i} zog{i}" for i in range(30))
    texts = [twice] * 2 + [prose(k, 400) for k in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5).cache()
    got = []
    for shape in (SL.Shape(least_edge=2, head_rows=60), SL.Shape(least_edge=2), SL.Shape(least_edge=2, head_rows=0)):
        tree, counts = SL.train(docs, shape=shape)
        got.append(({r.doc_id: r for r in SL.score(docs, tree, counts, shape=shape).collect()}, tree))
    assert got[0][0][0].train_tokens > 100_000
    assert got[0][0][0].score > got[0][0][0].base_score + 100
    assert all(len(x.states) > 0 for x in got[1][1].levels) and all(len(x.states) == 0 for x in got[2][1].levels)
    for i in range(len(texts)):
        assert got[0][0][i].score == pytest.approx(got[1][0][i].score, rel=1e-8)
        assert got[2][0][i].score == pytest.approx(got[1][0][i].score, rel=1e-8)


@pytest.mark.parametrize("least", [2, SL.Shape().least_edge])
def test_scores_against_a_plain_suffix_tree(spark, least):
    texts = ["the cat sat on the mat", "a dog sat on a log", ""] * 20 + [prose(k, 25) for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    shape = SL.Shape(least_edge=least)
    got = {r.doc_id: r.score for r in SL.score(docs, *SL.train(docs, shape=shape), shape=shape).collect()}
    streams = [[*words(t, True), b" "] for t in texts]
    count, following = {}, {}
    for s in streams:
        for i, w in enumerate(s):
            for k in range(min(i, 3) + 1):
                gram = tuple(s[i - k: i + 1])
                count[gram] = count.get(gram, 0) + 1
    for gram, m in count.items():
        if len(gram) > 1 and m >= least:
            following.setdefault(gram[:-1], {})[gram[-1]] = m
    n, v = sum(map(len, streams)), len({w for s in streams for w in s})

    def p(ctx, w, states):
        while ctx and ctx not in states:
            ctx = ctx[1:]
        if not ctx:
            return (count.get((w,), 0) + 0.1) / (n + 0.1 * (v + 1))
        stored = following[ctx]
        left = 1 - sum(m - 0.5 for m in stored.values()) / count[ctx]
        return max(stored.get(w, 0) - 0.5, 0) / count[ctx] + left * p(ctx[1:], w, states)

    kept = {c for c, stored in following.items()
            if sum(m * math.log2(p(c, w, following) / p(c[1:], w, following)) for w, m in stored.items()) > 4 * len(stored)}
    kept |= {c[k:] for c in kept for k in range(1, len(c))}
    assert {len(c) for c in kept} == {1, 2, 3}
    for i, s in enumerate(streams):
        want = sum(math.log10(p(tuple(s[max(0, j - 3): j]), w, kept)) for j, w in enumerate(s))
        assert got[i] == pytest.approx(want, rel=1e-7)


def test_bitmap_grows_with_its_table_and_misses_nothing(spark):
    sizes = []
    for n in (0, 10, 30_000):
        keys = spark.range(n).selectExpr("xxhash64(id) AS key")
        bitmap = SL._bitmap(keys)
        sizes.append(len(bitmap))
        held = np.array([r.key for r in keys.collect()], np.int64).view(np.uint64)
        assert SL._maybe(bitmap, held).all()
        other = np.random.default_rng(0).integers(0, 1 << 63, 20_000, dtype=np.uint64)
        assert SL._maybe(bitmap, other).mean() < 0.03
    assert sizes[0] == sizes[1] < sizes[2] <= 1 << (SL.FILTER_BITS - 6)


def _exchanged(df):
    """(records, bytes before compression) that the exchanges of an executed plan wrote, sum over all."""
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.nodeName()
        if name == "Exchange":
            metrics = node.metrics()
            found.append((metrics.apply("shuffleRecordsWritten").value(), metrics.apply("dataSize").value()))
        inner = {"AdaptiveSparkPlan": "executedPlan", "ShuffleQueryStage": "plan", "BroadcastQueryStage": "plan", "ResultQueryStage": "plan"}.get(name)
        children = node.children()
        for child in [getattr(node, inner)()] if inner else [children.apply(i) for i in range(children.size())]:
            walk(child)

    walk(plan)
    return tuple(map(sum, zip(*found)))


def test_counted_grams_travel_in_few_bytes(spark):
    """Two keys and a count are 24 bytes a gram; words by rank are a third of that at most,
    whether or not all words have a rank the counts are right."""
    texts = [prose(k, 3000) for k in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    streams = [[*words(t, True), b" "] for t in texts]
    n = sum(map(len, streams))
    everything = np.full(1 << 10, ~np.uint64(0))
    vocabulary = SL._counted(docs, "text", lambda tokens, place: tokens).orderBy(F.desc("n")).toPandas().key.to_numpy().view(np.uint64)
    for k in (1, 2, 3):
        want = sorted(grams_of(streams, k + 1).values())
        for ranked in (vocabulary, vocabulary[:20], vocabulary[:0]):
            grams = SL._counted_grams(docs, "text", k, 1, everything, n, ranked)
            got = grams.collect()
            assert sorted(r.n for r in got) == want and len({r.key for r in got}) == len(got)
            if len(ranked) == len(vocabulary):
                assert _exchanged(grams)[1] < 8 * len(got)


def grams_of(streams, length):
    count = {}
    for s in streams:
        for i in range(len(s) - length + 1):
            gram = tuple(s[i: i + length])
            count[gram] = count.get(gram, 0) + 1
    return count


def test_asked_keys_travel_in_blocks(spark, monkeypatch):
    """No row per asked key crosses an exchange, and the cut into blocks changes no score."""
    texts = ["", *(prose(k, 200) for k in range(150))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).cache()
    shape = SL.Shape(least_edge=2, head_rows=0)
    tree, counts = SL.train(docs, shape=shape)
    whole = {r.doc_id: (r.score, r.base_score, r.n_known) for r in SL.score(docs, tree, counts, shape=shape).collect()}
    plans = []
    staged = SL.materialize
    monkeypatch.setattr(SL, "materialize", lambda df, name: plans.append(df) or staged(df, name))
    monkeypatch.setattr(SL, "ASKED_ROWS", 500)
    monkeypatch.setattr(SL, "HOME_ROWS", 7)
    plans.append(SL.score(docs, tree, counts, shape=shape))
    few = {r.doc_id: (r.score, r.base_score, r.n_known) for r in plans[-1].collect()}
    assert not any("explode" in df._jdf.queryExecution().toString() for df in plans)
    assert few == whole and len(whole) == len(texts)


def test_packed_columns_come_back():
    r = np.random.default_rng(5)
    part = np.sort(r.integers(0, 9, 1000))
    columns = [r.integers(0, 1 << 63, 1000, dtype=np.uint64), r.integers(0, 300, 1000).astype("<u4"), r.integers(-9, 9, 1000)]
    parts, rows, blobs = SL._packed(part, columns)
    assert rows.sum() == 1000
    for p, n, blob in zip(parts, rows, blobs):
        for x, y in zip(columns, SL._unpacked(blob, n, ["<u8", "<u4", "<i8"])):
            assert (x[part == p] == y).all()
    assert SL._packed(part[:0], [x[:0] for x in columns])[2] == []


def test_key_lookup_equals_a_set():
    r = np.random.default_rng(4)
    for n in (0, 1, 5, 5000):
        keys = np.sort(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        table, asked = SL.Keys(keys), np.concatenate([keys, r.integers(0, 1 << 63, 300, dtype=np.uint64)])
        place = {k: i for i, k in enumerate(keys.tolist())}
        assert SL.Keys(keys).find(asked).tolist() == [place.get(k, -1) for k in asked.tolist()] and len(table) == n


def test_a_broadcast_table_comes_without_its_index():
    keys = np.unique(np.random.default_rng(6).integers(0, 1 << 63, 5000, dtype=np.uint64))
    for some in (keys, keys[:0]):
        sent = pickle.dumps(SL.Keys(some))
        assert len(sent) < 8 * len(some) + 500
        assert pickle.loads(sent).find(keys).tolist() == SL.Keys(some).find(keys).tolist()


def test_lm_tree_travels_compressed(spark):
    """A broadcast tree is copied to the disk of every executor: it comes without what its order
    and its whole units already say, and comes back as it was."""
    rng = np.random.default_rng(5)
    keys = [SL.Keys(np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))) for n in (30_000, 20_000, 10_000, 0, 0)]
    value = [np.round(rng.normal(size=len(k)) * SL.UNITS) / SL.UNITS for k in keys]
    tree = SL.Tree(keys[0], np.log10(rng.random(len(keys[0]))), [SL.Level(keys[1], value[1], keys[2], value[2]), SL.Level(keys[3], value[3], keys[4], value[4])],
                   123, 45, (rng.random(1 << 14) < 0.3).astype(np.uint64))
    sent = pickle.dumps(tree)
    plain = 16 * sum(map(len, keys)) + tree.rest.nbytes
    assert len(sent) < 0.85 * plain
    got = pickle.loads(sent)
    assert (got.tokens, got.distinct) == (123, 45)
    pairs = [(got.root, tree.root), (got.rest, tree.rest), (got.words.keys, keys[0].keys)]
    for a, b in zip(got.levels, tree.levels, strict=True):
        pairs += [(a.states.keys, b.states.keys), (a.keep, b.keep), (a.edges.keys, b.edges.keys), (a.gain, b.gain)]
    for a, b in pairs:
        assert a.dtype == b.dtype and (a == b).all() and len(a) == len(b)


def test_lm_lets_go_of_its_broadcasts(spark, monkeypatch):
    """Each is a file on the driver and on every executor until it is destroyed."""
    made, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, x: made.append(broadcast(self, x)) or made[-1])
    docs = spark.createDataFrame([(i, prose(i % 9, 60)) for i in range(40)], "doc_id long, text string")
    shape = SL.Shape(least_edge=2, head_rows=10)
    tree, counts = SL.train(docs, shape=shape)
    rows = SL.score(docs, tree, counts, shape=shape)
    assert len(made) >= shape.depth + 2 and not any(b._jbroadcast.isValid() for b in made)
    assert rows.count() == 40 and all(math.isfinite(r.score) for r in rows.collect())


def test_lm_many_texts_ask_for_the_same_rare_keys(spark):
    """Keys that several texts of a block ask for, and a text several times, count for each."""
    same = " ".join(f"zig{i % 7} zag{i % 5} zug{i % 3}" for i in range(50))
    texts = [same, same + " " + same, "zig1 zag1 none", "none none zig1", "", same] * 8
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = []
    for shape in (SL.Shape(), SL.Shape(head_rows=0)):
        got.append({r.doc_id: r for r in SL.score(docs, *SL.train(docs, shape=shape), shape=shape).collect()})
    for i, a in got[0].items():
        b = got[1][i]
        assert (a.n_tokens, a.n_known) == (b.n_tokens, b.n_known)
        assert (b.base_score, b.score) == pytest.approx((a.base_score, a.score), rel=1e-8)
    assert len({(r.base_score, r.score) for i, r in got[1].items() if texts[i] == same}) == 1
