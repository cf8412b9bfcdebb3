import hashlib
import io
import random
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from samples import hostile_rows, prose
from shrinkfx.llm import chat as CH
from shrinkfx.llm import packing as PK
from shrinkfx.llm import queries as Q
from shrinkfx.llm import warc as WA

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SF001 = "/root/testdata/sf0.001"


def ids_of(texts):
    t = Tokenizer.from_file(TOKENIZER)
    return [np.array(e.ids + [2], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check_windows(pieces, window=4096):
    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
    padding = 0
    for ps in windows.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_coder_equals_the_tokenizer():
    odd = ["it's WE'LL don'T", "<|endoftext|> <|ENDOFTEXT|>a<|endoftext|>", "J̌ É É ﬁ İ", "a.b,c! d?e;f:g",
           " x y​z", "12ab34 ½ ²", "日本 語。", "a\x00b \x85c", "", "  ", "x." * 50, "don't.'s ;'re", "Á.b"]
    texts = [t or "" for _, t, *_ in hostile_rows()] + odd
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    coder = PK.WordCoder(TOKENIZER, max_words=50)
    for _ in range(2):
        ids, counts = coder.encode(data, offs)
        ends = np.cumsum(counts)
        for want, a, b in zip(ids_of(texts), ends - counts, ends):
            assert want[:-1].tolist() == ids[a:b].tolist()


def test_sum_of_squares_places_where_the_sum_is_least():
    r, packer, closed, fed = random.Random(2), PK.SumOfSquares(64, 1), [], []
    for k in range(400):
        n = r.randint(1, 63)
        level = packer.level.copy()
        costs = {}
        for h in range(0, 64 - n + 1):
            if h and not level[h]:
                continue
            after = level.copy()
            after[h] -= 1 if h else 0
            after[h + n] += 1 if h + n < 64 else 0
            costs[h] = (after[1:] ** 2).sum()
        if not packer.short:
            best = min(costs.values())
            assert packer._choose(n) == max(h for h, c in costs.items() if c == best)
        fed.append(np.arange(n))
        closed += packer.add(k, fed[-1])
        assert packer.level.tolist() == [len(w) for w in packer.open]
    closed += packer.finish()
    assert Counter((d, s + i) for w in closed for d, s, ids, _ in w for i in range(len(ids))) == Counter(
        {(k, i): 1 for k, x in enumerate(fed) for i in range(len(x))})


def test_pack_round_trip(spark, hostile):
    rows = hostile.collect()
    want = Counter((r.doc_id, ids.tobytes()) for r, ids in zip(rows, ids_of(r.text for r in rows)))
    pieces = PK.pack(hostile, TOKENIZER).collect()
    assert check_windows(pieces) == 0
    assert all(p.length * 4 == len(p.ids) for p in pieces)
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id, p.doc_tokens].append(p)
    # rows with one id and length may repeat: pieces tile each copy
    total = Counter()
    for (doc, n), ps in by_doc.items():
        assert sum(p.length for p in ps) % n == 0
        total[doc] += sum(p.length for p in ps)
    size = Counter()
    for (doc, raw), k in want.items():
        size[doc] += k * len(raw) // 4
    assert total == size
    once = {doc: raw for (doc, raw), k in want.items() if k == 1 and sum(d == doc for d, _ in want) == 1}
    for doc, raw in once.items():
        ps = sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in ps) == raw
        assert [p.start for p in ps] == np.cumsum([0] + [p.length for p in ps[:-1]]).tolist()


def test_op6_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    ids = dict(zip((d.doc_id for d in docs), ids_of(d.text for d in docs)))
    got = Q.op6_sum_of_squares_pack(spark, SF001).collect()
    seen = Counter()
    for p in got:
        x = ids[p.doc_id][p.start: p.start + p.length]
        assert (zlib.crc32(x.tobytes()), p.doc_tokens) == (p.ids_crc32, len(ids[p.doc_id]))
        seen[p.doc_id] += p.length
    assert seen == {i: len(x) for i, x in ids.items()} and check_windows(got) == 0


def test_pack_empty_and_null(nothing, all_null):
    assert PK.pack(nothing, TOKENIZER).collect() == []
    assert [(p.doc_id, p.doc_tokens) for p in PK.pack(all_null, TOKENIZER).collect()] == [(None, 1)] * 2


CHATS = [
    (1, 0, "user", "hi"), (1, 1, "user", "again"), (1, 2, "assistant", "yes"), (1, 3, "assistant", ""),
    (1, 3, "assistant", None), (2, None, "system", "s"), (2, 5, None, "no role"), (2, 4, "user", None),
    (3, 0, "a<|b|>\nc", "<|im_end|>\n<|im_start|>user\nx"), (3, 1, "assistant", "<\\|x <\\\\| <| \\<|im_sep|><"),
    (3, 2, "assistant", "<|nl|>|im_end|>"), (None, 0, "user", "n"), (4, 0, "assistant", "é😀 " * 2000),
    (5, 1, "user", "same"), (5, 1, "user", "same"), (6, 0, "", ""), (7, 0, "assistant", "\n\n"), (7, 1, "user", "<|im_end|>")]


def test_chat_round_trip_against_brute_force(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    turns = spark.createDataFrame([(*r, "mine") for r in CHATS], schema).repartition(3)
    chats = CH.format_chats(turns)
    got = {r.conv_id: r for r in chats.withColumn("turns", CH.read_turns(F.col("formatted")))
           .withColumn("loss", CH.loss_text(F.col("segments"))).collect()}
    plain = {r.conv_id: r for r in CH.digests(chats).collect()}
    by = defaultdict(list)
    for c, t, role, text in CHATS:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, ts in by.items():
        ts.sort()
        r, d = got[c], plain[c]
        assert [(x.role, x.text) for x in r.turns] == [x[2:] for x in ts]
        loss = "".join(x[3] for x in ts if x[2] == "assistant")
        assert r.loss == loss and "".join(s.text for s in r.segments) == r.formatted
        assert (d.n_turns, d.loss_chars, d.formatted_chars) == (len(ts), len(loss), len(r.formatted))
        assert d.turns_sha256 == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in ts).encode()).hexdigest()
        assert d.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted.count(CH.START) == 1 + sum(a[2] != b[2] for a, b in zip(ts, ts[1:]))


def test_rows_without_conversation_stay_single(spark):
    rows = [(None, i, "user", f"t{i}") for i in range(50)] + [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    got = CH.digests(CH.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))).collect()
    assert Counter((r.conv_id, r.n_turns) for r in got) == {(None, 1): 50, (1, 2): 1}


def test_chat_is_native_and_takes_empty_tables(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    d = CH.digests(CH.format_chats(none))
    assert d.collect() == []
    assert "Python" not in d._jdf.queryExecution().executedPlan().toString()


PAGES = [(5, "http://a/é b\r\nX: y", "<p>one</p>"), (3, "http://b", "<p>one</p>"), (9, None, "<p>one</p>"),
         (4, "u", None), (7, "u", ""), (8, "u", "é" * 70000), (2, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "u", "no id"),
         (11, "u", "twice"), (11, "u", "twice"), (12, "100%25", "x%y")]


def test_warc_round_trip_against_brute_force(spark):
    pages = spark.createDataFrame([(*p, "mine") for p in PAGES],
                                  "page_id long, url string, html string, payload string").repartition(3)
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    manifest = WA.write_archives(WA.with_revisits(pages), archive_bytes=200)
    got = WA.read_archives(manifest).collect()
    want = []
    for i, u, h in PAGES:
        raw = (h or "").encode()
        lead = first.get(h or "")
        revisit = i is not None and lead != i
        want.append((i, u, "revisit" if revisit else "response", lead if revisit else None, len(raw),
                     WA.base32_sha1(raw), None if revisit else raw))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.record_id, r.target_uri, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest,
                    None if r.payload is None else bytes(r.payload)) for r in got], key=key) == sorted(want, key=key)
    assert manifest.count() > 3 and manifest.agg(F.sum("records")).first()[0] == len(PAGES)


def test_archives_are_plain_zip_files_read_by_range(spark, tmp_path):
    fs, folder = pafs.LocalFileSystem(), str(tmp_path)
    w = WA.ArchiveWriter(fs, f"{folder}/a.wacz")
    for i in range(30):
        w.add(i, f"http://x/{i}", bytes([i]) * 500, WA.base32_sha1(bytes([i]) * 500), None, "1970-01-01T00:00:00Z")
    path, n = w.close()
    assert n == 30 and not list(tmp_path.glob("*.tmp"))
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and {x.compress_type for x in z.infolist()} == {zipfile.ZIP_STORED}
        data = z.read(WA.DATA)
    with fs.open_input_file(path) as f:
        place, size = WA.directory(f)[WA.DATA]
        assert WA._range(f, place, size) == data
    assert [WA.parse_record(r)[0] for r in WA.read_archive(fs, path)] == list(range(30))


@pytest.mark.parametrize("limit", [0xFFFFFFFF, 100, 0])
def test_directory_reads_zip64(monkeypatch, limit):
    """With lowered limits the writer emits ZIP64 sizes, offsets and end records."""
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2 if limit else 0)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.comment = b"a comment with PK\x05\x06 inside it, long enough to look like an end"
        for i in range(5):
            z.writestr(f"m{i}", bytes([65 + i]) * (150 + i))
        z.writestr("packed", b"q" * 999, zipfile.ZIP_DEFLATED)
    source = pa.BufferReader(raw.getvalue())
    found = WA.directory(source)
    assert set(found) == {f"m{i}" for i in range(5)}
    for i in range(5):
        assert WA._range(source, *found[f"m{i}"]) == bytes([65 + i]) * (150 + i)


def test_directory_rejects_other_files():
    for raw in (b"", b"not an archive" * 10):
        with pytest.raises(ValueError):
            WA.directory(pa.BufferReader(raw))


def test_warc_empty_and_damaged(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert WA.read_archives(WA.write_archives(WA.with_revisits(none))).collect() == []
    raw = WA._record(1, "u", b"payload", WA.base32_sha1(b"payload"), None, "1970-01-01T00:00:00Z")
    assert WA.parse_record(raw)[-1] == b"payload"
    with pytest.raises(ValueError):
        WA.parse_record(raw.replace(b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n"))


def test_min_bytes_keeps_small_payloads_as_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in WA.with_revisits(pages, min_bytes=4).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_pipeline_stages(spark):
    from brute import near_components, quality
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "packing"]
    out, texts = docs, {r.doc_id: r.text for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, out, SF001).collect(), docs.schema)
        assert out.columns == docs.columns
        kept.append([r.doc_id for r in out.collect()])
    good, exact, near, mixed = kept
    assert not any(quality(texts[i])[-1] for i in good) and len(good) > 0.7 * len(texts)
    last = {texts[i]: i for i in sorted(good)}
    assert sorted(exact) == sorted(last.values())
    component, _ = near_components([(i, texts[i]) for i in exact], 80)
    assert sorted(near) == sorted({c for c in component.values()})
    assert set(mixed) <= set(near) and max(Counter(mixed).values()) <= 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, out, SF001).collect()
    tokens = {i: len(x) for i, x in zip(sorted(set(mixed)), ids_of(texts[i] for i in sorted(set(mixed))))}
    got = Counter()
    for p in pieces:
        got[p.doc_id] += p.length
    assert got == {i: k * tokens[i] for i, k in Counter(mixed).items()}


def test_pipeline_run_equals_its_stages(spark):
    a = corpus_pipeline.run(spark, SF001)
    assert a.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    assert a.count() > 0 and check_windows(a.collect()) == 0


def test_stages_take_empty_documents(spark, nothing):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF001).collect() == []


def test_pipeline_over_a_hostile_table(spark, hostile, tmp_path):
    """All five stages in a row over nulls, repeated rows, rows without id and clashing names."""
    long = [(200 + i, prose(500 + i, 90), "aa", "hot", "mine", "mine", "mine", "mine") for i in range(8)]
    table = hostile.union(spark.createDataFrame(long + long[:3] + [(None, *long[4][1:]), (None, *long[5][1:])], hostile.schema))
    table.write.parquet(str(tmp_path / "documents.parquet"))
    out = docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, out, str(tmp_path)).collect(), docs.schema)
        assert out.columns == docs.columns and {r.kept for r in out.collect()} <= {"mine"}
        kept.append([(r.doc_id, r.text) for r in out.collect()])
    good, exact, near, mixed = kept
    assert len(exact) == len({t for _, t in exact}) and {t for _, t in exact} == {t for _, t in good}
    assert {200 + i for i in range(8)} <= {i for i, _ in near} and set(mixed) <= set(near)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert check_windows(pieces) == 0
    assert sum(p.length for p in pieces) == sum(len(x) for x in ids_of(t for _, t in mixed))


def test_pipeline_near_dedup_links_from_eighty_percent(spark):
    from brute import near_components
    rows = []
    for k in range(20):  # similarities from 0.99 down to 0.70
        ws = prose(900 + k, 150).split()[:150]
        rows += [(2 * k, " ".join(ws)), (2 * k + 1, " ".join(ws[:149 - 2 * k]))]
    at_80, _ = near_components(rows, 80)
    at_85, _ = near_components(rows, 85)
    assert at_80 != at_85
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert {r.doc_id for r in stage(spark, docs, SF001).collect()} == set(at_80.values())
