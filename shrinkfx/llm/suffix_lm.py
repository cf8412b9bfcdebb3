"""Language-model scoring with a probabilistic suffix tree over words.

A state is a context of up to ``depth`` words. Next words seen ``least_edge`` times after
a context are stored with absolute discounting; the mass taken off goes to the suffix's
distribution, down to smoothed word counts at the root. A context is retained if its
next-word distribution diverges enough from that of its suffix (count times
Kullback-Leibler divergence, in bits, against a price per stored next word), or if a
longer retained context needs it. A text is scored by the longest retained state at each
word.

Counts cover all training documents; a gram's least count (``least_edge``) is the same at
every corpus size, so the tree grows with the input. Its tables are Spark tables. As retained states
and stored grams are closed under suffixes, a text's score is the sum of one number per
gram in it: the log of the mass a state leaves, and what a stored gram adds to its
suffix's log probability. The most frequent states and next words of each length and
the most frequent words (``head_rows`` of each at most) are broadcast; all others are
joined by key. That decides only which way a gram is looked up. A bitmap, sized by its
table up to 2**FILTER_BITS bits, tells which keys need not be asked for; it may only err by
asking in vain.

Grams are counted in blocks: a task sums what it has met and hands on one row per range of
hashes, which the range's task adds up. A range holds about ``RANGE_ROWS`` grams of all tasks
together. A gram travels as the ranks of its words among the broadcast ones (a rarer word as
its hash), ordered and compressed, in about a third of the bytes of its keys; the range's task
makes the keys. What texts ask of the table travels in such blocks too, each key once a block, and
so do the answers; there a range stands for ``ANSWER_ROWS`` words, as a text gets an answer from
each range that it asks. The broadcast tables are compressed like blocks.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shrinkfx.llm import textkit as K
from shrinkfx.llm.frames import arrow_map
from shrinkfx.session import materialize, stage

END = np.uint64(0xE4D0F7EC575EED01)
MERGE_WORDS = 2_000_000
RANGE_ROWS = 1_000_000
ANSWER_ROWS = 8_000_000  # a range of the table that texts ask, in words read
FILTER_BITS = 28
ASKED_ROWS = 1_000_000  # keys that a block of texts asks for
HOME_ROWS = 1 << 16  # texts of a block
UNITS = 1e10  # sums of logs are taken in whole units: equal rows get equal scores


@dataclass(frozen=True)
class Shape:
    depth: int = 3
    head_rows: int = 1 << 19  # about 9 MB a table
    discount: float = 0.5
    bits_per_edge: float = 4.0
    least_edge: int = 5
    add: float = 0.1


@dataclass
class Level:
    """Frequent states of one length and frequent grams one word longer."""

    states: Keys
    keep: np.ndarray  # log10 of the mass left to the suffix
    edges: Keys
    gain: np.ndarray  # log10 of what the gram's probability is above the mass times its suffix's

    def __reduce__(self):
        # whole units, so they are the same numbers afterwards
        return _level, (self.states, _blob(np.round(self.keep * UNITS).astype("<i8")), self.edges, _blob(np.round(self.gain * UNITS).astype("<i8")))


def _level(states: Keys, keep: bytes, edges: Keys, gain: bytes) -> Level:
    (keep,), (gain,) = _unpacked(keep, len(states), ["<i8"]), _unpacked(gain, len(edges), ["<i8"])
    return Level(states, keep / UNITS, edges, gain / UNITS)


@dataclass
class Tree:
    words: Keys  # the frequent words
    root: np.ndarray  # log10 of their smoothed probabilities
    levels: list[Level]
    tokens: int
    distinct: int
    rest: np.ndarray  # bitmap of the keys that are in the table alone

    def __reduce__(self):
        return _tree, (self.words, _blob(self.root), self.levels, self.tokens, self.distinct, len(self.rest), _blob(self.rest))


def _tree(words: Keys, root: bytes, levels: list[Level], tokens: int, distinct: int, size: int, rest: bytes) -> Tree:
    (root,), (rest,) = _unpacked(root, len(words), ["<f8"]), _unpacked(rest, size, ["<u8"])
    return Tree(words, root, levels, tokens, distinct, rest)


def token_stream(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes, tokens per row, place in its row) with an end after each row."""
    low = K.lower_ascii(data)
    starts, ends, per_row = K.words(low, offs)
    counts = per_row + 1
    out = np.full(int(counts.sum()), END)
    stop = np.cumsum(counts) - 1
    is_word = np.ones(len(out), bool)
    is_word[stop] = False
    out[is_word] = K.span_hash(K.prefix_hash(low), starts, ends)
    begin = stop - per_row
    return out, counts, np.arange(len(out)) - np.repeat(begin, counts)


class Keys:
    """A sorted table of hashes. The high bits of a hash lead to the first place where it can
    be, most often the only one, so a look-up costs a few reads instead of a binary search."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, min(24, len(keys).bit_length()))
        tops = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.begin = np.searchsorted(keys, tops).astype(np.int32)
        self.ended = np.append(keys, ~np.uint64(0))  # a search stops at the end at the latest

    def __reduce__(self):
        return _keys, (len(self), _blob(_steps(self.keys)))  # a broadcast table comes without its index

    @property
    def keys(self) -> np.ndarray:
        return self.ended[:-1]

    def __len__(self) -> int:
        return len(self.ended) - 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in the table, or -1."""
        at = self.begin[(keys >> np.uint64(64 - self.bits)).view(np.int64)].astype(np.int64)
        here = self.ended[at]
        missed, live = here != keys, np.flatnonzero(here < keys)
        place, asked = at[live], keys[live]
        while len(live):
            place += 1
            here = self.ended[place]
            hit, on = here == asked, here < asked
            at[live[hit]] = place[hit]
            missed[live[hit]] = False
            live, place, asked = live[on], place[on], asked[on]
        at[missed | (at == len(self))] = -1
        return at


def _keys(rows: int, blob: bytes) -> Keys:
    (steps,) = _unpacked(blob, rows, ["<u8"])
    return Keys(np.cumsum(steps, dtype=np.uint64))


def _pair(ctx: np.ndarray, sub: np.ndarray) -> np.ndarray:
    """Key of the gram whose words but the last have key ``ctx``, and but the first ``sub``."""
    return K.mix(ctx * np.uint64(0x9FB21C651E98DF25) + K.mix(sub ^ np.uint64(0x2545F4914F6CDD1D)))


def _grams(tokens: np.ndarray, place: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``longest`` words: (places at which a gram ends, key of the gram that ends at
    each place; zero where none does)."""
    key = tokens
    yield np.arange(len(tokens)), key
    for k in range(1, longest):
        at = np.flatnonzero(place >= k)
        longer = np.zeros(len(tokens), np.uint64)
        longer[at] = _pair(key[at - 1], key[at])
        key = longer
        yield at, key


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bitmap of a table's keys: about 16 bits a key, 2**FILTER_BITS at most. The high end of a
    key leads to a word of 64 bits, its low end to two bits there, so about one other key in
    sixty looks held."""
    bits = min(FILTER_BITS, max(16, (16 * keys.count()).bit_length()))
    got = (keys.select(F.expr(f"shiftrightunsigned(key, {70 - bits})").alias("at"),
                       F.expr("shiftleft(1L, cast(key & 63 as int)) | shiftleft(1L, cast(shiftright(key, 6) & 63 as int))").alias("bit"))
           .groupBy("at").agg(F.bit_or("bit").alias("bits"))).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[np.asarray(got.column("at").combine_chunks())] = np.asarray(got.column("bits").combine_chunks()).view(np.uint64)
    return out


def _maybe(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key can be in the bitmap's table."""
    word = bitmap[(keys >> np.uint64(65 - len(bitmap).bit_length())).astype(np.int64)]
    return ((word >> (keys & np.uint64(63))) & (word >> ((keys >> np.uint64(6)) & np.uint64(63))) & np.uint64(1)).astype(bool)


_ZSTD = pa.Codec("zstd", compression_level=1)


def _ranges(tokens: int, each: int) -> int:
    """Into how many ranges the hashes of what ``tokens`` words hold are cut."""
    return 1 << max(4, (tokens // each).bit_length())


def _first(values: np.ndarray) -> np.ndarray:
    """Places at which a run of equal values begins."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def _steps(values: np.ndarray, first: np.ndarray | int = 0) -> np.ndarray:
    """What ascending values add to the one before; at the places ``first`` the values themselves."""
    out = values.copy()
    out[1:] -= values[:-1]
    if len(out):
        out[first] = values[first]
    return out


def _planes(columns: list[np.ndarray]) -> np.ndarray:
    """The first bytes of a column's values stand together, then the second ones and so on."""
    return np.concatenate([np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T for x in columns])


def _blob(column: np.ndarray) -> bytes:
    return _ZSTD.compress(_planes([column]).tobytes(), asbytes=True)


def _packed(part: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(parts, rows, blobs) of columns whose rows are ordered by part."""
    first = _first(part)
    ends = np.append(first[1:], len(part))
    planes = _planes(columns)
    return part[first], ends - first, [_ZSTD.compress(planes[:, i:j].tobytes(), asbytes=True) for i, j in zip(first, ends)]


def _unpacked(blob: bytes, rows: int, types: list[str]) -> list[np.ndarray]:
    """The columns of a blob."""
    if not rows:
        return [np.zeros(0, t) for t in types]
    sizes = [np.dtype(t).itemsize for t in types]
    planes = np.frombuffer(_ZSTD.decompress(blob, rows * sum(sizes)), np.uint8).reshape(sum(sizes), rows)
    ends = np.cumsum(sizes)
    return [np.ascontiguousarray(planes[e - w: e].T).view(t).ravel() for t, w, e in zip(types, sizes, ends)]


class _Summer:
    """Counts of 64-bit keys, folded whenever enough have gathered."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> None:
        k, c = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.counts.append(c)
        self.size += len(k)

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys, self.counts, self.size = [], [], 0
        return keys[first], np.add.reduceat(counts, first)


def _counted(docs: DataFrame, text_col: str, keys_of) -> DataFrame:
    """(key, n): how often ``keys_of(tokens, place)`` yields each key over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Summer()

        def rows() -> Iterator[pa.RecordBatch]:
            keys, counts = total.fold()
            for i in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i: i + (1 << 16)].view(np.int64)),
                                                  pa.array(counts[i: i + (1 << 16)])], names=["key", "n"])

        for batch in batches:
            for part in K.slices(batch, "text"):
                tokens, _, place = token_stream(*K.flat(part.column("text")))
                total.add(keys_of(tokens, place))
                if total.size > MERGE_WORDS:
                    yield from rows()
        yield from rows()

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return arrow_map(texts, run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _counted_grams(docs: DataFrame, text_col: str, k: int, least: int, shorter: np.ndarray, tokens: int, ranked: np.ndarray,
                   sent: list[Broadcast] | None = None) -> DataFrame:
    """(ctx, sub, key, n) of the grams of ``k`` + 1 words seen ``least`` times in ``tokens``
    words. ``shorter`` is the bitmap of the grams of ``k`` words seen so often: no other can
    be inside one. ``ranked`` are the words that travel as their place in it plus one. What is
    broadcast is added to ``sent``."""
    spark = docs.sparkSession
    known, by_rank = spark.sparkContext.broadcast(shorter), spark.sparkContext.broadcast(ranked)
    if sent is not None:
        sent += known, by_rank
    ranges, types = _ranges(tokens, RANGE_ROWS), ["<u4"] * (k + 2)
    bits = ranges.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = by_rank.value
        order = np.argsort(words)
        table, rank = Keys(words[order]), (order + 1).astype(np.uint32)
        held: list[tuple[np.ndarray, ...]] = []
        others: list[np.ndarray] = []  # hashes of words without a rank: their numbers follow the last rank
        size = n_others = 0

        def rows() -> pa.RecordBatch:
            key, *ids = (np.concatenate(x) for x in zip(*held))
            by_key = np.argsort(key)
            key = key[by_key]
            first = _first(key)
            n, at = np.diff(np.append(first, len(key))).astype(np.uint32), by_key[first]
            part, ids = (key[first] >> np.uint64(64 - bits)), [x[at] for x in ids]
            # by range, in it by the first words: runs of equal numbers
            order = part << np.uint64(64 - bits)
            for j, x in enumerate(ids[:2], 1):
                order |= np.minimum(x, (1 << 20) - 1).astype(np.uint64) << np.uint64(64 - bits - 20 * j)
            order = np.argsort(order)
            part, n, ids = part[order], n[order], [x[order] for x in ids]
            other = np.concatenate([np.zeros(0, np.uint64), *others])
            some = np.flatnonzero(np.logical_or.reduce([x > len(words) for x in ids]))
            parts, counts, blobs = _packed(part, [np.where(x > len(words), 0, x).astype("<u4") for x in ids] + [n.astype("<u4")])
            rare = {}
            for r in np.unique(part[some]):
                here = some[part[some] == r]
                rare[int(r)] = b"".join(other[x[here][x[here] > len(words)].astype(np.int64) - len(words) - 1].astype("<u8").tobytes() for x in ids)
            return pa.RecordBatch.from_arrays([
                pa.array(parts.astype(np.int64)), pa.array(counts), pa.array(blobs, pa.binary()),
                pa.array([rare.get(r, b"") for r in parts.tolist()], pa.binary())], names=["part", "rows", "ids", "other"])

        for batch in batches:
            for piece in K.slices(batch, "text"):
                tokens, _, place = token_stream(*K.flat(piece.column("text")))
                *_, (at, key) = _grams(tokens, place, k)
                there = _maybe(known.value, key)
                at = np.flatnonzero(place >= k)
                at = at[there[at] & there[at - 1]]
                if not len(at):
                    continue
                inside = np.zeros(len(tokens), bool)
                for j in range(k + 1):
                    inside[at - j] = True
                inside = np.flatnonzero(inside)
                number = table.find(tokens[inside])
                ids, lone = np.zeros(len(tokens), np.uint32), number < 0
                ids[inside[~lone]] = rank[number[~lone]]
                ids[inside[lone]] = np.arange(n_others, n_others + lone.sum()) + len(words) + 1
                others.append(tokens[inside[lone]])
                n_others += int(lone.sum())
                held.append((_pair(key[at - 1], key[at]), *(ids[at - j] for j in range(k, -1, -1))))
                size += len(at)
                if size > MERGE_WORDS:
                    yield rows()
                    held, others, size, n_others = [], [], 0, 0
        if held:
            yield rows()

    def keyed(rows: int, blob: bytes, other: bytes) -> tuple[np.ndarray, ...]:
        """(key, ctx, sub, n) of a blob's grams."""
        words, (*ids, n) = by_rank.value, _unpacked(blob, rows, types)
        rare, at, keys = np.frombuffer(other, "<u8"), 0, []
        for x in ids:
            key, lone = np.zeros(rows, np.uint64), np.flatnonzero(x == 0)
            key[x > 0] = words[x[x > 0].astype(np.int64) - 1]
            key[lone] = rare[at: at + len(lone)]
            at += len(lone)
            keys.append(key)
        while len(keys) > 2:
            keys = [_pair(x, y) for x, y in zip(keys, keys[1:])]
        return _pair(*keys), *keys, n.astype(np.int64)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a partition holds a few ranges; what one task sent of a range is already summed
        held: dict[int, list] = {}
        for batch in batches:
            for r, *packed in zip(*(batch.column(c).to_pylist() for c in ("part", "rows", "ids", "other"))):
                held.setdefault(r, []).append(packed)
        for r in sorted(held):
            key, ctx, sub, n = (np.concatenate(x) for x in zip(*(keyed(*x) for x in held.pop(r))))
            order = np.argsort(key)
            first = np.flatnonzero(np.append(True, key[order[1:]] != key[order[:-1]]))
            n = np.add.reduceat(n[order], first)
            at = order[first[n >= least]]
            columns = [*(x[at].view(np.int64) for x in (ctx, sub, key)), n[n >= least]]
            for i in range(0, len(at), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[i: i + (1 << 16)]) for x in columns], names=["ctx", "sub", "key", "n"])

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    packed = arrow_map(texts, run, "part long, rows long, ids binary, other binary").repartition(ranges, "part")
    return arrow_map(packed, merged, "ctx long, sub long, key long, n long")


def _often(table: DataFrame, rows: int) -> Column:
    """The condition on ``n`` that the most frequent rows of ``table`` meet, ``rows`` at most:
    counts are grouped in steps of an eighth of a doubling, so a few hundred rows come back."""
    step = F.floor(F.log2("n") * 8)
    left, least = rows, 1 << 20
    for r in table.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("step")).collect():
        left -= r.c
        if left < 0:
            break
        least = r.step
    return step >= least


def _collect(table: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, values) of a table whose size ``head_rows`` bounds."""
    got = table.select("key", value).toArrow()
    keys, n = np.asarray(got.column("key").combine_chunks()).view(np.uint64), np.asarray(got.column(value).combine_chunks())
    order = np.argsort(keys)
    return keys[order], n[order].astype(np.float64)


def _release(spark: SparkSession, *folders: str) -> None:
    """Let go of the shuffle files of finished steps, and of stage tables that are read no more."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def train(docs: DataFrame, text_col: str = "text", shape: Shape = Shape()) -> tuple[Tree, DataFrame]:
    """The tree's frequent part and the table (key, n, value) of all word counts and of the
    log10 that each gram outside that part adds, in units. No rows: an empty tree."""
    spark = docs.sparkSession
    words_n = materialize(_counted(docs, text_col, lambda tokens, place: tokens), "lm-words")
    total = words_n.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(total["n"] or 0), int(total["v"])
    words, c = _collect(words_n.where(_often(words_n, shape.head_rows)), "n")
    ranked = words[np.argsort(-c, kind="stable")]
    mass = n + shape.add * (v + 1)
    least = max(shape.least_edge, 1)
    below = words_n.where(F.col("n") >= least).select(
        "key", "n", ((F.col("n") + shape.add) / mass).alias("p"), F.lit(None).cast("long").alias("sub"))
    found: list[tuple[DataFrame, DataFrame]] = []
    done: list[str] = []
    for k in range(1, shape.depth + 1):
        sent: list[Broadcast] = []
        grams, folder = stage(_counted_grams(docs, text_col, k, least, _bitmap(below), n, ranked, sent), f"lm-grams-{k}")
        for b in sent:
            b.destroy()  # the driver's file else stays until the session ends
        _release(spark)
        contexts = grams.groupBy("ctx").agg(F.sum(F.greatest(F.col("n") - shape.discount, F.lit(0.0))).alias("stored")).join(
            below.select(F.col("key").alias("ctx"), F.col("n").alias("size"), F.col("sub").alias("suffix")), "ctx").select(
            "ctx", "size", "suffix", F.greatest(1 - F.col("stored") / F.col("size"), F.lit(1e-12)).alias("left"))
        contexts, at = stage(contexts, f"lm-contexts-{k}")
        done.append(at)
        share = F.greatest(F.col("n") - shape.discount, F.lit(0.0)) / F.col("size")
        # a gram's suffix is seen at least as often, so both joins find their row
        edges = (grams.join(contexts.select("ctx", "size", "left"), "ctx")
                 .join(below.select(F.col("key").alias("sub"), F.col("p").alias("below")), "sub")
                 .withColumn("p", share + F.col("left") * F.col("below")))
        edges, at = stage(edges.select(
            "key", "ctx", "sub", "n", "p", F.round(F.log10(F.col("p") / (F.col("left") * F.col("below"))) * UNITS).cast("long").alias("value"),
            F.round(F.col("n") * F.log2(F.col("p") / F.col("below")) * 1e4).cast("long").alias("bits")), f"lm-edges-{k}")
        done.append(at)
        _release(spark, folder)
        worth = edges.groupBy("ctx").agg((F.sum("bits") > F.count(F.lit(1)) * shape.bits_per_edge * 1e4).alias("worth"))
        found.append((contexts.join(worth, "ctx"), edges))
        below = edges.select("key", "n", "p", "sub")
    levels, rest = _parts(found, shape, done)
    table = words_n.select("key", "n", F.lit(None).cast("long").alias("value"))
    bitmap = np.zeros(1 << 10, np.uint64)
    if rest is not None:
        rest = materialize(rest, "lm-rest")
        del found, below, contexts, edges, grams, worth
        _release(spark, *done)
        bitmap = _bitmap(rest)
        table = table.union(rest.select("key", F.lit(None).cast("long"), "value"))
    return Tree(Keys(words), np.log10((c + shape.add) / mass), levels, n, v, bitmap), table


def _parts(found: list[tuple[DataFrame, DataFrame]], shape: Shape, done: list[str]) -> tuple[list[Level], DataFrame | None]:
    """The frequent part of each length, and (key, value) of all other grams. Only states
    that pass the divergence test or are a suffix of one that does, and their grams. The
    folders of the tables written are added to ``done``."""
    levels, rest, needed = [], None, None
    for k in range(len(found), 0, -1):
        states, edges = found[k - 1]
        kept = states.where("worth").select("ctx")
        kept, at = stage(states.join((kept if needed is None else kept.union(needed)).distinct(), "ctx", "left_semi"), f"lm-kept-{k}")
        done.append(at)
        needed = kept.select(F.col("suffix").alias("ctx"))
        state_rows = kept.select(F.col("ctx").alias("key"), F.col("size").alias("n"), F.round(F.log10("left") * UNITS).cast("long").alias("value"))
        edge_rows = edges.join(kept.select("ctx"), "ctx", "left_semi").select("key", "n", "value")
        split = [(rows, _often(rows, shape.head_rows)) for rows in (state_rows, edge_rows)]
        (state, keep), (edge, gain) = (_collect(rows.where(often), "value") for rows, often in split)
        levels.append(Level(Keys(state), keep / UNITS, Keys(edge), gain / UNITS))
        _release(states.sparkSession)
        for rows, often in split:
            rows = rows.where(~often).select("key", "value")
            rest = rows if rest is None else rest.union(rows)
    return levels[::-1], None if rest is None else rest.groupBy("key").agg(F.sum("value").alias("value"))


def _scores(tree: Tree, tokens: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(word number or -1, log10 root probability, log10 model probability, asked) of each
    token by the frequent part of the tree; for a rare word the root is left out of both.
    ``asked`` has, per length, the places and keys of the grams that the table may hold.

    States and stored grams are closed under suffixes, and a stored gram's context is a
    state: where a shorter one is in neither part, no longer one is looked up."""
    number = tree.words.find(tokens)
    root = np.where(number >= 0, tree.root[number], 0.0) if len(tree.root) else np.zeros(len(tokens))
    model, asked, n = root.copy(), [], len(tree.levels)
    edge = np.ones(len(tokens), bool)   # may the gram that ends here be stored
    state = np.ones(len(tokens), bool)  # may it be a state
    for k, (_, key) in enumerate(_grams(tokens, place, n + 1)):
        if k:
            # one word longer: its context is a state, its suffix is stored
            next_edge = np.zeros(len(tokens), bool)
            next_edge[1:] = state[:-1] & edge[1:] & (place[1:] >= k)
            edge, state = next_edge, state & (place >= k)
        look = np.flatnonzero(edge | state) if k else np.arange(len(tokens))
        maybe = _maybe(tree.rest, key[look])
        asked.append((look[maybe], key[look[maybe]]))
        there = np.zeros(len(tokens), bool)
        there[look] = maybe
        if k:
            at = np.flatnonzero(edge)
            hit = tree.levels[k - 1].edges.find(key[at])
            model[at[hit >= 0]] += tree.levels[k - 1].gain[hit[hit >= 0]]
            edge[at] = (hit >= 0) | there[at]
        if k < n:
            at = np.flatnonzero(state)
            hit = tree.levels[k].states.find(key[at])
            # what a state leaves counts for the word after it, which every state has
            after = at[hit >= 0] + 1
            inside = after < len(tokens)
            inside[inside] = place[after[inside]] > 0
            model[after[inside]] += tree.levels[k].keep[hit[hit >= 0]][inside]
            state[at] = (hit >= 0) | there[at]
    return number, root, model, asked


def score(docs: DataFrame, tree: Tree, counts: DataFrame, text_col: str = "text", shape: Shape = Shape()) -> DataFrame:
    """``docs`` (without its text) with ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``.

    Null text is empty: one end token. Whole texts are scored whatever their length; equal
    rows get equal scores. Under a tree without training tokens every word has the
    smoothing mass alone. Input columns of the added names are replaced. ``docs`` is read
    once, from a table: a task that is run again must meet its rows in the same order.

    A block of texts (its home) sends the keys it asks for to their ranges; each range looks
    them up in its part of the table and sends the home one sum per text."""
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    carried = [c for c in docs.columns if c != text_col and c.lower() not in added]
    rows = docs.select(*[F.col(f"`{c}`") for c in carried], F.coalesce(F.col(text_col), F.lit("")).alias("_lm_text"))
    shared = docs.sparkSession.sparkContext.broadcast(tree)
    ranges, tokens_known = _ranges(tree.tokens, ANSWER_ROWS), tree.tokens
    bits = np.uint64(65 - ranges.bit_length())
    mass = float(tree.tokens + shape.add * (tree.distinct + 1))
    sums = ("_lm_tokens", "_lm_known", "_lm_base", "_lm_score")
    packs = {"_lm_part": pa.int64(), "_lm_home": pa.int64(), "_lm_rows": pa.int64(), "_lm_blob": pa.binary(), "_lm_who": pa.binary()}
    n_own = len(carried) + len(sums)

    def pack_rows(fields: list[pa.Field], *packed) -> pa.RecordBatch:
        """A batch of packed rows, with nulls in the texts' own ``fields`` and where nothing is given."""
        given = [pa.array(x, kind) for x, kind in zip(packed, packs.values())]
        given += [pa.nulls(len(packed[0]), kind) for kind in [*packs.values()][len(given):]]
        return pa.RecordBatch.from_arrays([pa.nulls(len(packed[0]), f.type) for f in fields] + given, names=[*(f.name for f in fields), *packs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, size, n_rows = shared.value, 0, 0
        held: list[tuple[np.ndarray, ...]] = []  # row, times (0: a gram, else how often the text has the word), key
        home = TaskContext.get().partitionId() << 32
        fields: list[pa.Field] = []

        def asks() -> pa.RecordBatch:
            row, times, key = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(key)
            row, times, key = row[order], times[order], key[order]
            part, first = key >> bits, _first(key)  # each key once, with how many ask for it; then who asks
            _, _, who = _packed(part, [row, times])
            key, some, part = key[first], np.diff(np.append(first, len(key))).astype("<u4"), part[first]
            parts, counts_, blobs = _packed(part, [_steps(key, _first(part)), some])
            return pack_rows(fields, parts.astype(np.int64), np.full(len(parts), home), counts_, blobs, who)

        for batch in batches:
            for piece in K.slices(batch, "_lm_text"):
                tokens, per_row, place = token_stream(*K.flat(piece.column("_lm_text")))
                number, base, model, asked = _scores(t, tokens, place)
                row, n = K.row_of(per_row), len(per_row)
                at, keys = (np.concatenate(x) for x in zip(*asked))
                order = np.argsort(row[at], kind="stable")
                held.append((row[at][order].astype("<u4") + np.uint32(n_rows), np.zeros(len(at), "<u4"), keys[order].astype("<u8")))
                rare = np.flatnonzero(number < 0)
                # one entry per row and rare word: sorted by row, then hash
                order = np.lexsort((tokens[rare], row[rare]))
                r, h = row[rare][order], tokens[rare][order]
                new = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (h[1:] != h[:-1]))) if len(r) else np.zeros(0, np.int64)
                held.append((r[new].astype("<u4") + np.uint32(n_rows), np.diff(np.append(new, len(r))).astype("<u4"), h[new].astype("<u8")))
                size += len(at) + len(new)
                own = [piece.column(c) for c in carried] + [
                    pa.array(per_row), pa.array(np.bincount(row[number >= 0], minlength=n)),
                    pa.array(np.bincount(row, base, minlength=n)), pa.array(np.bincount(row, model, minlength=n))]
                fields = [pa.field(c, x.type) for c, x in zip((*carried, *sums), own)]
                # a text's own row goes anywhere; its number in its home stands in for the rows
                yield pa.RecordBatch.from_arrays(
                    own + [pa.array(np.full(n, home % 1000003 % ranges)), pa.array(np.full(n, home)),
                           pa.array(np.arange(n_rows, n_rows + n)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=[*carried, *sums, *packs])
                n_rows += n
                if size > ASKED_ROWS or n_rows >= HOME_ROWS:
                    if size:
                        yield asks()
                    held, size, n_rows, home = [], 0, 0, home + 1
        if size:
            yield asks()

    def table_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            key, n, value = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(key)
            key = key[order]
            part = key >> bits
            parts, counts_, blobs = _packed(part, [_steps(key, _first(part)), n[order], value[order]])
            return pack_rows([], parts.astype(np.int64), np.full(len(parts), -1), counts_, blobs)

        for batch in batches:
            key, n, value = (np.array(batch.column(c)) for c in ("key", "n", "value"))
            held.append((key.view("<u8"), n, value))
            size += batch.num_rows
            if size > MERGE_WORDS:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, list] = {}
        asks: dict[int, list] = {}
        fields: list[pa.Field] = []
        for batch in batches:
            fields = [batch.schema.field(i) for i in range(n_own)]
            texts = batch.filter(batch.column("_lm_blob").is_null())
            if texts.num_rows:
                yield texts
            packed = batch.filter(batch.column("_lm_blob").is_valid())
            for r, home, n, blob, who in zip(*(packed.column(c).to_pylist() for c in packs)):
                if home < 0:
                    step, *others = _unpacked(blob, n, ["<u8", "<i8", "<i8"])
                    tables.setdefault(r, []).append((np.cumsum(step, dtype=np.uint64), *others))
                else:
                    asks.setdefault(r, []).append((home, n, blob, who))
        for r in sorted(asks):
            none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
            key, count, value = (np.concatenate(x) for x in zip(none, *tables.pop(r, [])))
            order = np.argsort(key)
            key, count, value = key[order], count[order], value[order]
            words, grams, count, value = key[count > 0], key[count == 0], count[count > 0], value[count == 0]
            homes, counts_, blobs = [], [], []
            for home, n, blob, who in asks.pop(r):
                step, some = _unpacked(blob, n, ["<u8", "<u4"])
                row, times = _unpacked(who, int(some.sum()), ["<u4", "<u4"])
                key = np.cumsum(step, dtype=np.uint64)
                seen = _at(words, count, key)
                root = np.repeat(np.round(np.log10((seen + shape.add) / mass) * UNITS), some)
                rest = np.where(times > 0, times * root, 0).astype("<i8")
                more = np.where(np.repeat(seen > 0, some), times, 0)
                gain = np.where(times == 0, np.repeat(_at(grams, value, key), some), 0)
                order = np.argsort(row)
                row = row[order]
                first = _first(row)
                _, (k,), (b,) = _packed(np.zeros(len(first), np.int64), [_steps(row[first])] + [
                    np.add.reduceat(x[order], first).astype("<i8") for x in (more, rest, gain)])
                homes.append(home)
                counts_.append(k)
                blobs.append(b)
            yield pack_rows(fields, np.full(len(homes), r), homes, counts_, blobs)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[int, list] = {}
        answers: dict[int, list] = {}
        for batch in batches:
            packed = batch.filter(batch.column("_lm_blob").is_valid())
            for home, n, blob in zip(*(packed.column(c).to_pylist() for c in list(packs)[1:4])):
                answers.setdefault(home, []).append((n, blob))
            own = batch.filter(batch.column("_lm_blob").is_null())
            homes = np.asarray(own.column("_lm_home"))
            for home in np.unique(homes).tolist():
                texts.setdefault(home, []).append(own.filter(pa.array(homes == home)))
        for home in sorted(texts):
            some = texts.pop(home)
            top = 1 + max(int(np.asarray(x.column("_lm_rows")).max()) for x in some)
            more, rest, gain = (np.zeros(top, np.int64) for _ in range(3))
            for n, blob in answers.pop(home, []):
                step, *add = _unpacked(blob, n, ["<u4", "<i8", "<i8", "<i8"])
                row = np.cumsum(step)  # each row once
                for x, y in zip((more, rest, gain), add):
                    x[row] += y
            for x in some:
                at = np.asarray(x.column("_lm_rows"))
                tokens, known, base, model = (np.asarray(x.column(c)) for c in sums)
                yield pa.RecordBatch.from_arrays([x.column(c) for c in carried] + [
                    pa.array(tokens), pa.array(known + more[at]), pa.array(np.full(len(at), tokens_known)),
                    pa.array(base + rest[at] / UNITS), pa.array(model + (rest + gain)[at] / UNITS)], names=[*carried, *added])

    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    blob = "_lm_part long, _lm_home long, _lm_rows long, _lm_blob binary, _lm_who binary"
    schema = ", ".join([*own, "_lm_tokens long, _lm_known long, _lm_base double, _lm_score double", blob])
    table = counts.select("key", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("value", F.lit(0)).alias("value"))
    asked = arrow_map(rows, run, schema).unionByName(arrow_map(table, table_rows, blob), allowMissingColumns=True)
    replies = arrow_map(asked.repartition(ranges, "_lm_part"), answered, schema).repartition(ranges, "_lm_home")
    scored = materialize(arrow_map(replies, summed, ", ".join([
        *own, "n_tokens long, n_known long, train_tokens long, base_score double, score double"])), "lm-scored")
    shared.destroy()
    return scored


def _at(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The value of each key of a sorted table, 0 where it has none."""
    if not len(keys):
        return np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)
