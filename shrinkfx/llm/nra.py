"""Ranked lexical search by NRA (no random access) over impact-sorted lists.

An impact is what one unit of a term's weight adds to a document's score. The documents
are cut into shards of bounded size; in a shard every query term has the list of its
postings, greatest impact first. Lists are only read from the front, all of them in steps
of doubling length. A document met so far has a score interval: its lower end is the sum of
what was read for it, the upper end adds, for each list in which it was not met yet, that
list's next impact. Reading goes on until

* no document outside can reach the k-th best lower end (the sum of all next impacts is
  below it), and then, for the documents whose upper end still reaches it alone,
* every such interval has closed, so membership, ties and final scores are all settled.

A shard hands on its ``k`` best per query and one window joins the shards, so nothing
larger than that is shuffled. Statistics (documents, terms, document frequencies) cover
all documents and are counted before; queries come in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shrinkfx.llm import textkit as K
from shrinkfx.llm.frames import arrow_map
from shrinkfx.session import materialize

#: bytes that belong to a term: ASCII letters and digits, and all of every other character
_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class Reader:
    first_step: int = 128          # postings of a list in the first step; then doubling
    shard_postings: int = 1 << 20  # a shard ends with the document that reaches this
    shard_rows: int = 10_000
    block_items: int = 1024        # queries of a block, and characters in it
    block_chars: int = 1 << 22


def terms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each term, lower-cased A-Z; terms per row) of a slice."""
    inside = np.concatenate([[False], _TERM[data], [False]])
    # a row's end also ends a term
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    hashes = K.span_hash(K.prefix_hash(K.lower_ascii(data)), starts, ends)
    return hashes, np.diff(np.searchsorted(starts, offs))


def _postings(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """(doc_id, n, term, tf) of every document: its number of terms, and the places in
    ``hashes`` of those that it holds with their counts."""
    context = docs.sparkSession.sparkContext
    wanted = context.broadcast(np.sort(hashes))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.value
        for batch in batches:
            for part in K.slices(batch, "text"):
                h, n = terms(*K.flat(part.column("text")))
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                held = known[at] == h
                key, tf = np.unique(K.row_of(n)[held] * len(known) + at[held], return_counts=True)
                offsets = np.searchsorted(key, np.arange(len(n) + 1) * len(known)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (key % len(known), tf)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n.astype(np.int64)), *lists],
                                                 names=["doc_id", "n", "term", "tf"])

    return arrow_map(docs, run, f"doc_id {id_type}, n long, term array<int>, tf array<int>")


def _frequencies(postings: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all their terms, documents that hold each query term)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(np.asarray(batch.column("term").flatten()), minlength=size)
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(df[found])], names=["term", "df"])

    about = postings.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("words")).first()
    df = np.zeros(size, np.int64)
    counted = arrow_map(postings.select("term"), run, "term long, df long")
    for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most one row a query term
        df[r.term] = r.df
    return about.docs, about.words or 0, df


class Shard:
    """The impact-sorted lists of some documents."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, n_terms: int,
                 docs: int, words: int):
        m = 75 + (25 * n * docs) // max(words, 1)
        doc, tf = K.row_of(sizes), tf.astype(np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
        order = np.lexsort((-impact, term))
        self.rows, self.doc, self.impact = len(n), doc[order], impact[order]
        self.begin = np.searchsorted(term[order], np.arange(n_terms + 1))

    def best(self, query: np.ndarray, weight: np.ndarray, k: int, tie: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the ``k`` best above 0, equal scores by ``tie``."""
        at, end = self.begin[query].copy(), self.begin[query + 1]
        lower = np.zeros(self.rows, np.int64)
        met, met_list = np.zeros(0, np.int64), np.zeros(0, np.int64)  # what was read: document, list
        settled, open_ = False, np.ones(self.rows, bool)  # settled: only ``open_`` documents can win
        while (at < end).any():
            take = np.minimum(step, end - at)
            which = np.repeat(np.arange(len(query)), take)
            posting = np.arange(len(which)) - np.repeat(np.cumsum(take) - take, take) + np.repeat(at, take)
            at, step = at + take, 2 * step
            doc = self.doc[posting]
            if settled:
                mine = open_[doc]
                doc, which, posting = doc[mine], which[mine], posting[mine]
            np.add.at(lower, doc, weight[which] * self.impact[posting])
            met, met_list = np.concatenate([met, doc]), np.concatenate([met_list, which])
            more = at < end
            following = np.where(more, weight * self.impact[np.where(more, at, 0)], 0)
            outside = int(following.sum())
            upper = lower + outside
            np.subtract.at(upper, met, following[met_list])
            kth = int(np.partition(lower, -k)[-k]) if self.rows >= k else 0
            settled = settled or outside < kth
            if settled:
                open_ &= upper >= kth
                if not (open_ & (upper > lower)).any():
                    break
        found = np.flatnonzero(open_ & (lower > 0))
        found = found[np.lexsort((tie[found], -lower[found]))][:k]
        return found, lower[found]


def _block(docs: DataFrame, items: list[tuple], k: int, reader: Reader) -> DataFrame:
    """The ranked documents of each shard for one block of (place, terms as hashes)."""
    context = docs.sparkSession.sparkContext
    hashes = np.unique(np.concatenate([t for _, t in items]))
    postings = materialize(_postings(docs, hashes), "postings")
    n_docs, words, df = _frequencies(postings, len(hashes))
    unit = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    queries = []
    for place, held in items:
        repeats = Counter(np.searchsorted(hashes, held).tolist())
        query = np.array([t for t in sorted(repeats) if df[t] and unit[t] > 0], np.int64)
        queries.append((place, query, unit[query] * np.array([repeats[t] for t in query.tolist()], np.int64)))
    sent = context.broadcast([q for q in queries if len(q[1])])
    n_terms, id_type = len(hashes), docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(np.asarray(batch.column("term").offsets).astype(np.int64))
            total = np.concatenate([[0], np.cumsum(sizes)])
            at = 0
            while at < batch.num_rows:
                to = int(np.searchsorted(total, total[at] + reader.shard_postings))
                to = min(max(to, at + 1), at + reader.shard_rows, batch.num_rows)
                part = batch.slice(at, to - at)
                ids = part.column("doc_id")
                tie = np.empty(len(ids), np.int64)
                tie[np.asarray(pc.sort_indices(ids, null_placement="at_end"))] = np.arange(len(ids))
                shard = Shard(np.asarray(part.column("n")), sizes[at:to], np.asarray(part.column("term").flatten()),
                              np.asarray(part.column("tf").flatten()), n_terms, n_docs, words)
                found = [(place, *shard.best(query, weight, k, tie, reader.first_step)) for place, query, weight in sent.value]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([p for p, _, _ in found], [len(d) for _, d, _ in found])),
                         ids.take(pa.array(np.concatenate([d for _, d, _ in found]))),
                         pa.array(np.concatenate([s for _, _, s in found]))], names=["place", "doc_id", "score"])
                at = to

    return arrow_map(postings, run, f"place long, doc_id {id_type}, score long")


def rank(docs: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", query_col: str = "text", reader: Reader = Reader()) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents with the highest score above 0.

    Terms are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased; null text has none. Of queries that share an id the smallest text stands; a
    query without terms has no result. Documents without terms do not count. Rows that
    repeat a document are documents of their own; a null document id ranks behind others of
    its score. Other columns are ignored; an empty table on either side gives no rows.
    Terms are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    items = queries.select(F.col(item_col).alias("item_id"), F.col(query_col).alias("text"))
    items = items.groupBy("item_id").agg(F.min("text").alias("text"))
    about = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    out = f"item_id {item_type}, rank int, doc_id {id_type}, score long"
    blocks = max(1, -(-about.n // reader.block_items), -(-(about.chars or 0) // reader.block_chars))
    parts = []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        hashes = [terms(*K.flat(pa.array([r.text or ""])))[0] for r in rows]
        held = [(i, h) for i, h in enumerate(hashes) if len(h)]
        if not held:
            continue
        names = spark.createDataFrame([(i, rows[i].item_id) for i, _ in held], f"place long, item_id {item_type}")
        parts.append(_block(docs, held, k, reader).join(F.broadcast(names), "place"))
    if not parts:
        return spark.createDataFrame([], out)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
