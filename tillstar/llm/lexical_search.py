"""Ranked lexical search by scanning the documents with an automaton of all query terms.

No index of the documents is kept. The terms of all items, each with a blank on either side (so
that only whole terms match), go into one Aho-Corasick automaton; one scan of the folded texts
counts every term of every item straight from the text. A term's number leads to the items that
hold it, so a second pass over the small table of counts scores all items at once and keeps the
best of each task.

Items are taken in blocks of at most ``BLOCK_BYTES`` of text (at least one item), each with a scan
of its own, so what is broadcast is bounded however many items there are.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.shingles import FOLD, folded_words, slices
from tillstar.llm.storage import materialise

BLOCK_BYTES = 2 << 20
SCORED_PAIRS = 2_000_000  # (document, term, item) triples held at a time
SALTS = 32

COUNTS = "doc_id long, n long, terms array<int>, tfs array<int>"
BEST = "item int, doc_id long, score long"


@lru_cache(maxsize=1)
def _automaton(terms: tuple[str, ...]):
    """Guarded terms with their numbers, built once a worker."""
    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word(f" {term} ", number)
    found.make_automaton()
    return found


def _counter(terms):
    """A function over (doc_id, text) batches: terms in all, and the numbers and counts of those the automaton knows.
    Documents without a term give no row."""
    def run(batches):
        automaton = _automaton(terms.value)
        for batch in slices(batches, 1):
            rows = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                folded = (text or b"").translate(FOLD)
                n = len(folded.split())
                if n:
                    hits = Counter(map(itemgetter(1), automaton.iter(f" {folded.decode()} ")))
                    for column, value in zip(rows, (doc, n, list(hits), list(hits.values()))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
                names=["doc_id", "n", "terms", "tfs"])

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Best:
    """The ``k`` best (score, then small id; null ids last) documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.zeros(items, np.int64)
        self.rows = tuple(np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64))  # item, id, id is null, score

    def add(self, ids: np.ndarray, null: np.ndarray, scores: np.ndarray) -> None:
        doc, item = np.nonzero((scores >= self.least) & (scores > 0))
        new = item, ids[doc], null[doc], scores[doc, item]
        item, ids, null, score = (np.concatenate(c) for c in zip(self.rows, new))
        order = np.lexsort((ids, null, -score, item))
        item, ids, null, score = (c[order] for c in (item, ids, null, score))
        first = np.flatnonzero(np.diff(item, prepend=-1))
        place = np.arange(len(item)) - np.repeat(first, np.diff(first, append=len(item)))
        self.rows = tuple(c[place < self.k] for c in (item, ids, null, score))
        full = place == self.k - 1
        self.least[item[full]] = score[full]


def _scorer(n_docs: int, n_terms: int, k: int, n_items: int, tables):
    """A function over count batches: the best documents of each item within the task."""
    def run(batches):
        weights, offsets, items, times = tables.value
        best = _Best(n_items, k)

        def score(best, part):
            ids = part.column(0)
            m = np.array([25 + 75 * n * n_docs // n_terms for n in part.column(1).to_pylist()], np.int64)
            size = part.column(2).value_lengths().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(size)), size)
            term = part.column(2).flatten().to_numpy(zero_copy_only=False)
            tf = part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            worth = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            wide = offsets[term + 1] - offsets[term]
            place = np.arange(wide.sum()) + np.repeat(offsets[term] - (np.cumsum(wide) - wide), wide)
            scores = np.zeros((len(size), n_items), np.int64)
            np.add.at(scores.ravel(), np.repeat(doc * n_items, wide) + items[place], np.repeat(worth, wide) * times[place])
            best.add(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), scores)

        for batch in batches:
            size = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            wide = np.diff(offsets)[batch.column(2).flatten().to_numpy(zero_copy_only=False)]  # items that hold each found term
            hits = np.append(0, np.cumsum(size))
            cost = np.append(0, np.cumsum(wide))[hits] + n_items * np.arange(len(hits))  # up to each document
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(cost, cost[start] + SCORED_PAIRS, "right")) - 1)
                score(best, batch.slice(start, stop - start))
                start = stop
        item, ids, null, score = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=null), pa.array(score, pa.int64())],
                                         names=["item", "doc_id", "score"])

    return run


def _item_blocks(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    """Items (item_id, text) in blocks by hash, each within the bound or a single item."""
    n = 1
    while True:
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
        sizes = items.groupBy(block.alias("b")).agg(F.sum(F.octet_length("text")).alias("bytes"), F.countDistinct("item_id", "text").alias("n"))
        if n >= 1 << 20 or not sizes.filter((F.col("bytes") > block_bytes) & (F.col("n") > 1)).limit(1).count():
            return [items.filter(block == b) for b in range(n)]
        n *= 2


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score (above 0).

    Terms are runs of letters, digits and non-ASCII characters, A-Z as a-z. Every row of ``items``
    is a query, also when rows repeat (equal rows are one); null or empty texts have no term and no result. Every row
    of ``docs`` is a document, also when ids repeat; a null id ranks after equal scores with an id.
    Texts are scanned whole in slices of bounded size; extra columns are ignored; empty tables give no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).distinct()
    items = items.filter(F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))  # holds a term
    blocks = [b for block in _item_blocks(items, block_bytes) if (b := block.collect())]  # bounded by the block
    out = None
    for rows in blocks:
        found = _search_block(spark, docs, [(r["item_id"], folded_words(r["text"].encode())) for r in rows], k)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def _search_block(spark, docs: DataFrame, items: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame:
    terms = tuple(sorted({t.decode() for _, words in items for t in words}))
    number = {t: i for i, t in enumerate(terms)}
    counts = materialise(docs.mapInArrow(_counter(spark.sparkContext.broadcast(terms)), COUNTS), "term-counts")
    n_docs, n_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(terms), np.int64)
    for r in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():  # one row a term of the block
        df[r["t"]] = r["df"]
    postings = sorted((number[t.decode()], i, times) for i, (_, words) in enumerate(items) for t, times in Counter(words).items())
    term, item, times = np.array(postings, np.int64).reshape(-1, 3).T
    offsets = np.searchsorted(term, np.arange(len(terms) + 1))
    weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
    tables = spark.sparkContext.broadcast((weights, offsets, item.copy(), times.copy()))
    best = counts.mapInArrow(_scorer(n_docs, n_terms, k, len(items), tables), BEST)
    order = F.col("score").desc(), F.col("doc_id").asc_nulls_last()
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    for by in (("item", salt), ("item",)):  # each task sends k rows an item; the salted turn keeps an item's share of a task small
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(items)], "item int, item_id long")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
