"""Benchmark decontamination by greedy string tiling.

1.  Seeds: the windows of ``min_match`` words of every benchmark item, hashed (an item with fewer words is one
    window). A Bloom filter of bounded size passes the documents' windows that may be seeds. A tile is a run of
    shared windows, so words outside of such windows are in no tile: only the words inside go on.
2.  Counted bound: tiles that cover n words hold at least n / ``min_match`` of the item's windows. So a contaminated
    document shares that many windows with the item, and one at least of them is left when the item's most frequent
    windows, one less than that many, are taken away. The exact join uses only the windows left; what many documents
    and items share joins nothing unless an item has little else.
3.  Each (document, item) pair whose shared windows reach the threshold is tiled: the longest common word runs are
    marked first, none overlapping, down to ``min_match`` words, found by Karp-Rabin hashes of shrinking length. The
    order of the tiles does not matter, so reordered passages are covered as well.
4.  A document is contaminated by an item when its tiles cover at least ``threshold`` of the item's words.

Steps 1 to 3 lose no pair: the result is that of tiling every document with every item.
"""

from __future__ import annotations

from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.bloom import BloomFilter
from tillstar.llm.passage_dedup import passage_words
from tillstar.llm.shingles import lean, long_lists, mix, release_memory, slices, word_hashes
from tillstar.llm.storage import materialise

MIN_MATCH, THRESHOLD = 3, 0.5
PAIR_WORDS = 1 << 19  # document words of the pairs that Python holds at a time

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so its powers can be divided out modulo 2 ** 64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

class _Free:
    """The words of one side that no tile covers yet, with Karp-Rabin hashes of their windows of any length."""

    def __init__(self, words: np.ndarray):
        self.words, self.free = words, np.ones(len(words), bool)
        powers, inverse = np.ones(len(words) + 1, np.uint64), np.ones(len(words) + 1, np.uint64)
        powers[1:], inverse[1:] = _BASE, _INVERSE
        powers, self.inverse = np.cumprod(powers), np.cumprod(inverse)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers[:-1])])

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows of ``length`` free words."""
        taken = np.concatenate([[0], np.cumsum(~self.free)])
        starts = np.flatnonzero(taken[length:] == taken[:-length])
        return starts, (self.sums[starts + length] - self.sums[starts]) * self.inverse[starts]

    def is_free(self, at: int, length: int) -> bool:
        return bool(self.free[at:at + length].all())


def tile(doc: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, words): longest first, none overlapping on either side.

    Runs of one length are taken in document order, each with the first place still free in the item.
    """
    left, right, tiles = _Free(doc), _Free(item), []
    high = min(len(doc), len(item))
    while high >= min_match:
        low = min_match - 1  # the longest length that both sides share, by bisection
        while low < high:
            length = (low + high + 1) // 2
            if np.isin(right.windows(length)[1], left.windows(length)[1]).any():
                low = length
            else:
                high = length - 1
        if low < min_match:
            break
        starts, hashes = right.windows(low)
        places = defaultdict(deque)
        for at, h in zip(starts.tolist(), hashes.tolist()):
            places[h].append(at)
        starts, hashes = left.windows(low)
        shared = np.isin(hashes, np.fromiter(places, np.uint64, len(places)))
        for d, h in zip(starts[shared].tolist(), hashes[shared].tolist()):
            if not left.is_free(d, low):
                continue
            queue = places[h]
            while queue and not right.is_free(queue[0], low):
                queue.popleft()
            if queue and np.array_equal(doc[d:d + low], item[queue[0]:queue[0] + low]):
                i = queue.popleft()
                left.free[d:d + low] = right.free[i:i + low] = False
                tiles.append((d, i, low))
        high = low - 1
    return tiles


def _windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of ``width`` words, in text order; windows of different widths have different hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(n, width, np.uint64)
    for k in range(width):
        acc = mix(acc * _BASE + hashes[k:k + n])
    return acc


def _inside(starts: np.ndarray, width: int, length: int) -> np.ndarray:
    """Which of ``length`` words stand in a window of ``width`` words at one of ``starts``."""
    edges = np.zeros(length + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return np.cumsum(edges)[:-1] > 0


def tile_shared(doc: np.ndarray, item: np.ndarray, min_match: int, least: float) -> list[tuple[int, int, int]]:
    """``tile`` on the words of ``doc`` that stand in windows shared with ``item``; without tiles when those windows
    cover fewer than ``least`` words of the item. The tiles are those of the whole document."""
    width = min(min_match, len(item))
    mine, theirs = _windows(doc, width), _windows(item, width)
    if _inside(np.flatnonzero(np.isin(theirs, mine)), width, len(item)).sum() < least:
        return []
    near = np.flatnonzero(_inside(np.flatnonzero(np.isin(mine, theirs)), width, len(doc)))
    gaps = np.flatnonzero(np.diff(near) > 1) + 1
    places = np.insert(near, gaps, -1)
    return [(int(places[d]), i, n) for d, i, n in tile(np.insert(doc[near], gaps, 0), item, width)]


def _passages(docs: DataFrame, seeds: BloomFilter, widths: list[int]) -> DataFrame:
    """Documents with a possible seed: the windows passed, and the words in them with their places; 0 stands in gaps."""
    def run(batches):
        for batch in slices(batches, 1):
            rows, hits, words, places = [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                hashes = word_hashes(passage_words(text)) if text else ()
                passed, inside = [], np.zeros(len(hashes), bool)
                for width in widths:
                    windows = _windows(hashes, width)
                    at = seeds.probe(windows)
                    if len(at):
                        passed.append(np.unique(windows[at]))
                        inside |= _inside(at, width, len(hashes))
                if not passed:
                    continue
                near = np.flatnonzero(inside)
                gaps = np.flatnonzero(np.diff(near) > 1) + 1
                rows.append(row)
                hits.append(np.concatenate(passed))
                words.append(np.insert(hashes[near], gaps, 0))
                places.append(np.insert(near, gaps, -1).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), long_lists(hits), long_lists(words), long_lists(places)],
                names=["id", "hits", "words", "places"])

    return docs.mapInArrow(run, "id long, hits array<long>, words array<long>, places array<long>")


def _items(benchmark: DataFrame, min_match: int) -> DataFrame:
    """Items with a word: item, item_words and seeds, the hash of the window at each place."""
    def run(batches):
        for batch in slices(batches, 1):
            split = [word_hashes(passage_words(t)) if t else np.empty(0, np.uint64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), long_lists(split), long_lists([_windows(w, max(1, min(min_match, len(w)))) for w in split])],
                names=["item", "item_words", "seeds"])

    return benchmark.mapInArrow(run, "item long, item_words array<long>, seeds array<long>").filter("size(item_words) > 0")


def _pair_slices(batches, size: int = PAIR_WORDS):
    """The batches cut into runs of rows with about ``size`` words of documents (column 2), one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False), dtype=np.int64)
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(start, stop - start)
            start, done = stop, ends[stop - 1]
    if lean():
        release_memory()


def _longs(column: pa.Array) -> list[np.ndarray]:
    """The rows of a list<int64> column as unsigned integers, without Python objects."""
    return [value.values.to_numpy().view(np.uint64) for value in column]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text",
                 min_match: int = MIN_MATCH, threshold: float = THRESHOLD) -> DataFrame:
    """One row per contaminated (document, item): id, item, coverage, n_tiles, longest, tiles
    (array of place in document, place in item, words; places count words).

    Words are runs of letters and digits, ASCII in lower case; a Han or kana character is a word. Null and empty
    texts match nothing. An item of fewer than ``min_match`` words is found where all its words stand in a row.
    Texts of any length are compared whole. Rows without id are left out: they could not be named. Of rows that
    share an id the one covered most counts. Extra columns are ignored; an empty table on either side gives an
    empty result. Items that share an id are one row each of the comparison, and the best covered one counts.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    benchmark = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    items = materialise(_items(benchmark.filter("item is not null"), min_match).withColumn("item_row", F.monotonically_increasing_id()), "items")
    # One less than the windows a contaminated document shares at least.
    wanted = F.ceil(F.size("item_words") * F.lit(float(threshold)))
    spare = F.greatest(F.ceil(wanted / F.least(F.lit(min_match), F.size("item_words"))), F.lit(1)) - 1
    seeds = (items.select("item_row", spare.alias("spare"), F.explode("seeds").alias("seed"))
             .groupBy("item_row", "spare", "seed").agg(F.count("*").alias("item_places")))
    widths = sorted(r.width for r in items.select(F.least(F.lit(min_match), F.size("item_words")).alias("width")).distinct().collect())
    found = materialise(_passages(docs, BloomFilter(seeds.select("seed").distinct(), "seed"), widths)
                        .withColumn("row", F.monotonically_increasing_id()), "passages")

    hits = found.select("row", F.explode("hits").alias("seed"))
    frequent_first = Window.partitionBy("item_row").orderBy(F.desc("n_docs"), "seed")  # as many rows as the item has words
    joining = (seeds.join(hits.groupBy("seed").agg(F.count("*").alias("n_docs")), "seed")
               .withColumn("passed", F.sum("item_places").over(frequent_first)).filter("passed > spare").select("seed", "item_row"))
    pairs = materialise(hits.join(materialise(joining, "seeds", narrow=True), "seed").select("row", "item_row").distinct(), "pairs", narrow=True)
    both = pairs.join(found.select("row", "id", "words", "places"), "row").join(items.select("item_row", "item", "item_words"), "item_row")

    def run(batches):
        for batch in _pair_slices(batches):
            rows = [[] for _ in range(5)]
            tiles = []
            ids, named = (batch.column(i).to_pylist() for i in range(2))
            for doc, item, words, places, wanted in zip(ids, named, *(_longs(batch.column(i)) for i in (2, 3, 4))):
                got = tile_shared(words, wanted, min_match, threshold * len(wanted))
                covered = sum(t[2] for t in got)
                if covered and covered >= threshold * len(wanted):
                    for column, value in zip(rows, (doc, item, covered / len(wanted), len(got), max(t[2] for t in got))):
                        column.append(value)
                    tiles.append([[int(places[d]), i, n] for d, i, n in got])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))),
                 pa.array(tiles, pa.list_(pa.list_(pa.int64())))],
                names=["id", "item", "coverage", "n_tiles", "longest", "tiles"])

    tiled = (both.select("id", "item", "words", "places", "item_words")
             .mapInArrow(run, "id long, item long, coverage double, n_tiles long, longest long, tiles array<array<long>>"))
    most = tiled.groupBy("id", "item").agg(F.max(F.struct("coverage", "longest", "n_tiles", "tiles")).alias("most"))
    return most.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "most.coverage", "most.n_tiles", "most.longest", "most.tiles")
