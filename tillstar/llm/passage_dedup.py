"""Substring dedup by hashing units of text: repeated passages are removed, the earliest ranked occurrence stays.

1.  Every text is cut into units: sentences, and long sentences further at content-defined breaks (after a word
    whose hash is 0 modulo ``break_every``), so that a passage falls into the same units again shortly after its
    start wherever it begins and however it is wrapped. Whole lines of ``line_words`` words or more are units too.
    A unit is normalised (words of letters and digits, ASCII in lower case; a Han or kana character is a word) and
    hashed to 128 bits; its original offsets are kept.
2.  Digests are grouped over the whole corpus. Counting is pre-aggregated in each task, so a unit in a third
    of all documents costs one row a task. A Bloom filter of the digests that occur twice or more passes the units
    that may repeat; only they are shuffled to the exact grouping, which ranks occurrences by document id (missing
    ids last) and place and keeps the first.
3.  Neighbouring repeated units of a text form a run. Runs of at least ``min_words`` words are removed, and so are
    repeated whole lines. Shorter ones (a stock phrase, a heading) stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.bloom import BloomFilter
from tillstar.llm.shingles import FOLD, folded_words, mix, slices, word_hashes
from tillstar.llm.storage import materialise

MIN_WORDS = 25
LINE_WORDS = 10  # whole lines from here on go when they repeat; shorter ones are mostly headings, greetings and list items
BREAK_EVERY = 8
RUN_BYTES = 2 << 20  # of text whose units are found at a time

_STOP = re.compile(r"[.!?](?=[ \t\n\v\f\r])|[。！？｡]")
_NEWLINE = re.compile("\n")
#: Han and kana are written without spaces: each such character is a word. Their punctuation parts words.
_WIDE_WORD = "々-〇ぁ-ゟァ-ヺー-ヿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff"
_WIDE_GAP = "\u3000-〄〈-〿・！-／：-＠［-｀｛-･"
_WIDE = re.compile(f"[{_WIDE_WORD}{_WIDE_GAP}]")
_WIDE_TOKEN = re.compile(f"[{_WIDE_WORD}]|[^\x00-/:-@\\[-`{{-\x7f{_WIDE_WORD}{_WIDE_GAP}]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def passage_words(text: str) -> list[bytes]:
    """``folded_words``, and each Han or kana character a word."""
    if text.isascii() or not _WIDE.search(text):
        return folded_words(text.encode())
    return [found.group().encode().translate(FOLD) for found in _WIDE_TOKEN.finditer(text)]


class Words(NamedTuple):
    """The words of a run of texts that stand one after the other, each ended by a newline that is none of its own. Places are
    bytes of the run, or characters where a text is a run by itself."""
    begin: np.ndarray
    hashes: np.ndarray
    breaks: np.ndarray  # whether a break follows the word
    opens: np.ndarray  # places where the texts begin and end
    closes: np.ndarray
    stops: np.ndarray  # places right after sentence ends and right after newlines
    lines: np.ndarray


_STOPS = np.isin(np.arange(256), list(b".!?"))
_SPACES = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def _breaks(hashes: np.ndarray, break_every: int) -> np.ndarray:
    return mix(hashes) % np.uint64(break_every) == 0


def _words(texts: list[bytes], break_every: int) -> Words:
    """Words of texts without Han and kana. Arrow numbers them, each distinct word is hashed once."""
    run = b"\n".join(texts)
    closes = np.cumsum([len(text) + 1 for text in texts]) - 1
    raw, folded = (np.frombuffer(x, np.uint8) for x in (run, run.translate(FOLD)))
    inside = np.zeros(len(run) + 2, bool)
    np.not_equal(folded, 32, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, size = edges[::2], edges[1::2] - edges[::2]
    offsets = np.append(0, np.cumsum(size)).astype(np.int32)
    letters = folded[inside[1:-1]]
    numbered = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    distinct = np.array([xxhash.xxh3_64_intdigest(w) for w in numbered.dictionary.to_pylist()], np.uint64)
    at = numbered.indices.to_numpy(zero_copy_only=False)
    stops = np.flatnonzero(_STOPS[raw[:-1]])
    return Words(begin, distinct[at], _breaks(distinct, break_every)[at], closes - [len(text) for text in texts], closes,
                 stops[_SPACES[raw[stops + 1]]] + 1, np.flatnonzero(raw == 10) + 1)


def _wide_words(text: str, break_every: int) -> Words:
    """Words of one text in which each Han or kana character is a word."""
    hashes = word_hashes(passage_words(text))
    begin = np.array([found.start() for found in _WIDE_TOKEN.finditer(text)], np.int64)
    stops, lines = (np.array([f.end() for f in found.finditer(text)], np.int64) for found in (_STOP, _NEWLINE))
    return Words(begin, hashes, _breaks(hashes, break_every), np.array([0]), np.array([len(text)]), stops, lines)


def _digest(words: Words, first: np.ndarray, count: np.ndarray, half: int) -> np.ndarray:
    """One half of the 128 bits over (place, word) of every range of words."""
    if not len(first):
        return np.empty(0, np.uint64)
    at = np.cumsum(count) - count
    place = np.arange(at[-1] + count[-1]) - np.repeat(at, count)
    keys = mix(np.arange(1, count.max() + 1, dtype=np.uint64) * _STEP)
    hashes = words.hashes[place + np.repeat(first, count)]
    mixed = mix(hashes * _STEP ^ mix(keys)[place]) if half else mix(hashes + keys[place])
    return mix(np.add.reduceat(mixed, at))


def _units(words: Words, line_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and number of words of the sentence units in order and then of the whole lines; the numbers of these lines."""
    n = len(words.hashes)
    opens = np.zeros(n + 1, bool)
    opens[np.searchsorted(words.begin, words.opens)] = opens[np.searchsorted(words.begin, words.stops)] = True
    opens[1:] |= words.breaks
    first = np.flatnonzero(opens[:n])
    edges = np.concatenate([[0], np.searchsorted(words.begin, words.lines), [n]])
    counts = np.diff(edges)
    whole = np.flatnonzero(counts >= max(1, line_words))
    return np.concatenate([first, edges[whole]]), np.concatenate([np.diff(first, append=n), counts[whole]]), whole


def _places(words: Words, first: np.ndarray, count: np.ndarray, whole: np.ndarray) -> list[np.ndarray]:
    """Of the units: number of the text, place in it (sentence units, then lines), start, end, words of the text before it, words, whether it is a line."""
    n = len(first) - len(whole)
    opens = np.searchsorted(words.begin, words.opens)  # the first word of each text
    text = np.searchsorted(opens, first, "right") - 1
    sentence, line = text[:n], text[n:]
    before = np.searchsorted(sentence, np.arange(len(opens) + 1))  # sentence units of the texts before each text
    place = np.concatenate([np.arange(n) - before[sentence], np.diff(before)[line] + np.arange(len(line)) - np.searchsorted(line, line)])
    bounds = np.append(words.begin, words.closes[-1])
    lines = np.concatenate([[0], words.lines, words.closes[-1:]])
    starts = np.concatenate([bounds[first[:n]], lines[whole]])
    ends = np.concatenate([bounds[first[:n] + count[:n]], lines[whole + 1]])
    ends[before[1:][np.diff(before) > 0] - 1] = words.closes[np.diff(before) > 0]
    return [text, place, starts, np.minimum(ends, words.closes[text]), first - opens[text], count, np.arange(len(first)) >= n]


def _runs(texts: list[str], break_every: int) -> Iterator[tuple[list[int], bytes | None, Words]]:
    """The texts in runs: their numbers, the bytes of the run (None: places are characters) and its words. Texts with Han or kana
    make runs by themselves."""
    wide = [bool(not text.isascii() and _WIDE.search(text)) for text in texts]
    for at, text in enumerate(texts):
        if wide[at]:
            yield [at], None, _wide_words(text, break_every)
    plain = [at for at, w in enumerate(wide) if not w]
    if plain:
        encoded = [texts[at].encode() for at in plain]
        yield plain, b"\n".join(encoded), _words(encoded, break_every)


def _halves(docs: DataFrame, line_words: int, break_every: int) -> DataFrame:
    """One half of the digest of every unit: enough to find what may repeat."""
    def run(batches):
        for batch in slices(batches, 1, RUN_BYTES):
            texts = [text for text in batch.column(1).to_pylist() if text]
            found = [_digest(words, *_units(words, line_words)[:2], 0) for _, _, words in _runs(texts, break_every)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64))], names=["d1"])

    return docs.select("row", "text").mapInArrow(run, "d1 long")


HIT = "id long, row long, place int, starts int, ends int, befores int, words int, alone boolean, d1 long, d2 long"


def _hits(docs: DataFrame, often: BloomFilter, line_words: int, break_every: int) -> DataFrame:
    """The units that may repeat."""
    def run(batches):
        for batch in slices(batches, 2, RUN_BYTES):
            for numbers, encoded, words in _runs([text or "" for text in batch.column(2).to_pylist()], break_every):
                units = _units(words, line_words)
                half = _digest(words, *units[:2], 0)
                at = np.sort(often.probe(half))
                if not len(at):
                    continue
                text, *columns = (c[at] for c in _places(words, *units))
                if encoded is not None:  # bytes of the run to characters of the text
                    characters = np.append(0, np.cumsum((np.frombuffer(encoded, np.uint8) & 0xC0) != 0x80, dtype=np.int32))
                    columns[1:3] = (characters[c] - characters[words.opens[text]] for c in columns[1:3])
                rows = pa.array(np.array(numbers)[text])
                columns = [pa.array(c).cast(t) for c, t in zip(columns, (*(pa.int32(),) * 5, pa.bool_()))]
                digests = [pa.array(c.view(np.int64)) for c in (half[at], _digest(words, units[0][at], units[1][at], 1))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *columns, *digests], names=names)

    names = [c.split()[0] for c in HIT.split(", ")]
    return docs.mapInArrow(run, HIT)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                      line_words: int = LINE_WORDS, break_every: int = BREAK_EVERY) -> DataFrame:
    """One row per removed passage: id, start, end (characters of the original text), n_units (sentence units in it), n_words,
    and the id that keeps its first unit (``keep_<id>``).

    Null, empty and wordless texts have no units. Of repeated rows (the same id and text) all occurrences but one
    are removed, told apart by their place. Rows without id rank last, their passages have a null id. Texts are
    taken in slices of bounded size, a very long one alone. Extra columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))
    often = _halves(docs, line_words, break_every).groupBy("d1").agg(F.count("*").alias("n")).filter("n > 1").select("d1")
    often = BloomFilter(materialise(often, "often", tidy=True), "d1")
    hits = materialise(_hits(docs, often, line_words, break_every), "hits")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "row", "place")
    first = hits.groupBy("d1", "d2", "alone").agg(F.min(rank).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = materialise(first.select("d1", "d2", "alone", "first"), "first", tidy=True)
    again = hits.join(first, ["d1", "d2", "alone"]).filter("row <> first.row or place <> first.place").withColumn("keep", F.col("first.id"))
    again = materialise(again.drop("first", "d1", "d2"), "again", tidy=True)

    in_row = Window.partitionBy("row").orderBy("place")
    runs = (again.filter("not alone").withColumn("run", F.col("place") - F.row_number().over(in_row))
            .groupBy("row", "run").agg(F.min("id").alias("id"), F.min("starts").alias("start"), F.max("ends").alias("end"), F.min("befores").alias("before"),
                                       F.count("*").alias("n_units"), F.sum("words").alias("n_words"), F.min_by("keep", "place").alias("keep")))
    spans = runs.filter(F.col("n_words") >= min_words).select(
        "id", "row", "before", (F.col("before") + F.col("n_words")).alias("after"), "start", "end", "n_units", "keep", F.lit(0).alias("kind"))
    spans = spans.unionByName(again.filter("alone").select(
        "id", "row", F.col("befores").alias("before"), (F.col("befores") + F.col("words")).cast("long").alias("after"), F.col("starts").alias("start"),
        F.col("ends").alias("end"), F.lit(0).cast("long").alias("n_units"), "keep", F.lit(1).alias("kind")))

    # Spans that overlap or touch are one passage.
    ordered = Window.partitionBy("row").orderBy("before", "kind", "after")
    reached = F.max("after").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.coalesce(F.col("before") > reached, F.lit(True)).cast("int"))
    spans = spans.withColumn("passage", F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = spans.groupBy("row", "passage").agg(
        F.min("id").alias("id"), F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"), F.sum("n_units").alias("n_units"),
        (F.max("after") - F.min("before")).alias("n_words"), F.min_by("keep", F.struct("before", "kind", "after")).alias("keep"))
    return out.select(F.col("id").alias(id_col), "start", "end", "n_units", "n_words", F.col("keep").alias(f"keep_{id_col}"))


def remove_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the passages cut out of their texts; ids must be unique. Documents without a passage are as before."""
    cuts = passages.groupBy(F.col(id_col).alias("cut_id")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))

    def run(batches):
        for batch in slices(batches, at):
            texts = []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                start, parts = 0, []
                for span in spans or ():
                    parts.append(text[start:span["start"]])
                    start = span["end"]
                texts.append("".join(parts) + text[start:] if spans else text)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    at = docs.columns.index(text_col)
    return docs.join(cuts, F.col(id_col) == F.col("cut_id"), "left").drop("cut_id").mapInArrow(run, docs.schema)
