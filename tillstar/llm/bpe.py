"""BPE encoding of whole texts by tree concatenation, and decoding.

A long text is cut into halves until they are short, wherever the cut falls: also inside a word, a
combining sequence or a special string. The halves are encoded on their own and joined in pairs,
up the tree. At a join only a window around the cut is encoded again, and it grows until its tokens
agree with both sides: with the left one in its first token, with the right one in a token before its
last. Why that is exact: merges choose the least rank, so a sequence of tokens is the encoding of its text
exactly when each two neighbours are the encoding of theirs, and with a shared token on both sides every two
neighbours come from one real encoding. A shared token counts only at a place where a text may be
cut in the first place, which ``safe`` checks: no character composes across it, no special string
covers it, no contraction (an apostrophe and up to two letters) stands around it.

Texts longer than ``SEGMENT_CHARS`` are cut into segments first, which Spark spreads over tasks;
the join of their encodings is the upper part of the same tree.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillstar.llm.shingles import slices
from tillstar.llm.tokens import RUN_BYTES, SPACES, tokenizer, word_encoder

LEAF_CHARS = 4_096
EDGE_CHARS = 128
SEGMENT_CHARS = 1 << 20
WINDOW_TOKENS = 4
DECODED_IDS = 1 << 20
SPACE = re.compile(f"[{SPACES}]")


@dataclass
class Encoded:
    """The tokens of ``text[start:stop]`` on its own: ids and the places (in the whole text) where they begin and end.
    Tokens far from the cuts may lack their places (-1)."""
    start: int
    stop: int
    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray

    def cut(self, low: int | None, high: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.ids[low:high], self.begins[low:high], self.ends[low:high]


class TreeEncoder:
    """Encodes long texts in a tree of halves (see the module). Of a leaf, the ``edge_chars`` at either side up to white space go to the
    library with the tokens' places; what lies between is encoded by its words. A leaf without such white space
    goes to the library whole."""

    def __init__(self, path: str, leaf_chars: int = LEAF_CHARS, window: int = WINDOW_TOKENS, edge_chars: int = EDGE_CHARS):
        self.library, self.words, self.edge_chars = tokenizer(path), word_encoder(path), max(1, edge_chars)
        self.leaf_chars, self.window = max(1, leaf_chars), max(1, window)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.joins = self.grown = 0

    def direct(self, text: str, start: int, stop: int) -> Encoded:
        found = self.library.encode(text[start:stop], add_special_tokens=False)
        places = np.array(found.offsets, np.int64).reshape(-1, 2) + start
        return Encoded(start, stop, np.array(found.ids, np.uint32), places[:, 0], places[:, 1])

    def safe(self, text: str, at: int) -> bool:
        """Whether what the library makes of the text from ``at`` on does not depend on what stands before."""
        if "'" in text[max(0, at - 2): at + 1]:
            return False
        near = text[max(0, at - 1): at + 1]
        if not near.isascii() and (unicodedata.combining(near[-1]) or not unicodedata.is_normalized("NFC", near)):
            return False
        return not any(s in text[max(0, at - len(s) + 1): at + len(s) - 1] for s in self.specials)

    def joined(self, text: str, left: Encoded, right: Encoded) -> Encoded:
        """The encoding of two neighbours as one text."""
        self.joins += 1
        width = self.window
        while True:
            low, high = max(0, len(left.ids) - width), min(len(right.ids), width)
            if low and left.begins[low] < 0:  # the window has outgrown the edge
                left = self.direct(text, left.start, left.stop)
                continue
            if (right.begins[:high] < 0).any():
                right = self.direct(text, right.start, right.stop)
                continue
            whole_left, whole_right = low == 0, high == len(right.ids)
            start = left.start if whole_left else int(left.begins[low])
            stop = right.stop if whole_right else int(right.ends[high - 1])
            middle = self.direct(text, start, max(stop, left.stop))
            first = whole_left or self._first_agrees(text, left, low, middle)
            match = (len(middle.ids), high) if whole_right else self._match(text, middle, right, high)
            if first and match:
                parts = left.cut(0, low), middle.cut(0, match[0]), right.cut(match[1], None)
                return Encoded(left.start, right.stop, *(np.concatenate(c) for c in zip(*parts)))
            self.grown += 1
            width *= 2

    def _first_agrees(self, text: str, left: Encoded, low: int, middle: Encoded) -> bool:
        return (len(middle.ids) > 0 and middle.ids[0] == left.ids[low] and middle.begins[0] == left.begins[low]
                and middle.ends[0] == left.ends[low] and self.safe(text, int(left.begins[low])))

    def _match(self, text: str, middle: Encoded, right: Encoded, high: int) -> tuple[int, int] | None:
        """Tokens (i, j) such that token i of the window, not its last, is token j of the right side: the last such pair."""
        place = {b: j for j, b in enumerate(right.begins[:high].tolist())}
        for i in range(len(middle.ids) - 2, -1, -1):
            j = place.get(int(middle.begins[i]))
            if (j is not None and middle.ids[i] == right.ids[j] and middle.ends[i] == right.ends[j]
                    and self.safe(text, int(middle.begins[i]))):
                return i, j
        return None

    def leaves(self, start: int, stop: int) -> list[tuple[int, int]]:
        if stop - start <= self.leaf_chars:
            return [(start, stop)]
        half = (start + stop) // 2
        return self.leaves(start, half) + self.leaves(half, stop)

    def _inner(self, text: str, start: int, stop: int) -> tuple[int, int] | None:
        """The white space nearest to both edges of a leaf, if there are two such places."""
        first = SPACE.search(text, start + self.edge_chars, max(start, stop - self.edge_chars))
        last = first and max(text.rfind(c, first.start() + 1, stop - self.edge_chars) for c in SPACES)
        return (first.start(), last) if first and last > 0 else None

    def _encode_leaves(self, texts: list[str], leaves: list[list[tuple[int, int]]]) -> list[list[Encoded]]:
        """The leaves of several texts, with one call of the library for all edges and one run of words for all that lies between."""
        spans = [(t, at, self._inner(text, *at)) for t, text in enumerate(texts) for at in leaves[t]]
        edges = [(t, a, b) for t, (start, stop), inner in spans for a, b in ([(start, inner[0]), (inner[1], stop)] if inner else [(start, stop)])]
        found = iter(self.library.encode_batch([texts[t][a:b] for t, a, b in edges], add_special_tokens=False))
        between = self.words.encode(pa.array([texts[t][inner[0]:inner[1]] for t, _, inner in spans if inner], pa.string()))

        def edge(at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            encoding = next(found)
            places = np.array(encoding.offsets, np.int64).reshape(-1, 2) + at
            return np.array(encoding.ids, np.uint32), places[:, 0], places[:, 1]

        out = [[] for _ in texts]
        for t, (start, stop), inner in spans:
            parts = [edge(start)]
            if inner:
                ids = next(between)
                unknown = np.full(len(ids), -1, np.int64)
                parts += (ids, unknown, unknown), edge(inner[1])
            out[t].append(Encoded(start, stop, *(np.concatenate(c) for c in zip(*parts))))
        return out

    def _joined_leaves(self, text: str, start: int, stop: int, leaves) -> Encoded:
        if stop - start <= self.leaf_chars:
            return next(leaves)
        half = (start + stop) // 2
        return self.joined(text, self._joined_leaves(text, start, half, leaves), self._joined_leaves(text, half, stop, leaves))

    def encode(self, texts: list[str]) -> list[Encoded]:
        """The encoding of each text: halves down to the leaves, then their joins."""
        leaves = self._encode_leaves(texts, [self.leaves(0, len(text)) for text in texts])
        return [self._joined_leaves(text, 0, len(text), iter(own)) for text, own in zip(texts, leaves)]

    def join_all(self, text: str, parts: list[Encoded]) -> Encoded:
        """Neighbouring encodings joined in pairs, level by level."""
        while len(parts) > 1:
            pairs = [self.joined(text, a, b) for a, b in zip(parts[::2], parts[1::2])]
            parts = pairs + parts[len(pairs) * 2:]
        return parts[0]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.append(0, np.cumsum([len(a) for a in arrays], dtype=np.int64)).astype(np.int32)
    values = np.concatenate([np.empty(0, np.uint32), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _encode_texts(path: str, leaf_chars: int):
    """(id, text) -> (id, ids): a text within a leaf by the words it consists of, a longer one by the tree."""
    def run(batches):
        words, tree = word_encoder(path), TreeEncoder(path, leaf_chars)
        for batch in slices(batches, 1, RUN_BYTES):
            texts = batch.column(1).fill_null("")
            long = pc.greater(pc.utf8_length(texts), leaf_chars)
            ids = list(words.encode(pc.if_else(long, "", texts)))
            places = np.flatnonzero(long.to_numpy(zero_copy_only=False)).tolist()
            for i, found in zip(places, tree.encode(texts.filter(long).to_pylist())):
                ids[i] = found.ids
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids)], names=["id", "ids"])

    return run


def _encode_segments(path: str, leaf_chars: int):
    """(id, digest, copies, part, text) -> the same with the segment's ids and token places."""
    def run(batches):
        tree = TreeEncoder(path, leaf_chars)
        for batch in slices(batches, 4, RUN_BYTES):
            found = tree.encode(batch.column(4).to_pylist())
            columns = [_lists([getattr(f, c) for f in found]) for c in ("ids", "begins", "ends")]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "ids", "begins", "ends"])

    return run


def _join_segments(path: str, leaf_chars: int, segment_chars: int):
    """All segments of one text -> its ids. A group is one text, which was one value of one row before."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        texts = table["text"].to_pylist()
        text, parts, at = "".join(texts), [], 0
        for i, piece in enumerate(texts):
            ids, begins, ends = (np.array(table[c][i].values) for c in ("ids", "begins", "ends"))
            begins, ends = (np.where(places < 0, -1, places.astype(np.int64) + at) for places in (begins, ends))
            parts.append(Encoded(at, at + len(piece), ids.astype(np.uint32), begins, ends))
            at += len(piece)
        ids = TreeEncoder(path, leaf_chars).join_all(text, parts).ids
        return pa.table({"id": table["id"][:1], "copies": table["copies"][:1], "ids": pa.chunked_array([_lists([ids])])})

    return run


def encode_texts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 leaf_chars: int = LEAF_CHARS, segment_chars: int = SEGMENT_CHARS, decoded: bool = False) -> DataFrame:
    """One row per row of ``docs``: id and ids (array<int>), as the library gives them without begin and end tokens;
    with ``decoded`` also the text that ``decode_ids`` gives for them, from the same Python workers.

    For tokenizers that compose (NFC), fold case, drop white space and split into contractions, runs of letters,
    single digits and runs of other marks, then merge within those. Null texts are empty and have no ids; ids of rows may be null
    or repeat; extra columns are ignored; an empty table gives an empty one. Texts of up to ``leaf_chars`` characters are encoded at once, longer
    ones in a tree, without a shuffle; only those above ``segment_chars`` are dealt over tasks in segments.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    huge = F.coalesce(F.length("text"), F.lit(0)) > segment_chars
    encode, schema = _encode_texts(tokenizer_path, leaf_chars), "id long, ids array<int>"
    if decoded:
        _refuse_decoder(tokenizer_path)
        decode = _decoder(tokenizer_path, ["id", "ids"], 1)
        plain = docs.filter(~huge).mapInArrow(lambda batches: decode(encode(batches)), f"{schema}, decoded string")
    else:
        plain = docs.filter(~huge).mapInArrow(encode, schema)
    texts = docs.filter(huge).groupBy("id", "text").agg(F.count("*").alias("copies")).withColumn("digest", F.sha2("text", 256))
    last = F.floor((F.length("text") - 1) / segment_chars).cast("int")
    parts = texts.withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    parts = parts.select("id", "digest", "copies", "part", F.substring("text", F.col("part") * segment_chars + 1, F.lit(segment_chars)).alias("text"))
    encoded = parts.repartition("digest", "part").mapInArrow(
        _encode_segments(tokenizer_path, leaf_chars),
        "id long, digest string, copies long, part int, text string, ids array<int>, begins array<int>, ends array<int>")
    whole = encoded.groupBy("id", "digest").applyInArrow(_join_segments(tokenizer_path, leaf_chars, segment_chars), "id long, copies long, ids array<int>")
    again = whole.select("id", "ids", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("id", "ids")
    again = decode_ids(again, tokenizer_path) if decoded else again
    return plain.unionByName(again).withColumnRenamed("id", id_col)


def _decoder(path: str, columns: list[str], ids_at: int):
    """Adds ``text``: the tokens of the vocabulary one after the other with a blank between them, as the library
    writes ids of a tokenizer without decoder."""
    def run(batches):
        library = tokenizer(path)
        vocabulary = pa.array([library.id_to_token(i) for i in range(library.get_vocab_size())], pa.string())
        for batch in batches:
            ends = np.append(0, np.cumsum(batch.column(ids_at).value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64))
            start = 0
            while start < batch.num_rows:  # about DECODED_IDS ids at a time, one row at least
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + DECODED_IDS, "right")) - 1)
                part = batch.slice(start, stop - start)
                offsets = (ends[start:stop + 1] - ends[start]).astype(np.int32)
                tokens = vocabulary.take(part.column(ids_at).flatten())
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), tokens), " ")
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*columns, "decoded"])
                start = stop

    return run


def _refuse_decoder(path: str) -> None:
    if tokenizer(path).decoder is not None:
        raise ValueError("this tokenizer file has a decoder")


def decode_ids(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """The rows of ``encoded`` with ``decoded``: the text that the library's decode gives for their ids, special tokens
    included. Null or empty ids give an empty text. Only for tokenizer files without a decoder (else a ValueError)."""
    _refuse_decoder(tokenizer_path)
    columns = encoded.columns
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    return encoded.mapInArrow(_decoder(tokenizer_path, columns, columns.index(ids_col)), schema)
