"""Token counts of whole texts, with overlap resynchronisation for huge documents.

A huge text is encoded in chunks that overlap, with offsets. Two neighbouring encodings are
spliced where both agree on a stable boundary: a position after white space (no token, no
special string and no character composition reaches across it) from which both give the same
tokens up to a later position of that kind. Where an overlap holds none, it is doubled and the
chunk encoded again, up to the end of the text; so memory is bounded by a chunk, not the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.shingles import slices
from tillstar.llm.tokens import RUN_BYTES, SPACES, tokenizer, word_encoder

HUGE_CHARS = 32_768
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256


def _encoded(library, text: str, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and their absolute start offsets for one chunk."""
    found = library.encode(text[start:stop], add_special_tokens=False)
    offsets = np.array(found.offsets, np.int64).reshape(-1, 2)
    return np.array(found.ids, np.int64), offsets[:, 0] + start


def _boundaries(text: str, start: int, stop: int) -> list[int]:
    """Positions in (start, stop) that follow white space and begin a word."""
    return [p for p in range(start + 1, stop) if text[p - 1] in SPACES and text[p] not in SPACES]


def splice_point(text: str, left, right, start: int, stop: int) -> int | None:
    """The first boundary in the overlap [start, stop) from which both encodings agree up to a later boundary; None without one."""
    marks = _boundaries(text, start, stop)
    for here, there in zip(marks, marks[1:]):
        (a, at_a), (b, at_b) = left, right
        in_a, in_b = (at_a >= here) & (at_a < there), (at_b >= here) & (at_b < there)
        if in_a.any() and np.array_equal(a[in_a], b[in_b]) and np.array_equal(at_a[in_a], at_b[in_b]):
            return here
    return None


def count_chunked(library, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of ``text`` from overlapping chunks; equal to the count of one encoding of the whole."""
    total, start, trusted = 0, 0, 0
    while True:
        cut, width = start + chunk, overlap
        while True:
            stop = min(len(text), cut + width)
            left = _encoded(library, text, start, stop)
            if stop == len(text):
                return total + int((left[1] >= trusted).sum())
            right = _encoded(library, text, cut, stop)
            point = splice_point(text, left, right, cut, stop)
            if point is not None:
                break
            width *= 2
        total += int(((left[1] >= trusted) & (left[1] < point)).sum())
        start, trusted = cut, point


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, huge_chars: int = HUGE_CHARS) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit.

    Null and empty texts count zero bytes and tokens. Texts up to ``huge_chars`` characters are
    encoded at once (each distinct word once a worker), longer ones in overlapping chunks.
    No shuffle; ids may be null or repeat; extra columns are ignored.
    """
    def run(batches):
        encoder = word_encoder(tokenizer_path)
        for batch in slices(batches, 1, RUN_BYTES):
            texts = batch.column(1).fill_null("")
            huge = pc.greater(pc.utf8_length(texts), huge_chars)
            tokens = encoder.counts(pc.if_else(huge, "", texts))
            for i in np.flatnonzero(huge.to_numpy(zero_copy_only=False)).tolist():
                tokens[i] = count_chunked(encoder.library, texts[i].as_py())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(tokens, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = docs.mapInArrow(run, "id long, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
