"""Word and word-shingle hashing shared by the text operators (runs inside tasks)."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext

MAX_CACHED_WORDS, LEAN_WORDS = 150_000, 40_000
SLICE_BYTES, LEAN_BYTES = 4 << 20, 1 << 20
LEAN = "tillstar.lean"

#: ASCII capitals to small letters; other ASCII that is no letter or digit to a space; bytes of longer characters stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LEFT = np.uint64(0x9E3779B97F4A7C15)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (a bijection), so that every bit of the result depends on every bit of x."""
    x = (x ^ (x >> _S30)) * _MIX1
    x = (x ^ (x >> _S27)) * _MIX2
    return x ^ (x >> _S31)


class WordHashes(dict):
    """word -> 64-bit hash, remembered per worker up to ``most`` words."""

    most = MAX_CACHED_WORDS

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = WordHashes()


def folded_words(text: bytes | None) -> list[bytes]:
    """Runs of letters and digits, ASCII in lower case; null has none."""
    return text.translate(FOLD).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """One hash per window of ``size`` words, in text order; a shorter non-empty sequence is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    width = min(size, len(h))
    acc = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        acc = mix(acc * _LEFT + h[k: len(h) - width + 1 + k])
    return acc


def slices(batches, text_column: int, size: int = SLICE_BYTES):
    """The batches cut into runs of rows with about ``size`` bytes of text, one row at least, so that what
    Python holds at a time does not depend on the batch size. A lean task holds less text and fewer word hashes."""
    if lean():
        size, _hashes.most = min(size, LEAN_BYTES), LEAN_WORDS
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(text_column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(start, stop - start)
            start, done = stop, ends[stop - 1]
            pa.default_memory_pool().release_unused()  # else Arrow keeps the largest run's memory for good
    if lean():
        _hashes.clear()
        _hashes.most = MAX_CACHED_WORDS
        release_memory()


def lean() -> bool:
    """Whether this task belongs to a chain of operators that asked for small workers (the local property ``LEAN`` of its job)."""
    context = TaskContext.get()
    return context is not None and context.getLocalProperty(LEAN) == "true"


def release_memory() -> None:
    """Return freed memory to the system; else an idle worker keeps what its largest task took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def binary_values(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def long_lists(arrays: list[np.ndarray]) -> pa.Array:
    """An Arrow list<int64> column from one integer array per row."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
