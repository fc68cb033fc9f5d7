"""Encoding of whole texts inside tasks with a public tokenizer file."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillstar.llm.shingles import lean, release_memory

SPACES = " \t\n\v\f\r"
MAX_CACHED_BYTES, LEAN_CACHED_BYTES = 12 << 20, 3 << 20  # of remembered words and their ids; looking words up takes a few times that for a moment
LIBRARY_BATCH = 5_000
RUN_BYTES = 8 << 20  # of text whose words are numbered at a time
SEPARATORS = ("§", "¶", "†", "※", "•", "|")
PROBE = "the Cat's sat , on it . a1b2 (re)do don't 12 naïve 'll x! ?! zq"


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker. Spark's tasks are the parallelism, so the library uses one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _parts(words: pa.Array) -> list[pa.Array]:
    """Words as a part to look up and a mark after it (or nothing). ASCII words are folded to small letters, as the
    tokenizer does itself, and lose one final mark after a letter, which is always a token of its own. Words that
    may hold a special string, and all others, stay whole."""
    plain = pc.and_(pc.equal(pc.utf8_length(words), pc.binary_length(words)), pc.invert(pc.match_substring(words, "<|")))
    words = pc.if_else(plain, pc.ascii_lower(words), words)
    marked = pc.and_(plain, pc.match_substring_regex(words, "[a-z][.,!?;:]$"))
    return [pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words), pc.if_else(marked, pc.utf8_slice_codeunits(words, -1), "")]


class WordEncoder:
    """Encodes texts word by word, each distinct word once.

    Right for tokenizers that fold case and drop white space (no token holds any, and none depends on its
    neighbours across it), as the word-level BPE does: the ids of a text are then those of
    its words in turn. Words stand between ASCII white space. Arrow numbers the words of a run of
    texts and finds the remembered ones; new words go to the library many at a time, as one text
    with a separator between them: a symbol that is one id and that no word of that text holds.
    Remembered words (an Arrow array) and their ids (one flat array) are bounded in bytes; of a full memory the words of the run at hand stay.
    A tokenizer that fails a probe of this property is used on whole texts instead.
    """

    def __init__(self, path: str):
        self.library = tokenizer(path)
        alone = ((mark, self._ids([mark])[0]) for mark in SEPARATORS)
        self.mark, self.mark_id = next(((m, ids[0]) for m, ids in alone if len(ids) == 1), (None, None))
        self.by_words = self.mark is not None and self._splits_at_spaces()
        self.forget()

    def _splits_at_spaces(self) -> bool:
        """Whether the library gives a probe of many kinds of words the ids of its words in turn, folded or not."""
        words = PROBE.split()
        whole, upper, *alone = self._ids([PROBE.replace(" ", " \n\t "), PROBE.upper(), *words])
        return whole == [i for ids in alone for i in ids] and upper == self._ids([PROBE.lower()])[0]

    def forget(self) -> None:
        self.words, self.flat, self.sizes = pa.array([], pa.string()), np.empty(0, "<u4"), np.empty(0, np.int64)

    def _keep(self, places: pa.Array) -> None:
        """Forget all words but these: what a run of texts uses again is common, most others are not."""
        rows = places.to_numpy(zero_copy_only=False)
        self.words = pa.concat_arrays([self.words.take(places)])
        self.flat, self.sizes = _gather(self.flat, self.sizes, rows), self.sizes[rows]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: pa.Array) -> None:
        """Remember new words and their ids."""
        held = pc.match_substring(new, self.mark)
        plain, rest = new.filter(pc.invert(held)), new.filter(held)
        flat, sizes = [self.flat], [self.sizes]
        for at in range(0, len(plain), LIBRARY_BATCH):
            part = plain.slice(at, LIBRARY_BATCH)
            text = pc.binary_join(pa.ListArray.from_arrays([0, len(part)], pa.concat_arrays([part])), f" {self.mark} ")[0].as_py()
            ids = np.array(self._ids([f"{text} {self.mark}"])[0], "<u4")
            is_mark = ids == self.mark_id
            size = np.diff(np.flatnonzero(is_mark), prepend=-1) - 1
            if len(size) != len(part):
                raise ValueError("the ids of words depend on their neighbours")
            flat.append(ids[~is_mark])
            sizes.append(size)
        for ids in self._ids(rest.to_pylist()):
            flat.append(np.array(ids, "<u4"))
            sizes.append(np.array([len(ids)]))
        self.words = pa.concat_arrays([self.words, plain, rest])
        self.flat, self.sizes = np.concatenate(flat), np.concatenate(sizes)

    def _numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of every word of the texts in turn, the end of each text among them (null: no words), and for
        each number the remembered places of its two parts."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = split.flatten().dictionary_encode()
        parts = pa.concat_arrays(_parts(words.dictionary)).dictionary_encode()
        distinct = parts.dictionary
        found = pc.index_in(distinct, value_set=self.words)
        if self.words.nbytes + self.flat.nbytes + self.sizes.nbytes > (LEAN_CACHED_BYTES if lean() else MAX_CACHED_BYTES):
            self._keep(found.drop_null())
            found = pc.index_in(distinct, value_set=self.words)
        if found.null_count:
            self._learn(distinct.filter(pc.is_null(found)))
            found = pc.index_in(distinct, value_set=self.words)
        places = found.to_numpy(zero_copy_only=False)[parts.indices.to_numpy(zero_copy_only=False)]
        ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        return words.indices.to_numpy(zero_copy_only=False), ends, places.reshape(2, -1).T

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        if not self.by_words:
            return np.array([len(ids) for ids in self._ids(texts.fill_null("").to_pylist())], np.int64)
        numbers, ends, places = self._numbered(texts)
        sums = np.concatenate([[0], np.cumsum(self.sizes[places].sum(axis=1)[numbers])])
        return np.diff(sums[ends], prepend=0)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text in turn (unsigned 32-bit)."""
        if not self.by_words:
            yield from (np.array(ids, "<u4") for ids in self._ids(texts.fill_null("").to_pylist()))
            return
        numbers, ends, places = self._numbered(texts)
        flat = _gather(self.flat, self.sizes, places.ravel())  # the ids of each distinct word
        sizes, begin = self.sizes[places].sum(axis=1), 0
        starts = np.cumsum(sizes) - sizes
        for end in ends.tolist():
            yield _gather(flat, sizes, numbers[begin:end], starts)
            begin = end


def _gather(flat: np.ndarray, sizes: np.ndarray, rows: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Rows of a flat array of lists, one after the other."""
    starts = np.cumsum(sizes) - sizes if starts is None else starts
    size = sizes[rows]
    return flat[np.arange(size.sum()) + np.repeat(starts[rows] - (np.cumsum(size) - size), size)]


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def release_words(path: str) -> None:
    """Give back the words this worker remembers for a tokenizer file. The tokenizer itself (some 15 MB) stays: the library keeps
    almost 4 MB of every one that has encoded and is loaded again, so a worker would grow with its tasks."""
    word_encoder(path).forget()
    release_memory()
