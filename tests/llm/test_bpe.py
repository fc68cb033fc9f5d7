import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillstar.llm.bpe import TreeEncoder, decode_ids, encode_texts
from tillstar.llm.queries import op12_bpe_codec

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(PATH)

PIECES = st.sampled_from([*"aábBHTS ̱̈'s.,!\n\t\x1c  é<|>rvelldmt字1K가각ſİ", "<|endoftext|>", "the", "ing", "'re", "'"])


def direct(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=60).map("".join), max_size=3), st.integers(1, 20), st.integers(1, 4), st.integers(1, 6))
def test_tree_equals_library_wherever_it_cuts(texts, leaf, window, edge):
    assert [e.ids.tolist() for e in TreeEncoder(PATH, leaf, window, edge).encode(texts)] == [direct(t) for t in texts]


@pytest.mark.parametrize("text", [
    "a" * 5000, "ab" * 3000, "!?" * 2000, "'" * 999, "<|endoftext|>" * 300, "́" * 400, "e" + "́" * 400 + "x", "don't we've I'll " * 300, " " * 3000,
    "".join(random.Random(5).choices("abcdefgh", k=6000)), "".join(random.Random(6).choices("the in'sre!", k=6000))])
def test_unsplit_text_of_any_length(text):
    tree = TreeEncoder(PATH, 64, 1)
    assert tree.encode([text])[0].ids.tolist() == direct(text)
    assert tree.joins > 0


ROWS = [(1, None), (2, ""), (3, "The Cat's <|endoftext|> naïve"), (None, "no id"), (4, "y" * 3000 + " end"), (4, "y" * 3000 + " end"),
        (5, " ".join(f"word{i}'s" for i in range(900))), (None, "z'" * 1500), (6, "café " * 400), (7, "same"), (7, "same")]


@pytest.mark.parametrize("leaf, segment", [(16, 100), (64, 1 << 20), (50, 50), (8192, 1 << 20)])
def test_rows_and_segments(spark, leaf, segment):
    docs = spark.createDataFrame([(i, t, 1, "d") for i, t in ROWS], "doc_id long, text string, ids int, decoded string")
    out = decode_ids(encode_texts(docs, PATH, leaf_chars=leaf, segment_chars=segment), PATH).collect()
    once = encode_texts(docs, PATH, leaf_chars=leaf, segment_chars=segment, decoded=True).collect()
    assert sorted(map(str, once)) == sorted(map(str, out))
    want = [(i, direct(t), LIBRARY.decode(direct(t), skip_special_tokens=False)) for i, t in ROWS]
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in out), key=str) == sorted(want, key=str)


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").limit(0)
    assert decode_ids(encode_texts(docs, PATH), PATH).count() == 0
    rows = spark.createDataFrame([(1, None), (2, []), (3, [49407, 5])], "k int, ids array<int>")
    assert sorted((r.k, r.decoded) for r in decode_ids(rows, PATH).collect()) == [(1, ""), (2, ""), (3, LIBRARY.decode([49407, 5], skip_special_tokens=False))]


def test_other_decoders_are_refused(spark):
    with pytest.raises(ValueError):
        decode_ids(spark.createDataFrame([([1],)], "ids array<int>"), public_tokenizers.path("byte_bpe_50k.json"))


def test_query_equals_the_library(spark):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = {r.doc_id: (len(i := direct(r.text)), sha(" ".join(map(str, i))), sha(LIBRARY.decode(i, skip_special_tokens=False))) for r in docs}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op12_bpe_codec(spark, SMALL).collect()} == want
