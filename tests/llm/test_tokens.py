import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillstar.llm.queries import op7_token_counts, op10_token_output
from tillstar.llm.token_count import count_chunked, token_counts
from tillstar.llm.token_output import pack, read_documents, read_range, unpack, write_token_files
from tillstar.llm.tokens import word_encoder
from tillstar.session import fresh_path

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(PATH)

TEXT = st.text(alphabet=st.sampled_from(list("aábBHT ̱̈'s.,!\n\t\x1c  é<|>endoftxŁ字1K")), max_size=80)


def direct(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_word_encoder_equals_library(text):
    texts = pa.array([text, None, "", text + " x"])
    assert [ids.tolist() for ids in word_encoder(PATH).encode(texts)] == [direct(t) for t in texts.to_pylist()]
    assert word_encoder(PATH).counts(texts).tolist() == [len(direct(t)) for t in texts.to_pylist()]


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=12), st.integers(5, 60), st.integers(1, 20))
def test_chunks_equal_one_encoding(parts, chunk, overlap):
    text = " x ".join(parts)
    assert count_chunked(LIBRARY, text, chunk, overlap) == len(direct(text))


def test_chunks_widen_over_a_word_longer_than_the_overlap():
    text = "ab cd " * 50 + "z" * 500 + " ef" * 40 + "<|endoftext|>" * 9
    assert count_chunked(LIBRARY, text, 64, 8) == len(direct(text))


@given(st.lists(st.integers(0, 2**17 - 1)), st.integers(17, 32), st.data())
def test_packing_round_trip_and_random_access(ids, bits, data):
    ids = np.array(ids, "<u4")
    payload = pack(ids, bits)
    assert unpack(payload, len(ids), bits).tolist() == ids.tolist()
    low = data.draw(st.integers(0, len(ids)))
    n = data.draw(st.integers(0, len(ids) - low))
    assert unpack(payload, n, bits, low).tolist() == ids[low:low + n].tolist()


def odd_docs(spark):
    rows = [(3, "The cat", "n"), (1, None, "n"), (2, "", "n"), (None, "lost id", "n"), (3, "The cat", "n"), (5, "w" * 40000 + " end", "n"),
            (4, "It's  naïve <|endoftext|>x", "n")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_counts_on_odd_rows(spark):
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(odd_docs(spark), PATH).collect())
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(direct(r.text)), len(direct(r.text)) > 2048) for r in odd_docs(spark).collect())
    assert got == want


def expected(docs):
    out, start = [], 0
    for r in sorted(docs, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")):
        ids = np.array(direct(r.text) + [1], "<u4")
        out.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block_ids", [1, 50, 1 << 16])
def test_files_on_odd_rows(spark, block_ids):
    folder = fresh_path(spark, "t")
    write_token_files(odd_docs(spark), folder, PATH, 1, block_ids=block_ids)
    want = expected(odd_docs(spark).collect())
    got = [tuple(r)[:4] for r in read_documents(spark, folder, with_ids=True).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    stream = [i for r in sorted(read_documents(spark, folder, with_ids=True).collect(), key=lambda r: r.start) for i in r.ids]
    assert read_range(spark, folder, 2, 9).tolist() == stream[2:9]
    assert read_range(spark, folder, 0, len(stream) + 5).tolist() == stream


def test_empty_tables(spark):
    empty = odd_docs(spark).limit(0)
    assert token_counts(empty, PATH).count() == 0
    folder = fresh_path(spark, "t")
    write_token_files(empty, folder, PATH, 1)
    assert read_documents(spark, folder).count() == 0 and len(read_range(spark, folder, 0, 5)) == 0


def test_queries_equal_the_library(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = {r.doc_id: len(direct(r.text)) for r in docs}
    assert {r.doc_id: r.n_tokens for r in op7_token_counts(spark, SMALL).collect()} == want
    assert sorted(map(tuple, op10_token_output(spark, SMALL).collect()), key=lambda r: r[1]) == expected(docs)


def test_tokenizers_that_keep_case_and_spaces_are_used_on_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, texts = Tokenizer.from_file(path), ["The  Cat's\n on it", "", "THE cat", None]
    encoder = word_encoder(path)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert not encoder.by_words and word_encoder(PATH).by_words
    assert [ids.tolist() for ids in encoder.encode(pa.array(texts))] == want
    assert encoder.counts(pa.array(texts)).tolist() == [len(ids) for ids in want]


def test_lean_tasks_of_a_worker_share_the_tokenizer_and_forget_the_words(monkeypatch):
    import tillstar.llm.token_output as output
    import tillstar.llm.tokens as tokens
    monkeypatch.setattr(output, "lean", lambda: True)
    loaded = tokens.tokenizer(PATH)
    for text in ["one two three", "four five", "one six"]:
        rows = pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([7]), pa.array([text])], names=["shard", "id", "text"])
        blocks = [b.to_pylist()[0] for b in output._blocks(PATH, 1, 64)([rows])]
        assert [unpack(b["payload"], b["n_ids"], b["bits"]).tolist() for b in blocks] == [[*direct(text), 1]]
        assert tokens.tokenizer(PATH) is loaded and word_encoder(PATH).library is loaded
        assert len(word_encoder(PATH).words) == 0


def test_a_full_memory_starts_anew(monkeypatch):
    import tillstar.llm.tokens as tokens
    monkeypatch.setattr(tokens, "MAX_CACHED_BYTES", 200)
    encoder = tokens.WordEncoder(PATH)
    for text in ["one two three four five six", "seven eight nine ten " * 9, "one two 11 12 13 14 15", "x y z " * 40]:
        assert [ids.tolist() for ids in encoder.encode(pa.array([text]))] == [direct(text)]


def test_rows_of_one_id_are_dealt_over_shards(spark):
    rows = [(None if i % 2 else 7, f"text number {i}") for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    folder = fresh_path(spark, "t")
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), folder, PATH, 1)
    out = read_documents(spark, folder, with_ids=True).collect()
    assert sorted((r.doc_id or -1, list(r.ids)) for r in out) == sorted((d or -1, direct(t) + [1]) for d, t in rows)
    assert sorted(r.start for r in out) == np.cumsum([0] + [r.n_tokens for r in sorted(out, key=lambda r: r.start)])[:-1].tolist()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = spark.read.parquet(f"{folder}/shards")
    assert shards.count() >= 4 and shards.agg({"n_ids": "max"}).first()[0] < 0.6 * sum(r.n_tokens for r in out)
