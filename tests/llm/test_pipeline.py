"""Every stage on its own input, against a plain computation."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tillstar.llm.quality_rules import measure
from tillstar.llm.storage import materialise, scratch
from tillstar.session import work_root

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SMALL)
        assert stage is corpus_pipeline.write_tokens or result.columns == docs.columns
        out.append(result.collect())
        docs = spark.createDataFrame(out[-1], result.schema)
    return out


def test_quality_stage(stages):
    want = {r.doc_id for r in stages[0] if (m := measure(r.text))[0] >= 50 and 2 * m[4] <= m[0]}
    assert {r.doc_id for r in stages[1]} == want  # no host of this table fails by half


def test_near_dedup_stage(stages):
    sets = {}
    for r in stages[1]:
        w = r.text.encode().lower().split()
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    kept, label = set(), {d: d for d in sets}
    ids = sorted(sets)
    for _ in ids:
        for a in ids:
            for b in ids:
                if a < b and label[a] != label[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if all(label[label[d]] == label[d] for d in ids):
            break
    kept = {d for d in ids if label[d] == d}
    assert sorted(r.doc_id for r in stages[2]) == sorted(kept)


def test_decontamination_stage(stages, spark):
    items = [r.text.split() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in stages[2] if any(" ".join(i) in " ".join(r.text.split()) for i in items)}
    before, after = {r.doc_id for r in stages[2]}, {r.doc_id for r in stages[3]}
    assert whole and not whole & after and before - after == whole


def test_mix_stage(stages):
    texts = {r.doc_id: r for r in stages[3]}
    copies = {}
    for r in stages[4]:
        assert texts[r.doc_id] == r
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 2
    words = sum(len(r.text.encode().split()) for r in stages[4]) / sum(len(r.text.encode().split()) for r in stages[3])
    assert abs(words - 1.5) < 0.05


def test_token_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for r in sorted(stages[4], key=lambda r: r.doc_id):
        ids = np.array(library.encode(r.text, add_special_tokens=False).ids + [1], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, stages[5]), key=lambda r: r[1]) == want


def test_stages_on_empty_and_odd_documents(spark):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    long = " ".join(f"w{i}" for i in range(80))
    odd = [(None, long, "en", "a", 1), (1, None, None, None, None), (2, "", "en", "a", 0), (3, long, "en", None, 5), (3, long, "en", None, 5), (4, long + " end", "en", "b", 5)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, SMALL)
            docs = spark.createDataFrame(result.collect(), result.schema)
        assert {r.doc_id for r in docs.collect()} <= {3}
        assert bool(rows) == bool(docs.count())


def test_run_equals_the_stages_and_leaves_the_token_files_alone(spark, stages):
    folder = work_root(spark).removeprefix("file:") + "/tillstar"
    before = set(os.listdir(folder))
    result = corpus_pipeline.run(spark, SMALL)
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} == {"corpus-tokens"}
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, stages[5]))


def test_scratch_tables_go_even_after_an_error(spark):
    folder = work_root(spark).removeprefix("file:") + "/tillstar"
    before = set(os.listdir(folder))
    with pytest.raises(KeyError), scratch(spark) as tables:
        kept = materialise(spark.range(3), "kept")
        tables.pop()
        materialise(spark.range(5), "lost")
        raise KeyError
    assert kept.count() == 3 and {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} == {"kept"}
    materialise(spark.range(2), "outside")


CLASHING = "size int, id string, kept int, n_words int, gone string, copy int, row_key long, same int, p0 int, text_ string"


def test_stages_carry_columns_with_any_name(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [f.split()[0] for f in CLASHING.split(", ")]
    wide = docs.select("*", *[F.lit(i).cast(f.split()[1]).alias(f.split()[0]) for i, f in enumerate(CLASHING.split(", "))])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain, wide = (df.sparkSession.createDataFrame(stage(spark, df, SMALL).collect(), df.schema) for df in (docs, wide))
        assert sorted(r.doc_id for r in plain.collect()) == sorted(r.doc_id for r in wide.collect())
        assert {tuple(r[n] for n in names) for r in wide.collect()} == {tuple(str(i) if f.split()[1] == "string" else i for i, f in enumerate(CLASHING.split(", ")))}
        docs = plain
    assert corpus_pipeline.write_tokens(spark, wide, SMALL).count() == docs.count()


def test_no_document_is_lost_for_its_id(spark):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    text = lambda n: " ".join(f"{chr(97 + n)}{i}x{i * 7 % 13}" for i in range(100))
    rows = [(1, text(0), "en", "a", 1), (1, text(1), "en", "a", 1), (None, text(2), "en", "a", 1), (None, text(3), "en", "b", 1), (2, text(4), "en", None, 1),
            (2, text(4), "en", None, 1), (None, text(0) + " more", "en", "a", 1), (3, None, "en", "a", 1)]
    docs = spark.createDataFrame(rows, schema)
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["near_dedup"](spark, docs, SMALL).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept) == sorted((str(d), t or "") for d, t, *_ in rows[:5] + rows[7:])
    kept = stage["decontamination"](spark, docs, SMALL).collect()
    assert len(kept) == len(rows)
    leak = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    leaky = spark.createDataFrame([(None, leak, "en", "a", 1), (7, leak, "en", "a", 1), (7, text(5), "en", "a", 1), (None, text(6), "en", "a", 1)], schema)
    assert sorted(r.text for r in stage["decontamination"](spark, leaky, SMALL).collect()) == [text(5), text(6)]
    mixed = stage["source_mix"](spark, docs.filter("text is not null"), SMALL).collect()
    assert {str(r.doc_id) for r in mixed} == {"1", "2", "None"} and len({r.text for r in mixed}) >= 5
    tokens = stage["token_output"](spark, docs, SMALL).collect()
    assert sorted(str(r.doc_id) for r in tokens) == sorted(str(d) for d, *_ in rows)
