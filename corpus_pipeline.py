"""From raw documents to token files: quality rules, near-duplicates, benchmark leaks, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the
last return the columns of ``documents`` (and any further ones the table has, whatever their names). ``run`` writes
each stage to the shared folder, and removes what no later stage reads. An empty table passes through; texts of any length are taken whole.

A row is told from others by a key of its id and text, so documents that share an id but not the text, and those without id, are
judged, kept and taken each by itself. Rows equal in both are one document: the second stage keeps one of them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.decontaminate import contaminated
from tillstar.llm.mixing import mix
from tillstar.llm.near_dedup import near_duplicates
from tillstar.llm.quality_rules import quality_rules
from tillstar.llm.selection import without
from tillstar.llm.shingles import LEAN
from tillstar.llm.storage import materialise, scratch
from tillstar.llm.token_output import read_documents, write_token_files
from tillstar.session import fresh_path, remove_path

TOKENIZER, END_ID = "word_bpe_49k.json", 1


KEY = "row_key"


def _small_workers(spark: SparkSession) -> None:
    """Five operators follow one another in the same executors: texts go to Python in batches of a few megabytes, and a
    worker gives its memory back after each task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.sparkContext.setLocalProperty(LEAN, "true")


def _renamed(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns under names of its own (p0, p1, ...) and a key of id and text, so that no column of the table
    can clash with one an operator makes; and those names of the ``needed`` columns."""
    _small_workers(docs.sparkSession)
    names = {c: f"p{i}" for i, c in enumerate(docs.columns)}
    out = docs.select(*[F.col(c).alias(p) for c, p in names.items()])
    return out.withColumn(KEY, F.xxhash64(names["doc_id"], names["text"])), [names[c] for c in needed]


def _restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"p{i}").alias(c) for i, c in enumerate(docs.columns)])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host is not rejected; empty and null texts fail, equal rows are judged alike."""
    rows, (doc_id, text, source) = _renamed(docs, "doc_id", "text", "source")
    carry = [c for c in rows.columns if c != KEY]
    return _restored(quality_rules(rows, id_col=doc_id, text_col=text, host_col=source, carry=carry).filter("kept"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id (one without id only if all lack it) of each group linked by 5-word shingles at similarity 0.8.
    Null and empty texts are linked with nothing; of rows equal in id and text one stays."""
    rows, (doc_id, text) = _renamed(docs, "doc_id", "text")
    groups = materialise(near_duplicates(rows, id_col=KEY, text_col=text, shingle=5, num=80, den=100), "stage-groups", narrow=True)
    keys = materialise(groups.groupBy(KEY).agg(F.count("*").alias("n"), F.min("component_id").alias("component")), "stage-keys", narrow=True)
    several = keys.groupBy("component").agg(F.count("*").alias("keys")).filter("keys > 1").select("component")
    members = keys.join(several, "component").select(KEY, "component")
    ids = rows.select(F.col(KEY).alias("of"), F.col(doc_id).alias("id"))
    ranked = members.join(ids, F.col(KEY) == F.col("of")).select("component", F.struct(F.col("id").isNull(), "id", KEY).alias("rank"), KEY)
    best = ranked.groupBy("component").agg(F.min("rank").alias("best"))
    gone = members.join(best, "component").filter(F.col(KEY) != F.col(f"best.{KEY}")).select(KEY)
    return _restored(without(rows, KEY, gone, keys.filter("n > 1").select(KEY), same=(doc_id, text)), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold at least half the words of no benchmark item; null and empty texts hold none."""
    rows, (text,) = _renamed(docs, "text")
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return _restored(without(rows, KEY, contaminated(rows, benchmark, id_col=KEY, text_col=text).select(KEY)), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; those without words are never taken. Of rows equal in id and text, all
    are taken as the most taken one."""
    rows, (text, source) = _renamed(docs, "text", "source")
    copies = (mix(rows, id_col=KEY, text_col=text, source_col=source, weights=(3, 1, 2), share=1.5, max_repeat=2).filter("copies > 0")
              .groupBy(F.col(KEY).alias("taken_key")).agg(F.max("copies").cast("int").alias("copies")))
    taken = rows.join(copies, F.col(KEY) == F.col("taken_key"))
    return _restored(taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32 of each document; null ids first, a text without words is
    the end id alone."""
    folder = fresh_path(spark, "corpus-tokens")
    _small_workers(spark)
    write_token_files(docs, folder, public_tokenizers.path(TOKENIZER), END_ID)
    return read_documents(spark, folder)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_output", write_tokens),
]

ORACLE_SQL = None  # SQL has no tokenizer and no seeded choice of documents


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; a stage's tables, and its input if that is the output of the stage before, are removed once its output stands."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        with scratch(spark) as tables:
            docs = stage(spark, docs, sf_dir)
            if name != STAGES[-1][0]:  # the last stage has written its files
                docs = materialise(docs, name)
                output = tables.pop()
        if before:
            remove_path(spark, before)
        before = output
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
