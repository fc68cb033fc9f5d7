"""Token ids in bit-packed blocks.

File format. The token stream is the ids of all documents in ascending id order, each
document followed by the end id. It is cut into shards (ranges of document ids) and blocks
of whole documents: a block is closed once it has ``BLOCK_IDS`` ids. A written folder has

* ``blocks`` (Parquet): ``shard``, ``block``, ``first`` (ids before the block in its shard),
  ``n_ids``, ``bits``, ``payload``, ``doc_ids``, ``doc_ends`` (ids up to the end of each
  document, counted in the block). The payload holds each id in ``bits`` bits, the fewest that
  hold the vocabulary, least significant bit first, so id ``i`` stands at bit ``i * bits``.
* ``shards`` (Parquet): ``shard``, ``start`` (ids before the shard), ``n_ids``.

The place of every id follows from the offsets, so a range is read by unpacking only its
blocks (``read_range``), and unpacking is a vectorised reshape of bits.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.shingles import lean, slices
from tillstar.llm.tokens import RUN_BYTES, release_words, word_encoder

BLOCK_IDS = 65_536

BLOCK_SCHEMA = ("shard int, block long, first long, n_ids long, bits int, payload binary,"
                " doc_ids array<long>, doc_ends array<long>")
SHARD_SCHEMA = "shard int, start long, n_ids long"

ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
                   ("bits", pa.int32()), ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                   ("doc_ends", pa.list_(pa.int64()))])


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Unsigned ids below 2 ** bits (bits up to 32) in ``bits`` bits each."""
    plane = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=bits)
    return np.packbits(plane, bitorder="little").tobytes()


def unpack(payload: bytes, n: int, bits: int, start: int = 0) -> np.ndarray:
    """``n`` ids from id ``start`` on, reading only the bytes that hold them."""
    low = start * bits
    raw = np.frombuffer(payload, np.uint8, offset=low // 8, count=(low % 8 + n * bits + 7) // 8)
    plane = np.zeros((n, 32), np.uint8)
    plane[:, :bits] = np.unpackbits(raw, bitorder="little")[low % 8: low % 8 + n * bits].reshape(n, bits)
    return np.packbits(plane, axis=1, bitorder="little").view("<u4").ravel()


def _blocks(path: str, end_id: int, block_ids: int):
    """A function over one sorted partition (shard, id, text) that yields its blocks."""
    def run(batches):
        encoder = word_encoder(path)
        bits = max(1, (max(encoder.library.get_vocab_size(), end_id + 1) - 1).bit_length())
        end = np.array([end_id], "<u4")
        block = first = size = 0
        pieces, doc_ids, doc_ends = [], [], []

        def closed(shard):
            nonlocal block, first, size
            row = [shard], [block], [first], [size], [bits], [pack(np.concatenate(pieces), bits)], [list(doc_ids)], [list(doc_ends)]
            block, first, size = block + 1, first + size, 0
            pieces.clear(), doc_ids.clear(), doc_ends.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(row, ARROW)], schema=ARROW)

        shard = None
        for batch in slices(batches, 2, RUN_BYTES):
            for at, doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), encoder.encode(batch.column(2))):
                shard = at
                pieces += (ids, end)
                size += len(ids) + 1
                doc_ids.append(doc)
                doc_ends.append(size)
                if size >= block_ids:
                    yield closed(shard)
        if doc_ids:
            yield closed(shard)
        if lean():
            release_words(path)

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode every whole text and write the files of this format to ``folder`` (a path of Spark's file system).

    Null texts are empty (the end id alone); null ids come first; rows of one id are ordered by a digest of
    their text, then the text. The documents are range-partitioned by id and digest, so each task writes one shard in
    order and rows that share an id, or lack one, are dealt over tasks too. Texts are taken in slices of bounded size, a
    very long one alone; extra columns are left out; an empty table gives no block.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("digest", F.xxhash64("text"))
    placed = docs.repartitionByRange("id", "digest").sortWithinPartitions("id", "digest", "text")
    placed = placed.select(F.spark_partition_id().alias("shard"), "id", "text")
    placed.mapInArrow(_blocks(tokenizer_path, end_id, block_ids), BLOCK_SCHEMA).write.parquet(f"{folder}/blocks")
    spark = docs.sparkSession
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
    # One row per task of the write: the only thing that is gathered.
    sizes = sorted((r["shard"], r["n"]) for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    starts = np.cumsum([0, *(n for _, n in sizes)])
    spark.createDataFrame([(s, int(at), n) for (s, n), at in zip(sizes, starts)], SHARD_SCHEMA).coalesce(1).write.parquet(f"{folder}/shards")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks with ``start``, the ids before the block in the whole stream. The shard table has one row per write task."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{folder}/shards")
    return blocks.join(F.broadcast(shards.select("shard", "start")), "shard").withColumn("start", F.col("start") + F.col("first"))


def read_documents(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, and its ids (array) if asked."""
    def run(batches):
        for batch in batches:
            rows = [[] for _ in range(5)]
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["n_ids"], row["bits"])
                low = 0
                for doc, high in zip(row["doc_ids"], row["doc_ends"]):
                    part = ids[low:high]
                    for column, value in zip(rows, (doc, row["start"] + low, high - low, zlib.crc32(part), part if with_ids else None)):
                        column.append(value)
                    low = high
            arrays = [pa.array(c, pa.int64()) for c in rows[:4]]
            if with_ids:
                arrays.append(pa.array(rows[4], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(arrays)])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    columns = ("start", "n_ids", "bits", "payload", "doc_ids", "doc_ends")
    return _files(spark, folder).select(*columns).mapInArrow(run, schema)


def read_range(spark: SparkSession, folder: str, start: int, stop: int) -> np.ndarray:
    """The ids at places [start, stop) of the stream, from the blocks that hold them (random access; small ranges)."""
    hit = _files(spark, folder).filter((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))
    parts = [np.empty(0, "<u4")]
    for r in hit.orderBy("start").select("start", "n_ids", "bits", "payload").collect():
        low, high = max(start, r["start"]), min(stop, r["start"] + r["n_ids"])
        parts.append(unpack(bytes(r["payload"]), high - low, r["bits"], low - r["start"]))
    return np.concatenate(parts)

