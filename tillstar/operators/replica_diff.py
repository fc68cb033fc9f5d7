"""Where two replicas of a ledger differ, found by digests from coarse to fine.

Each replica is written in a layout (month partitions, sorted by node, day and bucket inside) with a small
digest table: per (node, day, bucket of ids) the rows, the sum of amounts and the exclusive
or of two row hashes. Digests add up, so those of a day and of a node come from the same
table. Two replicas are compared node by node; only the days of differing nodes are compared
next, only the buckets of differing days after them, and only the rows of differing buckets are read
and named. Equal parts cost their digests, not their rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.session import fresh_path

LEVELS = (("node_id",), ("node_id", "jour"), ("node_id", "jour", "seau"))
ROW = ("transaction_id", "montant", "statut")  # what two replicas must agree on
MONTH = "mois"
N_BUCKETS = 64
ROWS_SCHEMA = "node_id string, jour date, transaction_id long, montant decimal(18,2), statut string, seau int, mois int"
DIGEST_SCHEMA = "node_id string, jour date, seau int, n long, total decimal(28,2), x1 long, x2 long"


def bucket(id_col: str = "transaction_id", n: int = N_BUCKETS) -> Column:
    return F.pmod(F.col(id_col), F.lit(n)).cast("int")


def write_replica(ledger: DataFrame, root: str) -> str:
    """Rows (node_id, jour, transaction_id, montant, statut) in their layout, and their digests.

    Tasks get slices of (day, node, id), so a busy day or node is split; null days stand in a month of their own.
    """
    month = F.coalesce(F.year("jour") * 100 + F.month("jour"), F.lit(0)).cast("int")
    rows = ledger.select("node_id", "jour", "transaction_id", F.col("montant").cast("decimal(18,2)").alias("montant"), "statut",
                         bucket().alias("seau"), month.alias(MONTH))
    (rows.repartitionByRange("jour", "node_id", "transaction_id").sortWithinPartitions(MONTH, "node_id", "jour", "seau")
     .write.mode("errorifexists").partitionBy(MONTH).parquet(f"{root}/rows"))
    spark = ledger.sparkSession
    written = read_rows(spark, root)
    # The day is part of the hash, else a row on another day would leave its node's digest as it is.
    day = F.coalesce(F.unix_date("jour"), F.lit(1 << 30))
    hashes = [F.bit_xor(F.xxhash64(F.lit(seed), day, *ROW)).alias(name) for seed, name in ((1, "x1"), (2, "x2"))]
    (written.groupBy(*LEVELS[-1]).agg(F.count(F.lit(1)).alias("n"), F.sum("montant").alias("total"), *hashes)
     .write.mode("errorifexists").parquet(f"{root}/digests"))
    return root


def read_rows(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(ROWS_SCHEMA).parquet(f"{root}/rows")


def read_digests(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(DIGEST_SCHEMA).parquet(f"{root}/digests")


def rolled_up(digests: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return digests.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))


def _null_safe(keys: tuple[str, ...], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}")) for k in keys])


def _side_by_side(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Full outer join with columns ``a_*`` and ``b_*``; nulls among the keys are equal."""
    a, b = (df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns]) for df, side in ((a, "a"), (b, "b")))
    return a.join(b, _null_safe(keys, "a_", "b_"), "full_outer")


def _either(keys: tuple[str, ...]) -> list[Column]:
    return [F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys]


def _within(parts: DataFrame, parents: DataFrame | None, keys: tuple[str, ...]) -> DataFrame:
    """The rows of ``parts`` whose keys are among those of ``parents`` (all of them without parents)."""
    if parents is None:
        return parts
    named = parents.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return parts.join(named, _null_safe(keys, "", "_"), "left_semi")


def differing(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The keys whose digests differ, or that one side lacks; with both counts and the gap of the sums."""
    both = _side_by_side(rolled_up(a, keys), rolled_up(b, keys), keys)
    gap = F.coalesce("a_total", F.lit(0)) - F.coalesce("b_total", F.lit(0))
    return both.filter(~_null_safe(("n", "total", "x1", "x2"), "a_", "b_")).select(
        *_either(keys), F.coalesce("a_n", F.lit(0)).alias("n_a"), F.coalesce("b_n", F.lit(0)).alias("n_b"), gap.alias("ecart"))


def descend(a: DataFrame, b: DataFrame) -> list[DataFrame]:
    """The differing nodes, days and buckets of two digest tables; a level looks at children of differing parents only."""
    out, parents, above = [], None, ()
    for keys in LEVELS:
        found = differing(_within(a, parents, above), _within(b, parents, above), keys)
        out.append(found)
        parents, above = found.select(*keys), keys
    return out


def level_report(levels: list[DataFrame]) -> DataFrame:
    """Per level: differing parts, the rows in them on either side and the gap of their sums."""
    names = ("noeud", "jour", "seau")
    return reduce(DataFrame.unionByName, [
        found.agg(F.count(F.lit(1)).alias("nb_differents"), F.coalesce(F.sum("n_a"), F.lit(0)).cast("bigint").alias("lignes_a"),
                  F.coalesce(F.sum("n_b"), F.lit(0)).cast("bigint").alias("lignes_b"),
                  F.coalesce(F.sum("ecart"), F.lit(0)).cast("double").alias("ecart")).withColumn("niveau", F.lit(name))
        for name, found in zip(names, levels)]).select("niveau", "nb_differents", "lignes_a", "lignes_b", "ecart")


def in_folders(rows: DataFrame, folders: dict[int, list[str | None]]) -> DataFrame:
    """The rows of some months (a static partition filter) and of their nodes, by which Parquet skips row groups."""
    nodes = {n for names in folders.values() for n in names}
    named = F.col("node_id").isin([n for n in nodes if n is not None])
    held = rows.filter(F.col(MONTH).isin(sorted(folders)))
    return held.filter(named | F.col("node_id").isNull() if None in nodes else named)


def rows_of(rows: DataFrame, buckets: DataFrame, folders: dict[int, list[str | None]]) -> DataFrame:
    """The rows of some buckets; ``folders``: the months and nodes that hold them. The layout keeps a bucket's rows together."""
    return _within(in_folders(rows, folders), buckets, LEVELS[-1])


def folders_of(buckets: DataFrame) -> dict[int, list[str | None]]:
    """Months and nodes of differing buckets: nodes times calendar months at most, so they may reach the driver."""
    month = F.coalesce(F.year("jour") * 100 + F.month("jour"), F.lit(0)).cast("int")
    out: dict[int, list[str | None]] = {}
    for r in buckets.select("node_id", month.alias(MONTH)).distinct().collect():
        out.setdefault(r[MONTH], []).append(r["node_id"])
    return out


def differing_rows(spark: SparkSession, root_a: str, root_b: str) -> DataFrame:
    """The transactions behind the differences: node, day, id, kind, and number and sum of its rows on either side.

    Kinds: absent_a, absent_b, montant (the sums differ), lignes (repeated on one side), contenu (anything else differs). An id may repeat in a replica:
    its rows are taken together. A row whose day changed is absent once on each side.
    """
    path = fresh_path(spark, "differing-buckets")
    descend(read_digests(spark, root_a), read_digests(spark, root_b))[-1].select(*LEVELS[-1]).write.parquet(path)
    buckets = spark.read.parquet(path)  # read three times
    folders = folders_of(buckets)
    keys = ("node_id", "jour", "transaction_id")

    def per_id(root: str) -> DataFrame:
        held = rows_of(read_rows(spark, root), buckets, folders)
        return held.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("montant").alias("total"), F.bit_xor(F.xxhash64(*ROW)).alias("x"))

    both = _side_by_side(per_id(root_a), per_id(root_b), keys)
    kind = (F.when(F.col("a_n").isNull(), "absent_a").when(F.col("b_n").isNull(), "absent_b").when(~F.col("a_total").eqNullSafe(F.col("b_total")), "montant")
            .when(F.col("a_n") != F.col("b_n"), "lignes").when(F.col("a_x") != F.col("b_x"), "contenu"))
    gap = F.coalesce("a_total", F.lit(0)) - F.coalesce("b_total", F.lit(0))
    return both.withColumn("ecart_type", kind).filter("ecart_type is not null").select(
        *_either(keys), "ecart_type", F.coalesce("a_n", F.lit(0)).alias("lignes_a"), F.coalesce("b_n", F.lit(0)).alias("lignes_b"),
        F.col("a_total").cast("double").alias("montant_a"), F.col("b_total").cast("double").alias("montant_b"), gap.cast("double").alias("ecart"))
