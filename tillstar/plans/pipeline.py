"""Batch load job: text staging -> checked star schema written as Parquet.

The run order of the source warehouse's scripts as one Spark driver program: staging files are
written and read back with their declared schemas; dimensions are built with their
unknown members; rows are counted by the writes themselves (no table is read again for it); natural keys (what the fact joins on) and transaction ids are asserted
unique, as a repeated key would fan the fact out; the fact is written in its month layout;
rows dropped for an unknown node are counted, and one fact row per kept staging row is asserted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar.operators import quality
from tillstar.operators.observed import REPORT_SCHEMA, ROWS, observed_write
from tillstar.operators.star import (Star, build_dim_agency, build_dim_merchant, build_dim_node, build_dim_user,
                                     build_fact, derived_columns, settle_lookups, unknown_user_row)
from tillstar.plans import fixtures as fx
from tillstar.sources import csv_staging, landing, schemas

DIMENSIONS = ("user", "merchant", "agency", "node", "date")
NATURAL_KEYS = {"user": "user_id", "merchant": "merchant_id", "agency": "agency_id", "node": "node_id", "date": "date_key"}
STAGING = {"users": schemas.STG_USERS, "merchants": schemas.STG_MERCHANTS, "agencies": schemas.STG_AGENCIES,
           "transactions": schemas.STG_TRANSACTIONS}
LOAD_DATE = "2024-01-01"


def stage(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Write staging tables as text files and read them with the declared schemas (absent columns are empty); with the rows each
    write counted, and those of transactions whose node is unknown."""
    out, counts = {}, {}
    nodes = [r["node_id"] for r in build_dim_node(spark).select("node_id").collect()]  # the literal replication nodes
    for name, df in tables.items():
        schema = STAGING[name]
        full = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast("string").alias(f.name) for f in schema.fields])
        path = f"{root}/_staging/{name}"
        unknown = {"unknown": F.sum(F.when(F.coalesce(F.col("node_id").isin(nodes), F.lit(False)), 0).otherwise(1))} if name == "transactions" else {}
        seen = observed_write(full, lambda rows, path=path: csv_staging.write_staging_csv(rows, path, compression="gzip"), **unknown)
        counts[f"stg_{name}"] = seen[ROWS]
        if unknown:
            counts["dropped_unknown_node"] = seen["unknown"]
        out[name] = csv_staging.read_staging(spark, path, schema)
    return out, counts


def load_star(spark: SparkSession, sf_dir: str, out_root: str, staging: dict[str, DataFrame] | None = None) -> Star:
    """Load ``staging`` (default: the fixture tables) under ``out_root`` (a new path); returns the written star."""
    given = staging or {"users": fx.stg_users(spark, sf_dir), "merchants": fx.stg_merchants(spark, sf_dir),
                        "agencies": fx.stg_agencies(spark, sf_dir), "transactions": fx.stg_transactions(spark, sf_dir)}
    stg, counts = stage(spark, given, out_root)

    users = build_dim_user(stg["users"], LOAD_DATE)
    dims = {"user": users.unionByName(unknown_user_row(users)), "merchant": build_dim_merchant(stg["merchants"]),
            "agency": build_dim_agency(stg["agencies"]), "node": build_dim_node(spark), "date": fx.fx_date(spark, sf_dir)}
    for name, df in dims.items():
        path = f"{out_root}/{name}"
        counts[f"dim_{name}"] = observed_write(df, lambda rows, path=path: rows.write.mode("errorifexists").parquet(path))[ROWS]
    dims = {name: spark.read.parquet(f"{out_root}/{name}") for name in dims}
    for name, df in dims.items():
        current = df.filter("is_current") if name == "user" else df
        quality.assert_unique(current, [NATURAL_KEYS[name]], f"dim_{name}")

    looked_up = [dims[d] for d in ("user", "merchant", "agency", "node")]
    fact = build_fact(stg["transactions"], *looked_up, settled=settle_lookups(stg["transactions"], *looked_up, f"{out_root}/_lookups"))
    seen = Observation()
    landing.write_fact_layout(fact, f"{out_root}/fact", watch=lambda rows: rows.observe(seen, F.count(F.lit(1)).alias(ROWS)),
                              derived=derived_columns())
    counts["fact_transactions"] = seen.get[ROWS]
    star = read_star(spark, out_root)
    quality.assert_unique(star.fact, ["tx_pk"], "fact_transactions")

    spark.createDataFrame(sorted(counts.items()), REPORT_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(f"{out_root}/_load_report")
    if counts["fact_transactions"] + counts["dropped_unknown_node"] != counts["stg_transactions"]:
        raise AssertionError(f"fact rows and dropped rows do not add up to the staged ones: {counts}")
    return star


def load_report(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, nb): rows staged, loaded and dropped."""
    return spark.read.parquet(f"{root}/_load_report")


def read_star(spark: SparkSession, root: str) -> Star:
    """The written star; the fact keeps its month column, so that month filters prune partitions."""
    rd = lambda n: spark.read.parquet(f"{root}/{n}")
    return Star(fact=rd("fact"), user=rd("user"), merchant=rd("merchant"), agency=rd("agency"), node=rd("node"), date=rd("date"))
