"""Governance as data operators: row security, column masks, PII scan,
classification-based projection, guarded export, audit rules, export anomaly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions.identifiers import VALID
from tillstar.session import fresh_path
from tillstar.sources.schemas import CLASSIFICATION

CLEAR_ROLES = ("directeur_general", "dpo")
BYPASS_ROLES = ("directeur_general",)


# ------------------------------------------------------------ G1/G2 row security
def rls_filter(fact: DataFrame, users: DataFrame, profiles: DataFrame, login: str, role: str) -> DataFrame:
    """Rows of ``fact`` the login may see: the transactions of users living in the
    login's region. Bypass roles see everything.

    The fact carries no region, so the policy goes through the user dimension:
    fact semi-join (current users semi-join the login's profile).
    """
    if role in BYPASS_ROLES:
        return fact
    visible = rls_users(users.filter(F.col("is_current")), profiles, login, role).select("user_key")
    return fact.join(visible, "user_key", "left_semi")


def rls_users(users: DataFrame, profiles: DataFrame, login: str, role: str) -> DataFrame:
    """Rows of the user dimension the login may see: those of the login's region (bypass roles see all)."""
    if role in BYPASS_ROLES:
        return users
    me = profiles.filter(F.col("login") == login).select("wilaya_id")
    return users.join(me, "wilaya_id", "left_semi")


# ------------------------------------------------------------ G3 masks
def mask_phone(c: Column, role: str) -> Column:
    return c if role in CLEAR_ROLES else F.concat(F.lit("***-****-"), F.right(c, F.lit(4)))


def mask_nni(c: Column, role: str) -> Column:
    return c if role in CLEAR_ROLES else F.lit("**********")


def mask_email(c: Column, role: str) -> Column:
    return c if role in CLEAR_ROLES else F.concat(F.lit("****@"), F.split_part(c, F.lit("@"), F.lit(2)))


def masked_users(users: DataFrame, role: str) -> DataFrame:
    """The user dimension as a given role reads it."""
    return users.withColumns({
        "phone": mask_phone(F.col("phone"), role),
        "nni": mask_nni(F.col("nni"), role),
        "email": mask_email(F.col("email"), role),
    })


# ------------------------------------------------------------ G4 PII scan
# Detection patterns (Java and RE2 compatible).
PII_PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    # International with separators, the country's +222 and eight digits in pairs or together, and the internal P form.
    "PHONE": r"(\+[0-9]{1,3} ?\(?[0-9]{2,3}\)?[ -]?[0-9]{3}[ -][0-9]{4}|\+222[ -]?[0-9]{2}[ -]?[0-9]{2}[ -]?[0-9]{2}[ -]?[0-9]{2}|\b[234][0-9]{7}|\bP[0-9]{8})\b",
    # Ten digits, and the internal N form.
    "NNI": r"\b([0-9]{10}|N[0-9]{8})\b",
    # Together or in groups of four.
    "IBAN": r"\b[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})\b",
    "CARD": r"\b(?:(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{13,19})\b",
}


# What a text must hold for a pattern to have a hit at all; other texts are not matched.
PII_NEEDS = {"EMAIL": "@", "PHONE": "[0-9]{2}", "NNI": "[0-9]{8}", "IBAN": "[A-Z]{2}[0-9]{2}", "CARD": "[0-9]{4}"}


def pii_scan(df: DataFrame, table_name: str, columns: list[str] | None = None) -> DataFrame:
    """Per (column, pii_type): rows with at least one hit, all hits, and the hits that are well formed (check digits,
    lengths, numbering plans: ``functions/identifiers.py``); the rest is malformed.

    One pass over the table: the matches of each (column, pattern) are extracted once (a projection of their own, as the checks
    within a lambda share no expressions) and counted inside a single aggregate, unpivoted afterwards. Whole texts are scanned.
    """
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    matches, found, aggs, rows = [], [], [], []
    for i, c in enumerate(cols):
        for j, (kind, pat) in enumerate(PII_PATTERNS.items()):
            named = F.when(F.col(c).rlike(PII_NEEDS[kind]), F.regexp_extract_all(F.col(c), F.lit(pat), F.lit(0)))
            matches.append(F.coalesce(named, F.array().cast("array<string>")).alias(f"m{i}_{j}"))
            hits = F.col(f"m{i}_{j}")
            found.append(F.struct(F.size(hits).alias("n"), F.size(F.filter(hits, VALID[kind])).alias("valid")).alias(f"f{i}_{j}"))
            n = F.col(f"f{i}_{j}.n")
            aggs += [F.sum(F.when(n > 0, 1).otherwise(0)).cast("bigint").alias(f"r{i}_{j}"), F.sum(n).cast("bigint").alias(f"h{i}_{j}"),
                     F.sum(f"f{i}_{j}.valid").cast("bigint").alias(f"v{i}_{j}")]
            rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("pii_type"), F.col(f"r{i}_{j}").alias("nb_rows"),
                                 F.col(f"h{i}_{j}").alias("nb_hits"), F.col(f"v{i}_{j}").alias("nb_valid")))
    return (df.select(*matches).select(*found).agg(*aggs).select(F.explode(F.array(*rows)).alias("x"))
            .select(F.lit(table_name).alias("table_name"), "x.*"))


# ------------------------------------------------------------ G5 classification
def with_classification(df: DataFrame, classes: dict[str, str] = CLASSIFICATION) -> DataFrame:
    """Attach a ``classification`` tag to each column's metadata."""
    return df.select(*[F.col(c).alias(c, metadata={"classification": classes.get(c, "INTERNAL")})
                       for c in df.columns])


ROLE_CLASSES = {
    "analyste_junior": ("PUBLIC", "INTERNAL"),
    "chef_agence": ("PUBLIC", "INTERNAL"),
    "dpo": ("PUBLIC", "INTERNAL", "PII"),
    "directeur_general": ("PUBLIC", "INTERNAL", "PII"),
}


def project_by_class(df: DataFrame, role: str) -> DataFrame:
    """Keep the columns whose classification the role may read."""
    allowed = ROLE_CLASSES.get(role, ("PUBLIC",))
    keep = [f.name for f in df.schema.fields if f.metadata.get("classification", "INTERNAL") in allowed]
    return df.select(*keep)


# ------------------------------------------------------------ G6 export guard
EXPORT_ALERT_ROWS = 10_000
EXPORT_REFUSE_ROWS = 50_000


def export_decision(n: Column, alert: int = EXPORT_ALERT_ROWS, refuse: int = EXPORT_REFUSE_ROWS) -> Column:
    return (F.when(n > refuse, "REFUSE").when(n > alert, "ALERT").otherwise("OK"))


def guarded_export(df: DataFrame, name: str, user: str, path: str, alert: int = EXPORT_ALERT_ROWS,
                   refuse: int = EXPORT_REFUSE_ROWS) -> DataFrame:
    """Write ``df`` as CSV unless it exceeds the refuse threshold; return the audit row with its true row count.

    The decision comes first: a limit of ``refuse + 1`` rows tells whether the request is too large, so a refused one is never written.
    Its full count then reads the request's keys only (a count prunes all columns). An accepted request (at most
    ``refuse`` rows) is computed once more into a fresh folder, and file and count come from there.
    """
    spark = df.sparkSession
    if df.limit(refuse + 1).count() > refuse:
        n, written = df.count(), None
    else:
        staged = fresh_path(spark, "export")
        df.limit(refuse + 1).write.parquet(staged)
        rows = spark.read.schema(df.schema).parquet(staged)
        n, written = rows.count(), path
        if n <= refuse:
            rows.write.mode("errorifexists").option("header", True).csv(path)
        else:  # grown between the two reads
            n, written = df.count(), None
    return spark.range(1).select(F.lit(name).alias("export_name"), F.lit(user).alias("demandeur"),
                                 F.lit(n).cast("bigint").alias("nb_lignes"),
                                 export_decision(F.lit(n), alert, refuse).alias("decision"),
                                 F.lit(written).cast("string").alias("fichier"))


# ------------------------------------------------------------ G7 audit rules
# Monitoring thresholds.
LONG_QUERY_S = 300
FULL_SCAN_ROWS = 500_000
NO_FILTER_SCAN_ROWS, NO_FILTER_RETURN_ROWS = 90_000, 10_000


def audit_rules(log: DataFrame) -> DataFrame:
    """Flag query-log rows against the monitoring rules; one row per rule with hit counts."""
    rules = {
        "kill_long_queries": F.col("elapsed_s") > LONG_QUERY_S,
        "limit_full_scan": F.col("scanned_rows") > FULL_SCAN_ROWS,
        "alert_no_filter": (F.col("scanned_rows") > NO_FILTER_SCAN_ROWS) & (F.col("returned_rows") > NO_FILTER_RETURN_ROWS),
    }
    agg = log.agg(*[F.sum(F.when(c, 1).otherwise(0)).cast("bigint").alias(k) for k, c in rules.items()],
                  F.count(F.lit(1)).alias("_n"))
    rows = [F.struct(F.lit(k).alias("rule"), F.col(k).alias("nb_hits")) for k in rules]
    return agg.select("_n", F.explode(F.array(*rows)).alias("x")).select("x.rule", "x.nb_hits",
                                                                         F.col("_n").alias("nb_queries"))


# ------------------------------------------------------------ G8 export anomaly
def export_anomaly(exports: DataFrame, user_col: str = "user_id", day_col: str = "jour", rows_col: str = "returned_rows",
                   k: float = 3.0, history: int = 7, min_history: int = 3) -> DataFrame:
    """Per user and day: exported rows vs the mean +- k * stddev of the previous
    ``history`` active days.

    Daily totals first (one row per user and day), so the per-user window holds
    at most one row per calendar day whatever the user's volume.
    """
    daily = exports.groupBy(user_col, day_col).agg(F.sum(rows_col).cast("bigint").alias("lignes_exportees"))
    w = Window.partitionBy(user_col).orderBy(day_col).rowsBetween(-history, -1)
    out = (daily.withColumn("_m", F.avg("lignes_exportees").over(w))
           .withColumn("_s", F.stddev_samp("lignes_exportees").over(w))
           .withColumn("_h", F.count(F.lit(1)).over(w)))
    away = F.abs(F.col("lignes_exportees") - F.col("_m"))
    anomaly = (F.col("_h") >= min_history) & (away > F.lit(k) * F.coalesce(F.col("_s"), F.lit(0.0)))
    return out.select(user_col, day_col, "lignes_exportees",
                      F.round("_m", 4).alias("moyenne_7j"), F.round("_s", 4).alias("ecart_type_7j"),
                      anomaly.alias("anomalie"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
