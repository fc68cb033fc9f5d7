"""Business marts: the 15 questions (B*), KPI cards (K*), dashboard charts (V*)
and the two materialized views (M*).

Conventions (mart contracts):
- "cf" marts keep ``is_conflict = FALSE`` rows only (a NULL flag is dropped too);
  the others use every row, as the source queries do.
- Volumes are ``ROUND(SUM(amount), 0)``; shares are ``ROUND(n * 100.0 / total, s)``
  over all groups, before any limit. Rounded measures are DOUBLE, counts BIGINT.
- Marts that group fact rows by an attribute of a large dimension (user region,
  merchant category, agency) aggregate the fact by the foreign key first, so the
  join and its shuffle see one row per key instead of one per transaction.
- ``dim_date`` is a calendar (bounded by its day range) and is broadcast.
- Every mart is ordered as its contract says; ties and equal ranks go by the label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.share import pct_of, with_share
from tillstar.operators.percentile import percentile_stats
from tillstar.operators.star import Star

SUCCESS, FAILED = "SUCCESS", "FAILED"


def _cf(fact: DataFrame) -> DataFrame:
    return fact.filter(~F.col("is_conflict"))


def r0(c: Column) -> Column:
    return F.round(c, 0).cast("double")


def r(c: Column, scale: int) -> Column:
    return F.round(c, scale).cast("double")


def mean(total: Column, n: Column) -> Column:
    """Exact decimal mean from a sum and a count (no intermediate rounding)."""
    return total / F.nullif(n, F.lit(0)).cast("decimal(20,0)")


def n_success(status: str = "status") -> Column:
    return F.sum(F.when(F.col(status) == SUCCESS, 1).otherwise(0)).cast("bigint")


def _with_date(fact: DataFrame, date: DataFrame, cols: list[str]) -> DataFrame:
    return fact.join(F.broadcast(date.select("date_key", *cols)), "date_key")


def _current_users(star: Star) -> DataFrame:
    return star.user.filter(F.col("is_current") & F.col("wilaya_name").isNotNull())


def _per_user(fact: DataFrame) -> DataFrame:
    return fact.groupBy("user_key").agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_vol"))


def _by_count(df: DataFrame, count: str, label: str) -> DataFrame:
    return df.orderBy(F.desc(count), F.asc_nulls_last(label))


def _top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


# ------------------------------------------------------------ Q1 - Q3
def q1_mom(star: Star) -> DataFrame:
    """Latest month vs the one before (by year, month), conflicts excluded.

    The two latest months are a distributed top-2 (each task keeps two rows),
    then one aggregate puts them side by side; no global window, no cross join.
    No row when fewer than two months exist, like the SQL's rank 1 x rank 2."""
    monthly = (_with_date(_cf(star.fact), star.date, ["year", "month", "month_name"])
               .groupBy("year", "month", "month_name")
               .agg(F.round(F.sum("amount"), 0).alias("volume_mru"))
               .withColumn("_m", F.col("year").cast("int") * 12 + F.col("month").cast("int")))
    last_two = monthly.orderBy(F.desc("_m")).limit(2)
    row = F.struct("month_name", "volume_mru")
    pair = last_two.agg(F.max_by(row, "_m").alias("cur"), F.min_by(row, "_m").alias("pre"),
                        F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == 2)
    cur, pre = F.col("cur.volume_mru"), F.col("pre.volume_mru")
    return pair.select(
        F.col("cur.month_name").alias("mois_courant"), cur.cast("double").alias("volume_mois_courant_mru"),
        F.col("pre.month_name").alias("mois_precedent"), pre.cast("double").alias("volume_mois_precedent_mru"),
        (cur - pre).cast("double").alias("variation_absolue_mru"),
        r((cur - pre) * 100 / F.nullif(pre, F.lit(0)), 1).alias("variation_pct"))


def q2_success(star: Star) -> DataFrame:
    f = star.fact
    agg = f.agg(n_success().alias("nb_succes"),
                F.sum(F.when(F.col("status") == FAILED, 1).otherwise(0)).cast("bigint").alias("nb_echecs"),
                F.count(F.lit(1)).alias("total"))
    return agg.select(pct_of(F.col("nb_succes"), F.col("total"), 1).alias("taux_succes_pct"),
                      "nb_succes", "nb_echecs", "total")


def q3_fees(star: Star) -> DataFrame:
    agg = _cf(star.fact).agg(F.sum("fee").alias("_fee"), F.count("fee").alias("_nfee"),
                             n_success().alias("_succ"),
                             F.count(F.when(F.col("fee") > 0, 1)).alias("nb_tx_avec_frais"))
    return agg.select(
        r0(F.col("_fee")).alias("frais_total_mru"),
        r(mean(F.col("_fee"), F.col("_nfee")), 2).alias("frais_moyen_par_tx"),
        r(mean(F.col("_fee"), F.col("_succ")), 2).alias("frais_moyen_tx_succes"),
        "nb_tx_avec_frais")


# ------------------------------------------------------------ Q4 - Q6
def _wilaya_totals(star: Star, exclude_conflicts: bool) -> DataFrame:
    fact = _cf(star.fact) if exclude_conflicts else star.fact
    users = _current_users(star).select("user_key", "wilaya_name")
    return (_per_user(fact).join(users, "user_key")
            .groupBy(F.col("wilaya_name").alias("wilaya"))
            .agg(F.sum("_n").alias("nb_transactions"), F.sum("_vol").alias("_vol")))


def q4_top_wilaya(star: Star, top: int = 10) -> DataFrame:
    g = with_share(_wilaya_totals(star, True), "nb_transactions", "pct_transactions", 1)
    out = g.select("wilaya", "nb_transactions", r0(F.col("_vol")).alias("volume_mru"),
                   r0(mean(F.col("_vol"), F.col("nb_transactions"))).alias("panier_moyen_mru"),
                   "pct_transactions")
    return _top(out, top, F.desc("volume_mru"), F.asc("wilaya"))


def q5_top_agency(star: Star, top: int = 10) -> DataFrame:
    per_agency = (_cf(star.fact).filter(F.col("agency_key") != -1)
                  .groupBy("agency_key")
                  .agg(F.count(F.lit(1)).alias("nb_transactions"), F.sum("amount").alias("_vol"),
                       F.sum("fee").alias("_fee"), n_success().alias("nb_succes")))
    a = star.agency.filter(F.col("agency_key") != -1).select("agency_key", "name", "wilaya_name", "tier")
    out = per_agency.join(a, "agency_key").select(
        "agency_key", F.col("name").alias("agence"), F.col("wilaya_name").alias("wilaya"), "tier", "nb_transactions",
        r0(F.col("_vol")).alias("volume_mru"), r0(F.col("_fee")).alias("frais_generes_mru"),
        r0(mean(F.col("_vol"), F.col("nb_transactions"))).alias("panier_moyen_mru"), "nb_succes",
        pct_of(F.col("nb_succes"), F.col("nb_transactions"), 1).alias("taux_succes_pct"))
    return _top(out, top, F.desc("volume_mru"), F.asc("agency_key")).drop("agency_key")


def q6_opportunity(star: Star) -> DataFrame:
    # user_key is unique in the dimension, so per-region distinct counts are plain counts.
    users = _current_users(star).select("user_key", "wilaya_name")
    ws = (users.join(_per_user(_cf(star.fact)), "user_key", "left")
          .groupBy("wilaya_name")
          .agg(F.count(F.lit(1)).alias("nb_utilisateurs"),
               F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("nb_transactions")))
    ratio = (F.col("nb_transactions").cast("decimal(20,0)")
             / F.nullif(F.col("nb_utilisateurs"), F.lit(0)).cast("decimal(20,0)"))
    ws = ws.withColumn("_ratio", ratio)
    nat = ws.select(F.round(F.avg("_ratio"), 2)).scalar()   # national mean, rounded (as compared)
    cls = (F.when(F.col("_ratio") < nat * F.lit(0.75), "Fort potentiel")
           .when(F.col("_ratio") < nat, "Potentiel modéré")
           .otherwise("Déjà performante"))
    rank = F.when(F.col("opportunite") == "Fort potentiel", 1).when(F.col("opportunite") == "Potentiel modéré", 2).otherwise(3)
    return ws.select(
        "wilaya_name", "nb_utilisateurs", "nb_transactions",
        r(F.col("_ratio"), 2).alias("tx_par_user"),
        nat.cast("double").alias("moy_nationale_tx_par_user"),
        cls.alias("opportunite")).orderBy(rank, F.desc("nb_utilisateurs"), F.asc("wilaya_name"))


# ------------------------------------------------------------ Q7 - Q9
def _reg_year_month(users: DataFrame) -> DataFrame:
    return users.select(F.year("registration_date").alias("annee"),
                        F.month("registration_date").alias("mois"))


def q7_new_users(star: Star) -> DataFrame:
    last = star.fact.agg(F.max("transaction_date").alias("_d")).select(
        F.year("_d").alias("annee"), F.month("_d").alias("mois"))
    users = _reg_year_month(star.user.filter(F.col("is_current")))
    return (users.join(F.broadcast(last), ["annee", "mois"])
            .groupBy("annee", "mois").agg(F.count(F.lit(1)).alias("nouveaux_utilisateurs")))


def q7_signups_by_month(star: Star) -> DataFrame:
    return (_reg_year_month(star.user.filter(F.col("is_current")))
            .groupBy("annee", "mois").agg(F.count(F.lit(1)).alias("nouveaux_utilisateurs"))
            .orderBy(F.asc_nulls_last("annee"), F.asc_nulls_last("mois")))


def q8_retention(star: Star) -> DataFrame:
    """Monthly retention in one shuffle: each successful transaction says "active in
    month m" and "was active before month m+1"; one aggregate per (user, month)
    merges both flags (map-side combine keeps a hot user at one row per task)."""
    active = (_with_date(star.fact.filter(F.col("status") == SUCCESS), star.date, ["year", "month"])
              .select("user_key", (F.col("year") * 12 + F.col("month") - 1).alias("_m")))
    marks = active.select("user_key", F.explode(F.array(
        F.struct(F.col("_m").alias("m"), F.lit(1).alias("cur"), F.lit(0).alias("prev")),
        F.struct((F.col("_m") + 1).alias("m"), F.lit(0).alias("cur"), F.lit(1).alias("prev")))).alias("_x"))
    per_user_month = (marks.groupBy("user_key", F.col("_x.m").alias("m"))
                      .agg(F.max("_x.cur").alias("cur"), F.max("_x.prev").alias("prev"))
                      .filter(F.col("cur") == 1))
    per_month = per_user_month.groupBy("m").agg(
        F.count(F.lit(1)).alias("actifs_mois_courant"),
        F.sum("prev").cast("bigint").alias("retenus_du_mois_precedent"))
    return per_month.select(
        F.floor(F.col("m") / 12).cast("int").alias("year"), (F.col("m") % 12 + 1).cast("int").alias("month"),
        "actifs_mois_courant", "retenus_du_mois_precedent",
        pct_of(F.col("retenus_du_mois_precedent"), F.col("actifs_mois_courant"), 1).alias("taux_retention_pct")).orderBy("year", "month")


def _user_share(star: Star, label: Column, name: str) -> DataFrame:
    g = (star.user.filter(F.col("is_current")).groupBy(label.alias(name))
         .agg(F.count(F.lit(1)).alias("nb_utilisateurs")))
    return _by_count(with_share(g, "nb_utilisateurs", "pourcentage", 1), "nb_utilisateurs", name)


def q9_kyc(star: Star) -> DataFrame:
    label = F.coalesce(F.nullif(F.col("kyc_level"), F.lit("")), F.lit("Non renseigné"))
    return _user_share(star, label, "niveau_kyc")


def q9_account_status(star: Star) -> DataFrame:
    return _user_share(star, F.col("status"), "statut_compte")


# ------------------------------------------------------------ Q10 - Q12
# Transaction type code -> label.
TYPE_LABELS = [
    ("DEP", "Dépôt"), ("WIT", "Retrait"), ("TRF", "Transfert"), ("PAY", "Paiement marchand"),
    ("BIL", "Paiement facture"), ("AIR", "Airtime"), ("SAL", "Salaire"), ("REV", "Remboursement"),
]


def type_label(code: Column) -> Column:
    expr = None
    for k, v in TYPE_LABELS:
        expr = (F.when(code == k, v) if expr is None else expr.when(code == k, v))
    return expr.otherwise(code)


def q10_type_mix(star: Star) -> DataFrame:
    g = (_cf(star.fact).groupBy(F.col("transaction_type").alias("type_tx"))
         .agg(F.count(F.lit(1)).alias("nb_transactions"), F.sum("amount").alias("_vol")))
    return _by_count(with_share(g, "nb_transactions", "pct_volume_transactions", 1).select(
        "type_tx", type_label(F.col("type_tx")).alias("libelle"), "nb_transactions",
        r0(F.col("_vol")).alias("volume_mru"), "pct_volume_transactions"), "nb_transactions", "type_tx")


def q11_peak_hours(tx: DataFrame) -> DataFrame:
    g = (tx.filter(F.col("transaction_time").isNotNull())
         .groupBy(F.col("tx_hour").alias("heure"))
         .agg(F.count(F.lit(1)).alias("nb_transactions"), F.sum("amount").alias("_vol")))
    return with_share(g, "nb_transactions", "pct", 1).select(
        "heure", F.concat(F.lpad(F.col("heure").cast("string"), 2, "0"), F.lit("h")).alias("plage_horaire"),
        "nb_transactions", r0(F.col("_vol")).alias("volume_mru"), "pct").orderBy("heure")


def failure_label(c: Column) -> Column:
    t = F.trim(c)
    return F.coalesce(F.when(t != "", t), F.lit("Non précisé"))


# Failure reason spellings merged into one code.
FAILURE_SYNONYMS = [("INSUF_BAL", "INSUFFICIENT_BALANCE")]


def normalized_failure(c: Column) -> Column:
    lab = failure_label(c)
    for src, dst in FAILURE_SYNONYMS:
        lab = F.when(lab == src, dst).otherwise(lab)
    return lab


def _failures(star: Star, label: Column, name: str, count_name: str, pct_name: str, scale: int,
              top: int) -> DataFrame:
    g = (star.fact.filter(F.col("status") == FAILED).groupBy(label.alias(name))
         .agg(F.count(F.lit(1)).alias(count_name)))
    # Reasons are free text: their number has no bound.
    return _top(with_share(g, count_name, pct_name, scale, bounded=False), top, F.desc(count_name), F.asc(name))


def q12_failure_reasons(star: Star, top: int = 10) -> DataFrame:
    return _failures(star, failure_label(F.col("failure_reason")), "motif_echec", "nb_echecs",
                     "pct_des_echecs", 1, top)


def q12_failure_reasons_normalized(star: Star, top: int = 10) -> DataFrame:
    return _failures(star, normalized_failure(F.col("failure_reason")), "motif_echec", "nb_echecs",
                     "pct_des_echecs", 1, top)


# ------------------------------------------------------------ Q13 - Q15
def _merchant_fact(star: Star) -> DataFrame:
    return _cf(star.fact).filter(F.col("merchant_key") != -1)


def _categories(star: Star) -> DataFrame:
    return star.merchant.filter(F.col("merchant_key") != -1).select("merchant_key", "category_label")


def q13_category_mix(star: Star) -> DataFrame:
    # tx_pk is unique, so distinct transactions per category = row count.
    per_merchant = (_merchant_fact(star).groupBy("merchant_key")
                    .agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_vol"),
                         F.sum("fee").alias("_fee")))
    g = (per_merchant.join(_categories(star), "merchant_key")
         .groupBy(F.col("category_label").alias("categorie"))
         .agg(F.sum("_n").alias("nb_transactions"), F.sum("_vol").alias("_vol"),
              F.sum("_fee").alias("_fee"), F.count(F.lit(1)).alias("nb_marchands_actifs")))
    return _by_count(with_share(g, "nb_transactions", "pct_transactions", 1).select(
        "categorie", "nb_transactions", r0(F.col("_vol")).alias("volume_mru"),
        r0(F.col("_fee")).alias("frais_generes_mru"), "nb_marchands_actifs", "pct_transactions"), "nb_transactions", "categorie")


def q14_basket(star: Star) -> DataFrame:
    ok = _merchant_fact(star).filter(F.col("status") == SUCCESS)
    # Per (merchant, amount) counts first: the join carries distinct amounts, not rows.
    per_amount = ok.groupBy("merchant_key", "amount").agg(F.count(F.lit(1)).alias("_w"))
    rows = per_amount.join(_categories(star), "merchant_key").select(F.col("category_label").alias("categorie"), "amount", "_w")
    stats = percentile_stats(rows, ["categorie"], "amount", 0.5, "_median", weight_col="_w")
    return stats.select(
        "categorie", F.col("_rows").alias("nb_transactions"),
        r0(mean(F.col("_sum"), F.col("_n"))).alias("panier_moyen_mru"),
        r0(F.col("_min")).alias("montant_min_mru"), r0(F.col("_max")).alias("montant_max_mru"),
        F.round(F.col("_median"), 0).alias("mediane_mru")).orderBy(F.desc_nulls_first("panier_moyen_mru"), F.asc_nulls_last("categorie"))


def q15_merchant_status(star: Star) -> DataFrame:
    g = (star.merchant.filter(F.col("merchant_key") != -1)
         .groupBy(F.col("status").alias("statut_marchand"))
         .agg(F.count(F.lit(1)).alias("nb_marchands")))
    return _by_count(with_share(g, "nb_marchands", "pourcentage", 1), "nb_marchands", "statut_marchand")


def q15_merchant_activity(star: Star) -> DataFrame:
    per_merchant = (_cf(star.fact).groupBy("merchant_key").agg(F.count("tx_pk").alias("_n")))
    m = star.merchant.filter(F.col("merchant_key") != -1).select("merchant_key", "status")
    act = m.join(per_merchant, "merchant_key", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    return act.groupBy(F.col("status").alias("statut_referentiel")).agg(
        F.sum(F.when(F.col("_n") > 0, 1).otherwise(0)).cast("bigint").alias("actifs_avec_transactions"),
        F.sum(F.when(F.col("_n") == 0, 1).otherwise(0)).cast("bigint").alias("inactifs_sans_transaction"),
        F.count(F.lit(1)).alias("total"))


# ------------------------------------------------------------ KPI cards
def kpi_total(star: Star) -> DataFrame:
    return star.fact.agg(F.count(F.lit(1)).alias("total_transactions"))


def kpi_volume(star: Star) -> DataFrame:
    return _cf(star.fact).agg(r0(F.sum("amount")).alias("volume_total_mru"))


def kpi_success_rate(star: Star) -> DataFrame:
    return (star.fact.agg(n_success().alias("_s"), F.count(F.lit(1)).alias("_n"))
            .select(pct_of(F.col("_s"), F.col("_n"), 1).alias("taux_succes_pct")))


# ------------------------------------------------------------ dashboard charts
def viz_monthly_volume(star: Star) -> DataFrame:
    return (_with_date(_cf(star.fact), star.date, ["month", "month_name"])
            .groupBy(F.col("month").cast("int").alias("num_mois"), F.col("month_name").alias("mois"))
            .agg(F.count(F.lit(1)).alias("nb_transactions"), r0(F.sum("amount")).alias("volume_mru"))
            .orderBy("num_mois"))


def viz_status_share(star: Star) -> DataFrame:
    g = star.fact.groupBy("status").agg(F.count(F.lit(1)).alias("nb"))
    return _by_count(with_share(g, "nb", "pourcentage", 2), "nb", "status")


def viz_top_wilaya(star: Star, top: int = 10) -> DataFrame:
    g = _wilaya_totals(star, False)
    out = g.select("wilaya", "nb_transactions", r0(F.col("_vol")).alias("volume_mru"),
                   r0(mean(F.col("_vol"), F.col("nb_transactions"))).alias("panier_moyen"))
    return _top(out, top, F.desc("volume_mru"), F.asc("wilaya"))


def viz_peak_hours(tx: DataFrame) -> DataFrame:
    return (tx.filter(F.col("transaction_time").isNotNull())
            .groupBy(F.col("tx_hour").alias("heure")).agg(F.count(F.lit(1)).alias("nb_transactions"))
            .orderBy("heure"))


def viz_type_share(star: Star) -> DataFrame:
    g = (star.fact.groupBy(F.col("transaction_type").alias("type_tx"))
         .agg(F.count(F.lit(1)).alias("nb"), F.sum("amount").alias("_vol")))
    return _by_count(with_share(g, "nb", "pct", 2).select("type_tx", "nb", r0(F.col("_vol")).alias("volume_mru"), "pct"), "nb", "type_tx")


def viz_failure_reasons(star: Star, top: int = 10) -> DataFrame:
    return _failures(star, failure_label(F.col("failure_reason")), "motif", "nb_echecs", "pct", 2, top)


# ------------------------------------------------------------ materialized views
def mv_daily_kpis(star: Star) -> DataFrame:
    per_day = (_cf(star.fact).groupBy("date_key")
               .agg(F.count(F.lit(1)).alias("nb_transactions"), F.sum("amount").alias("_vol"),
                    F.sum("fee").alias("_fee"), n_success().alias("nb_succes")))
    d = F.broadcast(star.date.select("date_key", "full_date", "year", "month", "day_of_month"))
    return per_day.join(d, "date_key").select(
        "full_date", F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"),
        F.col("day_of_month").cast("int").alias("day_of_month"), "nb_transactions",
        r0(F.col("_vol")).alias("volume_mru"), r0(F.col("_fee")).alias("frais_mru"), "nb_succes",
        pct_of(F.col("nb_succes"), F.col("nb_transactions"), 1).alias("taux_succes_pct"))


def mv_wilaya_volume(star: Star) -> DataFrame:
    per_user_day = (_cf(star.fact).groupBy("user_key", "date_key")
                    .agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_vol")))
    users = star.user.filter(F.col("is_current")).select("user_key", "wilaya_id", "wilaya_name")
    d = F.broadcast(star.date.select("date_key", "full_date"))
    return (per_user_day.join(users, "user_key").join(d, "date_key")
            .groupBy("wilaya_id", "wilaya_name", "full_date")
            .agg(F.sum("_n").alias("nb_transactions"), r0(F.sum("_vol")).alias("volume_mru")))
