"""Reference lookup tables (categories, transaction types, regions).

Small by construction (one row per code): Spark broadcasts them by the size of their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Merchant categories (id, code, mcc, avg_min, avg_max).
CATEGORIES = [
    (1, "ALM", "5411", 200, 5000),
    (2, "RST", "5812", 300, 5000),
    (3, "TRN", "4121", 200, 3000),
    (4, "TEL", "4812", 500, 10000),
    (5, "CRB", "5541", 1000, 20000),
    (6, "SAN", "5912", 500, 50000),
    (7, "HAB", "5651", 2000, 30000),
    (8, "ELC", "5732", 5000, 200000),
    (9, "BTP", "5211", 5000, 500000),
    (10, "EDU", "8211", 10000, 100000),
    (11, "SRV", "7299", 1000, 20000),
    (12, "HTL", "7011", 20000, 200000),
    (13, "AUT", "5999", 500, 50000),
]

# Transaction types (id, code); label/description are empty and
# the four requires_*/is_credit flags are all false in the source file.
TX_TYPES = [
    (1, "DEP"), (2, "WIT"), (3, "TRF"), (4, "PAY"), (5, "BIL"), (6, "AIR"), (7, "SAL"), (8, "REV"),
]

# Regions (id, code, name, capital, population, economic_weight).
WILAYAS = [
    (1, "NKC-N", "Nouakchott-Nord", "Dar Naim", 366000, 0.2),
    (2, "NKC-O", "Nouakchott-Ouest", "Tevragh-Zeina", 163000, 0.25),
    (3, "NKC-S", "Nouakchott-Sud", "Arafat", 435000, 0.15),
    (4, "NDB", "Dakhlet Nouadhibou", "Nouadhibou", 123000, 0.12),
    (5, "TRZ", "Trarza", "Rosso", 272000, 0.05),
    (6, "BRK", "Brakna", "Aleg", 312000, 0.04),
    (7, "GRG", "Gorgol", "Kaédi", 335000, 0.03),
    (8, "GDM", "Guidimaka", "Sélibaby", 267000, 0.02),
    (9, "ASB", "Assaba", "Kiffa", 325000, 0.03),
    (10, "HCH", "Hodh Ech Chargui", "Néma", 430000, 0.02),
    (11, "HGH", "Hodh El Gharbi", "Ayoûn el Atroûs", 294000, 0.02),
    (12, "ADR", "Adrar", "Atar", 62000, 0.03),
    (13, "TGT", "Tagant", "Tidjikja", 80000, 0.01),
    (14, "INR", "Inchiri", "Akjoujt", 19000, 0.01),
    (15, "TYS", "Tiris Zemmour", "Zouerate", 53000, 0.05),
]


# Declared schemas of the lookup files, in the order of the values above.
SCHEMAS = {
    "categories": "id int, code string, mcc string, avg_min int, avg_max int",
    "tx_types": "id int, code string, label string, requires_destination boolean, requires_merchant boolean, "
                "requires_agency boolean, is_credit boolean",
    "wilayas": "id int, code string, name string, capital string, population int, economic_weight double",
}
ROWS = {
    "categories": CATEGORIES,
    "tx_types": [(i, code, None, False, False, False, False) for i, code in TX_TYPES],
    "wilayas": WILAYAS,
}


def write_lookup(spark: SparkSession, name: str, path: str) -> str:
    """The lookup as a CSV file with a header (an empty field is NULL)."""
    spark.createDataFrame(ROWS[name], SCHEMAS[name]).coalesce(1).write.option("header", True).csv(path)
    return path


def read_lookup(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Scan a lookup file with its declared schema; a malformed row fails."""
    return spark.read.schema(SCHEMAS[name]).option("header", True).option("nullValue", "").option("mode", "FAILFAST").csv(path)
