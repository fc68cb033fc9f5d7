"""Declared schemas: staging (text, typed late) and the star tables.

Schemas are fixed and declared, never inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
I = T.IntegerType()


def _text(names: str) -> list[T.StructField]:
    return [T.StructField(n, S, True) for n in names.split()]


# Staging tables: id BIGINT, region ids INT, everything else text.
STG_USERS = T.StructType(
    [T.StructField("id", L, True)]
    + _text("nni first_name last_name full_name gender birth_date ethnicity phone email")
    + [T.StructField("wilaya_id", I, True)]
    + _text("wilaya_name")
    + [T.StructField("moughataa_id", I, True)]
    + _text("moughataa_name profile_type kyc_level status device_type registration_date "
            "last_login created_at updated_at")
)

STG_MERCHANTS = T.StructType(
    [T.StructField("id", L, True)]
    + _text("code mcc name category_code category_label owner_first_name owner_last_name "
            "owner_full_name owner_gender owner_ethnicity phone email")
    + [T.StructField("wilaya_id", I, True)]
    + _text("wilaya_name")
    + [T.StructField("moughataa_id", I, True)]
    + _text("moughataa_name address latitude longitude commission_rate avg_transaction_min "
            "avg_transaction_max status registration_date created_at updated_at")
)

STG_AGENCIES = T.StructType(
    [T.StructField("id", L, True)]
    + _text("code name")
    + [T.StructField("wilaya_id", I, True)]
    + _text("wilaya_name")
    + [T.StructField("moughataa_id", I, True)]
    + _text("moughataa_name address latitude longitude phone email opening_hours status tier "
            "float_balance max_float license_number license_expiry created_at updated_at")
)

STG_TRANSACTIONS = T.StructType(
    [T.StructField("id", L, True)]
    + _text(
        "reference idempotency_key transaction_type transaction_type_label amount fee total_amount "
        "currency source_account_id source_account_number source_user_id source_user_name "
        "destination_account_id destination_account_number destination_user_id destination_user_name "
        "merchant_id merchant_code merchant_name agency_id agency_code agency_name agent_id agent_name "
        "status failure_reason balance_before balance_after node_id datacenter sync_status "
        "last_synced_at amount_node_a amount_node_b channel device_type ip_address risk_score "
        "description transaction_date transaction_time created_at updated_at completed_at"
    )
)

MONEY = T.DecimalType(18, 2)
RISK = T.DecimalType(5, 2)
RATE = T.DecimalType(5, 4)

# Data classification of star columns (governance G5). Unlisted columns are INTERNAL.
CLASSIFICATION = {
    "nni": "PII", "phone": "PII", "email": "PII", "full_name": "PII",
    "wilaya_name": "PUBLIC", "wilaya_id": "PUBLIC", "profile_type": "PUBLIC",
    "status": "PUBLIC", "user_key": "INTERNAL", "user_id": "INTERNAL",
}
