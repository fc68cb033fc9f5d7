"""Row policy and column masks bound to the session user, as SQL views.

Whoever queries the views needs to pass neither login nor role: both follow from ``current_user()`` and the profile
table. A login without a profile sees no row; unknown and unprivileged roles see masked values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.operators.governance import BYPASS_ROLES, CLEAR_ROLES


def _has_role(roles: tuple[str, ...], profiles: str) -> str:
    """Whether the session user has one of the roles: a scalar subquery over the profiles of one login."""
    names = ", ".join(f"'{r}'" for r in roles)
    return f"(SELECT coalesce(bool_or(role IN ({names})), false) FROM {profiles} WHERE login = current_user())"


def create_policy_views(spark: SparkSession, fact: DataFrame, users: DataFrame, profiles: DataFrame, prefix: str = "policy") -> tuple[str, str]:
    """Temporary views ``<prefix>_fact`` (transactions of the users of the login's regions; bypass roles see all) and
    ``<prefix>_users`` (the same rows of the user dimension, with masked columns). Returns their names.

    Profiles: login, wilaya_id, role; a login may have several rows. The regions of a login are few, so the semi-joins keep
    the fact in place where Spark broadcasts the visible users, and shuffle by user otherwise.
    """
    sources = {name: f"{prefix}_source_{name}" for name in ("fact", "users", "profiles")}
    for name, df in (("fact", fact), ("users", users), ("profiles", profiles)):
        df.createOrReplaceTempView(sources[name])
    bypass, clear = (_has_role(roles, sources["profiles"]) for roles in (BYPASS_ROLES, CLEAR_ROLES))
    visible = f"wilaya_id IN (SELECT wilaya_id FROM {sources['profiles']} WHERE login = current_user())"
    masks = {"phone": "concat('***-****-', right(phone, 4))", "nni": "'**********'", "email": "concat('****@', split_part(email, '@', 2))"}
    columns = ", ".join(f"CASE WHEN {clear} OR {c} IS NULL THEN {c} ELSE {masks[c]} END AS {c}" if c in masks else c for c in users.columns)
    # Two disjoint parts instead of an OR around the subquery, so that the policy stays a semi-join.
    spark.sql(f"""CREATE OR REPLACE TEMPORARY VIEW {prefix}_users AS
        SELECT {columns} FROM {sources['users']} WHERE {bypass}
        UNION ALL SELECT {columns} FROM {sources['users']} WHERE NOT {bypass} AND {visible}""")
    seen = f"user_key IN (SELECT user_key FROM {sources['users']} WHERE is_current AND {visible})"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY VIEW {prefix}_fact AS
        SELECT * FROM {sources['fact']} WHERE {bypass}
        UNION ALL SELECT * FROM {sources['fact']} WHERE NOT {bypass} AND {seen}""")
    return f"{prefix}_fact", f"{prefix}_users"
