"""Row scoping per user, masking and audit as explicit DataFrame filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import mask_email, row_json
from ..schemas import UNKNOWN
from .joins import small, wildcard_members, wildcard_scope

SCOPE_CELLS = ("plant_code", "production_line")
ROLES = ("EXECUTIVE", "PLANT_MANAGER", "LINE_SUPERVISOR", "MAINTENANCE_TECH", "AUDITOR")


def app_user(user: str | None) -> str:
    """Lower-cased user name; none means nobody, who sees nothing."""
    return (user or "").lower()


def own_scopes(scopes: DataFrame, user: str | None) -> DataFrame:
    return scopes.where(F.lower("user_principal_name") == app_user(user))


def visible_keys(machines: DataFrame, scopes: DataFrame, user: str | None) -> DataFrame:
    """Machine keys matched by any active scope row of the user."""
    active = own_scopes(scopes, user).where("is_active")
    return wildcard_scope(machines, active, SCOPE_CELLS).select("machine_key").distinct()


def visible_to_all(machines: DataFrame, scopes: DataFrame, users: DataFrame) -> DataFrame:
    """(app_user, machine_key) for every row of ``users``, in one join. Names match whatever their case."""
    active = scopes.where("is_active").withColumn("_name", F.lower("user_principal_name"))
    seen = wildcard_members(machines, active, SCOPE_CELLS, "_name", ["machine_key"])
    return users.join(seen, F.lower("app_user") == F.col("_name")).select("app_user", "machine_key")


def scoped_fact(
    fact: DataFrame, machines: DataFrame, scopes: DataFrame, user: str | None, unrestricted: bool = False
) -> DataFrame:
    """Fact rows of visible machines; a user without scope gets none."""
    if unrestricted:
        return fact
    return fact.join(small(visible_keys(machines, scopes, user)), "machine_key", "left_semi")


def scoped_machines(machines: DataFrame, scopes: DataFrame, user: str | None) -> DataFrame:
    """Visible members and always the Unknown row."""
    seen = visible_keys(machines, scopes, user).select("machine_key", F.lit(True).alias("_seen"))
    return (
        machines.join(small(seen), "machine_key", "left")
        .where(F.col("_seen") | (F.col("machine_key") == UNKNOWN))
        .drop("_seen")
    )


def masked(fact: DataFrame, column: str = "acknowledged_by", privileged: bool = False) -> DataFrame:
    return fact.withColumn(column, mask_email(F.col(column), privileged))


def audit_changes(
    before: DataFrame, after: DataFrame, keys: Sequence[str], user: str | None, at: Column
) -> DataFrame:
    """One audit row per inserted, updated or deleted scope row, with the row as JSON."""
    columns = before.columns
    old = before.select(*[F.col(k).alias(f"_k_{k}") for k in keys], row_json(*columns).alias("_old"))
    new = after.select(*[F.col(k).alias(f"_k_{k}") for k in keys], row_json(*columns).alias("_new"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"o._k_{k}").eqNullSafe(F.col(f"n._k_{k}"))
    both = old.alias("o").join(new.alias("n"), cond, "full")
    action = (
        F.when(F.col("_old").isNull(), "INSERT")
        .when(F.col("_new").isNull(), "DELETE")
        .when(F.col("_old") != F.col("_new"), "UPDATE")
    )
    return both.select(
        at.alias("occurred_at"),
        F.lit(app_user(user)).alias("app_user"),
        action.alias("action"),
        F.lit("dim_user_scope").alias("object_name"),
        F.coalesce("_new", "_old").alias("detail"),
    ).where(F.col("action").isNotNull())
