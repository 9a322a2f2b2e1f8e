"""Joins between facts and their lookup tables.

No side is broadcast by hint. Catalyst compares the estimated size of a side
with ``spark.sql.autoBroadcastJoinThreshold``, AQE repeats the check with the
real shuffle size, and both fall back to a sort-merge join whose hot
partitions AQE splits. Lookup tables are unique by key, so a split partition
only repeats one lookup row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    fact: DataFrame, table: DataFrame, key: str, columns: dict[str, str], how: str = "inner"
) -> DataFrame:
    """Bring columns of the row whose ``id`` equals ``fact.<key>``.

    ``columns`` maps the lookup column to its name in the result.
    """
    side = table.select(
        F.col("id").alias("_lookup_id"), *[F.col(f"`{c}`").alias(n) for c, n in columns.items()]
    )
    return fact.join(side, fact[key] == side["_lookup_id"], how).drop("_lookup_id")


def without(left: DataFrame, right: DataFrame, key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` with no partner.

    The partners' keys are made distinct first: that collapses hot keys on the
    map side and leaves the partitioning the anti join needs.
    """
    keys = right.where(F.col(right_key).isNotNull()).select(F.col(right_key).alias("_partner")).distinct()
    return left.join(keys, left[key] == keys["_partner"], "left_anti")


def attach_groups(rows: DataFrame, groups: DataFrame, keys: list[str], spread_by: str, salts: int = 64) -> DataFrame:
    """Rows joined to the aggregate row of their group.

    Each group row is repeated once per salt and the rows spread over the salts
    by a unique column, so that one huge group is joined by many tasks. Meant for
    ``groups`` that are few, e.g. filtered to the odd ones.
    """
    spread = groups.withColumn("_salt", F.explode(F.array(*[F.lit(n) for n in range(salts)])))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    return salted.join(spread, [*keys, "_salt"]).drop("_salt")


def chain(versions: DataFrame, active: DataFrame) -> DataFrame:
    """Every stored version that resolves to an active one.

    One level by construction: each version points straight at the current one.
    Returns ``active_id, version_id``.
    """
    current = active.select(F.col("id").alias("active_id"))
    links = versions.select(
        F.col("id").alias("version_id"), F.col("current_service_recurrence_id").alias("_current")
    )
    return links.join(current, links["_current"] == current["active_id"]).select("active_id", "version_id")
