"""Identity resolution: uid → user, user → group."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall import model as M
from footfall.functions import columns as C

UNKNOWN_USER = "0"


def resolve_user(actions: DataFrame, uid_map: DataFrame) -> DataFrame:
    """Fill in the user of actions that carry only a uid.

    Rows with neither a valid user nor a usable uid are dropped; a uid that cannot
    be resolved gives user "0". ``uid_map`` has one (uid, user_id) row per uid.

    Rows with a user bypass the lookup: they are not shuffled by uid, and their uids
    cannot pile up in one partition of it. The price is a second scan of the source,
    with the filter pushed into it.
    """
    known = C.is_valid_user("user_id")
    usable_uid = F.coalesce((F.col("uid") != "") & (F.col("uid") != "0"), F.lit(False))
    lookup = uid_map.select("uid", F.col("user_id").alias("_found")).where(C.is_valid_user("_found"))
    looked_up = (
        actions.where(~known & usable_uid)
        .join(lookup, "uid", "left")
        .withColumn("user_id", F.coalesce("_found", F.lit(UNKNOWN_USER)))
    )
    return actions.where(known).unionByName(looked_up.select(*actions.columns))


SPREAD = 4096


def resolve_group(actions: DataFrame, group_map: DataFrame) -> DataFrame:
    """Group of every user, "0" when there is none; ``group_map`` holds raw (user_id, value).

    Rows without a valid user can match nothing. They get keys of their own, spread by content, so
    that they do not meet in one task.
    """
    groups = group_map.select("user_id", C.parse_group("value").alias("_group")).where(
        (F.col("_group") != M.OVERALL_GROUP) & C.is_valid_user("user_id")
    )
    group = F.coalesce(F.col("_group"), F.lit(M.OVERALL_GROUP))
    spread = F.concat(F.lit("-"), F.pmod(F.xxhash64(*actions.columns), F.lit(SPREAD)).cast("string"))
    keyed = actions.withColumn("_user", F.when(C.is_valid_user("user_id"), F.col("user_id")).otherwise(spread))
    joined = keyed.join(groups.withColumnRenamed("user_id", "_user"), "_user", "left")
    return joined.select(*actions.columns, group.alias("group_id"))


def resolve_identity(actions: DataFrame, uid_map: DataFrame, group_map: DataFrame) -> DataFrame:
    return resolve_group(resolve_user(actions, uid_map), group_map)
