"""Compact form of the user history that the counting operators work on.

Best-weight lookups ("the strongest action on an item in the link window") do not
need every event: rows of one user, item and weight that lie in the same slot of a
day are either all visible to a later trigger or stand in for each other. So a slot
keeps only its first position and its last time. Both are min/max over longs, which
Spark aggregates by hashing with map-side combine, so an item or user that holds a
large share of all events shrinks to a few rows per day before anything is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params
from footfall.session import materialize

USER = ["bid", "user_id", "group_id"]
SPAN = 100_000  # room for an epoch day below a packed weight
SEQ_BITS = 45  # arrival numbers up to 3.5e13


def countable(history: DataFrame) -> DataFrame:
    """History of users with a valid group; the rest never counts, even overall."""
    return history.where(C.is_valid_group("group_id"))


def since(history: DataFrame, p: Params, days: int | None) -> DataFrame:
    """Only rows that can affect day buckets of the last ``days`` days at ``as_of``.

    Contributions on a day need triggers on or after it and history at most one
    link window older, so this prunes the scan without changing those buckets.
    """
    rows = history.where(F.col("action_time") <= p.as_of)
    if days is None:
        return rows
    oldest = ((p.as_of // M.DAY_SECONDS) - days - p.link_days) * M.DAY_SECONDS
    return rows.where(F.col("action_time") >= oldest)


def pack(weight_tenths: Column, day: Column) -> Column:
    """(weight, day) as one long: compares like the struct, aggregates by hashing."""
    return weight_tenths.cast("long") * SPAN + day


def packed_tenths(packed: Column) -> Column:
    return F.floor(packed / SPAN).cast("int")


def packed_day(packed: Column) -> Column:
    return F.pmod(packed, F.lit(SPAN)).cast("int")


MOST_TENTHS = (1 << 10) - 1  # what a packed ordering key holds


def tenths() -> Column:
    """The weight in tenths. Counting keys hold 0.1 to 102.3 in steps of 0.1; any other weight
    is an error, as rounding it would silently change every count that it enters."""
    n = F.round(F.col("weight") * 10)
    exact = (F.abs(F.col("weight") * 10 - n) < 1e-9) & (F.abs(n) <= MOST_TENTHS)
    message = F.concat(F.lit("weight not countable: "), F.col("weight").cast("string"))
    return F.when(exact | n.isNull(), n.cast("int")).otherwise(F.raise_error(message).cast("int"))


def is_trigger() -> Column:
    return ~F.col("impression")


def _position() -> Column:
    """(time of day, seq, is impression) as one long; exact as long as seq fits."""
    fits = F.col("seq").between(0, (1 << SEQ_BITS) - 1)
    flagged = F.shiftleft(F.pmod(F.col("action_time"), F.lit(M.DAY_SECONDS)).cast("long"), SEQ_BITS + 1)
    value = flagged + F.col("seq") * 2 + F.col("impression").cast("int")
    return F.when(fits, value).otherwise(F.raise_error(F.lit("seq out of range")).cast("long"))


def segments(history: DataFrame, p: Params) -> DataFrame:
    """(bid, user, group, item, day, slot, tenths): first position and last time.

    Slots are a day long, or a link window long when that is shorter.
    """
    slot_seconds = min(p.link_seconds, M.DAY_SECONDS)
    slot = F.floor(F.pmod(F.col("action_time"), F.lit(M.DAY_SECONDS)) / slot_seconds).cast("int")
    keys = ["bid", "user_id", "group_id", "item_id", "day", "slot", "tenths"]
    compact = (
        history.withColumns({"day": C.epoch_day("action_time"), "slot": slot, "tenths": tenths()})
        .groupBy(*keys)
        .agg(F.min(_position()).alias("_first"), F.max("action_time").alias("last_time"))
    )
    inner = F.col("_first").bitwiseAND(F.lit((1 << (SEQ_BITS + 1)) - 1))
    return compact.select(
        *keys,
        (F.col("day") * F.lit(M.DAY_SECONDS).cast("long") + F.shiftright("_first", SEQ_BITS + 1)).alias("first_time"),
        F.shiftright(inner, 1).alias("first_seq"),
        (inner % 2 == 0).alias("first_is_trigger"),
        "last_time",
    )


def first_of_day(segs: DataFrame) -> DataFrame:
    """First position per user, item and day, over slots and weights."""
    day_start = F.col("day") * F.lit(M.DAY_SECONDS).cast("long")
    position = F.shiftleft(F.col("first_time") - day_start, SEQ_BITS) + F.col("first_seq")
    keys = ["bid", "user_id", "group_id", "item_id", "day"]
    return (
        segs.groupBy(*keys)
        .agg(F.min(position).alias("_first"))
        .select(
            *keys,
            (day_start + F.shiftright("_first", SEQ_BITS)).alias("first_time"),
            F.col("_first").bitwiseAND(F.lit((1 << SEQ_BITS) - 1)).alias("first_seq"),
        )
    )


def triggers(history: DataFrame, p: Params) -> DataFrame:
    """User actions, one per user, item and second (the last one stands for all of
    them: it sees everything the others see). ``shift`` is the day of t − link."""
    return (
        history.where(is_trigger())
        .groupBy(*USER, "item_id", "action_time")
        .agg(F.max("seq").alias("seq"))
        .withColumn("shift", C.epoch_day(F.col("action_time") - p.link_seconds))
    )


def hot_keys(rows: DataFrame, keys: list[str], p: Params) -> DataFrame:
    """Keys with more than ``rows_per_split`` rows, and their number of rows: at most
    rows / rows_per_split of them. The list is written, so that Spark knows its size when it plans the joins with it
    and broadcasts it where that allows; large sides are then not sorted and shuffled for a few keys."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return materialize(counts.where(F.col("_rows") > p.rows_per_split), "hot-keys")


def session_ends(segs: DataFrame, p: Params) -> DataFrame:
    """Times at which an item of a user stops being visible for want of newer actions."""
    keys = [*USER, "item_id"]
    slots = segs.groupBy(*keys, "day", "slot").agg(
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time")
    )
    following = F.lead("first_time").over(Window.partitionBy(*keys).orderBy("day", "slot"))
    end = F.col("last_time") + p.link_seconds
    return (
        slots.withColumn("_next", following)
        .where(F.col("_next").isNull() | (F.col("_next") >= end))
        .select(*USER, F.col("day").alias("shift"), end.alias("end_time"))
    )


def _before(values: Column, value: Column) -> Column:
    """Largest of ``values`` below ``value``, -1 if there is none."""
    return F.coalesce(F.array_max(F.filter(values, lambda v: v < value)), F.lit(-1).cast("long"))


def thin(triggers: DataFrame, segs: DataFrame, p: Params, hot: DataFrame) -> DataFrame:
    """Drop triggers of hot (user, shift) groups that cannot be the last one for any pair.

    Pairs only need the last trigger per item, other item and shift at which the other
    item is visible. Between two triggers on an item nothing becomes invisible unless
    a session of the user ends there, so the later one serves for both. Seconds of
    minutes with such an end are kept apart; so are runs of other minutes between two
    such minutes of an hour, and runs of hours without any end. What stays depends on
    the number of items and session ends of a day, not on its number of actions.
    ``hot`` are the ``hot_keys`` of the triggers by (user, shift).
    """
    group = [*USER, "shift"]
    hot = hot.select(*group, F.lit(True).alias("_hot"))
    flagged = triggers.join(hot, group, "left")
    ends = session_ends(segs.join(hot.select(*USER).distinct(), USER, "left_semi"), p).join(hot, group)
    minute, hour = F.floor(F.col("end_time") / 60), F.floor(F.col("end_time") / 3600)
    # At most 25 hours per group and 60 minutes per hour.
    hours = ends.groupBy(*group).agg(F.collect_set(hour).alias("_hours"))
    minutes = ends.groupBy(*group, hour.alias("_hour")).agg(F.collect_set(minute).alias("_minutes"))

    time = F.col("action_time")
    at_minute = F.floor(time / 60)
    in_hour, in_minute = F.col("_minutes").isNotNull(), F.array_contains("_minutes", at_minute)
    none = F.array().cast("array<bigint>")
    run = (
        F.when(~in_hour, _before(F.coalesce("_hours", none), F.col("_hour")))
        .when(~in_minute, _before(F.col("_minutes"), at_minute))
        .otherwise(time)
    )
    thinned = (
        flagged.where("_hot")
        .withColumn("_hour", F.floor(time / 3600))
        .join(hours, group, "left")
        .join(minutes, [*group, "_hour"], "left")
        .withColumns({"_run": run, "_in": F.when(in_hour, F.col("_hour")), "_apart": in_hour & in_minute})
        .groupBy(*group, "item_id", "_in", "_apart", "_run")
        .agg(F.max("action_time").alias("action_time"), F.max_by("seq", "action_time").alias("seq"))
    )
    return flagged.where(F.col("_hot").isNull()).select(*triggers.columns).unionByName(thinned.select(*triggers.columns))


def by_shift(segs: DataFrame, p: Params) -> DataFrame:
    """Segments once per trigger ``shift`` they can be visible to (2 for a one-day link)."""
    first = C.epoch_day(F.col("first_time") - p.link_seconds)
    return segs.withColumn("shift", F.explode(F.sequence(first, F.col("day"))))


def visible(p: Params) -> Column:
    """The segment has a row in (t − link, t], up to the trigger's own position."""
    started = (F.col("first_time") < F.col("action_time")) | (
        (F.col("first_time") == F.col("action_time")) & (F.col("first_seq") <= F.col("seq"))
    )
    return started & (F.col("last_time") > F.col("action_time") - p.link_seconds)


def split_hot(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread_by: str,
    p: Params,
    load: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Add a ``salt`` to both sides of an equi-join so that no key is too much for a task.

    Keys with more than ``rows_per_split`` left rows are cut into enough parts by a
    hash of ``spread_by``; the right side of such keys is repeated once per part. All
    other keys have the single part 0. ``load`` may stand in for ``left`` when counting: an earlier
    form of it with at least as many rows per key, or its rows of all keys that can be hot.
    """
    hot = hot_keys(left if load is None else load, keys, p).select(
        *keys, F.ceil(F.col("_rows") / p.rows_per_split).cast("int").alias("_parts")
    )
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    salted_left = left.join(hot, keys, "left").withColumn("salt", F.pmod(F.hash(spread_by), parts))
    salted_right = right.join(hot, keys, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return salted_left.drop("_parts"), salted_right.drop("_parts")
