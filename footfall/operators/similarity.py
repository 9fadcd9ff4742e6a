"""Item-item similarity from co-occurrence in user histories and in baskets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators import segments as S
from footfall.operators.popularity import by_group
from footfall.operators.segments import USER
from footfall.session import materialize


# Widths of the fields packed into one ordering long, low to high.
_DAY_BITS, _WEIGHT_BITS = 12, 10


def _stack(high: Column, value: Column, bits: int) -> Column:
    return F.shiftleft(high.cast("long"), bits) + value.cast("long")


def _field(packed: Column, shift: int, bits: int) -> Column:
    return F.shiftright(packed, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def co_occurrence(triggers: DataFrame, segs: DataFrame, p: Params, load: DataFrame | None = None) -> DataFrame:
    """Each trigger with the user's other items that are visible to it.

    An equi-join on (user, shift day) plus a time range, never a cross join: the day
    cuts long histories into pieces, the salt cuts a hot user's day by trigger item.
    """
    left, right = S.split_hot(triggers, segs, [*USER, "shift"], "item_id", p, load)
    right = right.select(
        *USER, "shift", "salt", F.col("item_id").alias("other"), "tenths", "day", "first_time", "first_seq", "last_time"
    )
    joined = left.join(right, [*USER, "shift", "salt"])
    return joined.where((F.col("other") != F.col("item_id")) & S.visible(p))


def user_pair_weight(history: DataFrame, p: Params, days: int | None = None) -> DataFrame:
    """Contributions of each user to item pairs.

    At a trigger a pair is worth the smaller of the two items' best weights in the
    link window, dated at the smaller of the two days. Later triggers replace the
    contribution while it is younger than the link window; once it is older, it stays
    and the next one counts in addition. Triggers of the same shift day always
    replace each other, so one candidate per pair, direction and shift day is enough:
    the join result collapses to that in the join's own partitions.
    """
    # The history feeds two compact forms, and both are used several times below: each is written once.
    rows = materialize(S.since(S.countable(history), p, days).select(*USER, "item_id", "action_time", "seq", "weight", "impression"), "history")
    compact = materialize(S.segments(rows.where(F.col("weight") > 0), p), "segments")
    segs = S.by_shift(compact, p)
    triggers = materialize(S.triggers(rows, p), "triggers")
    hot = S.hot_keys(triggers, [*USER, "shift"], p)
    triggers = S.thin(triggers, compact, p, hot)
    # Thinning adds no rows, so no other group can have become hot.
    load = triggers.join(hot.select(*USER, "shift"), [*USER, "shift"], "left_semi")

    own = segs.select(*USER, "item_id", "shift", "tenths", "day", "first_time", "first_seq", "last_time")
    with_own = (
        triggers.join(own, [*USER, "item_id", "shift"])
        .where(S.visible(p))
        .groupBy(*USER, "item_id", "shift", "action_time", "seq")
        .agg(F.max(S.pack(F.col("tenths"), F.col("day"))).alias("own"))
    )

    pairs = co_occurrence(with_own, segs, p, load=load)
    # Order: time, then the other item's (weight, day); the own (weight, day) rides along.
    offset = F.col("action_time") - p.link_seconds - F.col("shift") * F.lit(M.DAY_SECONDS).cast("long")
    order = _stack(offset, F.col("tenths"), _WEIGHT_BITS)
    order = _stack(order, F.col("day") - F.col("shift"), _DAY_BITS)
    order = _stack(order, S.packed_tenths(F.col("own")), _WEIGHT_BITS)
    order = _stack(order, S.packed_day(F.col("own")) - F.col("shift"), _DAY_BITS)
    last = pairs.groupBy(*USER, "shift", "salt", "item_id", "other").agg(
        F.max(order).alias("_order"), F.max_by("seq", order).alias("_seq")
    )

    o = F.col("_order")
    weight = F.least(_field(o, _DAY_BITS, _WEIGHT_BITS), _field(o, 2 * _DAY_BITS + _WEIGHT_BITS, _WEIGHT_BITS))
    day = F.least(_field(o, 0, _DAY_BITS), _field(o, _DAY_BITS + _WEIGHT_BITS, _DAY_BITS)) + F.col("shift")
    candidates = last.select(
        *USER,
        F.least("item_id", "other").alias("item_a"),
        F.greatest("item_id", "other").alias("item_b"),
        "shift",
        F.shiftright(o, 2 * (_DAY_BITS + _WEIGHT_BITS)).alias("_offset"),
        "_seq",
        weight.alias("tenths"),
        day.alias("_day"),
    )
    run = Window.partitionBy(*USER, "item_a", "item_b").orderBy("shift", "_offset", "_seq")
    following = F.lead("shift").over(run)
    return (
        candidates.withColumn("_next", following)
        .where(F.col("_next").isNull() | (F.col("_day") < F.col("_next")))
        .select(
            *USER, "item_a", "item_b", C.day_of_epoch("_day").alias("day"), (F.col("tenths") / 10.0).alias("weight")
        )
    )


def pair_count(history: DataFrame, p: Params, days: int | None = None) -> DataFrame:
    """Co-occurrence weight per pair, day and group, and over all groups."""
    return by_group(user_pair_weight(history, p, days), ["bid", "item_a", "item_b", "day"])


def pair_total(history: DataFrame, p: Params) -> DataFrame:
    """Pair weights of the retention window at ``as_of``."""
    contributions = user_pair_weight(history, p, p.retention_days)
    oldest = C.day_id(F.lit(p.as_of - p.retention_seconds))
    return by_group(contributions.where(F.col("day") >= oldest), ["bid", "item_a", "item_b"])


def pair_increment(history: DataFrame, p: Params, days: int | None = None, fresh: DataFrame | None = None) -> DataFrame:
    """Variant without per-user pair contributions: only an action that is stronger than
    every earlier one on its item in the link window adds to the item's pairs.

    Such an action is always the first of its slot and weight, so the candidates come
    out of the segments and never out of single events. With ``fresh``, a part of ``history``, only
    its actions add.
    """
    rows = S.since(S.countable(history), p, days)
    segs = materialize(S.segments(rows.where(F.col("weight") > 0), p), "segments")
    first = segs.where("first_is_trigger").select(
        *USER,
        "item_id",
        F.col("first_time").alias("action_time"),
        F.col("first_seq").alias("seq"),
        F.col("tenths").alias("new_tenths"),
        F.col("day").alias("new_day"),
        C.epoch_day(F.col("first_time") - p.link_seconds).alias("shift"),
    )
    if fresh is not None:
        position = [*USER, "item_id", "action_time", "seq"]
        first = first.join(fresh.select(*position).distinct(), position, "left_semi")
    # A row is offered to the days it can be linked from, so an action meets the rows of a few days, however long the history.
    earlier = segs.select(
        *USER,
        "item_id",
        F.explode(F.sequence(F.col("day"), F.col("day") + p.link_days)).alias("new_day"),
        F.col("tenths").alias("old_tenths"),
        F.col("day").alias("old_day"),
        F.col("first_time").alias("old_time"),
        F.col("first_seq").alias("old_seq"),
    )
    before = (F.col("old_time") < F.col("action_time")) | (
        (F.col("old_time") == F.col("action_time")) & (F.col("old_seq") < F.col("seq"))
    )
    beaten = (
        (F.col("old_tenths") >= F.col("new_tenths"))
        & (F.col("old_day") >= C.epoch_day(F.col("action_time") - p.link_seconds))
        & before
    )
    keys = [*USER, "item_id", "new_day"]
    left, right = first.alias("l"), earlier.alias("r")
    same = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    maxima = left.join(right, [*same, beaten], "left_anti")
    pairs = co_occurrence(maxima, S.by_shift(segs, p), p, load=first)
    best = pairs.groupBy(
        *USER, "shift", "salt", "item_id", "other", "action_time", "seq", "new_tenths", "new_day"
    ).agg(F.max(S.pack(F.col("tenths"), F.col("day"))).alias("_best"))
    contributions = best.select(
        "bid",
        "group_id",
        F.least("item_id", "other").alias("item_a"),
        F.greatest("item_id", "other").alias("item_b"),
        C.day_of_epoch(F.least("new_day", S.packed_day(F.col("_best")))).alias("day"),
        (F.least("new_tenths", S.packed_tenths(F.col("_best"))) / 10.0).alias("weight"),
    )
    return by_group(contributions, ["bid", "item_a", "item_b", "day"])


def item_neighbours(history: DataFrame, p: Params, days: int | None = None) -> DataFrame:
    """Distinct (group, item, other) where a user acted on ``item`` with ``other`` among
    their items of the link days; items touched by impressions only do not count.

    Of all triggers on an item with the same shift day, the last one sees most, so one
    per shift day is joined with one row per other item and day.
    """
    # The history feeds two compact forms: resolve it once.
    rows = materialize(S.since(S.countable(history), p, days), "history")
    last = (
        S.triggers(rows, p)
        .groupBy(*USER, "item_id", "shift")
        .agg(F.max("action_time").alias("action_time"), F.max_by("seq", "action_time").alias("seq"))
    )
    last = materialize(last, "last-triggers")
    daily = S.first_of_day(S.segments(rows.where(F.col("weight") > 0), p))
    left, right = S.split_hot(last, S.by_shift(daily, p), [*USER, "shift"], "item_id", p)
    right = right.select(*USER, "shift", "salt", F.col("item_id").alias("other"), "first_time", "first_seq")
    seen = (F.col("first_time") < F.col("action_time")) | (
        (F.col("first_time") == F.col("action_time")) & (F.col("first_seq") <= F.col("seq"))
    )
    return (
        left.join(right, [*USER, "shift", "salt"])
        .where(seen & (F.col("other") != F.col("item_id")))
        .select("bid", "group_id", "item_id", "other")
        .distinct()
        .withColumn("part_key", F.concat_ws("#", "group_id", C.pair_key("item_id", "other")))
    )


def _similar(pairs: DataFrame, totals: DataFrame, keys: list[str], tasks: int | None = None) -> DataFrame:
    """Pairs joined with the totals of both items, and their cosine; ``tasks`` sets the number of tasks a join gets."""
    dealt = lambda side, by: side.repartition(tasks, *keys, by) if tasks else side
    first = totals.select(*keys, F.col("item_id").alias("item_a"), F.col("weight").alias("_a"))
    second = totals.select(*keys, F.col("item_id").alias("item_b"), F.col("weight").alias("_b"))
    joined = dealt(pairs, "item_a").join(dealt(first, "item_a"), [*keys, "item_a"])
    joined = dealt(joined, "item_b").join(dealt(second, "item_b"), [*keys, "item_b"])
    return joined.withColumn("weight", C.cosine_weight("weight", "_a", "_b")).drop("_a", "_b")


def _both_ways(similar: DataFrame, keys: list[str]) -> DataFrame:
    ways = F.array(
        F.struct(F.col("item_a").alias("item"), F.col("item_b").alias("other")),
        F.struct(F.col("item_b").alias("item"), F.col("item_a").alias("other")),
    )
    return similar.where(F.col("weight") > 0).select(*keys, F.inline(ways), "weight")


def item_cf(pairs: DataFrame, totals: DataFrame) -> DataFrame:
    """Ranked-list candidates "users of item also used other", per group and overall.

    ``pairs`` and ``totals`` are retention-window totals per group (group "0" = all).
    """
    keys = ["bid", "group_id"]
    both = _both_ways(_similar(pairs, totals, keys), keys)
    overall = F.col("group_id") == M.OVERALL_GROUP
    list_id = F.when(overall, M.LIST_CF_OVERALL).otherwise(M.LIST_CF)
    return both.select(
        "bid",
        C.result_key("bid", "item", F.lit(M.DEFAULT_ADPOS), list_id, "group_id").alias("key"),
        F.col("other").alias("item_id"),
        "weight",
        list_id.alias("alg_name"),
    )


PAIRS_PER_TASK = 500_000


def basket_cf(rows: DataFrame, basket: str, item: str, p: Params, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """Cosine similarity of items that share baskets, both directions.

    The self-join is on the basket with one order of each pair; a basket with very
    many items is cut by the first item, so its pairs spread over tasks. The number of
    tasks follows the number of pairs, so the memory of one does not grow with the input;
    pairs are counted where the shuffle has put them, since few of them repeat within a task.
    """
    members = materialize(rows.select(F.col(basket).alias("basket"), F.col(item).alias("item_id")).distinct(), "baskets")
    totals = members.groupBy("item_id").agg(F.count("*").cast("double").alias("weight"))
    size = F.col("count").cast("double")
    n_rows, n_pairs = members.groupBy("basket").count().agg(F.sum(size), F.sum(size * (size - 1) / 2)).first()
    tasks = int(max(n_rows or 0, n_pairs or 0) // pairs_per_task) + 1
    left, right = S.split_hot(members, members, ["basket"], "item_id", p)
    left, right = (side.repartition(tasks, "basket", "salt") for side in (left, right))
    pairs = (
        left.withColumnRenamed("item_id", "item_a")
        .join(right.withColumnRenamed("item_id", "item_b"), ["basket", "salt"])
        .where(F.col("item_a") < F.col("item_b"))
        .repartition(tasks, "item_a", "item_b")
        .groupBy("item_a", "item_b")
        .agg(F.count("*").cast("double").alias("weight"))
    )
    return _both_ways(_similar(pairs, totals, [], tasks), [])
