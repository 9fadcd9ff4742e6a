"""Column helpers: validity rules, keys, days, weights and scores.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from footfall import model as M


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------- validity


def is_valid_user(user: Column | str) -> Column:
    """All digits and at least five of them (which rules out "0")."""
    return F.coalesce(_col(user).rlike(r"^[0-9]{5,}\z"), F.lit(False))


def is_valid_time(time: Column | str) -> Column:
    """Epoch seconds as text: all digits and at least nine of them."""
    return F.coalesce(_col(time).rlike(r"^[0-9]{9,}\z"), F.lit(False))


def is_valid_group(group: Column | str) -> Column:
    c = _col(group)
    number = F.when(c.rlike(r"^[0-9]+\z"), c.try_cast("int"))
    return F.coalesce(number.isin(*M.VALID_GROUPS), F.lit(False))


def is_valid_item(item: Column | str) -> Column:
    return F.coalesce(_col(item) != "", F.lit(False))


is_valid_page = is_valid_item


def is_recommend_action(action_type: Column | str) -> Column:
    """Impressions and clicks on a recommended list; works on text and numbers."""
    return F.coalesce(_col(action_type).cast("string").isin(*[str(t) for t in M.RECOMMEND_TYPES]), F.lit(False))


def is_number(text: Column | str) -> Column:
    return F.coalesce(_col(text).rlike(r"^[0-9]+\z"), F.lit(False))


# ----------------------------------------------------------------------- days


def epoch_day(time: Column | str) -> Column:
    """Epoch seconds to days since 1970-01-01 (UTC), as int."""
    return F.floor(_col(time) / M.DAY_SECONDS).cast("int")


def day_of_epoch(day: Column | str) -> Column:
    """Days since 1970-01-01 to a yyyyMMdd number."""
    date = F.date_from_unix_date(_col(day).cast("int"))
    return (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("long")


def day_id(time: Column | str) -> Column:
    """Epoch seconds to a yyyyMMdd number in UTC."""
    return day_of_epoch(epoch_day(time))


# ----------------------------------------------------------------------- keys


def join_key(*parts: Column | str) -> Column:
    return F.concat_ws("#", *[_col(p).cast("string") for p in parts])


def pair_key(a: Column | str, b: Column | str) -> Column:
    """Both items in canonical order, '#'-joined."""
    return F.concat_ws("#", F.least(_col(a), _col(b)), F.greatest(_col(a), _col(b)))


def result_key(bid, subject, adpos, list_id, group) -> Column:
    return join_key(bid, subject, adpos, list_id, group)


def part_key(user: Column | str, uid: Column | str) -> Column:
    """Partition key of an action: the user, else a non-empty uid, else null."""
    return F.when(is_valid_user(user), _col(user)).when(_col(uid) != "", _col(uid))


# -------------------------------------------------------------------- weights


def _weight_case(action_type: Column, table: Mapping[int, float], scale: float, cast: str) -> Column:
    by_weight: dict[float, list[int]] = {}
    for kind, weight in table.items():
        by_weight.setdefault(weight, []).append(kind)
    case = None
    for weight, kinds in by_weight.items():
        value = F.lit(weight * scale).cast(cast)
        case = F.when(action_type.isin(*kinds), value) if case is None else case.when(action_type.isin(*kinds), value)
    return case


def action_weight(action_type: Column | str, table: Mapping[int, float] = M.ACTION_WEIGHTS) -> Column:
    """Preference weight of an action type; null when the type is unknown."""
    return _weight_case(_col(action_type), table, 1.0, "double")


def action_weight_tenths(action_type: Column | str, table: Mapping[int, float] = M.ACTION_WEIGHTS) -> Column:
    """Same in integer tenths, so that sums and comparisons are exact."""
    return _weight_case(_col(action_type), table, 10.0, "int")


def profile_weight_tenths(action_type: Column | str, override: Mapping[int, float] | None = None) -> Column:
    """Interest weight in tenths; ``override`` wins over the built-in table."""
    table = dict(M.PROFILE_WEIGHTS)
    table.update(override or {})
    return F.coalesce(_weight_case(_col(action_type), table, 10.0, "int"), F.lit(0))


def filter_score_tenths(action_type: Column | str, count: Column | str) -> Column:
    """Already-seen score in tenths: 0.1 per impression, 1 per stronger action."""
    kind, n = _col(action_type), _col(count).cast("long")
    return F.when(kind == 1, n).when(kind > 1, n * 10).otherwise(F.lit(0).cast("long"))


# ---------------------------------------------------------------- text fields


def strip_suffix(item: Column | str) -> Column:
    """Drop one trailing '#1' or '#2' marker from an item id."""
    return F.regexp_replace(_col(item), r"#[12]\z", "")


def result_items(action_result: Column | str) -> Column:
    """Items of a recommended list: split on ';', markers stripped, empties dropped."""
    return F.filter(
        F.transform(F.split(_col(action_result), ";", -1), strip_suffix),
        lambda x: x != "",
    )


def parse_group(value: Column | str) -> Column:
    """Second part of 'x,group,…' or 'x|group|…' when it is a valid group, else '0'."""
    second = F.get(F.split(_col(value), r"[,|]"), F.lit(1))
    return F.when(is_valid_group(second), second).otherwise(F.lit(M.OVERALL_GROUP))


def flag_number(text: Column | str) -> Column:
    c = _col(text)
    return F.when(c == "1", 1).when(c == "2", 2).otherwise(0)


# --------------------------------------------------------------------- scores


def cosine_weight(pair: Column | str, first: Column | str, second: Column | str) -> Column:
    p, a, b = _col(pair), _col(first), _col(second)
    return F.when((p == 0) | (a == 0) | (b == 0), F.lit(0.0)).otherwise(p / (F.sqrt(a) * F.sqrt(b)))


def ctr_weight(click: Column | str, impress: Column | str) -> Column:
    c, i = _col(click), _col(impress)
    return F.when((c > 0) & (i > 0), c / i).otherwise(F.lit(0.0))
