"""Configurable row validation: a field list per topic and rules per column."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions import columns as C


@dataclass(frozen=True)
class ColumnRule:
    """Not-null (null or the text "null") and an inclusive numeric range like "[1,9]"."""

    not_null: bool = False
    value_range: str | None = None

    def bounds(self) -> tuple[int, int] | None:
        parts = re.sub(r"[\[\]()]", "", self.value_range or "").split(",")
        if len(parts) == 2 and all(re.fullmatch(r"[0-9]+", p) for p in parts):
            return int(parts[0]), int(parts[1])
        return None

    def violated(self, value: Column) -> Column:
        bad = F.lit(False)
        if self.not_null:
            bad = value.isNull() | (F.lower(value) == "null")
        bounds = self.bounds()
        if bounds:
            number = F.when(C.is_number(value), value.try_cast("long"))
            bad = bad | ~F.coalesce(number.between(*bounds), F.lit(False))
        return F.coalesce(bad, F.lit(False))


@dataclass(frozen=True)
class TopicRules:
    """Field list per topic; column rules per (business, topic)."""

    fields: Mapping[str, Sequence[str]]
    rules: Mapping[tuple[str, str], Mapping[str, ColumnRule]]


def validate_rows(rows: DataFrame, config: TopicRules) -> DataFrame:
    """Check ``values`` (array<string>) of each (bid, topic) row.

    Adds ``reason`` (null when valid). Unknown topics or businesses, a wrong
    number of values and any broken rule reject the row. The whole configuration
    becomes one generated expression; no lookup join is needed.
    """
    reason = None
    for (bid, topic), column_rules in config.rules.items():
        if topic not in config.fields:
            continue
        fields = list(config.fields[topic])
        here = (F.col("bid") == bid) & (F.col("topic") == topic)
        checks = F.when(F.size("values") != len(fields), F.lit("field_count"))
        for name, rule in column_rules.items():
            if name in fields:
                value = F.get("values", F.lit(fields.index(name)))
                checks = checks.when(rule.violated(value), F.lit(f"bad_{name}"))
        checks = checks.otherwise(F.lit(""))
        reason = F.when(here, checks) if reason is None else reason.when(here, checks)
    reason = F.lit("unknown_topic") if reason is None else F.coalesce(reason, F.lit("unknown_topic"))
    return rows.withColumn("reason", F.when(reason != "", reason))


def named_values(rows: DataFrame, config: TopicRules) -> DataFrame:
    """Valid rows as a field → value map in ``row``."""
    names = reduce(
        lambda acc, item: acc.when(F.col("topic") == item[0], F.array(*[F.lit(f) for f in item[1]])),
        list(config.fields.items())[1:],
        F.when(
            F.col("topic") == next(iter(config.fields)),
            F.array(*[F.lit(f) for f in next(iter(config.fields.values()))]),
        ),
    )
    return rows.where(F.col("reason").isNull()).withColumn("row", F.map_from_arrays(names, "values"))


RULE_SCHEMA = "bid string, topic string, position int, field string, not_null boolean, value_range string"


def rules_from_rows(rows: DataFrame) -> TopicRules:
    """The configuration as a table: a row per (bid, topic, field) with the field's position and its rule.

    The fields of a topic are those of any business. It is a table of configuration: it is read by the driver whole.
    """
    fields: dict[str, dict[int, str]] = {}
    config: dict[tuple[str, str], dict[str, ColumnRule]] = {}
    for r in rows.select("bid", "topic", "position", "field", "not_null", "value_range").collect():
        fields.setdefault(r["topic"], {})[r["position"]] = r["field"]
        own = config.setdefault((r["bid"], r["topic"]), {})
        if r["not_null"] or r["value_range"]:
            own[r["field"]] = ColumnRule(bool(r["not_null"]), r["value_range"])
    return TopicRules({t: [f for _, f in sorted(by.items())] for t, by in fields.items()}, config)
