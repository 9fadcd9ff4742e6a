"""Content tags of items, tag indexes, user interest profiles, text classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from footfall import model as M
from footfall.functions import columns as C
from footfall.model import Params
from footfall.operators.ranking import top_n
from footfall.sources.dimensions import latest_per

TAG_LEVELS = (("big_type_name", 0), ("mid_type_name", 1), ("small_type_name", 2))


def item_tags(dim_item: DataFrame, classified: DataFrame | None = None, classifier_level: int = 3) -> DataFrame:
    """(bid, item, tag, level, weight, item_time): the three category names of an item
    and, when given, the classifier's (bid, item_id, tag, weight). Empty tags are skipped.

    Given categories carry no classifier weight (0).
    """
    given = F.array(
        *[F.struct(F.col(name).alias("tag"), F.lit(level).alias("level"), F.lit(0.0).alias("tag_weight")) for name, level in TAG_LEVELS]
    )
    tags = dim_item.select("bid", "item_id", "item_time", F.inline(given))
    if classified is not None:
        times = dim_item.select("bid", "item_id", "item_time")
        scored = classified.select(
            "bid", "item_id", "tag", F.lit(classifier_level).alias("level"), F.col("weight").alias("tag_weight")
        )
        tags = tags.unionByName(scored.join(times, ["bid", "item_id"]))
    return tags.where(F.coalesce(F.col("tag") != "", F.lit(False)))


def tag_index(tags: DataFrame, p: Params, min_day: int = 0) -> DataFrame:
    """Freshest items per tag, newest attributes per item, items up to ``min_day`` left out."""
    rows = tags.where(C.day_id("item_time") > min_day)
    newest = latest_per(rows, ["bid", "tag", "item_id"], [F.desc("item_time"), F.asc("level"), F.desc("tag_weight")])
    ranked = top_n(newest, ["bid", "tag"], [F.desc("item_time"), F.asc("item_id")], p.tag_index_size)
    return ranked.select("bid", "tag", "rank", "item_id", "item_time", "level", "tag_weight")


def action_tags(actions: DataFrame, tags: DataFrame) -> DataFrame:
    """Actions with each tag of their item; items without tags drop out."""
    return actions.join(tags.select("bid", "item_id", "tag", "level"), ["bid", "item_id"])


def drop_denied_tags(tagged: DataFrame, denied: Sequence[str] | DataFrame) -> DataFrame:
    """Tags on a deny list (place and section names) do not describe interests."""
    if isinstance(denied, DataFrame):
        return tagged.join(denied.select("tag").distinct(), "tag", "left_anti")
    return tagged.where(~F.col("tag").isin(*denied)) if denied else tagged


def default_denied_tags() -> list[str]:
    return list(M.DEFAULT_DENIED_TAGS)


def with_profile_weight(actions: DataFrame, override: Mapping[int, float] | DataFrame | None, name: str = "_tenths") -> DataFrame:
    """Actions with their interest weight in tenths. ``override`` wins over the built-in weights: a mapping, or a
    table (action_type, weight) with a row per type."""
    if not isinstance(override, DataFrame):
        return actions.withColumn(name, C.profile_weight_tenths("action_type", override))
    own = override.select(F.col("action_type").cast("int").alias("_type"), F.round(F.col("weight") * 10).cast("int").alias("_own"))
    joined = actions.join(own, F.col("action_type") == F.col("_type"), "left")
    return joined.withColumn(name, F.coalesce("_own", C.profile_weight_tenths("action_type"))).drop("_type", "_own")


def user_profile(
    actions: DataFrame,
    tags: DataFrame,
    p: Params,
    denied: Sequence[str] | DataFrame = (),
    override: Mapping[int, float] | DataFrame | None = None,
) -> DataFrame:
    """Interest per user and tag: summed action weights of the tag's items.

    Actions shrink to one weight per (user, item) before they meet the tags, so a hot
    item reaches the join as one row per user. Sums run in integer tenths.
    """
    weighted = (
        with_profile_weight(
            actions.where(C.is_valid_user("user_id") & C.is_valid_item("item_id") & (F.col("action_time") <= p.as_of)), override
        )
        .where(F.col("_tenths") > 0)
        .groupBy("bid", "user_id", "item_id")
        .agg(F.sum("_tenths").alias("_tenths"))
    )
    tagged = drop_denied_tags(tags.select("bid", "item_id", "tag", "level").distinct(), denied)
    weight = F.sum("_tenths") * F.lit(M.PROFILE_LEVEL * M.PROFILE_LOSS / 10.0)
    return (
        weighted.join(tagged, ["bid", "item_id"])
        .groupBy("bid", "user_id", "tag")
        .agg(F.round(weight, 6).alias("weight"), F.min("level").alias("level"))
        .where(F.col("weight") > 0)
        .withColumn("type", F.lit(1))
    )


def profile_top_tags(profile: DataFrame, p: Params) -> DataFrame:
    return top_n(profile, ["bid", "user_id"], [F.desc("weight"), F.asc("tag")], p.profile_size)


def fit_classifier(labelled: DataFrame, features: int = 1 << 14, iterations: int = 20):
    """Text classifier (``text``, ``label``) as a Spark ML pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StringIndexer

    stages = [
        StringIndexer(inputCol="label", outputCol="_label", stringOrderType="alphabetAsc"),
        RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"(?U)\W+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(
            featuresCol="_features", labelCol="_label", probabilityCol="_probability", maxIter=iterations, regParam=0.01
        ),
    ]
    return Pipeline(stages=stages).fit(labelled)


def classify_items(items: DataFrame, model, id_columns: Sequence[str], min_weight: float = 0.0) -> DataFrame:
    """(id columns, tag, weight) for every label of the fitted model."""
    from pyspark.ml.functions import vector_to_array

    names = model.stages[0].labels
    scoring = model.copy()
    scoring.stages = model.stages[1:]
    scored = scoring.transform(items).select(*id_columns, vector_to_array("_probability").alias("_p"))
    entries = F.array(
        *[F.struct(F.lit(n).alias("tag"), F.get("_p", F.lit(i)).alias("weight")) for i, n in enumerate(names)]
    )
    return scored.select(*id_columns, F.inline(entries)).where(F.col("weight") >= min_weight)
