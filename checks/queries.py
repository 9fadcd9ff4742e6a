"""The registered queries: every operator over the whole shared tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall import fixtures as X
from footfall.functions import columns as C
from footfall.operators import content, ctr, enrich, filtering, history as H, popularity, ranking, similarity
from footfall.plans import recommend
from footfall.sources import dimensions as D, messages as msg, rules

Query = Callable[[SparkSession, str], DataFrame]
P = X.PARAMS
QUERIES: dict[str, Query] = {}

DENIED_TAGS = ("ECONOMY", "Brand#7")
RULES = rules.TopicRules(
    fields={
        "user_action": ("user_id", "uid", "action_type", "action_time", "item_id", "platform"),
        "recommend_action": ("user_id", "uid", "action_type", "action_time", "item_id"),
    },
    rules={
        ("1", "user_action"): {
            "user_id": rules.ColumnRule(not_null=True, value_range="[10001,11200]"),
            "action_type": rules.ColumnRule(value_range="[1,12]"),
            "platform": rules.ColumnRule(not_null=True),
        },
        ("1", "recommend_action"): {"item_id": rules.ColumnRule(not_null=True)},
    },
)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --------------------------------------------------------------------- ingest


@query
def ingest_category(spark, sf):
    rows = msg.with_fields(msg.with_category(X.action_messages(spark, sf)))
    return rows.select("seq", "category", F.size("fields").alias("n_fields"), F.get("fields", F.lit(6)).alias("item_field"))


@query
def parse_actions_general(spark, sf):
    return msg.accepted(msg.parse_actions(X.action_messages(spark, sf)))


@query
def parse_actions_news(spark, sf):
    return msg.accepted(msg.parse_actions(X.action_messages(spark, sf), "news"))


@query
def parse_items(spark, sf):
    return msg.accepted(msg.parse_items(X.item_messages(spark, sf)))


@query
def parse_users(spark, sf):
    return msg.accepted(msg.parse_users(X.user_messages(spark, sf)))


@query
def parse_weights(spark, sf):
    return msg.accepted(msg.parse_weights(X.weight_messages(spark, sf)))


@query
def parse_categories(spark, sf):
    return msg.accepted(msg.parse_categories(X.category_messages(spark, sf)))


@query
def parse_ad_pools(spark, sf):
    return msg.accepted(msg.parse_ad_pools(X.pool_messages(spark, sf)))


@query
def reject_reasons(spark, sf):
    return msg.rejects(X.all_messages(spark, sf), "news")


@query
def ingest_counts(spark, sf):
    return msg.ingest_counts(X.all_messages(spark, sf))


@query
def validate_rows(spark, sf):
    a = X.actions(spark, sf)
    text = [F.col(c).cast("string") for c in ("user_id", "uid", "action_type", "action_time", "item_id")]
    platform = F.when(F.col("platform") == "3", "NULL").otherwise(F.col("platform"))
    rows = a.select(
        "seq",
        F.when(F.col("seq") % 17 == 0, "2").otherwise(F.col("bid")).alias("bid"),
        F.when(F.col("seq") % 19 == 0, "other").otherwise(F.col("topic")).alias("topic"),
        F.when(F.col("topic") == "user_action", F.array(*text, platform)).otherwise(F.array(*text)).alias("values"),
    )
    rows = rows.withColumn("values", F.when(F.col("seq") % 23 == 0, F.slice("values", 1, 4)).otherwise(F.col("values")))
    return rules.validate_rows(rows, RULES).select("seq", "bid", "topic", F.coalesce("reason", F.lit("ok")).alias("verdict"))


@query
def dim_latest_items(spark, sf):
    typed = D.typed_items(X.dim_item_messages_parsed(spark, sf))
    return D.upsert_dimension(typed, ["bid", "item_id"], [F.desc("imp_date"), F.desc("seq")])


@query
def dim_latest_users(spark, sf):
    typed = D.typed_users(msg.accepted(msg.parse_users(X.user_messages(spark, sf))))
    return D.unexpired(D.upsert_dimension(typed, ["bid", "user_id"], [F.desc("imp_date"), F.desc("seq")]), P.as_of)


@query
def dim_latest_weights(spark, sf):
    typed = D.typed_weights(msg.accepted(msg.parse_weights(X.weight_messages(spark, sf))))
    return D.upsert_dimension(typed, ["bid", "action_type"], [F.desc("imp_date"), F.desc("seq")])


@query
def dim_latest_categories(spark, sf):
    typed = D.typed_categories(msg.accepted(msg.parse_categories(X.category_messages(spark, sf))))
    return D.upsert_dimension(typed, ["bid", "cate_id"], [F.desc("imp_date"), F.desc("seq")])


# ------------------------------------------------------------ identity, history


@query
def resolve_identity(spark, sf):
    return X.resolved_actions(spark, sf)


@query
def explode_impressions(spark, sf):
    return H.explode_impressions(X.actions(spark, sf)).select("seq", "bid", "user_id", "item_id", "action_type", "action_time")


@query
def user_history(spark, sf):
    return X.history(spark, sf)


@query
def action_detail(spark, sf):
    return H.action_detail(X.history(spark, sf), P)


@query
def impress_detail(spark, sf):
    return H.impress_detail(X.history(spark, sf), P)


CAP = 2


@query
def detail_nested(spark, sf):
    return H.nest_detail(H.cap_day_items(H.action_detail(X.history(spark, sf), P), CAP))


@query
def detail_nested_flat(spark, sf):
    return H.flatten_detail(detail_nested(spark, sf))


@query
def combine_last(spark, sf):
    return H.combine_last(X.actions(spark, sf), replace(P, flush_seconds=3600))


@query
def combine_max_type(spark, sf):
    return H.combine_max_type(X.resolved_actions(spark, sf), replace(P, flush_seconds=3600))


# ------------------------------------------------------------------ popularity


@query
def action_with_history(spark, sf):
    return popularity.action_with_history(X.history(spark, sf), P)


@query
def user_item_weight(spark, sf):
    return popularity.user_item_weight(X.history(spark, sf), P)


@query
def item_count(spark, sf):
    return popularity.item_count(X.history(spark, sf), P)


@query
def item_total(spark, sf):
    return popularity.item_total(X.history(spark, sf), P)


@query
def hot_items(spark, sf):
    return popularity.hot_items(popularity.item_total(X.history(spark, sf), P))


@query
def hot_by_category(spark, sf):
    totals = popularity.item_total(X.history(spark, sf), P)
    return popularity.hot_by_category(totals, X.dim_item(spark, sf), "big_type")


@query
def hot_by_small_category(spark, sf):
    totals = popularity.item_total(X.history(spark, sf), P)
    return popularity.hot_by_category(totals, X.dim_item(spark, sf), "small_type")


# ------------------------------------------------------------------ similarity


@query
def user_pair_weight(spark, sf):
    return similarity.user_pair_weight(X.history(spark, sf), P)


@query
def user_pair_weight_3_days(spark, sf):
    return similarity.user_pair_weight(X.history(spark, sf), replace(P, link_seconds=3 * 86400))


@query
def user_pair_weight_6_hours(spark, sf):
    return similarity.user_pair_weight(X.history(spark, sf), replace(P, link_seconds=6 * 3600))


@query
def pair_count(spark, sf):
    return similarity.pair_count(X.history(spark, sf), P)


@query
def pair_total(spark, sf):
    return similarity.pair_total(X.history(spark, sf), P)


@query
def pair_increment(spark, sf):
    return similarity.pair_increment(X.history(spark, sf), P)


@query
def item_neighbours(spark, sf):
    return similarity.item_neighbours(X.history(spark, sf), P)


@query
def item_cf(spark, sf):
    h = X.history(spark, sf)
    cf = similarity.item_cf(similarity.pair_total(h, P), popularity.item_total(h, P))
    return cf.withColumn("weight", F.round("weight", 6))


@query
def basket_cf(spark, sf):
    orders = X.table(spark, sf, "orders").select("o_orderkey")
    items = X.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    rows = items.join(orders, items.l_orderkey == orders.o_orderkey)
    return similarity.basket_cf(rows, "l_orderkey", "l_partkey", P).withColumn("weight", F.round("weight", 6))


# ------------------------------------------------------------------------- ctr


@query
def ctr_daily(spark, sf):
    return ctr.ctr_daily(X.resolved_actions(spark, sf))


@query
def ctr_lists(spark, sf):
    return ctr.ctr(ctr.ctr_daily(X.resolved_actions(spark, sf)), P).withColumn("weight", F.round("weight", 6))


@query
def ctr_lists_by_group(spark, sf):
    return ctr.ctr(ctr.ctr_daily(X.resolved_actions(spark, sf)), P, per_group=True).withColumn("weight", F.round("weight", 6))


# ------------------------------------------------------------- enrich, ranking


@query
def enrich_actions(spark, sf):
    return enrich.enrich_items(X.resolved_actions(spark, sf), X.dim_item(spark, sf)).select(
        "seq", "bid", "item_id", "user_id", "big_type", "mid_type", "small_type", "free", "price", "shop_id", "item_time"
    )


def _item_ranges(spark, sf):
    records = D.typed_items(X.dim_item_messages_parsed(spark, sf)).withColumn("valid_from", D.day_start("imp_date"))
    return D.validity(records, ["bid", "item_id"])


@query
def item_ranges(spark, sf):
    """Validity ranges of the item records."""
    return _item_ranges(spark, sf).select("bid", "item_id", "price", "item_time", "valid_from", "valid_to")


@query
def enrich_actions_as_of(spark, sf):
    """Actions with the item attributes that held at their time."""
    rows = enrich.enrich_items_as_of(X.resolved_actions(spark, sf), _item_ranges(spark, sf))
    return rows.select("seq", "bid", "item_id", "user_id", "big_type", "mid_type", "small_type", "free", "price", "shop_id", "item_time")


@query
def enrich_results(spark, sf):
    totals = popularity.item_total(X.history(spark, sf), P)
    candidates = enrich.category_candidates(totals, "mid_type").unionByName(popularity.hot_items(totals))
    return enrich.enrich_results(candidates, X.dim_item(spark, sf))


@query
def top_results(spark, sf):
    lists = recommend.ranked_lists(X.resolved_actions(spark, sf), X.dim_item(spark, sf), P)
    return lists.select("key", "rank", "item_id", F.round("weight", 6).alias("weight"), "item_time", "free", "shop_id")


@query
def hot_top_results(spark, sf):
    lists = recommend.hot_lists(X.resolved_actions(spark, sf), X.dim_item(spark, sf), P)
    return lists.select("key", "rank", "item_id", "weight", "item_time")


@query
def sink_keyed(spark, sf):
    """Hot lists put into the keyed sink: all keys, then the overall ones anew, and one key long
    ago; read back before the first two expire. The other keys must survive the second put."""
    from footfall.session import materialize, shared_folder
    from footfall.streaming import store

    lists = materialize(hot_top_results(spark, sf), "hot-lists")
    served = store.served_table(spark, shared_folder(spark, "served"), lists.schema)
    old = lists.limit(1).withColumn("key", F.lit("gone"))
    store.put(served, old, 0, P.as_of - 20 * 86400, 10 * 86400)
    store.put(served, lists.withColumn("rank", F.col("rank") + 100), 1, P.as_of, 10 * 86400)
    store.put(served, lists.where(F.col("key").endswith("#0")), 2, P.as_of, 10 * 86400)
    return store.get_alive(served, ["key"], P.as_of + 86400)


@query
def user_recent(spark, sf):
    return ranking.user_recent(X.resolved_actions(spark, sf), X.dim_item(spark, sf), P).drop("seq")


@query
def merge_recent(spark, sf):
    """Lists at an earlier time merged with the actions since then give today's lists."""
    rows, dim = X.resolved_actions(spark, sf), X.dim_item(spark, sf)
    cut = P.as_of - 5 * 86400
    stored = ranking.user_recent(rows, dim, replace(P, as_of=cut))
    fresh = ranking.user_recent(rows.where(F.col("action_time") > cut), dim, P)
    return ranking.merge_recent(stored, fresh, P).select("key", "rank", "item_id", "action_time")


# ------------------------------------------------------------------- filtering


@query
def filter_scores(spark, sf):
    return filtering.filter_scores(H.daily_detail(X.history(spark, sf), P), P)


CURRENT = replace(P, as_of=P.as_of - 2 * 86400, flush_seconds=43200)


@query
def filter_scores_current(spark, sf):
    actions = X.resolved_actions(spark, sf)
    return filtering.filter_scores(H.daily_detail(H.user_history(actions), CURRENT), CURRENT, current=actions)


FILTER = replace(P, filter_impress_days=5, filter_size=4)


@query
def user_filter_list(spark, sf):
    detail = H.daily_detail(X.history(spark, sf), FILTER)
    return filtering.user_filter_list(filtering.filter_scores(detail, FILTER), detail, FILTER)


# --------------------------------------------------------------------- content


@query
def item_tags(spark, sf):
    return content.item_tags(X.dim_item(spark, sf))


@query
def tag_index(spark, sf):
    return content.tag_index(content.item_tags(X.dim_item(spark, sf)), P, min_day=20240129)


@query
def action_tags(spark, sf):
    tags = content.drop_denied_tags(content.item_tags(X.dim_item(spark, sf)), DENIED_TAGS)
    return content.action_tags(X.actions(spark, sf), tags).select("seq", "bid", "user_id", "item_id", "tag", "level")


@query
def user_profile(spark, sf):
    tags = content.item_tags(X.dim_item(spark, sf))
    return content.user_profile(X.resolved_actions(spark, sf), tags, P, DENIED_TAGS)


@query
def user_profile_override(spark, sf):
    tags = content.item_tags(X.dim_item(spark, sf))
    denied = spark.createDataFrame([(t,) for t in DENIED_TAGS], "tag string")
    return content.user_profile(X.resolved_actions(spark, sf), tags, P, denied, override={12: 0.7})


@query
def profile_top_tags(spark, sf):
    small = replace(P, profile_size=3)
    return content.profile_top_tags(user_profile(spark, sf), small)


@query
def classify_items(spark, sf):
    docs = X.table(spark, sf, "documents").select("doc_id", "text", "lang")
    labels = X.table(spark, sf, "labels").select("doc_id")
    model = content.fit_classifier(docs.join(labels, "doc_id").select("text", F.col("lang").alias("label")))
    return content.classify_items(docs, model, ["doc_id"]).withColumn("weight", F.round("weight", 3))


def _classified_documents(spark, sf):
    """Documents as items, and their tags by a classifier that learned the quality labels."""
    docs = X.table(spark, sf, "documents")
    items = docs.select(
        F.lit("1").alias("bid"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("item_id"),
        F.col("lang").alias("big_type_name"),
        F.col("source").alias("mid_type_name"),
        F.lit("").alias("small_type_name"),
        (F.lit(P.as_of) - (F.col("doc_id") % 16) * 1800).cast("long").alias("item_time"),
        "text",
    )
    name = F.when(F.col("quality") == 1, "good").otherwise("junk")
    labels = X.table(spark, sf, "labels").select("doc_id", name.alias("label"))
    model = content.fit_classifier(docs.join(labels, "doc_id").select("text", "label"))
    return items, content.classify_items(items, model, ["bid", "item_id"])


@query
def classified_weights(spark, sf):
    """Every item gets every label once, and the weights add up to 1."""
    _, classified = _classified_documents(spark, sf)
    total = F.round(F.sum("weight"), 6).alias("weight_sum")
    return classified.groupBy("item_id").agg(F.count("*").alias("n_tags"), F.countDistinct("tag").alias("n_labels"), total)


@query
def classified_tag_index(spark, sf):
    """Given categories and the classifier's tags in one tag index."""
    items, classified = _classified_documents(spark, sf)
    return content.tag_index(content.item_tags(items, classified), P).drop("tag_weight")


def _document_tree(spark, sf, labelled):
    """A tree of languages and quality labels, fitted on a part of the labelled documents."""
    from footfall.operators import classify

    docs = X.table(spark, sf, "documents").select("doc_id", "text", "lang")
    labels = X.table(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("junk").alias("label"))
    known = docs.join(labels, "doc_id")
    tree = classify.fit_tree(known.where(labelled), ["lang", "label"], letters=3)
    return known, tree, classify.classify_tree(docs, tree, ["doc_id"])


@query
def classified_tree(spark, sf):
    """Leaf weights of every document add up to 1, and children to their parent."""
    _, _, classified = _document_tree(spark, sf, F.lit(True))
    below = F.when(F.col("level") == 1, F.col("weight")).otherwise(0.0)
    parent = F.when(F.col("level") == 1, F.col("path")).otherwise(F.col("tag"))
    per_parent = classified.groupBy("doc_id", parent.alias("_parent")).agg(
        F.sum(below).alias("_below"), F.sum(F.when(F.col("level") == 0, F.col("weight")).otherwise(0.0)).alias("_own"), F.count_if(F.col("level") == 1).alias("_n")
    )
    return per_parent.groupBy("doc_id").agg(
        F.sum("_n").alias("n_leaves"), F.round(F.sum("_below"), 6).alias("leaf_sum"), F.round(F.max(F.abs(F.col("_below") - F.col("_own"))), 6).alias("gap")
    )


@query
def classified_tree_best(spark, sf):
    """Held-out documents per language: most get the right language, by the runs of three letters in a few hundred texts."""
    from footfall.operators import classify

    held_out = F.col("doc_id") % 4 == 2
    known, tree, classified = _document_tree(spark, sf, ~held_out)
    best = classify.best_path(classified, tree, ["doc_id"]).select("doc_id", F.col("path").alias("_lang"))
    rows = known.where(held_out).join(best, "doc_id")
    return rows.groupBy("lang").agg(F.count("*").alias("n"), (F.avg((F.col("_lang") == F.col("lang")).cast("double")) >= 0.7).alias("accurate"))


# ------------------------------------------------------------ column functions


@query
def column_functions(spark, sf):
    a = X.actions(spark, sf)
    return a.select(
        "seq",
        C.is_valid_user("user_id").alias("valid_user"),
        C.is_valid_time(
            F.concat(
                F.when(F.col("seq") % 13 == 0, "x").otherwise(""), F.substring(F.col("action_time").cast("string"), F.lit(1), (F.col("seq") % 7 + 4).cast("int"))
            )
        ).alias("valid_time"),
        C.is_valid_group(F.concat("platform", F.lit("1"))).alias("valid_group"),
        C.is_valid_item("uid").alias("valid_item"),
        C.is_recommend_action("action_type").alias("recommend"),
        C.day_id("action_time").alias("day"),
        C.pair_key("item_id", F.concat(F.lit("i"), F.col("seq") % 50)).alias("pair"),
        C.join_key("bid", "user_id", "uid").alias("key"),
        C.action_weight("action_type").alias("weight"),
        (C.profile_weight_tenths("action_type") / 10.0).alias("profile_weight"),
        C.filter_score_tenths("action_type", F.lit(3)).alias("score_tenths"),
        C.strip_suffix(F.concat("item_id", F.lit("#"), F.col("seq") % 4)).alias("stripped"),
        C.parse_group(F.concat(F.lit("a,"), F.col("seq") % 95, F.lit("|z"))).alias("parsed_group"),
        F.round(C.cosine_weight(F.col("seq") % 3, F.col("seq") % 5, F.col("seq") % 7), 6).alias("cosine"),
        F.round(C.ctr_weight(F.col("seq") % 3, F.col("seq") % 5), 6).alias("ctr"),
    )


# ------------------------------------------------------------------- streaming

# The events arrive in three parts; each run picks up where the last one stopped.
STREAM_CUTS = (0, 20240111, 20240121, 99999999)


def _in_parts(spark, rows, schema, run, late=None):
    """Stage the actions part by part and run the streaming job to its end after each.

    Rows for which ``late`` holds arrive a part later than they should, those of the last part in time.
    """
    from footfall.session import shared_folder

    folder = shared_folder(spark, "stream")
    day = C.day_id("action_time")
    # A state store per shuffle partition: one per core is plenty here.
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(min(int(partitions), cores)))
        parts = list(zip(STREAM_CUTS, STREAM_CUTS[1:]))
        for i, (low, high) in enumerate(parts):
            part = (day >= low) & (day < high)
            if late is not None:
                held = F.lit(False) if i == len(parts) - 1 else late
                before = F.lit(False) if i == 0 else (day >= parts[i - 1][0]) & (day < parts[i - 1][1]) & late
                part = (part & ~held) | before
            rows.where(part).write.mode("append").parquet(f"{folder}/in")
            source = spark.readStream.schema(schema).parquet(f"{folder}/in")
            run(source, folder).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    return folder


def _stream_history(spark, sf, run):
    rows = X.history(spark, sf)
    return _in_parts(spark, rows, rows.schema, run)


NOW = {"availableNow": True}


@query
def stream_item_count(spark, sf):
    from footfall.streaming import counters

    table = lambda folder: counters.count_table(spark, f"{folder}/counts")
    folder = _stream_history(
        spark, sf, lambda source, f: counters.start_item_count(source, table(f), f"{f}/checkpoint", P, NOW)
    )
    return table(folder).totals(["bid", "item_id", "day", "group_id"], "weight")


@query
def stream_pair_count(spark, sf):
    from footfall.streaming import pairs

    table = lambda folder: pairs.pair_table(spark, f"{folder}/pairs")
    events = lambda folder: pairs.history_table(spark, f"{folder}/events")
    # Started with a clock inside the data and folding both tables at every batch: neither may show.
    early = replace(P, as_of=P.as_of - 15 * 86400)
    folder = _stream_history(
        spark,
        sf,
        lambda source, f: pairs.start_pair_count(
            source, events(f), table(f), f"{f}/checkpoint", early, NOW, compact_every=1
        ),
    )
    return table(folder).totals(["bid", "item_a", "item_b", "day", "group_id"], "weight")


TOP = replace(P, result_size=10)


@query
def stream_top_lists(spark, sf):
    """Hot, category and item-item lists by delta propagation: a part of the events comes late, all tables are folded at every
    batch, the clock starts inside the data, and lists keep two entries more than they serve."""
    from footfall.session import materialize
    from footfall.streaming import ranked, toplists

    dim = materialize(X.dim_item(spark, sf), "dim-item")
    early = replace(TOP, as_of=P.as_of - 25 * 86400)
    tables = lambda folder: toplists.tables(spark, f"{folder}/tables", buckets=8)

    def run(source, f):
        return toplists.start_top_lists(source, tables(f), f"{f}/checkpoint", early, dim, trigger=NOW, compact_every=1, reserve=12)

    rows = X.history(spark, sf)
    folder = _in_parts(spark, rows, rows.schema, run, late=_late())
    served = ranked.served(tables(folder).lists, dim, TOP)
    return served.select("key", "rank", "item_id", F.round("weight", 6).alias("weight"), "item_time")


def _late():
    return F.pmod("seq", F.lit(9)) == 4


@query
def stream_user_recent(spark, sf):
    """Newest items in event-time state; a part of the actions comes late, the table is folded at every batch."""
    from footfall.streaming import users

    table = lambda folder: users.recent_table(spark, f"{folder}/recent", buckets=8)

    def run(source, f):
        return users.start_user_recent(source, table(f), f"{f}/checkpoint", P, 40 * 86400, trigger=NOW, compact_every=1)

    rows = X.resolved_actions(spark, sf)
    folder = _in_parts(spark, rows, rows.schema, run, late=_late())
    return users.served_recent(table(folder), X.dim_item(spark, sf), P).drop("seq")


@query
def stream_user_profile(spark, sf):
    """Interest profiles in state, the three best tags of every user."""
    from footfall.session import materialize
    from footfall.streaming import users

    tags = materialize(content.item_tags(X.dim_item(spark, sf)), "item-tags")
    table = lambda folder: users.profile_table(spark, f"{folder}/profiles", buckets=8)
    small = replace(P, profile_size=3)

    def run(source, f):
        return users.start_user_profile(source, tags, table(f), f"{f}/checkpoint", small, DENIED_TAGS, trigger=NOW, compact_every=2)

    rows = X.resolved_actions(spark, sf)
    return users.served_profiles(table(_in_parts(spark, rows, rows.schema, run, late=_late())))


@query
def stream_filter_list(spark, sf):
    """Already-seen lists from incremental detail counts, with a clock that starts inside the data."""
    from footfall.streaming import seen

    tables = lambda folder: seen.tables(spark, f"{folder}/seen", buckets=8)
    early = replace(FILTER, as_of=P.as_of - 25 * 86400)

    def run(source, f):
        return seen.start_filter_lists(source, tables(f), f"{f}/checkpoint", early, trigger=NOW, compact_every=1)

    rows = X.history(spark, sf)
    return seen.served(tables(_in_parts(spark, rows, rows.schema, run, late=_late())))


@query
def stream_dim_items(spark, sf):
    """The newest item records, from messages in random order, through validity ranges."""
    from footfall.streaming import dimensions

    tables = lambda folder: dimensions.tables(spark, f"{folder}/items", buckets=8)

    def run(source, f):
        return dimensions.start_items(source, tables(f), f"{f}/checkpoint", trigger=NOW, compact_every=2)

    # The time only decides the part that a message arrives with.
    rows = X.item_messages(spark, sf).withColumn("action_time", F.lit(P.as_of) - F.pmod(F.xxhash64("seq"), F.lit(30)) * 86400)
    return dimensions.current(tables(_in_parts(spark, rows, rows.schema, run)))


@query
def stream_pair_increment(spark, sf):
    """Pair increments from queues in state, on events in the order of their days."""
    from footfall.streaming import increments

    table = lambda folder: increments.pair_table(spark, f"{folder}/pairs", buckets=8)
    folder = _stream_history(
        spark, sf, lambda source, f: increments.start_pair_increment(source, table(f), f"{f}/checkpoint", P, NOW, compact_every=1)
    )
    return table(folder).totals(["bid", "item_a", "item_b", "day", "group_id"], "weight")


@query
def stream_identity_item_count(spark, sf):
    """From actions without users to item counts: uid records come in later parts than the actions that need them."""
    from footfall.streaming import counters, identity

    rows = X.actions(spark, sf)
    records = X.uid_map(spark, sf).withColumn("record_time", F.lit(0).cast("long")).withColumn("_part", F.pmod(F.xxhash64("uid"), F.lit(3)))
    groups = X.group_map(spark, sf)
    table = lambda folder: counters.count_table(spark, f"{folder}/counts")
    step = iter(range(len(STREAM_CUTS) - 1))

    def run(source, f):
        records.where(F.col("_part") == next(step)).drop("_part").write.mode("append").parquet(f"{f}/records")
        named = spark.readStream.schema(records.drop("_part").schema).parquet(f"{f}/records")
        out, day = f"{f}/resolved", 86400
        identity.start_identity(source, named, groups, out, f"{f}/identity", wait_seconds=60 * day, delay_seconds=40 * day, trigger=NOW).awaitTermination()
        history = H.user_history(identity.resolved_stream(spark, out, rows.schema))
        return counters.start_item_count(history, table(f), f"{f}/checkpoint", P, NOW)

    return table(_in_parts(spark, rows, rows.schema, run)).totals(["bid", "item_id", "day", "group_id"], "weight")


def _stream_ctr(spark, sf, with_lists):
    from footfall.streaming import lists

    dim = X.dim_item(spark, sf)
    table = lambda folder: lists.ctr_table(spark, f"{folder}/ctr")
    ranked = lambda folder: lists.list_table(spark, f"{folder}/lists")

    def run(source, f):
        extra = {"lists": ranked(f), "dim_item": dim} if with_lists else {}
        return lists.start_ctr(source, table(f), f"{f}/checkpoint", P, NOW, **extra)

    rows = X.resolved_actions(spark, sf)
    return table, ranked, _in_parts(spark, rows, rows.schema, run)


@query
def stream_ctr(spark, sf):
    from footfall.streaming import lists

    table, _, folder = _stream_ctr(spark, sf, False)
    return table(folder).latest(lists.CTR_KEY).drop("batch")


@query
def stream_top_results(spark, sf):
    from footfall.streaming import lists

    _, ranked, folder = _stream_ctr(spark, sf, True)
    served = lists.served_lists(ranked(folder), P)
    return served.select("key", "rank", "item_id", F.round("weight", 6).alias("weight"), "item_time")


@query
def stream_ingest(spark, sf):
    from footfall.streaming import ingest

    table = lambda folder: ingest.parsed_table(spark, f"{folder}/parsed")
    rows = X.actions(spark, sf)
    lines = X.message_lines(rows).join(rows.select("seq", "action_time"), "seq")

    def run(source, folder):
        return ingest.start_ingest(source, table(folder), f"{folder}/checkpoint", "news", trigger=NOW)

    folder = _in_parts(spark, lines, lines.schema, run)
    return ingest.verdict_counts(table(folder))
