"""The same queries as SQL for DuckDB, written independently of the Spark plans.

Each statement is put together from named relations; only those it mentions (and
what they mention) end up in its WITH clause.
"""

from __future__ import annotations

import re

AS_OF = 1706659200


def day(t: str) -> str:
    return f"CAST(strftime(make_timestamp(CAST({t} AS BIGINT) * 1000000), '%Y%m%d') AS BIGINT)"


def first_day(days: int, as_of: int = AS_OF) -> str:
    return day(str(as_of - days * 86400))


def valid_user(c: str) -> str:
    return f"regexp_full_match({c}, '[0-9]{{5,}}')"


VALID_GROUPS = "'10','11','12','21','22','31','32','41','42','51','52','61','62','71','72','81','82','91','92'"
WEIGHT = (
    "CASE WHEN {0} = 1 THEN 0.0::DOUBLE WHEN {0} IN (2,3) THEN 1.0 WHEN {0} IN (4,16,17,18) THEN 1.5 "
    "WHEN {0} IN (5,6,7,8,9,10,11,25,26) THEN 2.0 WHEN {0} IN (12,13) THEN 2.5 END"
)
PROFILE_TENTHS = (
    "CASE WHEN {0} = 5 THEN 15 WHEN {0} IN (9,10,11) THEN 4 WHEN {0} = 13 THEN 5 "
    "WHEN {0} IN (16,17,18,21,25) THEN 3 WHEN {0} IN (19,20) THEN 20 ELSE 0 END"
)

RELATIONS: dict[str, str] = {}

RELATIONS["acts"] = """
SELECT *, CASE WHEN action_type IN (1,2) THEN 'recommend_action' ELSE 'user_action' END AS topic FROM (
  SELECT event_id AS seq, strftime(ts, '%Y%m%d') AS imp_date, '1' AS bid,
    CASE WHEN events.user_id % 10 = 0 THEN '0' ELSE CAST(events.user_id + 10000 AS VARCHAR) END AS user_id,
    CASE WHEN events.user_id % 50 = 40 THEN '' ELSE CAST(events.user_id + 1 AS VARCHAR) END AS uid,
    CAST(event_id % 3 AS VARCHAR) AS adpos,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 5 WHEN 'purchase' THEN 12 WHEN 'error' THEN 16 END
      AS action_type,
    epoch_us(ts) // 1000000 AS action_time,
    CASE WHEN event_type IN ('view','click') THEN 'p' || (event_id % 5) ELSE 'i' || k END AS item_id,
    CASE WHEN event_type IN ('view','click') THEN 'i' || k || '#1;i' || ((k + 7) % 100) || '#2;' ELSE 'i' || k END AS action_result,
    'm' || events.user_id AS imei, CAST(event_id % 4 AS VARCHAR) AS platform, 'l' || (events.user_id % 7) AS lbs_info
  FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k FROM events) events)
"""

RELATIONS["act_msgs"] = """
SELECT seq,
  CASE WHEN seq % 101 = 0 THEN NULL WHEN seq % 103 = 0 THEN 'Unknown' ELSE 'UserActionInfo' END AS category,
  concat_ws('|', imp_date, bid, user_id, '', uid, imei, item_id, lbs_info, platform, adpos, action_type, '')
  || CASE WHEN seq % 97 = 0 THEN '' ELSE
     '|' || concat_ws('|', CASE WHEN seq % 89 = 0 THEN '0' ELSE CAST(action_time AS VARCHAR) END, '', '', action_result) END AS line
FROM acts
"""

RELATIONS["item_msgs"] = f"""
SELECT p_partkey * 2 + v AS seq, 'ItemInfo' AS category, concat_ws('|', v + 20240129, '1',
  CASE WHEN p_partkey % 41 = 7 THEN '' ELSE 'i' || p_partkey END,
  CASE WHEN p_partkey % 37 = 5 THEN 'x' ELSE CAST(ascii(p_type) AS VARCHAR) END,
  regexp_extract(p_brand, '(\\d+)', 1), p_size,
  CASE WHEN p_partkey % 43 = 9 THEN '' ELSE p_type END, p_brand, split_part(p_name, ' ', 1),
  p_partkey % 3, 1, CAST(CAST(p_retailprice + v AS DECIMAL(14,2)) AS VARCHAR), p_name,
  {AS_OF} - (p_partkey % 16) * 1800, {AS_OF + 86400}, p_partkey % 4, p_partkey % 100) AS line
FROM part, (VALUES (0), (1)) AS versions(v)
"""

RELATIONS["user_msgs"] = """
SELECT c_custkey AS seq, 'UserInfo' AS category, concat_ws('|', 20240130, '1',
  CASE WHEN c_custkey % 20 = 0 THEN '0' ELSE CAST(c_custkey + 10000 AS VARCHAR) END, '', 'm' || c_custkey, c_custkey + 1,
  c_nationkey % 5, 20230101 + c_custkey % 28, 1672531200 + c_custkey * 60) AS line FROM customer
"""

RELATIONS["weight_msgs"] = """
SELECT o_orderkey AS seq, 'ActionWeightInfo' AS category,
  concat_ws('|', strftime(o_orderdate, '%Y%m%d'), '1', o_custkey % 200, (o_orderkey % 4) || '.5') AS line FROM orders
"""

RELATIONS["cate_msgs"] = """
SELECT p_partkey AS seq, 'ItemCategoryInfo' AS category, concat_ws('|', 20240101 + p_partkey % 28, '1',
  regexp_extract(p_brand, '(\\d+)', 1), p_brand, 2, ascii(p_type)) AS line FROM part
"""

RELATIONS["pool_msgs"] = """
SELECT s_suppkey AS seq, 'AdPool' AS category, concat_ws('|', 20240130, '1', s_suppkey, s_name,
  'i' || s_suppkey || ';i' || (s_suppkey + 1), 'i' || (s_suppkey + 2), 'e') AS line FROM supplier
"""

RELATIONS["msgs"] = """
SELECT * FROM act_msgs WHERE category IS NOT NULL UNION ALL SELECT * FROM item_msgs UNION ALL SELECT * FROM user_msgs
UNION ALL SELECT * FROM weight_msgs UNION ALL SELECT * FROM cate_msgs UNION ALL SELECT * FROM pool_msgs
"""


def _verdict(profile: str) -> str:
    f = lambda i: f"f[{i + 1}]"
    valid_time = f"regexp_full_match({f(12)}, '[0-9]{{9,}}')"
    no_key = f"NOT {valid_user(f(2))} AND {f(4)} = ''"
    item = f"regexp_replace(CASE WHEN {f(10)} IN ('16','17','18') THEN {f(15)} ELSE {f(6)} END, '#[12]$', '')"
    if profile == "general":
        action = f"WHEN {no_key} THEN 'no_part_key' WHEN NOT {valid_time} THEN 'bad_time'"
    else:
        action = f"""WHEN {no_key} THEN 'no_part_key'
          WHEN {f(10)} NOT IN ('1','5','9','10','11','13','25','26','16','17','18') THEN 'type_not_accepted'
          WHEN {f(8)} NOT IN ('2','3') THEN 'bad_platform'
          WHEN NOT regexp_full_match({f(9)}, '[0-9]+') THEN 'bad_adpos'
          WHEN NOT {valid_time} THEN 'bad_time'
          WHEN {f(10)} NOT IN ('1','2') AND {item} = '' THEN 'empty_item'"""
    return f"""
SELECT *, CASE category
  WHEN 'UserActionInfo' THEN CASE WHEN {f(10)} IN ('1','2') THEN 'recommend_action' ELSE 'user_action' END
  WHEN 'ItemInfo' THEN 'item_detail_info' WHEN 'UserInfo' THEN 'user_detail_info' WHEN 'ActionWeightInfo' THEN 'action_weight_info'
  WHEN 'ItemCategoryInfo' THEN 'category_level_info' WHEN 'AdPool' THEN 'adpool_info' END AS topic,
  CASE WHEN needed IS NULL THEN 'unknown_category' WHEN len(f) < needed THEN 'too_few_fields'
  WHEN category = 'UserActionInfo' THEN CASE {action} END
  WHEN category = 'ItemInfo' THEN CASE WHEN {f(2)} = '' THEN 'empty_item'
    WHEN NOT regexp_full_match({f(3)}, '[0-9]+') THEN 'bad_category' WHEN {f(6)} = '' THEN 'no_category_name' END
  WHEN category = 'UserInfo' THEN CASE WHEN NOT {valid_user(f(2))} THEN 'bad_user' END
  END AS reason
FROM (SELECT *, string_split(line, '|') AS f, CASE category WHEN 'UserActionInfo' THEN 16 WHEN 'ItemInfo' THEN 17
  WHEN 'UserInfo' THEN 9 WHEN 'ActionWeightInfo' THEN 4 WHEN 'ItemCategoryInfo' THEN 6 WHEN 'AdPool' THEN 7 END AS needed
  FROM msgs)
"""


RELATIONS["checked_general"] = _verdict("general")
RELATIONS["checked_news"] = _verdict("news")

RELATIONS["dim"] = f"""
SELECT '1' AS bid, CASE WHEN p_partkey % 25 = 24 THEN 'u' ELSE 'i' END || p_partkey AS item_id, CAST(ascii(p_type) AS BIGINT) AS big_type, p_type AS big_type_name,
  CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) AS mid_type, p_brand AS mid_type_name,
  CAST(p_size AS BIGINT) AS small_type, split_part(p_name, ' ', 1) AS small_type_name, CAST(p_partkey % 3 AS INTEGER) AS free,
  p_retailprice AS price, 's' || (p_partkey % 10) AS shop_id, CAST({AS_OF} - (p_partkey % 16) * 1800 AS BIGINT) AS item_time
FROM part
"""

RELATIONS["uids"] = """
SELECT CAST(c_custkey + 1 AS VARCHAR) AS uid,
  CASE WHEN c_custkey % 20 = 0 THEN '0' ELSE CAST(c_custkey + 10000 AS VARCHAR) END AS found FROM customer
"""

RELATIONS["groups"] = """
SELECT CAST(c_custkey + 10000 AS VARCHAR) AS user_id, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '11' WHEN 'BUILDING' THEN '21'
  WHEN 'FURNITURE' THEN '31' WHEN 'HOUSEHOLD' THEN '41' ELSE '0' END AS group_id FROM customer
"""

RELATIONS["res"] = f"""
SELECT r.*, coalesce(g.group_id, '0') AS group_id FROM (
  SELECT acts.* EXCLUDE (user_id), CASE WHEN {valid_user('acts.user_id')} THEN acts.user_id
    WHEN {valid_user('found')} THEN found ELSE '0' END AS user_id
  FROM acts LEFT JOIN uids ON uids.uid = acts.uid
  WHERE {valid_user('acts.user_id')} OR acts.uid NOT IN ('', '0')) r
LEFT JOIN groups g ON g.user_id = r.user_id
"""

RELATIONS["hist"] = f"""
SELECT bid, user_id, group_id, item_id, action_type, action_time, seq, impression, {WEIGHT.format('action_type')} AS weight FROM (
  SELECT bid, user_id, group_id, regexp_replace(unnest(string_split(action_result, ';')), '#[12]$', '') AS item_id,
    action_type, action_time, seq, TRUE AS impression FROM res WHERE action_type IN (1,2)
  UNION ALL SELECT bid, user_id, group_id, item_id, action_type, action_time, seq, FALSE FROM res WHERE action_type NOT IN (1,2))
WHERE item_id <> '' AND {valid_user('user_id')} AND {WEIGHT.format('action_type')} IS NOT NULL
"""

RELATIONS["h"] = f"SELECT *, {day('action_time')} AS d FROM hist WHERE group_id IN ({VALID_GROUPS}) AND action_time <= {AS_OF}"


def _detail(where: str, as_of: int = AS_OF, days: int = 7) -> str:
    return f"""SELECT bid, user_id, {day('action_time')} AS day, item_id, action_type, count(*) AS cnt, max(action_time) AS last_time
FROM hist WHERE {where} AND {day('action_time')} >= {first_day(days, as_of)} AND action_time <= {as_of} GROUP BY ALL"""


def _weighed(detail: str) -> str:
    return f"""SELECT * FROM ({detail}) QUALIFY max({WEIGHT.format('action_type')}) OVER (PARTITION BY bid, user_id, day, item_id) > 0"""


RELATIONS["a_detail"] = _weighed(_detail("TRUE"))
RELATIONS["i_detail"] = _detail("impression")
EARLY = AS_OF - 2 * 86400
RELATIONS["a_detail_early"] = _weighed(_detail("TRUE", EARLY))
RELATIONS["i_detail_early"] = _detail("impression", EARLY)

RELATIONS["uiw"] = f"""
SELECT bid, user_id, group_id, item_id, m.d AS day, m.w AS weight FROM (
  SELECT tr.bid, tr.user_id, tr.group_id, tr.item_id, max(struct_pack(w := x.weight, d := x.d)) AS m
  FROM (SELECT bid, user_id, group_id, item_id, max(action_time) AS t FROM h WHERE NOT impression GROUP BY ALL) tr
  JOIN h x ON x.bid = tr.bid AND x.user_id = tr.user_id AND x.item_id = tr.item_id AND x.action_time <= tr.t
    AND x.d >= {day('tr.t - 86400')}
  GROUP BY ALL)
"""

RELATIONS["counts"] = """
SELECT bid, item_id, day, coalesce(group_id, '0') AS group_id, sum(weight) AS weight
FROM uiw GROUP BY GROUPING SETS ((bid, item_id, day, group_id), (bid, item_id, day))
"""

RELATIONS["totals"] = f"""
SELECT bid, item_id, group_id, sum(weight) AS weight FROM counts WHERE day >= {first_day(7)} GROUP BY ALL
"""


def _upw(link: int) -> str:
    return f"""
WITH s AS (SELECT tr.bid, tr.user_id, tr.group_id, tr.item_id, tr.action_time AS t, tr.seq, x.item_id AS o,
    max(struct_pack(w := x.weight, d := x.d)) AS m
  FROM h tr JOIN h x ON x.bid = tr.bid AND x.user_id = tr.user_id
    AND (x.action_time < tr.action_time OR (x.action_time = tr.action_time AND x.seq <= tr.seq))
    AND x.action_time > tr.action_time - {link}
  WHERE NOT tr.impression GROUP BY ALL),
p AS (SELECT b.bid, b.user_id, b.group_id, b.t, b.seq, least(b.item_id, b.o) AS item_a, greatest(b.item_id, b.o) AS item_b,
    least(b.m.w, me.m.w) AS weight, least(b.m.d, me.m.d) AS day
  FROM s b JOIN s me ON me.bid = b.bid AND me.seq = b.seq AND me.o = me.item_id WHERE b.o <> b.item_id AND b.m.w > 0),
k AS (SELECT *, lead(t) OVER (PARTITION BY bid, user_id, item_a, item_b ORDER BY t, seq) AS nt FROM p)
SELECT bid, user_id, group_id, item_a, item_b, day, weight FROM k WHERE nt IS NULL OR day < {day(f'nt - {link}')}
"""


RELATIONS["upw"] = _upw(86400)

RELATIONS["pairs"] = f"""
SELECT bid, item_a, item_b, coalesce(group_id, '0') AS group_id, sum(weight) AS weight
FROM upw WHERE day >= {first_day(7)} GROUP BY GROUPING SETS ((bid, item_a, item_b, group_id), (bid, item_a, item_b))
"""

RELATIONS["hot"] = """
SELECT bid, CASE WHEN group_id = '0' THEN bid || '#0#1#B3001#0' ELSE bid || '#0#1#C3001#' || group_id END AS key, item_id, weight,
  CASE WHEN group_id = '0' THEN 'B3001' ELSE 'C3001' END AS alg_name FROM totals
"""


def _by_category(level: str) -> str:
    return f"""
SELECT t.bid, t.bid || '#' || {level} || '#1#' || CASE WHEN group_id = '0' THEN 'B2001' ELSE 'C2001' END || '#' || group_id AS key,
  t.item_id, weight, CASE WHEN group_id = '0' THEN 'B2001' ELSE 'C2001' END AS alg_name
FROM totals t JOIN dim d ON d.bid = t.bid AND d.item_id = t.item_id WHERE {level} > 0
"""


RELATIONS["cf"] = """
SELECT bid, bid || '#' || x || '#1#' || CASE WHEN group_id = '0' THEN 'B1001' ELSE 'C1001' END || '#' || group_id AS key, y AS item_id,
  weight, CASE WHEN group_id = '0' THEN 'B1001' ELSE 'C1001' END AS alg_name
FROM (SELECT p.bid, p.group_id, item_a, item_b, p.weight / (sqrt(a.weight) * sqrt(b.weight)) AS weight
  FROM pairs p JOIN totals a ON a.bid = p.bid AND a.group_id = p.group_id AND a.item_id = p.item_a
  JOIN totals b ON b.bid = p.bid AND b.group_id = p.group_id AND b.item_id = p.item_b) s,
  LATERAL (SELECT item_a AS x, item_b AS y UNION ALL SELECT item_b, item_a) ways
"""

RELATIONS["ctr_day"] = f"""
SELECT bid, adpos, page_id, item_id, group_id, {day('action_time')} AS day,
  count(*) FILTER (action_type = 1) AS impress, count(*) FILTER (action_type = 2) AS click
FROM (SELECT bid, adpos, item_id AS page_id, regexp_replace(unnest(string_split(action_result, ';')), '#[12]$', '') AS item_id,
  group_id, action_type, action_time FROM res WHERE action_type IN (1,2) AND item_id <> '')
WHERE item_id <> '' GROUP BY ALL
"""


def _ctr(group: str) -> str:
    by_group = ", group_id" if group == "group_id" else ""
    return f"""
SELECT bid, bid || '#' || page_id || '#' || adpos || '#A1001#' || {group} AS key, item_id, sum(click) / sum(impress) AS weight,
  'A1001' AS alg_name FROM ctr_day WHERE day >= {first_day(7)} GROUP BY bid, adpos, page_id, item_id{by_group}
HAVING sum(click) > 0 AND sum(impress) > 0
"""


RELATIONS["ctr_all"] = _ctr("'0'")

ITEM = (
    "coalesce(big_type, 0) AS big_type, coalesce(mid_type, 0) AS mid_type, coalesce(small_type, 0) AS small_type, "
    "coalesce(free, 0) AS free, coalesce(CAST(floor(price) AS BIGINT), 0) AS price, coalesce(shop_id, '') AS shop_id, "
    "coalesce(item_time, 0) AS item_time"
)

RELATIONS["category_big"] = _by_category("big_type")
RELATIONS["category_mid"] = _by_category("mid_type")


def _top(sources: str, extra: str = "", limit: int = 100) -> str:
    return f"""
SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY weight DESC, item_id) AS INTEGER) AS rank, item_id,
  round(weight, 6) AS weight, item_time{extra}
FROM (SELECT c.*, {ITEM} FROM ({sources}) c LEFT JOIN dim d ON d.bid = c.bid AND d.item_id = c.item_id)
WHERE {AS_OF} - item_time <= CASE WHEN split_part(key, '#', 4) LIKE '%3001%' THEN 3600 ELSE 21600 END
QUALIFY rank <= {limit}
"""


def _recent(source: str, limit: int = 30) -> str:
    return f"""
SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY action_time DESC, seq DESC, item_id) AS INTEGER) AS rank, item_id,
  action_type, action_time, platform, lbs_info, big_type, mid_type, small_type, shop_id, item_time
FROM (SELECT a.*, {ITEM}, CASE WHEN {valid_user('user_id')} THEN a.bid || '#' || user_id || '#D1'
    WHEN uid NOT IN ('', '0') THEN a.bid || '#' || uid || '#D2' END AS key
  FROM ({source}) a LEFT JOIN dim d ON d.bid = a.bid AND d.item_id = a.item_id
  WHERE action_type NOT IN (1,2) AND a.item_id <> ''
  QUALIFY row_number() OVER (PARTITION BY key, a.item_id ORDER BY action_time DESC, seq DESC) = 1)
WHERE key IS NOT NULL QUALIFY rank <= {limit}
"""


def _scores(a: str, i: str, as_of: int, a_days: int, i_days: int, more: str = "") -> str:
    score = "CASE WHEN action_type = 1 THEN cnt WHEN action_type > 1 THEN cnt * 10 ELSE 0 END"
    return f"""
SELECT bid, user_id, item_id, source, CAST(sum(s) AS BIGINT) AS score_tenths FROM (
  SELECT bid, user_id, item_id, 'action' AS source, {score} AS s FROM {a} WHERE day >= {first_day(a_days, as_of)}
  UNION ALL SELECT bid, user_id, item_id, 'impress', {score} FROM {i} WHERE day >= {first_day(i_days, as_of)} {more}) GROUP BY ALL
"""


RELATIONS["scores_wide"] = _scores("a_detail", "i_detail", AS_OF, 3, 5)

RELATIONS["tags"] = """
SELECT bid, item_id, item_time, big_type_name AS tag, 0 AS level, 0.0::DOUBLE AS tag_weight FROM dim
UNION ALL SELECT bid, item_id, item_time, mid_type_name, 1, 0.0 FROM dim
UNION ALL SELECT bid, item_id, item_time, small_type_name, 2, 0.0 FROM dim
"""


def _profile(weight: str, denied: str = "'ECONOMY', 'Brand#7'") -> str:
    return f"""
SELECT r.bid, user_id, tag, round(CAST(sum({weight}) AS BIGINT) * 0.025::DOUBLE, 6) AS weight, min(level) AS level, 1 AS type
FROM (SELECT * FROM res WHERE {valid_user('user_id')} AND item_id <> '' AND action_time <= {AS_OF}) r
JOIN (SELECT DISTINCT bid, item_id, tag, level FROM tags WHERE tag NOT IN ({denied})) t ON t.bid = r.bid AND t.item_id = r.item_id
GROUP BY r.bid, user_id, tag HAVING sum({weight}) > 0
"""


RELATIONS["profile"] = _profile(PROFILE_TENTHS.format("action_type"))

RELATIONS["baskets"] = "SELECT DISTINCT l_orderkey AS b, l_partkey AS i FROM lineitem JOIN orders ON o_orderkey = l_orderkey"
RELATIONS["basket_totals"] = "SELECT i, count(*) AS n FROM baskets GROUP BY i"


def statement(body: str) -> str:
    """Prefix the relations that ``body`` uses, in definition order."""
    used: set[str] = set()

    def visit(sql: str) -> None:
        for name in RELATIONS:
            if name not in used and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                used.add(name)
                visit(RELATIONS[name])

    visit(body)
    ctes = ", ".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in RELATIONS.items() if n in used)
    return f"WITH {ctes} {body}" if ctes else body


def _fields(columns: str, checked: str, category: str) -> str:
    return f"SELECT seq, {columns} FROM {checked} WHERE category = '{category}' AND reason IS NULL"


def _actions(profile: str) -> str:
    item = "f[7]"
    if profile == "news":
        item = "regexp_replace(CASE WHEN f[11] IN ('16','17','18') THEN f[16] ELSE f[7] END, '#[12]$', '')"
    columns = f"""CASE WHEN {valid_user('f[3]')} THEN f[3] ELSE f[5] END AS part_key, f[2] AS bid, topic, f[3] AS user_id,
      f[5] AS uid, f[10] AS adpos, CAST(f[11] AS INTEGER) AS action_type, CAST(f[13] AS BIGINT) AS action_time, {item} AS item_id,
      f[16] AS action_result, f[6] AS imei, f[9] AS platform, f[8] AS lbs_info"""
    return _fields(columns, f"checked_{profile}", "UserActionInfo")


def _plain(key: int, names: str, positions: list[int]) -> str:
    columns = [f"f[{key + 1}] AS part_key", "topic", "f[2] AS bid", "f[1] AS imp_date"]
    return ", ".join(columns + [f"f[{i + 1}] AS {n}" for n, i in zip(names.split(), positions, strict=True)])


ITEM_NAMES = (
    "item_id cate_id1 cate_id2 cate_id3 cate_name1 cate_name2 cate_name3 free publish price text item_time expire_time plat_form score"
)


def _latest(columns: str, category: str, key: str) -> str:
    return f"""SELECT {columns} FROM checked_general WHERE category = '{category}' AND reason IS NULL
QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY CAST(f[1] AS BIGINT) DESC, seq DESC) = 1"""


def _flag(f: str) -> str:
    return f"CASE {f} WHEN '1' THEN 1 WHEN '2' THEN 2 ELSE 0 END"


BODIES: dict[str, str] = {}

BODIES["ingest_category"] = """
SELECT seq, category, CAST(len(string_split(line, '|')) AS INTEGER) AS n_fields, string_split(line, '|')[7] AS item_field
FROM act_msgs WHERE category IS NOT NULL"""
BODIES["parse_actions_general"] = _actions("general")
BODIES["parse_actions_news"] = _actions("news")
BODIES["parse_items"] = _fields(_plain(2, ITEM_NAMES, list(range(2, 17))) + ", '0' AS shop_id", "checked_general", "ItemInfo")
BODIES["parse_users"] = _fields(
    _plain(2, "user_id imei uid level reg_date reg_time", [2, 4, 5, 6, 7, 8]), "checked_general", "UserInfo"
)
BODIES["parse_weights"] = _fields(_plain(2, "type_id weight", [2, 3]), "checked_general", "ActionWeightInfo")
BODIES["parse_categories"] = _fields(
    _plain(2, "cate_id cate_name level father_id", [2, 3, 4, 5]), "checked_general", "ItemCategoryInfo"
)
BODIES["parse_ad_pools"] = _fields(_plain(2, "pool_id pool_info recom_items top_items ext", [2, 3, 4, 5, 6]), "checked_general", "AdPool")
BODIES["reject_reasons"] = "SELECT seq, line, reason FROM checked_news WHERE reason IS NOT NULL"
BODIES["ingest_counts"] = """
SELECT 'received' AS side, category AS name, count(*) AS n FROM checked_general GROUP BY category
UNION ALL SELECT 'emitted', topic, count(*) FROM checked_general WHERE reason IS NULL GROUP BY topic"""
BODIES["validate_rows"] = """
SELECT seq, b AS bid, tp AS topic, CASE WHEN b <> '1' OR tp = 'other' THEN 'unknown_topic'
  WHEN seq % 23 = 0 THEN 'field_count'
  WHEN tp = 'recommend_action' THEN 'ok'
  WHEN NOT regexp_full_match(user_id, '[0-9]+') OR CAST(user_id AS BIGINT) NOT BETWEEN 10001 AND 11200 THEN 'bad_user_id'
  WHEN action_type NOT BETWEEN 1 AND 12 THEN 'bad_action_type' WHEN platform = '3' THEN 'bad_platform' ELSE 'ok' END AS verdict
FROM (SELECT *, CASE WHEN seq % 17 = 0 THEN '2' ELSE bid END AS b, CASE WHEN seq % 19 = 0 THEN 'other' ELSE topic END AS tp FROM acts)"""
BODIES["dim_latest_items"] = _latest(
    f"""seq, f[2] AS bid, f[3] AS item_id, CAST(f[1] AS BIGINT) AS imp_date, CAST(f[4] AS BIGINT) AS big_type, f[7] AS big_type_name,
  CAST(f[5] AS BIGINT) AS mid_type, f[8] AS mid_type_name, CAST(f[6] AS BIGINT) AS small_type, f[9] AS small_type_name,
  {_flag('f[10]')} AS free, {_flag('f[11]')} AS publish, CAST(f[12] AS DOUBLE) AS price, f[13] AS text,
  CAST(f[14] AS BIGINT) AS item_time, CAST(f[16] AS BIGINT) AS plat_form, CAST(f[17] AS BIGINT) AS score, '0' AS shop_id""",
    "ItemInfo",
    "f[2], f[3]",
)
BODIES["dim_latest_users"] = _latest(
    """seq, f[2] AS bid, f[3] AS user_id, CAST(f[1] AS BIGINT) AS imp_date, f[5] AS imei, f[6] AS uid, CAST(f[7] AS INTEGER) AS level,
  CAST(f[8] AS BIGINT) AS reg_date, CAST(f[9] AS BIGINT) AS reg_time""",
    "UserInfo",
    "f[2], f[3]",
)
BODIES["dim_latest_weights"] = _latest(
    "seq, f[2] AS bid, f[3] AS action_type, CAST(f[1] AS BIGINT) AS imp_date, CAST(f[4] AS DOUBLE) AS weight",
    "ActionWeightInfo",
    "f[2], f[3]",
)
BODIES["dim_latest_categories"] = _latest(
    "seq, f[2] AS bid, f[3] AS cate_id, CAST(f[1] AS BIGINT) AS imp_date, f[4] AS name, f[5] AS level, CAST(f[6] AS INTEGER) AS father_id",
    "ItemCategoryInfo",
    "f[2], f[3]",
)
BODIES["resolve_identity"] = "SELECT * FROM res"
BODIES["explode_impressions"] = """
SELECT * FROM (SELECT seq, bid, user_id, regexp_replace(unnest(string_split(action_result, ';')), '#[12]$', '') AS item_id, action_type,
  action_time FROM acts WHERE action_type IN (1,2)) WHERE item_id <> ''"""
BODIES["user_history"] = "SELECT * FROM hist"
BODIES["action_detail"] = "SELECT * FROM a_detail"
BODIES["impress_detail"] = "SELECT * FROM i_detail"
BODIES["detail_nested_flat"] = """
SELECT d.bid, d.user_id, CAST(dense_rank() OVER (PARTITION BY d.bid, d.user_id ORDER BY d.day DESC) - 1 AS INTEGER) AS position,
  d.day, d.item_id, action_type, cnt, last_time
FROM a_detail d JOIN (SELECT bid, user_id, day, item_id FROM a_detail GROUP BY bid, user_id, day, item_id
  QUALIFY row_number() OVER (PARTITION BY bid, user_id, day ORDER BY max(last_time) DESC, item_id) <= 2) k
ON k.bid = d.bid AND k.user_id = d.user_id AND k.day = d.day AND k.item_id = d.item_id"""
BODIES["combine_last"] = """
SELECT bid, user_id, item_id, action_time // 3600 * 3600 AS window_start, action_time, seq, action_type FROM acts
QUALIFY row_number() OVER (PARTITION BY bid, user_id, item_id, action_time // 3600 ORDER BY action_time DESC, seq DESC) = 1"""
BODIES["combine_max_type"] = """
SELECT bid, user_id, group_id, item_id, action_time // 3600 * 3600 AS window_start, action_type, action_time FROM res
QUALIFY row_number() OVER (PARTITION BY bid, user_id, group_id, item_id, action_time // 3600
  ORDER BY action_type DESC, action_time) = 1"""
BODIES["action_with_history"] = f"""
SELECT DISTINCT a.bid, a.user_id, a.item_id, a.seq, a.action_time, a.action_type, {day('x.action_time')} AS past_day,
  x.action_type AS past_type, x.weight AS past_weight
FROM hist a JOIN hist x ON x.bid = a.bid AND x.user_id = a.user_id AND x.item_id = a.item_id AND x.action_time <= a.action_time
  AND {day('x.action_time')} >= {day('a.action_time - 86400')} WHERE NOT a.impression"""
BODIES["user_item_weight"] = "SELECT * FROM uiw"
BODIES["item_count"] = "SELECT * FROM counts"
BODIES["item_total"] = "SELECT * FROM totals"
BODIES["hot_items"] = "SELECT * FROM hot"
BODIES["hot_by_category"] = "SELECT * FROM category_big"
BODIES["hot_by_small_category"] = _by_category("small_type")
BODIES["user_pair_weight"] = "SELECT * FROM upw"
BODIES["user_pair_weight_3_days"] = f"SELECT * FROM ({_upw(3 * 86400)})"
BODIES["user_pair_weight_6_hours"] = f"SELECT * FROM ({_upw(6 * 3600)})"
BODIES["pair_count"] = """
SELECT bid, item_a, item_b, day, coalesce(group_id, '0') AS group_id, sum(weight) AS weight
FROM upw GROUP BY GROUPING SETS ((bid, item_a, item_b, day, group_id), (bid, item_a, item_b, day))"""
BODIES["pair_total"] = "SELECT * FROM pairs"
BODIES["pair_increment"] = f"""
SELECT bid, item_a, item_b, day, coalesce(group_id, '0') AS group_id, sum(weight) AS weight FROM (
  SELECT tr.bid, tr.group_id, tr.seq, least(tr.item_id, x.item_id) AS item_a, greatest(tr.item_id, x.item_id) AS item_b,
    least(tr.weight, max(struct_pack(w := x.weight, d := x.d)).w) AS weight,
    least(tr.d, max(struct_pack(w := x.weight, d := x.d)).d) AS day
  FROM (SELECT * FROM h t WHERE NOT impression AND NOT EXISTS (SELECT 1 FROM h o WHERE o.bid = t.bid AND o.user_id = t.user_id
      AND o.item_id = t.item_id AND o.weight >= t.weight AND o.d >= {day('t.action_time - 86400')}
      AND (o.action_time < t.action_time OR (o.action_time = t.action_time AND o.seq < t.seq)))) tr
  JOIN h x ON x.bid = tr.bid AND x.user_id = tr.user_id AND x.item_id <> tr.item_id AND x.weight > 0
    AND (x.action_time < tr.action_time OR (x.action_time = tr.action_time AND x.seq <= tr.seq))
    AND x.action_time > tr.action_time - 86400
  GROUP BY tr.bid, tr.group_id, tr.seq, tr.item_id, x.item_id, tr.weight, tr.d)
GROUP BY GROUPING SETS ((bid, item_a, item_b, day, group_id), (bid, item_a, item_b, day))"""
BODIES["item_neighbours"] = f"""
SELECT DISTINCT tr.bid, tr.group_id, tr.item_id, x.item_id AS other,
  tr.group_id || '#' || least(tr.item_id, x.item_id) || '#' || greatest(tr.item_id, x.item_id) AS part_key
FROM h tr JOIN h x ON x.bid = tr.bid AND x.user_id = tr.user_id AND x.item_id <> tr.item_id AND x.weight > 0
  AND (x.action_time < tr.action_time OR (x.action_time = tr.action_time AND x.seq <= tr.seq))
  AND x.d >= {day('tr.action_time - 86400')} WHERE NOT tr.impression"""
BODIES["item_cf"] = "SELECT bid, key, item_id, round(weight, 6) AS weight, alg_name FROM cf"
BODIES["basket_cf"] = """
SELECT item, other, round(n / (sqrt(na) * sqrt(nb)), 6) AS weight FROM (
  SELECT a.i AS item, b.i AS other, count(*) AS n FROM baskets a JOIN baskets b ON a.b = b.b AND a.i <> b.i GROUP BY ALL)
JOIN (SELECT i AS item, n AS na FROM basket_totals) USING (item) JOIN (SELECT i AS other, n AS nb FROM basket_totals) USING (other)"""
BODIES["ctr_daily"] = "SELECT * FROM ctr_day"
BODIES["ctr_lists"] = "SELECT bid, key, item_id, round(weight, 6) AS weight, alg_name FROM ctr_all"
BODIES["ctr_lists_by_group"] = f"SELECT bid, key, item_id, round(weight, 6) AS weight, alg_name FROM ({_ctr('group_id')})"
BODIES["enrich_actions"] = f"""
SELECT seq, r.bid, r.item_id, user_id, {ITEM} FROM res r LEFT JOIN dim d ON d.bid = r.bid AND d.item_id = r.item_id"""
_RANGES = """
SELECT bid, item_id, CAST(price AS DOUBLE) AS price, item_time, valid_from, big_type, mid_type, small_type, free, shop_id,
  coalesce(lead(valid_from) OVER (PARTITION BY bid, item_id ORDER BY valid_from), 9223372036854775807) AS valid_to
FROM (
  SELECT f[2] AS bid, f[3] AS item_id, f[12] AS price, CAST(f[14] AS BIGINT) AS item_time, CAST(f[4] AS BIGINT) AS big_type,
    CAST(f[5] AS BIGINT) AS mid_type, CAST(f[6] AS BIGINT) AS small_type, {free} AS free, '0' AS shop_id,
    CAST(epoch(strptime(f[1], '%Y%m%d')) AS BIGINT) AS valid_from
  FROM checked_general WHERE category = 'ItemInfo' AND reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY f[2], f[3], f[1] ORDER BY seq DESC) = 1)
""".format(free=_flag("f[10]"))
BODIES["item_ranges"] = f"SELECT bid, item_id, price, item_time, valid_from, valid_to FROM ({_RANGES})"
BODIES["enrich_actions_as_of"] = f"""
SELECT seq, r.bid, r.item_id, user_id, {ITEM} FROM res r LEFT JOIN ({_RANGES}) d
ON d.bid = r.bid AND d.item_id = r.item_id AND r.action_time >= valid_from AND r.action_time < valid_to"""
BODIES["enrich_results"] = f"""
SELECT c.bid, key, c.item_id, weight, alg_name, {ITEM} FROM (SELECT * FROM hot UNION ALL SELECT * FROM category_mid) c
LEFT JOIN dim d ON d.bid = c.bid AND d.item_id = c.item_id"""
BODIES["top_results"] = _top(
    "SELECT * FROM hot UNION ALL SELECT * FROM category_big UNION ALL SELECT * FROM cf UNION ALL SELECT * FROM ctr_all",
    ", free, shop_id",
)
BODIES["hot_top_results"] = _top("SELECT * FROM hot")
BODIES["user_recent"] = _recent("SELECT * FROM res")
BODIES["merge_recent"] = f"SELECT key, rank, item_id, action_time FROM ({_recent('SELECT * FROM res')})"
BODIES["filter_scores"] = _scores("a_detail", "i_detail", AS_OF, 3, 1)
BODIES["filter_scores_current"] = _scores(
    "a_detail_early",
    "i_detail_early",
    EARLY,
    3,
    1,
    f"""UNION ALL SELECT bid, user_id, item_id, 'action', CASE WHEN action_type = 1 THEN 1 ELSE 10 END FROM (
    SELECT * FROM res WHERE {valid_user('user_id')} AND item_id <> '' AND action_time > {EARLY - 43200} AND action_time <= {EARLY}
    QUALIFY row_number() OVER (PARTITION BY bid, user_id, item_id ORDER BY action_time DESC, seq DESC) = 1)""",
)
BODIES["user_filter_list"] = """
SELECT bid, user_id, CAST(row_number() OVER (PARTITION BY bid, user_id ORDER BY source = 'impress', score_tenths DESC, item_id) AS INTEGER)
  AS rank, item_id, source, score_tenths / 10 AS score
FROM scores_wide WHERE (source = 'action' OR score_tenths >= 3)
  AND EXISTS (SELECT 1 FROM a_detail d WHERE d.bid = scores_wide.bid AND d.user_id = scores_wide.user_id)
QUALIFY rank <= 4"""
BODIES["item_tags"] = "SELECT * FROM tags WHERE tag <> ''"
BODIES["tag_index"] = f"""
SELECT bid, tag, CAST(row_number() OVER (PARTITION BY bid, tag ORDER BY item_time DESC, item_id) AS INTEGER) AS rank, item_id, item_time,
  level, tag_weight
FROM (SELECT * FROM tags WHERE tag <> '' AND {day('item_time')} > 20240129
  QUALIFY row_number() OVER (PARTITION BY bid, tag, item_id ORDER BY item_time DESC, level) = 1)
QUALIFY rank <= 100"""
BODIES["action_tags"] = """
SELECT seq, a.bid, user_id, a.item_id, tag, level FROM acts a JOIN tags t ON t.bid = a.bid AND t.item_id = a.item_id
WHERE tag <> '' AND tag NOT IN ('ECONOMY', 'Brand#7')"""
BODIES["user_profile"] = "SELECT * FROM profile"
BODIES["user_profile_override"] = _profile(f"CASE WHEN action_type = 12 THEN 7 ELSE {PROFILE_TENTHS.format('action_type')} END")
BODIES["profile_top_tags"] = """
SELECT *, CAST(row_number() OVER (PARTITION BY bid, user_id ORDER BY weight DESC, tag) AS INTEGER) AS rank FROM profile
QUALIFY rank <= 3"""
BODIES["column_functions"] = f"""
SELECT seq, {valid_user('user_id')} AS valid_user, seq % 13 <> 0 AND seq % 7 + 4 >= 9 AS valid_time, platform || '1' IN ({VALID_GROUPS}) AS valid_group,
  uid <> '' AS valid_item, action_type IN (1,2) AS recommend, {day('action_time')} AS day,
  least(item_id, 'i' || (seq % 50)) || '#' || greatest(item_id, 'i' || (seq % 50)) AS pair,
  bid || '#' || user_id || '#' || uid AS key, {WEIGHT.format('action_type')} AS weight,
  {PROFILE_TENTHS.format('action_type')} / 10 AS profile_weight,
  CAST(CASE WHEN action_type = 1 THEN 3 ELSE 30 END AS BIGINT) AS score_tenths,
  item_id || CASE WHEN seq % 4 IN (1, 2) THEN '' ELSE '#' || (seq % 4) END AS stripped,
  CASE WHEN CAST(seq % 95 AS VARCHAR) IN ({VALID_GROUPS}) THEN CAST(seq % 95 AS VARCHAR) ELSE '0' END AS parsed_group,
  CASE WHEN seq % 3 = 0 OR seq % 5 = 0 OR seq % 7 = 0 THEN 0.0::DOUBLE
    ELSE round((seq % 3) / (sqrt(seq % 5) * sqrt(seq % 7)), 6) END AS cosine,
  CASE WHEN seq % 3 > 0 AND seq % 5 > 0 THEN round((seq % 3) / (seq % 5), 6) ELSE 0.0::DOUBLE END AS ctr
FROM acts"""

BODIES["sink_keyed"] = f"""
SELECT * REPLACE (CASE WHEN key LIKE '%#0' THEN rank ELSE rank + 100 END AS rank),
       CAST({AS_OF + 10 * 86400} AS BIGINT) AS expire_at
FROM ({BODIES['hot_top_results']})"""
BODIES["classified_weights"] = """
SELECT 'd' || doc_id AS item_id, CAST(2 AS BIGINT) AS n_tags, CAST(2 AS BIGINT) AS n_labels, CAST(1 AS DOUBLE) AS weight_sum
FROM documents"""
BODIES["classified_tree"] = """
SELECT doc_id, (SELECT count(DISTINCT (lang, quality)) FROM documents JOIN labels USING (doc_id)) AS n_leaves,
  CAST(1 AS DOUBLE) AS leaf_sum, CAST(0 AS DOUBLE) AS gap FROM documents"""
BODIES["classified_tree_best"] = """
SELECT lang, count(*) AS n, TRUE AS accurate FROM documents JOIN labels USING (doc_id) WHERE doc_id % 4 = 2 GROUP BY lang"""
BODIES["classified_tag_index"] = f"""
SELECT '1' AS bid, tag, CAST(row_number() OVER (PARTITION BY tag ORDER BY item_time DESC, item_id) AS INTEGER) AS rank,
  item_id, item_time, level
FROM (
  SELECT t.tag, t.level, 'd' || doc_id AS item_id, CAST({AS_OF} - (doc_id % 16) * 1800 AS BIGINT) AS item_time
  FROM documents, LATERAL (VALUES (lang, 0), (source, 1), ('good', 3), ('junk', 3)) AS t(tag, level)
)
QUALIFY rank <= 100"""
BODIES["stream_ingest"] = """
SELECT coalesce(reason, topic) AS verdict, count(*) AS n FROM checked_news WHERE category = 'UserActionInfo' GROUP BY ALL"""
BODIES["stream_item_count"] = BODIES["item_count"]
BODIES["stream_pair_increment"] = BODIES["pair_increment"]
BODIES["stream_identity_item_count"] = BODIES["item_count"]
BODIES["stream_pair_count"] = BODIES["pair_count"]
BODIES["stream_ctr"] = BODIES["ctr_daily"]
BODIES["stream_top_results"] = _top("SELECT * FROM ctr_all")
BODIES["stream_top_lists"] = _top("SELECT * FROM hot UNION ALL SELECT * FROM category_big UNION ALL SELECT * FROM cf", limit=10)
BODIES["stream_user_recent"] = f"""
SELECT * FROM ({_recent('SELECT * FROM res')})
QUALIFY max(action_time) OVER (PARTITION BY key) + 7 * 86400 > {AS_OF}"""
BODIES["stream_user_profile"] = BODIES["profile_top_tags"]
BODIES["stream_dim_items"] = BODIES["dim_latest_items"]
BODIES["stream_filter_list"] = BODIES["user_filter_list"]


def oracle_sql() -> dict[str, str]:
    return {name: statement(body) for name, body in BODIES.items()}
