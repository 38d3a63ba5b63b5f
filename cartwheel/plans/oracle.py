"""DuckDB oracle SQL for the registered queries.

Each query is written independently of the Spark code, from the operator
statements, over the driver's views (``events``, ``part``). Shared CTEs are
assembled from the small builders below.
"""

from __future__ import annotations

import datetime as _dt

from cartwheel.plans.fixture import (
    CAP_BACKFILL, CAP_BINDING, CAP_DEFAULT, CART_MAX_ROWS, HOT_TOP, HOT_TOP_BACKFILL, LABEL_DATE, SEED,
    SUBMISSION_CAP, SUBMISSION_CAP_UNSCORED, USER_SAMPLE_FRAC,
)

L = LABEL_DATE


def D(days: int = 0, base: _dt.date | None = None) -> str:
    """Date literal ``base + days`` (base defaults to the fixture label date)."""
    return f"DATE '{((base or L) + _dt.timedelta(days=days)).isoformat()}'"


ACTIONS = """
actions AS (
  SELECT user_id,
         user_id // 5 * 66 + CAST(json_extract_string(props, '$.k') AS BIGINT) // 2 AS item_id,
         CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
                              WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS SMALLINT) AS behavior_type,
         (user_id // 5 * 66 + CAST(json_extract_string(props, '$.k') AS BIGINT) // 2) % 6 AS item_category,
         CAST(ts AS DATE) - CASE user_id % 7 WHEN 1 THEN 4 WHEN 3 THEN 4 WHEN 5 THEN 5 ELSE 0 END AS dt
  FROM events
)"""

ITEMS = """
items AS (
  SELECT p_partkey AS item_id, p_partkey % 6 AS item_category
  FROM part WHERE p_size > 10
)"""

ITEMS_FANOUT = """
items AS (
  SELECT p_partkey AS item_id, p_partkey % 6 AS item_category
  FROM part WHERE p_size > 10
  UNION ALL
  SELECT p_partkey AS item_id, p_partkey % 6 AS item_category
  FROM part WHERE p_size > 45
)"""


def flags_cte(base: _dt.date | None = None) -> str:
    b = base or L
    return f"""
flags AS (
  SELECT user_id, item_id,
    bool_or(dt BETWEEN {D(-7, b)} AND {D(-1, b)}) AS t_recent,
    bool_or(dt BETWEEN {D(-14, b)} AND {D(-1, b)} AND behavior_type IN (2, 3)) AS t_strong,
    bool_or(dt = {D(0, b)} AND behavior_type = 4) AS t_label,
    bool_or(dt BETWEEN {D(-6, b)} AND {D(0, b)}) AS p_recent,
    bool_or(dt BETWEEN {D(-13, b)} AND {D(0, b)} AND behavior_type IN (2, 3)) AS p_strong
  FROM actions
  WHERE dt BETWEEN {D(-14, b)} AND {D(0, b)} AND item_id IN (SELECT item_id FROM items)
  GROUP BY user_id, item_id
)"""


FLAGS = flags_cte()


def train_cands(name: str = "cands", cap: int = CAP_DEFAULT, align: bool = True) -> str:
    lab = "(t_label AND (t_recent OR t_strong))" if align else "t_label"
    return f"""
{name} AS (
  SELECT user_id, item_id, CAST(lab AS INTEGER) AS label FROM (
    SELECT user_id, item_id, lab,
           row_number() OVER (PARTITION BY user_id ORDER BY tier, item_id) AS rn
    FROM (SELECT user_id, item_id, {lab} AS lab,
                 CASE WHEN {lab} THEN 0 WHEN t_strong THEN 1 WHEN t_recent THEN 2 END AS tier
          FROM flags) t
    WHERE tier IS NOT NULL) r
  WHERE rn <= {cap}
)"""


def pred_cands(name: str = "cands", cap: int = CAP_DEFAULT) -> str:
    return f"""
{name} AS (
  SELECT user_id, item_id FROM (
    SELECT user_id, item_id,
           row_number() OVER (PARTITION BY user_id ORDER BY tier, item_id) AS rn
    FROM (SELECT user_id, item_id,
                 CASE WHEN p_strong THEN 1 WHEN p_recent THEN 2 END AS tier
          FROM flags) t
    WHERE tier IS NOT NULL) r
  WHERE rn <= {cap}
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def feature_ctes(ref_days: int, cands: str = "cands", prefix: str = "",
                 base: _dt.date | None = None) -> list[str]:
    """CTEs ``{p}pop, {p}daily, {p}uf, {p}itf, {p}pf, {p}needed, {p}ucf`` for one ref."""
    p = prefix
    ref = D(ref_days, base)
    r7 = D(ref_days - 7, base)
    r3 = D(ref_days - 3, base)
    return [
        f"""{p}pop AS (
  SELECT * FROM actions
  WHERE dt < {ref} AND item_id IN (SELECT item_id FROM items)
    AND user_id IN (SELECT user_id FROM {cands})
)""",
        f"""{p}daily AS (
  SELECT user_id, item_id, item_category, dt, count(*) AS n,
         count(*) FILTER (WHERE behavior_type = 1) AS n1,
         count(*) FILTER (WHERE behavior_type = 2) AS n2,
         count(*) FILTER (WHERE behavior_type = 3) AS n3,
         count(*) FILTER (WHERE behavior_type = 4) AS n4
  FROM {p}pop GROUP BY user_id, item_id, item_category, dt
)""",
        f"""{p}uagg AS (
  SELECT user_id, CAST(sum(n) AS BIGINT) AS tot,
         CAST(sum(n1) AS BIGINT) AS b1, CAST(sum(n2) AS BIGINT) AS b2,
         CAST(sum(n3) AS BIGINT) AS b3, CAST(sum(n4) AS BIGINT) AS b4,
         count(DISTINCT dt) AS active_days,
         CAST(coalesce(sum(n) FILTER (WHERE dt >= {r7}), 0) AS BIGINT) AS r7,
         CAST(coalesce(sum(n) FILTER (WHERE dt >= {r3}), 0) AS BIGINT) AS r3,
         max(dt) AS last_dt, count(DISTINCT item_category) AS ucat
  FROM {p}daily GROUP BY user_id
)""",
        f"""{p}uf AS (
  SELECT u.user_id,
         coalesce(a.tot, 0) AS user_total_actions,
         coalesce(a.b1, 0) AS behavior_1_count, coalesce(a.b2, 0) AS behavior_2_count,
         coalesce(a.b3, 0) AS behavior_3_count, coalesce(a.b4, 0) AS behavior_4_count,
         CASE WHEN coalesce(a.tot, 0) > 0 THEN CAST(a.b4 AS DOUBLE) / CAST(a.tot AS DOUBLE) ELSE 0.0 END AS purchase_rate,
         coalesce(a.active_days, 0) AS active_days,
         CASE WHEN coalesce(a.active_days, 0) > 0 THEN CAST(a.tot AS DOUBLE) / CAST(a.active_days AS DOUBLE) ELSE 0.0 END AS avg_actions_per_day,
         coalesce(a.r7, 0) AS recent_7d_actions, coalesce(a.r3, 0) AS recent_3d_actions,
         CAST(coalesce(date_diff('day', a.last_dt, {ref}), 999) AS INTEGER) AS days_since_last_action,
         coalesce(a.ucat, 0) AS unique_categories
  FROM (SELECT DISTINCT user_id FROM {cands}) u LEFT JOIN {p}uagg a ON a.user_id = u.user_id
)""",
        f"""{p}iagg AS (
  SELECT item_id, CAST(sum(n) AS BIGINT) AS tot, CAST(sum(n4) AS BIGINT) AS buys,
         count(DISTINCT user_id) AS users, CAST(sum(n1) AS BIGINT) AS views,
         CAST(coalesce(sum(n1) FILTER (WHERE dt >= {r7}), 0) AS BIGINT) AS v7,
         CAST(coalesce(sum(n1) FILTER (WHERE dt >= {r3}), 0) AS BIGINT) AS v3,
         max(dt) AS last_dt
  FROM {p}daily WHERE item_id IN (SELECT item_id FROM {cands}) GROUP BY item_id
)""",
        f"""{p}itf AS (
  SELECT i.item_id,
         coalesce(a.tot, 0) AS item_total_actions, coalesce(a.buys, 0) AS total_purchases,
         coalesce(a.users, 0) AS unique_users, coalesce(a.views, 0) AS views,
         CASE WHEN coalesce(a.views, 0) > 0 THEN CAST(a.buys AS DOUBLE) / CAST(a.views AS DOUBLE) ELSE 0.0 END AS conversion_rate,
         CASE WHEN coalesce(a.users, 0) > 0 THEN CAST(a.tot AS DOUBLE) / CAST(a.users AS DOUBLE) ELSE 0.0 END AS avg_actions_per_user,
         coalesce(a.v7, 0) AS recent_7d_views, coalesce(a.v3, 0) AS recent_3d_views,
         CAST(coalesce(date_diff('day', a.last_dt, {ref}), 999) AS INTEGER) AS days_since_last_view,
         P.item_category
  FROM (SELECT DISTINCT item_id FROM {cands}) i
  LEFT JOIN {p}iagg a ON a.item_id = i.item_id
  LEFT JOIN items P ON P.item_id = i.item_id
)""",
        f"""{p}pagg AS (
  SELECT user_id, item_id, CAST(sum(n) AS BIGINT) AS tot,
         CAST(sum(n1) AS BIGINT) AS c1, CAST(sum(n2) AS BIGINT) AS c2,
         CAST(sum(n3) AS BIGINT) AS c3, CAST(sum(n4) AS BIGINT) AS c4,
         min(dt) AS first_dt, max(dt) AS last_dt
  FROM {p}daily GROUP BY user_id, item_id
)""",
        f"""{p}pf AS (
  SELECT k.user_id, k.item_id,
         coalesce(a.tot, 0) AS ui_total_actions, coalesce(a.c1, 0) AS ui_view_count,
         coalesce(a.c2, 0) AS ui_collect_count, coalesce(a.c3, 0) AS ui_cart_count,
         coalesce(a.c4, 0) AS ui_purchase_count,
         CAST(coalesce(date_diff('day', a.last_dt, {ref}), 999) AS INTEGER) AS ui_days_since_last_action,
         CAST(CASE WHEN a.first_dt IS NOT NULL THEN date_diff('day', a.first_dt, a.last_dt) + 1 ELSE 0 END AS INTEGER) AS ui_action_span_days,
         CASE WHEN a.first_dt IS NOT NULL
              THEN CAST(a.tot AS DOUBLE) / CAST(date_diff('day', a.first_dt, a.last_dt) + 1 AS DOUBLE)
              ELSE 0.0 END AS ui_avg_actions_per_day
  FROM (SELECT DISTINCT user_id, item_id FROM {cands}) k
  LEFT JOIN {p}pagg a ON a.user_id = k.user_id AND a.item_id = k.item_id
)""",
        f"""{p}needed AS (
  SELECT DISTINCT c.user_id, P.item_category
  FROM {cands} c LEFT JOIN items P ON P.item_id = c.item_id
)""",
        f"""{p}ucagg AS (
  SELECT d.user_id, d.item_category, CAST(sum(d.n) AS BIGINT) AS acts, count(DISTINCT d.item_id) AS its
  FROM {p}daily d
  WHERE EXISTS (SELECT 1 FROM {p}needed q WHERE q.user_id = d.user_id AND q.item_category = d.item_category)
  GROUP BY d.user_id, d.item_category
)""",
        f"""{p}ucf AS (
  SELECT q.user_id, q.item_category,
         coalesce(a.acts, 0) AS user_category_actions, coalesce(a.its, 0) AS user_category_items
  FROM {p}needed q LEFT JOIN {p}ucagg a
    ON a.user_id = q.user_id AND a.item_category = q.item_category
)""",
    ]


FEATURE_SELECT = """
  uf.user_total_actions, uf.behavior_1_count, uf.behavior_2_count, uf.behavior_3_count,
  uf.behavior_4_count, uf.purchase_rate, uf.active_days, uf.avg_actions_per_day,
  uf.recent_7d_actions, uf.recent_3d_actions, uf.days_since_last_action, uf.unique_categories,
  itf.item_total_actions, itf.total_purchases, itf.unique_users, itf.views, itf.conversion_rate,
  itf.avg_actions_per_user, itf.recent_7d_views, itf.recent_3d_views, itf.days_since_last_view,
  coalesce(itf.item_category, 0) AS item_category,
  pf.ui_total_actions, pf.ui_view_count, pf.ui_collect_count, pf.ui_cart_count,
  pf.ui_purchase_count, pf.ui_days_since_last_action, pf.ui_action_span_days, pf.ui_avg_actions_per_day,
  coalesce(ucf.user_category_actions, 0) AS user_category_actions,
  coalesce(ucf.user_category_items, 0) AS user_category_items"""


def features_select(cands: str = "cands", label: bool = True, prefix: str = "") -> str:
    p = prefix
    lab = "c.label, " if label else ""
    sel = FEATURE_SELECT.replace("uf.", f"{p}uf.").replace("itf.", f"{p}itf.") \
        .replace("pf.", f"{p}pf.").replace("ucf.", f"{p}ucf.")
    return f"""SELECT c.user_id, c.item_id, {lab}{sel}
FROM {cands} c
LEFT JOIN {p}pf ON {p}pf.user_id = c.user_id AND {p}pf.item_id = c.item_id
LEFT JOIN {p}itf ON {p}itf.item_id = c.item_id
LEFT JOIN {p}ucf ON {p}ucf.user_id = c.user_id AND {p}ucf.item_category = {p}itf.item_category
LEFT JOIN {p}uf ON {p}uf.user_id = c.user_id"""


def train_features_cte(name: str = "tf", items_cte: str = ITEMS) -> list[str]:
    """CTE list ending with ``{name}``: train features with label."""
    return [ACTIONS, items_cte, FLAGS, train_cands("cands"), *feature_ctes(0, "cands"),
            f"{name} AS ({features_select('cands', True)})"]


def pred_features_cte(name: str = "pf_all") -> list[str]:
    return [ACTIONS, ITEMS, FLAGS, pred_cands("pcands"), *feature_ctes(1, "pcands", prefix="p_"),
            f"{name} AS ({features_select('pcands', False, prefix='p_')})"]


SCORE = ("(CAST((((user_id * 7919 + item_id * 104729) % 10007) + 10007) % 10007 AS BIGINT)"
         " + 5000 * least(ui_cart_count, 1) + 2500 * least(ui_collect_count, 1)) / 20000::DOUBLE")

ORACLE: dict[str, str] = {}


def _reg(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# ---- sources / filters ----
_reg("actions_bridge", with_(ACTIONS) + "\nSELECT user_id, item_id, behavior_type, item_category, dt FROM actions")
_reg("target_items", with_(ITEMS) + "\nSELECT item_id, item_category FROM items")
_reg("actions_in_target", with_(ACTIONS, ITEMS) + """
SELECT user_id, item_id, behavior_type, item_category, dt FROM actions
WHERE item_id IN (SELECT item_id FROM items)""")
_reg("buys_on_day", with_(ACTIONS) + f"""
SELECT DISTINCT user_id, item_id FROM actions WHERE dt = {D(0)} AND behavior_type = 4""")

# ---- recall ----
_reg("recall_recent", with_(ACTIONS, ITEMS, FLAGS) + "\nSELECT user_id, item_id FROM flags WHERE t_recent")
_reg("recall_strong", with_(ACTIONS, ITEMS, FLAGS) + "\nSELECT user_id, item_id FROM flags WHERE t_strong")
_reg("recall_union", with_(ACTIONS, ITEMS, FLAGS) + "\nSELECT user_id, item_id FROM flags WHERE t_recent OR t_strong")
_reg("label_pairs", with_(ACTIONS, ITEMS, FLAGS) + "\nSELECT user_id, item_id FROM flags WHERE t_label")
_reg("label_pairs_aligned", with_(ACTIONS, ITEMS, FLAGS) + """
SELECT user_id, item_id FROM flags WHERE t_label AND (t_recent OR t_strong)""")
_reg("label_pairs_dropped", with_(ACTIONS, ITEMS, FLAGS) + """
SELECT count(*) FILTER (WHERE t_label) AS label_pairs,
       count(*) FILTER (WHERE t_label AND (t_recent OR t_strong)) AS kept,
       count(*) FILTER (WHERE t_label AND NOT (t_recent OR t_strong)) AS dropped
FROM flags""")
_reg("train_candidates", with_(ACTIONS, ITEMS, FLAGS, train_cands("c")) + "\nSELECT user_id, item_id, label FROM c")
_reg("train_candidates_unaligned", with_(ACTIONS, ITEMS, FLAGS, train_cands("c", align=False))
     + "\nSELECT user_id, item_id, label FROM c")
_reg("pred_candidates", with_(ACTIONS, ITEMS, FLAGS, pred_cands("c")) + "\nSELECT user_id, item_id FROM c")
_reg("candidates_capped", with_(ACTIONS, ITEMS, FLAGS, train_cands("c", cap=CAP_BINDING))
     + "\nSELECT user_id, item_id, label FROM c")
HOT = f"""
hot AS (
  SELECT item_id, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, item_id) AS INTEGER) AS hot_rank
  FROM (SELECT item_id, count(*) AS cnt FROM actions
        WHERE dt BETWEEN {D(-6)} AND {D(0)} AND item_id IN (SELECT item_id FROM items)
        GROUP BY item_id) x
  QUALIFY row_number() OVER (ORDER BY cnt DESC, item_id) <= {{top}}
)"""
_reg("hot_items", with_(ACTIONS, ITEMS, HOT.format(top=HOT_TOP)) + "\nSELECT item_id, cnt, hot_rank FROM hot")
_BACKFILL = [
    pred_cands("c", cap=CAP_BACKFILL), HOT.format(top=HOT_TOP_BACKFILL),
    f"""sizes AS (SELECT user_id, count(*) AS n FROM c GROUP BY user_id)""",
    f"""fill AS (
  SELECT s.user_id, h.item_id,
         row_number() OVER (PARTITION BY s.user_id ORDER BY h.hot_rank) AS k, s.n
  FROM sizes s JOIN hot h ON TRUE
  WHERE s.n < {CAP_BACKFILL}
    AND NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = s.user_id AND c.item_id = h.item_id)
)"""]
_BACKFILL_ROWS = f"""
SELECT user_id, item_id FROM c
UNION ALL
SELECT user_id, item_id FROM fill WHERE k <= {CAP_BACKFILL} - n"""
BACKFILLED = with_(*_BACKFILL) + _BACKFILL_ROWS
_reg("pred_candidates_backfilled", with_(ACTIONS, ITEMS, FLAGS, *_BACKFILL) + _BACKFILL_ROWS)
_reg("candidate_stats", with_(ACTIONS, ITEMS, FLAGS, train_cands("c")) + """
SELECT count(*) AS rows, CAST(coalesce(sum(label), 0) AS BIGINT) AS pos,
       count(*) - CAST(coalesce(sum(label), 0) AS BIGINT) AS neg,
       CASE WHEN coalesce(sum(label), 0) > 0
            THEN CAST(count(*) - sum(label) AS DOUBLE) / CAST(sum(label) AS DOUBLE)
            ELSE 'inf'::DOUBLE END AS neg_pos_ratio
FROM c""")

# ---- features ----
_TF = [ACTIONS, ITEMS, FLAGS, train_cands("cands"), *feature_ctes(0, "cands")]
_reg("user_features", with_(*_TF) + "\nSELECT * FROM uf")
_reg("item_features", with_(*_TF) + "\nSELECT * FROM itf")
_reg("pair_features", with_(*_TF) + "\nSELECT * FROM pf")
_reg("user_category_features", with_(*_TF) + "\nSELECT * FROM ucf")
_reg("train_features", with_(*train_features_cte("tf")) + "\nSELECT * FROM tf")
_reg("pred_features", with_(*pred_features_cte("pfa")) + "\nSELECT * FROM pfa")
_reg("train_features_fanout", with_(*train_features_cte("tf", ITEMS_FANOUT)) + "\nSELECT * FROM tf")


# ---- strategies ----
STRONG_COND = ("(coalesce(ui_cart_count, 0) > 0 OR coalesce(ui_collect_count, 0) > 0 "
               "OR coalesce(recent_3d_actions, 0) > 0 OR coalesce(ui_days_since_last_action, 0) <= 3 "
               "OR coalesce(ui_purchase_count, 0) > 0)")

PRED_BASE = [*pred_features_cte("pfa"),
             f"scored AS (SELECT *, {SCORE} AS pred_prob FROM pfa)",
             "results AS (SELECT user_id, item_id, max(pred_prob) AS pred_prob FROM scored GROUP BY user_id, item_id)",
             f"strong AS (SELECT DISTINCT user_id, item_id FROM pfa WHERE {STRONG_COND})"]


def two_stage_sql(name: str, res: str, k: int, m: int, strong: str = "strong") -> list[str]:
    return [
        f"""{name}_f AS (
  SELECT r.user_id, r.item_id, r.pred_prob,
         EXISTS (SELECT 1 FROM {strong} s WHERE s.user_id = r.user_id AND s.item_id = r.item_id) AS is_strong
  FROM {res} r)""",
        f"""{name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, is_strong ORDER BY pred_prob DESC, item_id) AS rn
  FROM {name}_f)""",
        f"""{name}_n AS (
  SELECT *, coalesce(max(CASE WHEN is_strong THEN rn END) OVER (PARTITION BY user_id), 0) AS n_strong
  FROM {name}_r)""",
        f"""{name} AS (
  SELECT user_id, item_id, pred_prob FROM {name}_n
  WHERE CASE WHEN is_strong THEN rn <= least({m}, n_strong, {k})
             ELSE rn <= {k} - least({m}, n_strong, {k}) END)""",
    ]


ALL_ROWS = 1 << 62          # no cap


def cart_sql(name: str, feats: str, res: str, max_rows: int, days_max: int) -> list[str]:
    return [
        f"""{name}_p AS (
  SELECT user_id, item_id, min(coalesce(ui_days_since_last_action, 999)) AS min_gap
  FROM {feats} WHERE coalesce(ui_cart_count, 0) > 0 GROUP BY user_id, item_id)""",
        f"""{name}_pool AS (
  SELECT r.user_id, r.item_id, r.pred_prob, c.min_gap
  FROM {res} r JOIN {name}_p c ON c.user_id = r.user_id AND c.item_id = r.item_id)""",
        f"""{name}_d AS (
  SELECT CASE WHEN {days_max} < 2 OR count(*) FILTER (WHERE min_gap <= 1) >= {max_rows} THEN 1
              WHEN {days_max} < 3 OR count(*) FILTER (WHERE min_gap <= 2) >= {max_rows} THEN 2
              ELSE 3 END AS d
  FROM {name}_pool)""",
        f"""{name} AS (
  SELECT user_id, item_id, pred_prob FROM {name}_pool
  WHERE min_gap <= (SELECT d FROM {name}_d)
  QUALIFY row_number() OVER (ORDER BY pred_prob DESC, user_id, item_id) <= {max_rows})""",
    ]


_reg("strong_pairs", with_(*PRED_BASE) + "\nSELECT user_id, item_id FROM strong")
_reg("prefilter_strong", with_(*PRED_BASE) + """
SELECT r.* FROM results r WHERE EXISTS (SELECT 1 FROM strong s WHERE s.user_id = r.user_id AND s.item_id = r.item_id)""")
_reg("prefilter_min_prob", with_(*PRED_BASE) + """
SELECT r.* FROM results r WHERE EXISTS (SELECT 1 FROM strong s WHERE s.user_id = r.user_id AND s.item_id = r.item_id)
  AND r.pred_prob >= 0.3""")
_reg("result_dedup", with_(*train_features_cte("tf", ITEMS_FANOUT)) + f"""
SELECT user_id, item_id, max({SCORE}) AS pred_prob FROM tf GROUP BY user_id, item_id""")
_reg("topk_per_user", with_(*PRED_BASE) + """
SELECT user_id, item_id FROM results
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY pred_prob DESC, item_id) <= 5""")
_reg("two_stage", with_(*PRED_BASE, *two_stage_sql("ts", "results", 3, 1)) + "\nSELECT user_id, item_id FROM ts")
_reg("threshold_select", with_(*PRED_BASE) + "\nSELECT user_id, item_id FROM results WHERE pred_prob >= 0.5")
_reg("global_topn", with_(*PRED_BASE) + """
SELECT user_id, item_id FROM results ORDER BY pred_prob DESC, user_id, item_id LIMIT 100""")
for _name, _rows, _days in (("cart_only", ALL_ROWS, 2), ("cart_only_relaxed", ALL_ROWS, 3), ("cart_only_capped", CART_MAX_ROWS, 3)):
    _reg(_name, with_(*PRED_BASE, *cart_sql("co", "pfa", "results", _rows, _days)) + "\nSELECT user_id, item_id FROM co")
_reg("cap_submission", with_(*PRED_BASE, *two_stage_sql("ts", "results", 5, 1)) + """
SELECT t.user_id, t.item_id FROM ts t LEFT JOIN results r ON r.user_id = t.user_id AND r.item_id = t.item_id
ORDER BY coalesce(r.pred_prob, 0) DESC, t.user_id, t.item_id LIMIT """ + str(SUBMISSION_CAP))
BUYS_L = f"buys AS (SELECT DISTINCT user_id, item_id FROM actions WHERE dt = {D(0)} AND behavior_type = 4)"
_reg("exclude_day_buys", with_(*PRED_BASE, *two_stage_sql("ts", "results", 5, 1), BUYS_L) + """
SELECT t.user_id, t.item_id FROM ts t
WHERE NOT EXISTS (SELECT 1 FROM buys b WHERE b.user_id = t.user_id AND b.item_id = t.item_id)""")
_reg("submission", with_(
    *PRED_BASE,
    """pre AS (SELECT r.* FROM results r
  WHERE EXISTS (SELECT 1 FROM strong s WHERE s.user_id = r.user_id AND s.item_id = r.item_id)
    AND r.pred_prob >= 0.09)""",
    *cart_sql("co", "pfa", "pre", ALL_ROWS, 1), BUYS_L,
    """kept AS (SELECT c.user_id, c.item_id FROM co c
  WHERE NOT EXISTS (SELECT 1 FROM buys b WHERE b.user_id = c.user_id AND b.item_id = c.item_id))""",
    f"""capped AS (SELECT k.user_id, k.item_id FROM kept k
  LEFT JOIN pre p ON p.user_id = k.user_id AND p.item_id = k.item_id
  ORDER BY coalesce(p.pred_prob, 0) DESC, k.user_id, k.item_id LIMIT {SUBMISSION_CAP})""")
     + "\nSELECT DISTINCT user_id, item_id FROM capped")
_reg("threshold_by_quantile", with_(*PRED_BASE) + """
SELECT round(coalesce(quantile_cont(pred_prob, 0.9), 0.5), 9) AS threshold FROM results""")
for _name, _t in (("threshold_with_fallback", 2.0), ("threshold_kept", 0.6)):      # K7: no pick at all, some picks
    _reg(_name, with_(
        *PRED_BASE, f"thr AS (SELECT user_id, item_id FROM results WHERE pred_prob >= {_t})",
        *two_stage_sql("ts", "results", 3, 1)) + """
SELECT user_id, item_id FROM thr WHERE (SELECT count(*) FROM thr) >= 1
UNION ALL
SELECT user_id, item_id FROM ts WHERE (SELECT count(*) FROM thr) < 1""")
_reg("score_quantiles", with_(*PRED_BASE) + """
SELECT round(quantile_cont(pred_prob, 0.5), 9) AS q50, round(quantile_cont(pred_prob, 0.9), 9) AS q90,
       round(quantile_cont(pred_prob, 0.999), 9) AS q999 FROM results""")

# ---- metrics ----
TRAIN_SCORED = [*train_features_cte("tf"), f"sc AS (SELECT *, {SCORE} AS pred_prob FROM tf)"]
KS = (1, 3, 5, 10)


def _per_user_sql() -> list[str]:
    hits = ",\n".join(
        f"  CAST(coalesce(sum(label) FILTER (WHERE rn <= {k}), 0) AS DOUBLE) AS hits_{k},\n"
        f"  coalesce(sum(label / log2(rn + 1)) FILTER (WHERE rn <= {k}), 0.0) AS dcg_{k}"
        for k in KS)
    cols = ",\n".join(
        f"  hits_{k} / {float(k)} AS p_{k},\n"
        f"  CASE WHEN npos > 0 THEN hits_{k} / npos ELSE 0.0 END AS r_{k},\n"
        f"  CASE WHEN hits_{k} > 0 THEN 1.0 ELSE 0.0 END AS h_{k},\n"
        f"  CASE WHEN least({k}, npos) > 0 THEN dcg_{k} / list_sum(list_transform(range(1, CAST(least({k}, npos) AS BIGINT) + 1), lambda i: 1.0 / log2(i + 1))) ELSE 0.0 END AS n_{k}"
        for k in KS)
    return [
        "rk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pred_prob DESC, item_id) AS rn FROM sc)",
        f"pu0 AS (SELECT user_id, CAST(sum(label) AS DOUBLE) AS npos,\n{hits}\nFROM rk GROUP BY user_id)",
        f"pu AS (SELECT user_id,\n{cols}\nFROM pu0)",
        "avgs AS (SELECT " + ", ".join(f"avg(p_{k}) AS p_{k}, avg(r_{k}) AS r_{k}, avg(h_{k}) AS h_{k}, avg(n_{k}) AS n_{k}" for k in KS) + " FROM pu)",
        "rm AS (" + "\nUNION ALL\n".join(
            f"SELECT {k} AS k, p_{k} AS precision, r_{k} AS recall, "
            f"CASE WHEN p_{k} + r_{k} > 0 THEN 2 * p_{k} * r_{k} / (p_{k} + r_{k}) ELSE 0.0 END AS f1, "
            f"h_{k} AS hit_ratio, n_{k} AS ndcg FROM avgs" for k in KS) + ")",
    ]


AUC_CTES = [
    """bs AS (SELECT pred_prob AS s, count(*) FILTER (WHERE label = 1) AS pos,
                 count(*) FILTER (WHERE label <> 1) AS neg FROM sc GROUP BY pred_prob)""",
    """cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM bs)""",
    """auc AS (SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0
          THEN sum(CAST(pos AS DOUBLE) * (CAST(nb AS DOUBLE) + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE))
          END AS auc FROM cum)""",
]
_reg("auc", with_(*TRAIN_SCORED, *AUC_CTES) + "\nSELECT round(auc, 9) AS auc FROM auc")
_reg("precision_recall_at_k", with_(*TRAIN_SCORED, *_per_user_sql()) + """
SELECT k, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM rm""")
_reg("hit_ratio_at_k", with_(*TRAIN_SCORED, *_per_user_sql()) + "\nSELECT k, round(hit_ratio, 9) AS hit_ratio FROM rm")
_reg("ndcg_at_k", with_(*TRAIN_SCORED, *_per_user_sql()) + "\nSELECT k, round(ndcg, 9) AS ndcg FROM rm")
_reg("metric_report", with_(*TRAIN_SCORED, *_per_user_sql(), *AUC_CTES) + "\n" + "\nUNION ALL\n".join(
    [f"SELECT '{m}' AS metric, k, round({m}, 9) AS value FROM rm" for m in ("precision", "recall", "f1", "hit_ratio", "ndcg")]
    + ["SELECT 'auc' AS metric, 0 AS k, round(auc, 9) AS value FROM auc"]))


def f1_sql(counts: str) -> str:
    """Adds f1/precision/recall (rounded) to a one-row counts CTE."""
    return f"""SELECT tp, pred_cnt, true_pos,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 9) AS f1,
  round(p, 9) AS precision, round(r, 9) AS recall
FROM (SELECT *, CASE WHEN pred_cnt > 0 AND true_pos > 0 THEN CAST(tp AS DOUBLE) / pred_cnt ELSE 0.0 END AS p,
             CASE WHEN pred_cnt > 0 AND true_pos > 0 THEN CAST(tp AS DOUBLE) / true_pos ELSE 0.0 END AS r
      FROM {counts}) x"""


def thr_counts(src: str, t: float) -> str:
    return f"""(SELECT count(*) FILTER (WHERE pred_prob >= {t}) AS pred_cnt,
        CAST(coalesce(sum(label) FILTER (WHERE pred_prob >= {t}), 0) AS BIGINT) AS tp,
        CAST(coalesce(sum(label), 0) AS BIGINT) AS true_pos FROM {src})"""


_reg("f1_counts", with_(*TRAIN_SCORED) + "\n" + f1_sql(thr_counts("sc", 0.3)))
_reg("score_summary", with_(*TRAIN_SCORED) + """
SELECT round(avg(CASE WHEN pred_prob >= 0.5 THEN 1.0 ELSE 0.0 END), 9) AS share_ge_t,
       round(avg(CAST(label AS DOUBLE)), 9) AS pos_rate, count(DISTINCT user_id) AS users FROM sc""")

# ---- tuning ----
_STRONG_ROW = f"*, {STRONG_COND} AS is_strong"


def _ts_rows(k: int, m: int) -> list[str]:
    return [
        f"fl AS (SELECT {_STRONG_ROW} FROM sc)",
        "fr AS (SELECT *, row_number() OVER (PARTITION BY user_id, is_strong ORDER BY pred_prob DESC, item_id) AS rn FROM fl)",
        "fn AS (SELECT *, coalesce(max(CASE WHEN is_strong THEN rn END) OVER (PARTITION BY user_id), 0) AS n_strong FROM fr)",
    ]


def _ts_keep(k: int, m: int) -> str:
    return (f"CASE WHEN is_strong THEN rn <= least({m}, n_strong, {k}) "
            f"ELSE rn <= {k} - least({m}, n_strong, {k}) END")


_reg("eval_two_stage", with_(*TRAIN_SCORED, *_ts_rows(3, 1)) + "\n" + f1_sql(
    f"""(SELECT CAST(coalesce(sum(label) FILTER (WHERE {_ts_keep(3, 1)}), 0) AS BIGINT) AS tp,
        count(*) FILTER (WHERE {_ts_keep(3, 1)}) AS pred_cnt,
        CAST(coalesce(sum(label), 0) AS BIGINT) AS true_pos, 3 AS k, 1 AS m FROM fn)""").replace(
    "SELECT tp, pred_cnt, true_pos,", "SELECT k, m, tp, pred_cnt, true_pos,", 1))
_reg("eval_threshold", with_(*TRAIN_SCORED) + "\n" + f1_sql(thr_counts("sc", 0.5)))
_reg("eval_cart_only", with_(*TRAIN_SCORED) + "\n" + f1_sql(
    """(SELECT count(*) FILTER (WHERE coalesce(ui_cart_count, 0) > 0 AND coalesce(ui_days_since_last_action, 999) <= 1 AND pred_prob >= 0.09) AS pred_cnt,
        CAST(coalesce(sum(label) FILTER (WHERE coalesce(ui_cart_count, 0) > 0 AND coalesce(ui_days_since_last_action, 999) <= 1 AND pred_prob >= 0.09), 0) AS BIGINT) AS tp,
        CAST(coalesce(sum(label), 0) AS BIGINT) AS true_pos FROM sc)"""))
_reg("eval_forced", with_(*TRAIN_SCORED, f"ss AS (SELECT * FROM sc WHERE {STRONG_COND})",
                          """sel AS (SELECT * FROM ss
  WHERE coalesce(ui_cart_count, 0) > 0 AND coalesce(ui_days_since_last_action, 999) <= 1 AND pred_prob >= 0.09
  )""") + "\n" + f1_sql(
    """(SELECT (SELECT count(*) FROM sel) AS pred_cnt,
        (SELECT CAST(coalesce(sum(label), 0) AS BIGINT) FROM sel) AS tp,
        (SELECT CAST(coalesce(sum(label), 0) AS BIGINT) FROM ss) AS true_pos,
        (SELECT count(DISTINCT user_id) FROM ss) AS users)""").replace(
    "SELECT tp, pred_cnt, true_pos,", "SELECT 'cart_only' AS strategy, users, tp, pred_cnt, true_pos,", 1))
_reg("eval_forced_topk", with_(*TRAIN_SCORED, *_ts_rows(3, 1),
                               f"""sel AS (SELECT * FROM fn WHERE {_ts_keep(3, 1)} AND pred_prob >= 0.3
  QUALIFY row_number() OVER (ORDER BY pred_prob DESC, user_id, item_id) <= 100)""") + "\n" + f1_sql(
    """(SELECT (SELECT count(*) FROM sel) AS pred_cnt,
        (SELECT CAST(coalesce(sum(label), 0) AS BIGINT) FROM sel) AS tp,
        (SELECT CAST(coalesce(sum(label), 0) AS BIGINT) FROM sc) AS true_pos,
        (SELECT count(DISTINCT user_id) FROM sc) AS users)""").replace(
    "SELECT tp, pred_cnt, true_pos,", "SELECT 'topk_two_stage' AS strategy, users, tp, pred_cnt, true_pos,", 1))

_GRID = [(k, m) for k in (3, 5, 8, 10, 12, 15) for m in (0, 1, 2, 3, 5) if m <= k]
_reg("grid_two_stage", with_(*TRAIN_SCORED, *_ts_rows(15, 0),
                             "grid(grid_idx, k, m) AS (VALUES " + ", ".join(f"({i}, {k}, {m})" for i, (k, m) in enumerate(_GRID)) + ")",
                             """cnt AS (SELECT g.grid_idx, g.k, g.m,
    CAST(coalesce(sum(f.label) FILTER (WHERE CASE WHEN f.is_strong THEN f.rn <= least(g.m, f.n_strong, g.k) ELSE f.rn <= g.k - least(g.m, f.n_strong, g.k) END), 0) AS BIGINT) AS tp,
    count(f.rn) FILTER (WHERE CASE WHEN f.is_strong THEN f.rn <= least(g.m, f.n_strong, g.k) ELSE f.rn <= g.k - least(g.m, f.n_strong, g.k) END) AS pred_cnt,
    (SELECT CAST(coalesce(sum(label), 0) AS BIGINT) FROM sc) AS true_pos
  FROM grid g LEFT JOIN fn f ON TRUE GROUP BY g.grid_idx, g.k, g.m)""") + "\n"
     + f1_sql("cnt").replace("SELECT tp, pred_cnt, true_pos,", "SELECT grid_idx, k, m, tp, pred_cnt, true_pos,", 1))

_THR_GRID = """tq AS (SELECT quantile_cont(pred_prob, 0.9) AS lo, quantile_cont(pred_prob, 0.999) AS hi FROM sc),
tg AS (SELECT CAST(i AS INTEGER) AS grid_idx, CASE WHEN i = 24 THEN hi ELSE lo + i * ((hi - lo) / 24) END AS threshold
       FROM tq, range(0, 25) r(i))"""
_reg("grid_threshold", with_(*TRAIN_SCORED, _THR_GRID, """tc AS (SELECT g.grid_idx, g.threshold,
    CAST(coalesce(sum(s.label) FILTER (WHERE s.pred_prob >= g.threshold), 0) AS BIGINT) AS tp,
    count(*) FILTER (WHERE s.pred_prob >= g.threshold) AS pred_cnt,
    CAST(coalesce(sum(s.label), 0) AS BIGINT) AS true_pos,
    CAST(count(*) FILTER (WHERE s.pred_prob >= g.threshold) AS DOUBLE) / count(*) AS q_level
  FROM tg g, sc s GROUP BY g.grid_idx, g.threshold)""") + "\n"
     + f1_sql("tc").replace("SELECT tp, pred_cnt, true_pos,",
                            "SELECT grid_idx, round(threshold, 9) AS threshold, tp, pred_cnt, true_pos, round(q_level, 9) AS q_level,", 1))


# ---- strategy choice and full validation ----
def _f1_cols(tp="tp", pc="pred_cnt", tpos="true_pos") -> str:
    p = f"CASE WHEN {pc} > 0 AND {tpos} > 0 THEN CAST({tp} AS DOUBLE) / {pc} ELSE 0.0 END"
    r = f"CASE WHEN {pc} > 0 AND {tpos} > 0 THEN CAST({tp} AS DOUBLE) / {tpos} ELSE 0.0 END"
    return f"CASE WHEN ({p}) + ({r}) > 0 THEN 2 * ({p}) * ({r}) / (({p}) + ({r})) ELSE 0.0 END AS f1"


def chosen_sql(scored: list[str]) -> str:
    return with_(
    *scored, *_ts_rows(15, 0),
    "grid(grid_idx, k, m) AS (VALUES " + ", ".join(f"({i}, {k}, {m})" for i, (k, m) in enumerate(_GRID)) + ")",
    """gcnt AS (SELECT g.grid_idx, g.k, g.m,
    CAST(coalesce(sum(f.label) FILTER (WHERE CASE WHEN f.is_strong THEN f.rn <= least(g.m, f.n_strong, g.k) ELSE f.rn <= g.k - least(g.m, f.n_strong, g.k) END), 0) AS BIGINT) AS tp,
    count(f.rn) FILTER (WHERE CASE WHEN f.is_strong THEN f.rn <= least(g.m, f.n_strong, g.k) ELSE f.rn <= g.k - least(g.m, f.n_strong, g.k) END) AS pred_cnt,
    (SELECT CAST(coalesce(sum(label), 0) AS BIGINT) FROM sc) AS true_pos
  FROM grid g LEFT JOIN fn f ON TRUE GROUP BY g.grid_idx, g.k, g.m)""",
    f"bt AS (SELECT *, {_f1_cols()} FROM gcnt ORDER BY f1 DESC, grid_idx LIMIT 1)",
    _THR_GRID,
    """tcnt AS (SELECT g.grid_idx, g.threshold,
    CAST(coalesce(sum(s.label) FILTER (WHERE s.pred_prob >= g.threshold), 0) AS BIGINT) AS tp,
    count(*) FILTER (WHERE s.pred_prob >= g.threshold) AS pred_cnt,
    CAST(coalesce(sum(s.label), 0) AS BIGINT) AS true_pos,
    CAST(count(*) FILTER (WHERE s.pred_prob >= g.threshold) AS DOUBLE) / count(*) AS q_level
  FROM tg g, sc s GROUP BY g.grid_idx, g.threshold)""",
    f"bh AS (SELECT *, {_f1_cols()} FROM tcnt ORDER BY f1 DESC, grid_idx LIMIT 1)") + """
SELECT CASE WHEN bt.f1 >= bh.f1 THEN 'topk_two_stage' ELSE 'threshold' END AS name,
       CAST(CASE WHEN bt.f1 >= bh.f1 THEN bt.k END AS INTEGER) AS k,
       CAST(CASE WHEN bt.f1 >= bh.f1 THEN bt.m END AS INTEGER) AS m,
       round(CASE WHEN bt.f1 >= bh.f1 THEN NULL ELSE bh.threshold END, 9) AS threshold,
       round(CASE WHEN bt.f1 >= bh.f1 THEN NULL ELSE bh.q_level END, 9) AS q_level,
       CAST(CASE WHEN bt.f1 >= bh.f1 THEN NULL ELSE bt.k END AS INTEGER) AS fallback_k,
       CAST(CASE WHEN bt.f1 >= bh.f1 THEN NULL ELSE bt.m END AS INTEGER) AS fallback_m
FROM bt, bh"""


_reg("chosen_strategy", chosen_sql(TRAIN_SCORED))
# E14's other branch: a score that knows the label makes the threshold rule win.
_reg("chosen_strategy_threshold", chosen_sql([*train_features_cte("tf"),
    f"sc AS (SELECT *, {SCORE} / 2 + label * 0.5 AS pred_prob FROM tf)"]))

_reg("full_validation", with_(
    *TRAIN_SCORED,
    "res_v AS (SELECT user_id, item_id, max(pred_prob) AS pred_prob, max(label) AS label FROM sc GROUP BY user_id, item_id)",
    f"strong_t AS (SELECT DISTINCT user_id, item_id FROM tf WHERE {STRONG_COND})",
    """res AS (SELECT user_id, item_id, pred_prob FROM res_v r
  WHERE EXISTS (SELECT 1 FROM strong_t s WHERE s.user_id = r.user_id AND s.item_id = r.item_id))""",
    *two_stage_sql("ts", "res", 5, 1, strong="strong_t"),
    """cnt AS (SELECT
    (SELECT CAST(coalesce(sum(coalesce(r.label, 0)), 0) AS BIGINT) FROM ts LEFT JOIN res_v r
       ON r.user_id = ts.user_id AND r.item_id = ts.item_id) AS tp,
    (SELECT count(*) FROM ts) AS pred_cnt,
    (SELECT CAST(coalesce(sum(label), 0) AS BIGINT) FROM res_v) AS true_pos)""") + "\n" + f1_sql("cnt"))


# ---- sampling ----
def md5_order(seed: int = SEED) -> str:
    return f"md5(concat_ws('_', user_id, item_id, '{seed}')), user_id, item_id"


def neg_sample_sql(n: str, src: str, ratio: float, gap: int | None = None, seed: int = SEED) -> list[str]:
    gap_cond = f" AND ui_days_since_last_action <= {gap}" if gap is not None else ""
    return [
        f"{n}_pos AS (SELECT * FROM {src} WHERE label = 1)",
        f"{n}_neg AS (SELECT * FROM {src} WHERE label = 0{gap_cond})",
        f"{n}_cnt AS (SELECT (SELECT count(*) FROM {n}_pos) AS np, (SELECT count(*) FROM {n}_neg) AS nn)",
        f"""{n}_negs AS (SELECT * FROM {n}_neg
  QUALIFY row_number() OVER (ORDER BY {md5_order(seed)})
          <= (SELECT least(nn, CAST(floor(np * {ratio}) AS BIGINT)) FROM {n}_cnt))""",
        f"""{n} AS (
  SELECT * FROM {src} WHERE (SELECT np = 0 OR nn = 0 FROM {n}_cnt)
  UNION ALL SELECT * FROM {n}_pos WHERE (SELECT np > 0 AND nn > 0 FROM {n}_cnt)
  UNION ALL SELECT * FROM {n}_negs WHERE (SELECT np > 0 AND nn > 0 FROM {n}_cnt))""",
    ]


def bucketed_sql(n: str, src: str, ratio: float, bounds=(1, 3, 7), seed: int = SEED) -> list[str]:
    g = "ui_days_since_last_action"
    case = f"CASE WHEN {g} IS NULL THEN {len(bounds)} " + " ".join(
        f"WHEN {g} <= {b} THEN {i}" for i, b in enumerate(bounds)) + f" ELSE {len(bounds)} END"
    return [
        f"{n}_b AS (SELECT *, {case} AS _b FROM {src})",
        f"{n}_pc AS (SELECT _b, count(*) AS pc FROM {n}_b WHERE label = 1 GROUP BY _b)",
        f"{n}_nc AS (SELECT _b, count(*) AS nc FROM {n}_b WHERE label = 0 GROUP BY _b)",
        f"""{n}_q AS (SELECT p._b, least(CAST(floor(p.pc * {ratio}) AS BIGINT), q.nc) AS quota
  FROM {n}_pc p JOIN {n}_nc q ON q._b = p._b WHERE floor(p.pc * {ratio}) > 0)""",
        f"""{n}_pick AS (SELECT b.* EXCLUDE (_b) FROM {n}_b b JOIN {n}_q q ON q._b = b._b WHERE b.label = 0
  QUALIFY row_number() OVER (PARTITION BY b._b ORDER BY md5(concat_ws('_', b.user_id, b.item_id, '{seed}')), b.user_id, b.item_id) <= q.quota)""",
        *neg_sample_sql(f"{n}_fb", src, ratio, None, seed),
        f"""{n}_st AS (SELECT (SELECT count(*) FROM {n}_pc) AS npb, (SELECT count(*) FROM {n}_nc) AS nnb,
                        (SELECT count(*) FROM {n}_q) AS nq)""",
        f"""{n} AS (
  SELECT * FROM {src} WHERE (SELECT npb = 0 OR nnb = 0 FROM {n}_st)
  UNION ALL SELECT * FROM {n}_fb WHERE (SELECT npb > 0 AND nnb > 0 AND nq = 0 FROM {n}_st)
  UNION ALL SELECT * FROM {src} WHERE label = 1 AND (SELECT npb > 0 AND nnb > 0 AND nq > 0 FROM {n}_st)
  UNION ALL SELECT * FROM {n}_pick WHERE (SELECT npb > 0 AND nnb > 0 AND nq > 0 FROM {n}_st))""",
    ]


_TFC = train_features_cte("tf")
_reg("neg_sample", with_(*_TFC, *neg_sample_sql("ns", "tf", 20)) + "\nSELECT * FROM ns")
_reg("neg_sample_bucketed", with_(*_TFC, *bucketed_sql("nb", "tf", 20)) + "\nSELECT * FROM nb")
_reg("neg_sample_chained", with_(*_TFC, *neg_sample_sql("c1", "tf", 1, gap=3), *bucketed_sql("c2", "c1", 1))
     + "\nSELECT * FROM c2")
_reg("neg_sample_by_user", with_(
    *_TFC,
    "pos AS (SELECT * FROM tf WHERE label = 1)",
    "neg AS (SELECT * FROM tf WHERE label = 0)",
    "cn AS (SELECT (SELECT count(*) FROM pos) AS np, (SELECT count(*) FROM neg) AS nn)",
    "tg AS (SELECT np, nn, least(nn, CAST(floor(np * 5) AS BIGINT)) AS target FROM cn)",
    """alloc AS (SELECT user_id, least(CAST(round_even(c / tg.nn * tg.target, 0) AS BIGINT), c) AS take
  FROM (SELECT user_id, count(*) AS c FROM neg GROUP BY user_id) u, tg
  WHERE least(CAST(round_even(c / tg.nn * tg.target, 0) AS BIGINT), c) > 0)""",
    f"""picked AS (SELECT neg.* FROM neg JOIN alloc USING (user_id)
  QUALIFY row_number() OVER (PARTITION BY neg.user_id ORDER BY {md5_order()}) <= alloc.take)""",
    f"""picked_cut AS (SELECT * FROM picked
  QUALIFY row_number() OVER (ORDER BY {md5_order()}) <= (SELECT target FROM tg))""",
    f"""fallback AS (SELECT * FROM neg
  QUALIFY row_number() OVER (ORDER BY {md5_order()}) <= (SELECT target FROM tg))""",
    """sel AS (
  SELECT * FROM picked_cut WHERE (SELECT count(*) FROM picked) > 0
  UNION ALL SELECT * FROM fallback WHERE (SELECT count(*) FROM picked) = 0)""") + """
SELECT * FROM tf WHERE (SELECT np = 0 OR nn = 0 FROM cn)
UNION ALL SELECT * FROM pos WHERE (SELECT np > 0 AND nn > 0 FROM cn)
UNION ALL SELECT * FROM sel WHERE (SELECT np > 0 AND nn > 0 FROM cn)""")
_reg("user_sample", with_(
    *_TFC,
    "us AS (SELECT DISTINCT user_id FROM tf)",
    f"un AS (SELECT least(count(*), greatest(1, CAST(floor(count(*) * {USER_SAMPLE_FRAC}) AS BIGINT))) AS n FROM us)",
    f"""chosen AS (SELECT user_id FROM us
  QUALIFY row_number() OVER (ORDER BY md5(concat_ws('_', user_id, '{SEED}')), user_id) <= (SELECT n FROM un))""")
     + "\nSELECT * FROM tf WHERE user_id IN (SELECT user_id FROM chosen)")
_reg("balanced_sample", with_(*_TFC) + f"""
SELECT * FROM tf QUALIFY row_number() OVER (PARTITION BY label ORDER BY {md5_order()}) <= 100""")
_reg("recency_bucket", with_(*_TFC) + """
SELECT user_id, item_id, label,
       CASE WHEN ui_days_since_last_action IS NULL THEN 3 WHEN ui_days_since_last_action <= 1 THEN 0
            WHEN ui_days_since_last_action <= 3 THEN 1 WHEN ui_days_since_last_action <= 7 THEN 2 ELSE 3 END AS bucket
FROM tf""")
_reg("group_kfold", with_(*_TFC) + f"""
SELECT user_id, item_id, label,
       CAST(CAST('0x' || substr(md5(concat_ws('_', user_id, '{SEED}')), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold
FROM tf""")
_reg("stratified_kfold", with_(*_TFC) + f"""
SELECT user_id, item_id, label,
       CAST((row_number() OVER (PARTITION BY label ORDER BY {md5_order()}) - 1) % 5 AS INTEGER) AS fold
FROM tf""")


# ---- load-test log: lineitem join orders, P = every part ----
LOAD_L = _dt.date(2001, 8, 1)
LOAD_ACTIONS = """
actions AS (
  SELECT o.o_custkey AS user_id, o.o_custkey // 15 * 20 + l.l_partkey % 20 AS item_id,
         CAST(1 + (((l.l_orderkey * 7 + l.l_linenumber) % 4) + 4) % 4 AS SMALLINT) AS behavior_type,
         (o.o_custkey // 15 * 20 + l.l_partkey % 20) % 25 AS item_category,
         DATE '2001-08-01' - CAST((DATE '2001-08-01' - CAST(o.o_orderdate AS DATE)) % 30 AS INTEGER) AS dt
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""
LOAD_ITEMS = """
items AS (SELECT p_partkey AS item_id, ((p_partkey % 25) + 25) % 25 AS item_category FROM part)"""
_LOAD = [LOAD_ACTIONS, LOAD_ITEMS, flags_cte(LOAD_L)]
_reg("load_train_candidates", with_(*_LOAD, train_cands("c")) + "\nSELECT user_id, item_id, label FROM c")
_reg("load_train_features", with_(*_LOAD, train_cands("cands"), *feature_ctes(0, "cands", base=LOAD_L),
                                  f"tf AS ({features_select('cands', True)})") + "\nSELECT * FROM tf")
_reg("load_pred_features", with_(*_LOAD, pred_cands("pcands"), *feature_ctes(1, "pcands", prefix="p_", base=LOAD_L),
                                 f"pfa AS ({features_select('pcands', False, prefix='p_')})") + "\nSELECT * FROM pfa")


# ---- further variants ----
ITEMS_FANOUT_DEDUP = ITEMS_FANOUT.replace("items AS (", "items_raw AS (", 1) + \
    ",\nitems AS (SELECT DISTINCT item_id, item_category FROM items_raw)"
# Features of pairs without history: unaligned positives, backfilled hot items.
_reg("train_features_unaligned", with_(ACTIONS, ITEMS, FLAGS, train_cands("cands", align=False), *feature_ctes(0, "cands"),
                                       f"tf AS ({features_select('cands', True)})") + "\nSELECT * FROM tf")
_reg("pred_features_backfilled", with_(
    ACTIONS, ITEMS, FLAGS, f"bf AS ({BACKFILLED})", *feature_ctes(1, "bf", prefix="p_"),
    f"pfa AS ({features_select('bf', False, prefix='p_')})") + "\nSELECT * FROM pfa")
_reg("train_features_dedup", with_(*train_features_cte("tf", ITEMS_FANOUT_DEDUP)) + "\nSELECT * FROM tf")
_reg("strategy_dispatch", with_(*PRED_BASE, *two_stage_sql("ts", "results", 5, 2)) + "\nSELECT user_id, item_id FROM ts")
_reg("threshold_strategy", with_(
    *PRED_BASE,
    "tq AS (SELECT quantile_cont(pred_prob, 0.7) AS t FROM results)",
    "thr AS (SELECT user_id, item_id FROM results WHERE pred_prob >= (SELECT t FROM tq))")
     + "\nSELECT user_id, item_id FROM thr")
_reg("train_features_no_time_gaps", with_(*train_features_cte("tf")) + """
SELECT * EXCLUDE (days_since_last_action, ui_days_since_last_action, recent_3d_actions,
                  recent_7d_actions, recent_7d_views, recent_3d_views) FROM tf""")
_reg("eval_forced_threshold", with_(*TRAIN_SCORED) + "\n" + f1_sql(
    """(SELECT count(*) FILTER (WHERE pred_prob >= 0.5) AS pred_cnt,
        CAST(coalesce(sum(label) FILTER (WHERE pred_prob >= 0.5), 0) AS BIGINT) AS tp,
        CAST(coalesce(sum(label), 0) AS BIGINT) AS true_pos, count(DISTINCT user_id) AS users FROM sc)""").replace(
    "SELECT tp, pred_cnt, true_pos,", "SELECT 'threshold' AS strategy, users, tp, pred_cnt, true_pos,", 1))
_reg("eval_forced_topn", with_(*TRAIN_SCORED, f"ss AS (SELECT * FROM sc WHERE {STRONG_COND})",
                               """sel AS (SELECT * FROM ss ORDER BY pred_prob DESC, user_id, item_id LIMIT 50)""")
     + "\n" + f1_sql(
    """(SELECT (SELECT count(*) FROM sel) AS pred_cnt,
        (SELECT CAST(coalesce(sum(label), 0) AS BIGINT) FROM sel) AS tp,
        (SELECT CAST(coalesce(sum(label), 0) AS BIGINT) FROM ss) AS true_pos,
        (SELECT count(DISTINCT user_id) FROM ss) AS users)""").replace(
    "SELECT tp, pred_cnt, true_pos,", "SELECT 'global_topn' AS strategy, users, tp, pred_cnt, true_pos,", 1))


# ---- masks rolled by a day, balanced folds, fold metrics, missing columns and scores ----
_reg("recall_flags_rolled", with_(ACTIONS, ITEMS, FLAGS) + "\nSELECT * FROM flags")
_reg("group_kfold_balanced", with_(
    *_TFC,
    f"""us AS (SELECT user_id, count(*) AS size,
    row_number() OVER (ORDER BY count(*) DESC, md5(concat_ws('_', user_id, '{SEED}')), user_id) AS n
  FROM tf GROUP BY user_id)""",
    """deal AS (
  SELECT CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS user_id, CAST(NULL AS INTEGER) AS fold, [0, 0, 0, 0, 0]::BIGINT[] AS load
  UNION ALL
  SELECT u.n, u.user_id, list_position(d.load, list_min(d.load)) - 1,
         list_transform(d.load, lambda x, i: CASE WHEN i = list_position(d.load, list_min(d.load)) THEN x + u.size ELSE x END)
  FROM deal d JOIN us u ON u.n = d.n + 1)""").replace("WITH ", "WITH RECURSIVE ", 1) + """
SELECT tf.user_id, item_id, label, CAST(fold AS INTEGER) AS fold FROM tf JOIN deal USING (user_id)""")
_reg("fold_report", with_(
    *TRAIN_SCORED,
    f"""fr AS (SELECT *, CAST(CAST('0x' || substr(md5(concat_ws('_', user_id, '{SEED}')), 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold,
    row_number() OVER (PARTITION BY user_id ORDER BY pred_prob DESC, item_id) AS rn FROM sc)""",
    """fu AS (SELECT fold, user_id, sum(label) AS npos, coalesce(sum(label) FILTER (WHERE rn <= 5), 0) AS hits
  FROM fr GROUP BY fold, user_id)""",
    """fm AS (SELECT fold, avg(hits / 5.0::DOUBLE) AS precision, avg(CASE WHEN npos > 0 THEN hits / npos::DOUBLE ELSE 0 END) AS recall
  FROM fu GROUP BY fold)""",
    """fc AS (SELECT fold, pred_prob, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
  FROM fr GROUP BY fold, pred_prob)""",
    """fb AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY pred_prob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM fc)""",
    """fa AS (SELECT fold, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
    THEN sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) END AS auc FROM fb GROUP BY fold)""") + """
SELECT fold, round(auc, 9) AS auc, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 9) AS f1
FROM fa JOIN fm USING (fold)""")
_reg("strong_pairs_missing_columns", with_(*PRED_BASE) + """
SELECT DISTINCT user_id, item_id FROM pfa
WHERE coalesce(ui_cart_count, 0) > 0 OR coalesce(ui_days_since_last_action, 0) <= 3 OR coalesce(ui_purchase_count, 0) > 0""")
_reg("cap_submission_unscored", with_(*PRED_BASE, *two_stage_sql("ts", "results", 5, 1),
                                      "kept AS (SELECT * FROM results WHERE pred_prob >= 0.6)") + f"""
SELECT t.user_id, t.item_id FROM ts t LEFT JOIN kept r ON r.user_id = t.user_id AND r.item_id = t.item_id
ORDER BY coalesce(r.pred_prob, 0) DESC, t.user_id, t.item_id LIMIT {SUBMISSION_CAP_UNSCORED}""")
