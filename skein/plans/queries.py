"""Registered queries over the driver's tables and their DuckDB oracle SQL.

Every query reads whole tables (or data Spark derives from them); integral outputs are
BIGINT and fractional outputs DOUBLE rounded to 4 places (2 for money) on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import asof as AS
from skein.operators import joins as J
from skein.operators import running as RN
from skein.operators import windows as W
from skein.plans.testdata import MATCHES_SQL, long, matches, table
from skein.session import stored_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def r4(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


def r4up(c):
    """``r4`` with ties moved up on both engines, so that the last bit of a mean cannot decide.

    ``round`` makes a decimal number of every value. Away from a tie the nearest whole number of
    ten thousandths is the same one, and its division gives the same double; a zero keeps ``round``
    (which drops its sign), as do places near a tie, large numbers, infinities and NaN."""
    return r4double(F.col(c).cast("double") + 1e-9)


def r4double(x):
    """``r4`` of a double; a decimal number is made near ties only (see ``r4up``)."""
    y = x * 10000.0
    near = F.rint(y)
    plain = (F.abs(y) < 1e9) & (F.abs(y - near) < 0.4999) & (near != 0.0)
    return F.when(plain, near / 10000.0).otherwise(F.round(x, 4))


LONG_ORDER = ["event_date", "fight_url", "fighter_url"]
W_LONG = "WINDOW w AS (PARTITION BY fighter_url ORDER BY event_date, fight_url ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

STATUS_CATS = ["f", "o", "p"]
PRIORITY_CATS = ["1-urgent", "2-high", "3-medium", "4-not_specified", "5-low"]


def _sql_label(col: str) -> str:
    return f"replace(replace(trim(lower(coalesce({col}, ''))), ' ', '_'), '''', '')"


def _sql_dummies(col: str, cats, w: str = "w") -> str:
    return ",\n".join(
        f"CAST(sum(CASE WHEN {_sql_label(col)} = '{c}' THEN 1 ELSE 0 END) OVER {w} AS BIGINT) AS \"total_{c}\"" for c in cats
    )


def _orders_joined(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).join(J.bounded_dim(n), F.col("c_nationkey") == n["n_nationkey"])


# ---------------------------------------------------------------- flagship: career_latest

_CAREER_LATEST_SQL = f"""
WITH j AS (SELECT o.o_custkey, o.o_orderkey, o.o_orderdate, o.o_orderstatus, o.o_orderpriority, o.o_totalprice,
                  c.c_name, n.n_name
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
t AS (SELECT *,
  {_sql_dummies('o_orderstatus', STATUS_CATS)},
  {_sql_dummies('o_orderpriority', PRIORITY_CATS)},
  sum(coalesce(o_totalprice, 0)) OVER w AS tp,
  CAST(row_number() OVER w AS BIGINT) AS total_orders
  FROM j WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
      FROM t WHERE o_orderdate IS NOT NULL AND o_custkey IS NOT NULL)
SELECT o_custkey, c_name, n_name, o_orderkey, o_orderdate,
       {", ".join(f'"total_{c}"' for c in STATUS_CATS + PRIORITY_CATS)},
       round(tp, 2) AS total_o_totalprice, total_orders
FROM r WHERE rn = 1
"""


@query("career_latest", _CAREER_LATEST_SQL)
def career_latest(spark, d, strategy=None):
    """J4 + C15 + W4 + W5: latest running totals per customer."""
    df = _orders_joined(spark, d)
    tot = W.career_totals(
        df, "o_custkey", ["o_orderdate", "o_orderkey"], dummy_cols=["o_orderstatus", "o_orderpriority"],
        numerical_cols=["o_totalprice"], row_count_col="total_orders",
        categories={"o_orderstatus": STATUS_CATS, "o_orderpriority": PRIORITY_CATS}, strategy=strategy,
    )
    latest = W.latest_per_entity(tot, "o_custkey", "o_orderdate", ties=["o_orderkey"])
    return latest.select(
        "o_custkey", "c_name", "n_name", "o_orderkey", "o_orderdate",
        *[f"total_{c}" for c in STATUS_CATS + PRIORITY_CATS],
        F.round("total_o_totalprice", 2).alias("total_o_totalprice"),
        "total_orders",
    )


# ---------------------------------------------------------------- W1-W3


@query("dummy_totals", f"""
SELECT o_orderkey, o_custkey, {_sql_dummies('o_orderstatus', STATUS_CATS)}
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def dummy_totals(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    out = W.dummy_totals(o, "o_orderstatus", "o_custkey", ["o_orderdate", "o_orderkey"])
    return out.select("o_orderkey", "o_custkey", *[f"total_{c}" for c in STATUS_CATS])


@query("dummy_totals_priority", f"""
SELECT o_orderkey, o_custkey, {_sql_dummies('o_orderpriority', PRIORITY_CATS)}
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def dummy_totals_priority(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    out = W.dummy_totals(o, "o_orderpriority", "o_custkey", ["o_orderdate", "o_orderkey"])
    return out.select("o_orderkey", "o_custkey", *[f"total_{c}" for c in PRIORITY_CATS])


_NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_EVENT_TEXT_SQL = (
    "CASE WHEN event_type = 'error' THEN json_extract_string(props, '$.k') || 'x' "
    "ELSE json_extract_string(props, '$.k') END"
)


@query("category_totals", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS category,
  count(*) OVER (PARTITION BY o_orderstatus, o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
FROM orders
""")
def category_totals(spark, d):
    """W1 in long form: thousands of labels (customers) within three hot entities (statuses)."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", F.col("o_custkey").cast("string").alias("cust"))
    out = W.category_totals(o, "cust", "o_orderstatus", ["o_orderdate", "o_orderkey"])
    return out.select("o_orderkey", "category", "total")


def _event_text(spark, d):
    ev = table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    return ev.withColumn("v", F.when(F.col("event_type") == "error", F.concat(k, F.lit("x"))).otherwise(k))


@query("numeric_totals", f"""
WITH e AS (SELECT event_id, user_id, ts, {_EVENT_TEXT_SQL} AS s FROM events),
c AS (SELECT *, coalesce(CASE WHEN regexp_matches(s, '{_NUM_RE}') THEN TRY_CAST(trim(s) AS DOUBLE) END, 0.0) AS v FROM e)
SELECT event_id, user_id, v, sum(v) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total_v
FROM c
""")
def numeric_totals(spark, d):
    """W2 + C13: lenient numeric coercion (junk -> 0) and its running sum."""
    ev = _event_text(spark, d).select("event_id", "user_id", "ts", "v")
    out = W.numeric_totals(ev, "v", "user_id", ["ts", "event_id"])
    return out.select("event_id", "user_id", F.col("v").cast("double").alias("v"), F.col("total_v").cast("double").alias("total_v"))


@query("row_count", """
SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS row_count
FROM events
""")
def row_count(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "ts")
    return W.row_count(ev, "user_id", ["ts", "event_id"]).select("event_id", "user_id", "row_count")


@query("latest_per_entity", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
  FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL) WHERE rn = 1
""")
def latest_per_entity(spark, d):
    """W5 + P4."""
    return W.latest_per_entity(table(spark, d, "events"), "user_id", "ts", ties=["event_id"])


# ---------------------------------------------------------------- P1 / U1


@query("wide_to_long", f"""
WITH {MATCHES_SQL}
SELECT fight_url, event_url, event_date, fighter_url, result, time_seconds, method, role, opp_url FROM lg
""")
def wide_to_long_q(spark, d):
    return long(spark, d)


@query("union_rows", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, CAST(NULL AS INTEGER) AS nation FROM customer
UNION ALL
SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE), s_nationkey FROM supplier
""")
def union_rows(spark, d):
    from skein.operators.reshape import union_rows as U

    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return U(c, s)


# ---------------------------------------------------------------- W6-W10


@query("stats_after", f"""
WITH {MATCHES_SQL}
SELECT fight_url, fighter_url,
  CAST(count(*) OVER w AS BIGINT) AS total_fights_after,
  CAST(sum(CASE WHEN result = 'Win' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS cumulative_wins_after,
  CAST(sum(CASE WHEN result = 'Loss' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS cumulative_losses_after,
  round(sum(CASE WHEN result = 'Win' THEN 1 ELSE 0 END) OVER w / count(*) OVER w, 4) AS win_rate_after,
  round(avg(time_seconds) OVER w, 4) AS avg_time_seconds_after
FROM lg {W_LONG}
""")
def stats_after(spark, d):
    out = W.results_own_stats(long(spark, d), "fighter_url", LONG_ORDER, incoming=False, rolling=False, time_diffs=False)
    return out.select("fight_url", "fighter_url", "total_fights_after", "cumulative_wins_after",
                      "cumulative_losses_after", r4("win_rate_after").alias("win_rate_after"),
                      r4("avg_time_seconds_after").alias("avg_time_seconds_after"))


_W_IN = ("WINDOW w AS (PARTITION BY fighter_url ORDER BY event_date, fight_url "
         "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")


@query("stats_incoming", f"""
WITH {MATCHES_SQL}, s AS (
SELECT fight_url, fighter_url,
  CAST(count(*) OVER w AS BIGINT) AS total_fights_in,
  CAST(coalesce(sum(CASE WHEN result = 'Win' THEN 1 ELSE 0 END) OVER w, 0) AS BIGINT) AS cumulative_wins_in,
  CAST(coalesce(sum(CASE WHEN result = 'Loss' THEN 1 ELSE 0 END) OVER w, 0) AS BIGINT) AS cumulative_losses_in,
  avg(time_seconds) OVER w AS avg_time_seconds_in
FROM lg {_W_IN})
SELECT fight_url, fighter_url, total_fights_in, cumulative_wins_in, cumulative_losses_in,
  round(CASE WHEN total_fights_in > 0 THEN cumulative_wins_in / total_fights_in END, 4) AS win_rate_in,
  round(avg_time_seconds_in, 4) AS avg_time_seconds_in
FROM s
""")
def stats_incoming(spark, d):
    out = W.results_own_stats(long(spark, d), "fighter_url", LONG_ORDER, after=False, rolling=False, time_diffs=False)
    return out.select("fight_url", "fighter_url", "total_fights_in", "cumulative_wins_in", "cumulative_losses_in",
                      r4("win_rate_in").alias("win_rate_in"), r4("avg_time_seconds_in").alias("avg_time_seconds_in"))


def _rolling_sql(incoming: bool) -> str:
    parts = []
    for w in (3, 5):
        frame = f"{w} PRECEDING AND 1 PRECEDING" if incoming else f"{w - 1} PRECEDING AND CURRENT ROW"
        sfx = "_in" if incoming else ""
        spec = f"(PARTITION BY fighter_url ORDER BY event_date, fight_url ROWS BETWEEN {frame})"
        win = "CASE WHEN result = 'Win' THEN 1 ELSE 0 END"
        parts.append(f"CAST(sum({win}) OVER {spec} AS BIGINT) AS rolling_{w}_wins{sfx}")
        parts.append(f"CAST(count({win}) OVER {spec} AS BIGINT) AS rolling_{w}_fights{sfx}")
        parts.append(
            f"round(CASE WHEN count({win}) OVER {spec} > 0 THEN sum({win}) OVER {spec} / count({win}) OVER {spec} END, 4)"
            f" AS rolling_{w}_win_rate{sfx}"
        )
        parts.append(f"round(avg(time_seconds) OVER {spec}, 4) AS rolling_{w}_avg_time{sfx}")
    return f"WITH {MATCHES_SQL}\nSELECT fight_url, fighter_url,\n  " + ",\n  ".join(parts) + "\nFROM lg"


def _rolling_cols(incoming: bool):
    sfx = "_in" if incoming else ""
    cols = ["fight_url", "fighter_url"]
    for w in (3, 5):
        cols += [
            F.col(f"rolling_{w}_wins{sfx}").cast("bigint").alias(f"rolling_{w}_wins{sfx}"),
            F.col(f"rolling_{w}_fights{sfx}").cast("bigint").alias(f"rolling_{w}_fights{sfx}"),
            r4(f"rolling_{w}_win_rate{sfx}").alias(f"rolling_{w}_win_rate{sfx}"),
            r4(f"rolling_{w}_avg_time{sfx}").alias(f"rolling_{w}_avg_time{sfx}"),
        ]
    return cols


@query("rolling_after_3_5", _rolling_sql(False))
def rolling_after(spark, d):
    out = W.results_own_stats(long(spark, d), "fighter_url", LONG_ORDER, after=False, incoming=False, time_diffs=False)
    return out.select(*_rolling_cols(False))


@query("rolling_incoming_3_5", _rolling_sql(True))
def rolling_incoming(spark, d):
    out = W.results_own_stats(long(spark, d), "fighter_url", LONG_ORDER, after=False, incoming=False, time_diffs=False)
    return out.select(*_rolling_cols(True))


@query("time_differences", """
SELECT o_orderkey, o_custkey,
  CAST(floor((epoch_us(o_orderdate) - epoch_us(min(o_orderdate) OVER w)) / 86400000000) AS BIGINT) AS time_since_first_fight,
  CAST(floor((epoch_us(o_orderdate) - epoch_us(lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)))
             / 86400000000) AS BIGINT) AS time_since_last_fight
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def time_differences(spark, d):
    """W10 + C18."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = W.time_differences(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate")
    return out.select("o_orderkey", "o_custkey", "time_since_first_fight", "time_since_last_fight")


# ---------------------------------------------------------------- J5 / J6


def _purchases_views(spark, d):
    ev = table(spark, d, "events")
    p = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    v = ev.where(F.col("event_type") == "view").select(
        "user_id", "ts", F.col("event_id").alias("view_id"), F.col("value").alias("view_value")
    )
    return p, v


_PV_SQL = """
p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts, event_id AS view_id, value AS view_value FROM events WHERE event_type = 'view')
"""


@query("asof_backward", f"""
WITH {_PV_SQL}
SELECT p.event_id, p.user_id, p.ts, p.value, v.view_id, v.view_value
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts
""")
def asof_backward(spark, d):
    """Last view at or before each purchase of the same user."""
    p, v = _purchases_views(spark, d)
    return AS.asof_join(p, v, on="ts", by="user_id", payload=["view_id", "view_value"], direction="backward",
                        right_ties=["view_id"])


@query("asof_forward", f"""
WITH {_PV_SQL}
SELECT p.event_id, p.user_id, p.ts, p.value, v.view_id, v.view_value
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts <= v.ts
""")
def asof_forward(spark, d):
    """First view at or after each purchase of the same user."""
    p, v = _purchases_views(spark, d)
    return AS.asof_join(p, v, on="ts", by="user_id", payload=["view_id", "view_value"], direction="forward",
                        right_ties=["view_id"])


# ---------------------------------------------------------------- W11 / W12 / J8 (opponents)

from skein.operators import aggregate as AG  # noqa: E402
from skein.operators import opponent as OP  # noqa: E402
from skein.operators import profile as PR  # noqa: E402
from skein.operators import reshape as RS  # noqa: E402
from skein.functions import scalars as S  # noqa: E402

_OWN_SQL = f"""
{MATCHES_SQL},
x AS (SELECT *, CASE WHEN result = 'Win' THEN 1 ELSE 0 END AS win, CASE WHEN result = 'Loss' THEN 1 ELSE 0 END AS loss FROM lg),
own AS (SELECT fight_url, fighter_url, opp_url, event_date,
          count(*) OVER wi AS n_in,
          coalesce(sum(win) OVER wi, 0) AS wins_in, coalesce(sum(loss) OVER wi, 0) AS losses_in,
          sum(win) OVER wa AS wins_after, sum(loss) OVER wa AS losses_after
        FROM x
        WINDOW wa AS (PARTITION BY fighter_url ORDER BY event_date, fight_url ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               wi AS (PARTITION BY fighter_url ORDER BY event_date, fight_url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
src AS (SELECT fighter_url AS k, event_date AS d, fight_url AS m,
          CASE WHEN n_in > 0 THEN wins_in END AS wi, CASE WHEN n_in > 0 THEN losses_in END AS li,
          wins_after AS wa, losses_after AS la FROM own),
bk AS (SELECT * FROM (SELECT l.fight_url, l.fighter_url, s.wi, s.li,
          row_number() OVER (PARTITION BY l.fight_url, l.fighter_url ORDER BY s.d DESC NULLS LAST, s.m DESC NULLS LAST) AS rn
        FROM own l LEFT JOIN src s ON s.k = l.opp_url AND s.d <= l.event_date) WHERE rn = 1),
fw AS (SELECT * FROM (SELECT l.fight_url, l.fighter_url, s.wa, s.la,
          row_number() OVER (PARTITION BY l.fight_url, l.fighter_url ORDER BY s.d ASC NULLS LAST, s.m ASC NULLS LAST) AS rn
        FROM own l LEFT JOIN src s ON s.k = l.opp_url AND s.d >= l.event_date) WHERE rn = 1),
oa AS (SELECT o.fight_url, o.fighter_url, o.event_date,
           CAST(bk.wi AS BIGINT) AS opp_cumulative_wins_in, CAST(bk.li AS BIGINT) AS opp_cumulative_losses_in,
           CAST(fw.wa AS BIGINT) AS opp_cumulative_wins_after, CAST(fw.la AS BIGINT) AS opp_cumulative_losses_after
         FROM own o JOIN bk USING (fight_url, fighter_url) JOIN fw USING (fight_url, fighter_url))
"""

_OPP_COLS = ["opp_cumulative_wins_in", "opp_cumulative_losses_in", "opp_cumulative_wins_after", "opp_cumulative_losses_after"]


def _own(spark, d, strategy=None):
    return W.results_own_stats(long(spark, d), "fighter_url", LONG_ORDER, rolling=False, time_diffs=False, strategy=strategy)


@query("opponent_asof", f"""
WITH {_OWN_SQL}
SELECT fight_url, fighter_url, {", ".join(_OPP_COLS)} FROM oa
""")
def opponent_asof(spark, d, strategy=None):
    """W11 (as-of lookups, backward for incoming and forward for after)."""
    out = OP.opponent_records(_own(spark, d, strategy), on="asof", strategy=strategy)
    return out.select("fight_url", "fighter_url", *[F.col(c).cast("bigint").alias(c) for c in _OPP_COLS])


@query("opponent_match", f"""
WITH {_OWN_SQL}
SELECT o.fight_url, o.fighter_url,
  CAST(s.wi AS BIGINT) AS opp_cumulative_wins_in, CAST(s.li AS BIGINT) AS opp_cumulative_losses_in,
  CAST(s.wa AS BIGINT) AS opp_cumulative_wins_after, CAST(s.la AS BIGINT) AS opp_cumulative_losses_after
FROM own o LEFT JOIN src s ON s.k = o.opp_url AND s.m = o.fight_url
""")
def opponent_match(spark, d):
    """W11 with ``on='match'``: the opponent's own row of the same match."""
    out = OP.opponent_records(_own(spark, d), on="match")
    return out.select("fight_url", "fighter_url", *[F.col(c).cast("bigint").alias(c) for c in _OPP_COLS])


@query("opponent_totals", f"""
WITH {_OWN_SQL}
SELECT fight_url, fighter_url,
  {", ".join(f"CAST(sum(coalesce({c}, 0)) OVER w AS BIGINT) AS total_{c}" for c in _OPP_COLS)}
FROM oa {W_LONG}
""")
def opponent_totals(spark, d):
    """Running sums of the opponents' records over own matches."""
    out = OP.opponent_totals(OP.opponent_records(_own(spark, d), on="asof"), "fighter_url", LONG_ORDER)
    return out.select("fight_url", "fighter_url", *[F.col(f"total_{c}").cast("bigint").alias(f"total_{c}") for c in _OPP_COLS])


@query("opponent_swap", f"""
WITH {MATCHES_SQL},
r AS (SELECT fight_url, fighter_url, row_number() OVER (PARTITION BY fight_url ORDER BY fighter_url) AS rn,
             count(*) OVER (PARTITION BY fight_url) AS cnt FROM lg)
SELECT a.fight_url, a.fighter_url, b.fighter_url AS opp_url
FROM r a LEFT JOIN r b ON a.fight_url = b.fight_url AND b.rn = a.cnt + 1 - a.rn
""")
def opponent_swap(spark, d):
    """Opponent by reversing each match's participant list."""
    lg = long(spark, d).select("fight_url", "fighter_url")
    return OP.opponent_by_reversal(lg, "fight_url", "fighter_url", order=["fighter_url"])


# ---------------------------------------------------------------- A1 / A2 and W13-W16 (rounds)


def _round_exprs():
    """Statistic columns of a round, made from a line item by the same text on both engines."""
    cols = {"kd": "l_quantity", "ctrl_seconds": "floor(l_discount * 100) * 10"}
    for i, s in enumerate(AG.FRACTION_STATS):
        landed = f"(l_partkey * {i + 3} + l_linenumber) % 17"
        cols[f"{s}_landed"] = f"CASE WHEN l_linenumber = {i + 2} THEN NULL ELSE CAST({landed} AS DOUBLE) END"
        cols[f"{s}_attempted"] = f"CAST(({landed}) + (l_suppkey + {i}) % 5 AS DOUBLE)"
    return cols


def _rounds_view(spark, d, by_match=False):
    """``by_match`` deals the line items by match while they are narrow: rolled up, a row is five
    times as wide, and both the roll-up and the join of the matches' dates find them there."""
    li = table(spark, d, "lineitem")
    if by_match:
        li = li.select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_returnflag").repartition("l_orderkey")
    return li.select(
        F.col("l_orderkey").alias("fight_url"),
        F.col("l_suppkey").alias("fighter"),
        F.col("l_linenumber").alias("round"),
        F.col("l_partkey").alias("part"),
        *[F.expr(e).cast("double").alias(c) for c, e in _round_exprs().items()],
        F.col("l_returnflag").alias("flag"),
    )


_ROUND_SUMS = list(_round_exprs())
_ROUND_ACCURACY = [f"{s.split('_')[0]}_accuracy" for s in AG.FRACTION_STATS]
_ROUNDS_SQL = f"""
rv AS (SELECT l_orderkey AS fight_url, l_suppkey AS fighter, l_linenumber AS round, l_partkey AS part,
              {", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in _round_exprs().items())}, l_returnflag AS flag
       FROM lineitem),
fa AS (SELECT fight_url, fighter, max(round) AS round, {", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in _ROUND_SUMS)},
              arg_min(flag, round * 1000000 + part) FILTER (WHERE flag IS NOT NULL) AS flag
       FROM rv WHERE fight_url IS NOT NULL AND fighter IS NOT NULL GROUP BY fight_url, fighter),
fac AS (SELECT *, {", ".join(f"CASE WHEN {s}_attempted > 0 THEN {s}_landed / {s}_attempted END AS {a}" for s, a in zip(AG.FRACTION_STATS, _ROUND_ACCURACY))} FROM fa),
fd AS (SELECT fac.*, o_orderdate AS event_date FROM fac JOIN orders ON fight_url = o_orderkey)
"""

_FIGHT_METRICS = ["round", *_ROUND_SUMS, *_ROUND_ACCURACY]


def _fights(spark, d):
    """The per-match table without its accuracies, which need a row's own columns only."""
    fa = AG.aggregate_rounds(_rounds_view(spark, d, by_match=True), order_col=["round", "part"]).drop("part")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("fight_url"), F.col("o_orderdate").alias("event_date"))
    return fa.join(o, "fight_url")


@query("rounds_to_fight", f"""
WITH {_ROUNDS_SQL}
SELECT fight_url, fighter, CAST(round AS BIGINT) AS round, {", ".join(f"round({c}, 4) AS {c}" for c in _ROUND_SUMS)}, flag FROM fa
""")
def rounds_to_fight(spark, d):
    """A1: rounds -> one row per (match, participant)."""
    fa = AG.aggregate_rounds(_rounds_view(spark, d), order_col=["round", "part"])
    return fa.select("fight_url", "fighter", F.col("round").cast("bigint").alias("round"), *[r4(c).alias(c) for c in _ROUND_SUMS], "flag")


@query("accuracy", f"""
WITH {_ROUNDS_SQL}
SELECT fight_url, fighter, {", ".join(f"round({a}, 4) AS {a}" for a in _ROUND_ACCURACY)} FROM fac
""")
def accuracy(spark, d):
    """A2: landed / attempted when attempted > 0, for all nine pairs."""
    fa = AG.accuracy(AG.aggregate_rounds(_rounds_view(spark, d), order_col=["round", "part"]))
    return fa.select("fight_url", "fighter", *[r4(a).alias(a) for a in _ROUND_ACCURACY])


_W_F = "(PARTITION BY fighter ORDER BY event_date, fight_url ROWS BETWEEN {})"


def _metric_cum_sql():
    parts = []
    for m in _FIGHT_METRICS:
        cur = _W_F.format("UNBOUNDED PRECEDING AND CURRENT ROW")
        inn = _W_F.format("UNBOUNDED PRECEDING AND 1 PRECEDING")
        parts += [
            f"round(CASE WHEN {m} IS NOT NULL THEN sum({m}) OVER {cur} END + 1e-9, 4) AS cum_{m}_current",
            f"round(CASE WHEN {m} IS NOT NULL THEN sum({m}) OVER {cur} END / (fight_order + 1) + 1e-9, 4) AS avg_{m}_current",
            f"round(coalesce(sum({m}) OVER {inn}, 0) + 1e-9, 4) AS cum_{m}_in",
            f"round(CASE WHEN fight_order > 0 THEN coalesce(sum({m}) OVER {inn}, 0) / fight_order END + 1e-9, 4) AS avg_{m}_in",
        ]
    return (f"WITH {_ROUNDS_SQL}, fo AS (SELECT *, row_number() OVER (PARTITION BY fighter ORDER BY event_date, fight_url) - 1 "
            f"AS fight_order FROM fd)\nSELECT fight_url, fighter, " + ",\n".join(parts) + " FROM fo")


def _metric_stats(spark, d, strategy=None):
    return W.metric_stats(stored_table(_fights(spark, d), "fights"), "fighter", ["event_date", "fight_url", "fighter"], _FIGHT_METRICS, strategy=strategy, late=AG.accuracy)


@query("metric_cumulative", _metric_cum_sql())
def metric_cumulative(spark, d):
    """Cumulative current / incoming per metric with averages."""
    out = _metric_stats(spark, d)
    cols = []
    for m in _FIGHT_METRICS:
        cols += [f"cum_{m}_current", f"avg_{m}_current", f"cum_{m}_in", f"avg_{m}_in"]
    return out.select("fight_url", "fighter", *[r4up(c).alias(c) for c in cols])


def _metric_roll_sql():
    parts = []
    for w in (3, 5):
        spec = _W_F.format(f"{w} PRECEDING AND 1 PRECEDING")
        for m in _FIGHT_METRICS:
            parts += [f"round(sum({m}) OVER {spec} + 1e-9, 4) AS rolling_{w}_{m}_in",
                      f"round(avg({m}) OVER {spec} + 1e-9, 4) AS rolling_{w}_avg_{m}_in"]
        parts.append(f"CAST(count(*) OVER {spec} AS BIGINT) AS rolling_{w}_fights_in")
    return f"WITH {_ROUNDS_SQL}\nSELECT fight_url, fighter, " + ",\n".join(parts) + " FROM fd"


@query("metric_rolling", _metric_roll_sql())
def metric_rolling(spark, d, strategy=None):
    """Rolling incoming sums, means and counts per metric."""
    out = _metric_stats(spark, d, strategy)
    cols = []
    for w in (3, 5):
        for m in _FIGHT_METRICS:
            cols += [r4up(f"rolling_{w}_{m}_in").alias(f"rolling_{w}_{m}_in"), r4up(f"rolling_{w}_avg_{m}_in").alias(f"rolling_{w}_avg_{m}_in")]
        cols.append(f"rolling_{w}_fights_in")
    return out.select("fight_url", "fighter", *cols)


@query("fight_order", f"""
WITH {_ROUNDS_SQL}
SELECT fight_url, fighter, CAST(row_number() OVER (PARTITION BY fighter ORDER BY event_date, fight_url) - 1 AS BIGINT) AS fight_order
FROM fd
""")
def fight_order(spark, d):
    """0-based order of each participant's matches."""
    return _metric_stats(spark, d).select("fight_url", "fighter", "fight_order")


def _opp_metric_sql():
    metrics = _FIGHT_METRICS
    cur = _W_F.format("UNBOUNDED PRECEDING AND CURRENT ROW")
    inn = _W_F.format("UNBOUNDED PRECEDING AND 1 PRECEDING")
    stat_cols = []
    for m in metrics:
        stat_cols += [
            f"coalesce(sum({m}) OVER {inn}, 0) AS cum_{m}_in",
            f"CASE WHEN fight_order > 0 THEN coalesce(sum({m}) OVER {inn}, 0) / fight_order END AS avg_{m}_in",
            f"CASE WHEN {m} IS NOT NULL THEN sum({m}) OVER {cur} END AS cum_{m}_current",
            f"CASE WHEN {m} IS NOT NULL THEN sum({m}) OVER {cur} END / (fight_order + 1) AS avg_{m}_current",
        ]
    in_names = [f"cum_{m}_in" for m in metrics] + [f"avg_{m}_in" for m in metrics]
    cur_names = [f"cum_{m}_current" for m in metrics] + [f"avg_{m}_current" for m in metrics]
    return f"""
WITH {_ROUNDS_SQL},
fo AS (SELECT *, row_number() OVER (PARTITION BY fighter ORDER BY event_date, fight_url) - 1 AS fight_order FROM fd),
st AS (SELECT fight_url, fighter, event_date, fight_order, {", ".join(stat_cols)} FROM fo),
rk AS (SELECT fight_url, fighter, row_number() OVER (PARTITION BY fight_url ORDER BY fighter) AS rn,
              count(*) OVER (PARTITION BY fight_url) AS cnt FROM st),
op AS (SELECT a.fight_url, a.fighter, b.fighter AS opp_url FROM rk a LEFT JOIN rk b
       ON a.fight_url = b.fight_url AND b.rn = a.cnt + 1 - a.rn),
l AS (SELECT st.fight_url, st.fighter, st.event_date, op.opp_url FROM st JOIN op USING (fight_url, fighter)),
bk AS (SELECT * FROM (SELECT l.fight_url, l.fighter, {", ".join(f"s.{c}" for c in in_names)},
          row_number() OVER (PARTITION BY l.fight_url, l.fighter ORDER BY s.event_date DESC NULLS LAST, s.fight_url DESC NULLS LAST) AS rn
        FROM l LEFT JOIN st s ON s.fighter = l.opp_url AND s.event_date <= l.event_date) WHERE rn = 1),
fw AS (SELECT * FROM (SELECT l.fight_url, l.fighter, {", ".join(f"s.{c}" for c in cur_names)},
          row_number() OVER (PARTITION BY l.fight_url, l.fighter ORDER BY s.event_date ASC NULLS LAST, s.fight_url ASC NULLS LAST) AS rn
        FROM l LEFT JOIN st s ON s.fighter = l.opp_url AND s.event_date >= l.event_date) WHERE rn = 1)
SELECT bk.fight_url, bk.fighter AS fighter_url, l.opp_url,
  {", ".join(f"round(bk.{c} + 1e-9, 4) AS opp_{c}" for c in in_names)},
  {", ".join(f"round(fw.{c} + 1e-9, 4) AS opp_{c}" for c in cur_names)}
FROM bk JOIN fw USING (fight_url, fighter) JOIN l USING (fight_url, fighter)
"""


@query("opponent_metrics", _opp_metric_sql())
def opponent_metrics(spark, d):
    """J8 + W16: opponent per-metric cumulative stats via as-of lookups."""
    fights = _fights(spark, d)
    fights = stored_table(OP.opponent_by_reversal(fights, "fight_url", "fighter", order=["fighter"]), "fights")
    st = W.metric_stats(fights, "fighter", ["event_date", "fight_url", "fighter"], _FIGHT_METRICS, windows=(), late=AG.accuracy)  # no rolling column is asked for
    out = OP.opponent_metrics(st, _FIGHT_METRICS, entity_col="fighter", materialize=True, keep=["fight_url", "fighter", "opp_url"])
    names = [f"opp_cum_{m}_in" for m in _FIGHT_METRICS] + [f"opp_avg_{m}_in" for m in _FIGHT_METRICS]
    names += [f"opp_cum_{m}_current" for m in _FIGHT_METRICS] + [f"opp_avg_{m}_current" for m in _FIGHT_METRICS]
    return out.select("fight_url", F.col("fighter").alias("fighter_url"), "opp_url", *[r4up(c).alias(c) for c in names])


@query("synthetic_date", """
SELECT o_orderkey, strftime(DATE '1970-01-01' + CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS INTEGER), '%Y-%m-%d') AS event_date
FROM orders
""")
def synthetic_date(spark, d):
    """1970-01-01 + row index (days) over a total order."""
    o = table(spark, d, "orders").select("o_orderkey")
    out = W.synthetic_dates(o, ["o_orderkey"])
    return out.select("o_orderkey", F.date_format("event_date", "yyyy-MM-dd").alias("event_date"))


# ---------------------------------------------------------------- A3 / A4 / A7


@query("avg_interval", """
SELECT o_custkey, round(floor((epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate))) / 86400000000) / (count(o_orderdate) - 1), 4)
       AS avg_interval
FROM orders GROUP BY o_custkey HAVING count(o_orderdate) > 1
""")
def avg_interval(spark, d):
    """A3 (+P5): mean days between matches, entities with 2+ dates."""
    out = AG.avg_interval(table(spark, d, "orders"), "o_custkey", "o_orderdate")
    return out.select("o_custkey", r4("avg_interval").alias("avg_interval"))


@query("avg_interval_days", """
SELECT o_custkey, CASE WHEN count(o_orderdate) > 1 THEN
  CAST(floor((epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate))) / (count(o_orderdate) - 1) / 86400000000) AS BIGINT) END
  AS avg_interval_days
FROM orders GROUP BY o_custkey
""")
def avg_interval_days(spark, d):
    """A4: floored mean interval, NULL for a single date."""
    return AG.avg_interval_days(table(spark, d, "orders"), "o_custkey", "o_orderdate")


@query("interval_histogram", """
WITH a AS (SELECT floor((epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate))) / 86400000000) / (count(o_orderdate) - 1) AS x
           FROM orders GROUP BY o_custkey HAVING count(o_orderdate) > 1),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM a),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 40 ELSE 1.0 END AS width FROM b),
c AS (SELECT CAST(least(floor((x - lo) / width), 39) AS INTEGER) AS bin, count(*) AS n FROM a, w GROUP BY 1)
SELECT CAST(g.bin AS BIGINT) AS bin, round(lo + g.bin * width, 4) AS bin_start, round(lo + (g.bin + 1) * width, 4) AS bin_end,
       CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(40)) g CROSS JOIN w LEFT JOIN c ON c.bin = g.bin
""")
def interval_histogram(spark, d):
    """40-bin histogram of the A3 distribution."""
    h = AG.histogram(AG.avg_interval(table(spark, d, "orders"), "o_custkey", "o_orderdate"), "avg_interval", 40)
    return h.select(F.col("bin").cast("bigint").alias("bin"), r4("bin_start").alias("bin_start"),
                    r4("bin_end").alias("bin_end"), F.col("count").cast("bigint").alias("count"))


# ---------------------------------------------------------------- A8 / F1-F5 / P6


_RM_CATS = [f"{r}_{m}" for r in ("draw", "loss", "win") for m in ("decision", "knockout", "other", "submission")]
_METHOD_TYPE_SQL = ("CASE WHEN method IN ('U-DEC', 'S-DEC', 'M-DEC') THEN 'Decision' WHEN method = 'KO/TKO' THEN 'Knockout' "
                    "WHEN method = 'SUB' THEN 'Submission' ELSE 'Other' END")


def _outcome_sql():
    sums = ",\n".join(
        f"CAST(sum(CASE WHEN rm = '{c}' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS \"total_{c}\"" for c in _RM_CATS
    )
    unions = []
    for m in ("Knockout", "Submission", "Decision"):
        for outcome, word in (("wins", "win"), ("losses", "loss")):
            unions.append(f"SELECT fighter_url, '{m}' AS method, '{outcome}' AS outcome, "
                          f"CAST(coalesce(\"total_{word}_{m.lower()}\", 0) AS BIGINT) AS n FROM r WHERE rn = 1")
    return f"""
WITH {MATCHES_SQL},
x AS (SELECT *, lower(result) || '_' || lower({_METHOD_TYPE_SQL}) AS rm FROM lg),
t AS (SELECT fighter_url, event_date, fight_url, {sums} FROM x {W_LONG}),
r AS (SELECT *, row_number() OVER (PARTITION BY fighter_url ORDER BY event_date DESC, fight_url) AS rn FROM t)
""" + "\nUNION ALL\n".join(unions)


@query("outcome_matrix", _outcome_sql())
def outcome_matrix(spark, d):
    """C8 + C16 + W1 + W5 + A8: wins/losses by method from each participant's latest totals."""
    lg = long(spark, d).withColumn("method_type", S.method_type("method"))
    lg = lg.withColumn("result_method", S.composite_label("result", "method_type"))
    tot = W.career_totals(lg, "fighter_url", LONG_ORDER, dummy_cols=["result_method"], row_count_col=None,
                          categories={"result_method": _RM_CATS})
    latest = W.latest_per_entity(tot, "fighter_url", "event_date", ties=["fight_url"])
    return AG.outcome_matrix(latest, "fighter_url")


AS_OF = "2002-01-01"


def _careers(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_custkey").cast("int")).alias("date_of_birth"))
    df = o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate", "date_of_birth",
        F.when(F.col("o_orderstatus") == "F", "Win").when(F.col("o_orderstatus") == "O", "Loss").otherwise("Draw").alias("result"),
        F.floor("o_totalprice").cast("double").alias("fight_duration_seconds"),
    )
    return W.career_totals(df, "o_custkey", ["o_orderdate", "o_orderkey"], dummy_cols=["result"],
                           numerical_cols=["fight_duration_seconds"], row_count_col="total_fights",
                           categories={"result": ["draw", "loss", "win"]})


_CAREERS_SQL = """
cj AS (SELECT o_custkey, o_orderkey, o_orderdate, DATE '1950-01-01' + CAST(c_custkey AS INTEGER) AS date_of_birth,
              CASE o_orderstatus WHEN 'F' THEN 'Win' WHEN 'O' THEN 'Loss' ELSE 'Draw' END AS result,
              CAST(floor(o_totalprice) AS DOUBLE) AS fight_duration_seconds
       FROM orders JOIN customer ON o_custkey = c_custkey),
ct AS (SELECT *, sum(CASE WHEN result = 'Win' THEN 1 ELSE 0 END) OVER w AS total_win,
              sum(CASE WHEN result = 'Loss' THEN 1 ELSE 0 END) OVER w AS total_loss,
              sum(CASE WHEN result = 'Draw' THEN 1 ELSE 0 END) OVER w AS total_draw,
              sum(fight_duration_seconds) OVER w AS total_fight_duration_seconds
       FROM cj WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


def _clock_sql(x: str) -> str:
    n = f"CAST(trunc({x}) AS BIGINT)"
    days = f"CAST(floor({n} / 86400) AS BIGINT)"
    rem = f"({n} - {days} * 86400)"
    clock = (f"CAST(CAST(floor({rem} / 3600) AS BIGINT) AS VARCHAR) || ':' || "
             f"lpad(CAST(CAST(floor(({rem} % 3600) / 60) AS BIGINT) AS VARCHAR), 2, '0') || ':' || "
             f"lpad(CAST({rem} % 60 AS VARCHAR), 2, '0')")
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {days} = 0 THEN {clock} ELSE CAST({days} AS VARCHAR) || "
            f"CASE WHEN abs({days}) = 1 THEN ' day, ' ELSE ' days, ' END || {clock} END")


@query("entity_profile", f"""
WITH {_CAREERS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn,
              row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nf FROM ct),
iv AS (SELECT o_custkey, CASE WHEN count(o_orderdate) > 1 THEN CAST(floor((epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate)))
              / (count(o_orderdate) - 1) / 86400000000) AS BIGINT) END AS avg_interval_days FROM orders GROUP BY o_custkey)
SELECT r.o_custkey,
  CAST(floor(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(CAST(date_of_birth AS TIMESTAMP))) / 86400000000) / 365) AS BIGINT) AS age,
  CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(o_orderdate)) / 86400000000) AS BIGINT) AS time_since_last_days,
  iv.avg_interval_days,
  CAST(total_win AS VARCHAR) || '-' || CAST(total_loss AS VARCHAR) || '-' || CAST(total_draw AS VARCHAR) AS record_wld,
  {_clock_sql('total_fight_duration_seconds')} AS total_time_display,
  strftime(o_orderdate, '%B %d, %Y') AS last_date_display,
  CAST(nf AS BIGINT) AS total_fights
FROM r LEFT JOIN iv ON iv.o_custkey = r.o_custkey
WHERE r.rn = 1
""")
def entity_profile(spark, d):
    """F1-F4 (+C19-C21): one profile row per customer as of 2002-01-01."""
    prof = PR.entity_profile(_careers(spark, d), AS_OF, entity_col="o_custkey", date_col="o_orderdate",
                             ties=("o_orderkey",), dob_col="date_of_birth")
    return prof.select("o_custkey", "age", "time_since_last_days", "avg_interval_days", "record_wld",
                       "total_time_display", "last_date_display", "total_fights")


@query("history", f"""
WITH {_CAREERS_SQL}
SELECT o_custkey, strftime(o_orderdate, '%B %d, %Y') AS o_orderdate, o_orderkey, result,
       {_clock_sql('fight_duration_seconds')} AS fight_duration
FROM ct
""")
def history(spark, d):
    """P6 + C19 + C20 + O3: per-match history rows, newest first."""
    return PR.history(_careers(spark, d), entity_col="o_custkey", columns=("o_orderdate", "o_orderkey", "result", "fight_duration"),
                      date_col="o_orderdate")


# ---------------------------------------------------------------- J1-J3, J7, D3


@query("left_dim", """
SELECT l_orderkey AS event_url, l_linenumber, l_partkey, l_suppkey, o_orderdate AS event_date, o_orderstatus AS event
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
""")
def left_dim(spark, d):
    """Left join of the event dimension, date renamed to event_date."""
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("event_url"), "l_linenumber", "l_partkey", "l_suppkey")
    ev = table(spark, d, "orders").select(F.col("o_orderkey").alias("event_url"), F.col("o_orderdate").alias("date"),
                                           F.col("o_orderstatus").alias("event"))
    return J.merge_events(li, ev)


@query("distinct_bridge", f"""
WITH {MATCHES_SQL}
SELECT l_orderkey AS fight_url, l_suppkey AS fighter, l_linenumber AS round, l_partkey AS part, b.event_url
FROM lineitem LEFT JOIN (SELECT DISTINCT fight_url, event_url FROM lg) b ON l_orderkey = b.fight_url
""")
def distinct_bridge(spark, d):
    """Left join of the distinct (match, event) bridge."""
    rv = _rounds_view(spark, d).select("fight_url", "fighter", "round", "part")
    return J.merge_results(rv, long(spark, d))


@query("dim_dedupe", f"""
WITH {MATCHES_SQL},
s AS (SELECT s_suppkey AS fighter_url, s_name, s_acctbal FROM supplier),
ds AS (SELECT DISTINCT * FROM (SELECT * FROM s UNION ALL SELECT * FROM s))
SELECT fight_url, lg.fighter_url, s_name, s_acctbal FROM lg LEFT JOIN ds ON lg.fighter_url = ds.fighter_url
""")
def dim_dedupe(spark, d):
    """J3 + A5: full-row dedupe of a duplicated dimension, then left join."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("fighter_url"), "s_name", "s_acctbal")
    return J.merge_entities(long(spark, d).select("fight_url", "fighter_url"), s.unionByName(s)).select(
        "fight_url", "fighter_url", "s_name", "s_acctbal")


def _nat_sides(spark, d):
    a = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_size")
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), "s_nationkey")
    return a, b


for _how, _sql_how in (("outer", "FULL OUTER"), ("inner", "INNER"), ("left", "LEFT"), ("right", "RIGHT")):
    def _nat(spark, d, _h=_how):
        a, b = _nat_sides(spark, d)
        return J.natural_join(a, b, _h).select("id", "p_size", "s_nationkey")

    _nat.__doc__ = f"J7: natural join on the common columns, how={_how}."
    query(f"natural_join_{_how}", f"""
WITH a AS (SELECT p_partkey AS id, p_size FROM part), b AS (SELECT s_suppkey AS id, s_nationkey FROM supplier)
SELECT id, p_size, s_nationkey FROM a {_sql_how} JOIN b USING (id)
""")(_nat)


@query("null_safe_join", """
WITH a AS (SELECT c_custkey, nullif(c_nationkey, 0) AS nk FROM customer),
b AS (SELECT nullif(n_nationkey, 0) AS nk, n_name FROM nation)
SELECT a.c_custkey, coalesce(a.nk, b.nk) AS nk, b.n_name FROM a LEFT JOIN b ON a.nk IS NOT DISTINCT FROM b.nk
""")
def null_safe_join(spark, d):
    """D3: NULL keys match each other (pandas merge semantics) with ``<=>``."""
    a = table(spark, d, "customer").select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(0)).alias("nk"))
    b = table(spark, d, "nation").select(F.nullif(F.col("n_nationkey"), F.lit(0)).alias("nk"), "n_name")
    return J.join_on(a, b, ["nk"], "left", null_safe=True).select("c_custkey", "nk", "n_name")


# ---------------------------------------------------------------- K1-K3, E6, E9, S*, O*


@query("worklist_urls", f"""
WITH {MATCHES_SQL} SELECT event_url FROM m
""")
def worklist_urls(spark, d):
    """K1: projection of the event URL column, duplicates kept."""
    return RS.event_urls(matches(spark, d))


@query("worklist_fights", f"""
WITH {MATCHES_SQL} SELECT DISTINCT fight_url FROM lg
""")
def worklist_fights(spark, d):
    """K3: distinct match URLs."""
    return RS.distinct_urls(long(spark, d), "fight_url")


@query("worklist_exploded", """
SELECT DISTINCT u AS url FROM (SELECT unnest(list(l_suppkey)) AS u FROM lineitem GROUP BY l_orderkey)
""")
def worklist_exploded(spark, d):
    """K2: distinct elements of a list column (supplier lists per order)."""
    lists = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("fighters_urls"))
    return RS.flattened_urls(lists, "fighters_urls", "url")


# Display headers of the rounds table and their normalised names.
_RAW_HEADERS = {"l_orderkey": "Fight URL", "l_suppkey": "Fighter", "l_linenumber": "Round.", "l_quantity": "Sig. str.",
                "l_discount": "Sig. str. %", "l_tax": "Td %"}


@query("normalize_headers", """
SELECT l_orderkey AS fight_url, l_suppkey AS fighter, l_linenumber AS round, l_quantity AS sig_str,
       l_discount AS sig_str_pct, l_tax AS td_pct FROM lineitem
""")
def normalize_headers(spark, d):
    """Header normalisation (lower, drop '.', space -> '_', '%' -> 'pct')."""
    li = table(spark, d, "lineitem").select(*[F.col(k).alias(v) for k, v in _RAW_HEADERS.items()])
    return RS.normalize_columns(li)


@query("validate_split", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS pr,
                  CASE WHEN o_orderstatus = 'O' THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS price FROM orders)
SELECT o_orderkey,
  CASE WHEN pr IS NULL THEN 'pr is null' WHEN TRY_CAST(price AS DOUBLE) IS NULL THEN 'price is not double' END AS _reason
FROM o
""")
def validate_split(spark, d):
    """E9 + V1: required / typed field contract -> valid rows and rejected rows with a reason."""
    from skein.operators.cleaners import validate_rows

    o = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("pr"),
        F.when(F.col("o_orderstatus") == "O", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("price"),
    )
    valid, rejected = validate_rows(o, ["o_orderkey", "pr"], {"price": "double"})
    return valid.select("o_orderkey", F.lit(None).cast("string").alias("_reason")).unionByName(
        rejected.select("o_orderkey", "_reason"))


def _scratch_path(spark, tag):
    import uuid

    from skein.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@query("json_roundtrip", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def json_roundtrip(spark, d):
    """S5 + S1: write JSON Lines to the shared folder, read back with an explicit schema."""
    from skein.sources import io

    path = _scratch_path(spark, "json")
    io.write_json(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), path)
    return io.read_json(spark, path, "o_orderkey bigint, o_orderstatus string, o_orderpriority string", multiline=False)


@query("parquet_roundtrip", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def parquet_roundtrip(spark, d):
    """S6/S7 + S3: write Parquet (partitioned) to the shared folder and read back."""
    from skein.sources import io

    path = _scratch_path(spark, "parquet")
    io.write_parquet(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), path, partition_by=["o_orderstatus"])
    return io.read_parquet(spark, path, ["o_orderkey", "o_orderstatus", "o_orderpriority"])


@query("sorted_output", f"""
WITH {MATCHES_SQL} SELECT event_url, fight_url, fighter_url, result FROM lg ORDER BY event_url, fight_url, fighter_url
""")
def sorted_output(spark, d):
    """O1: presentation sort by event, match, participant (NULLs last)."""
    return RS.sorted_output(long(spark, d).select("event_url", "fight_url", "fighter_url", "result"),
                            ["event_url", "fight_url", "fighter_url"])


@query("tail_n", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5
""")
def tail_n(spark, d):
    """Last five rows in date order (top-k; the limit is the feature)."""
    return RS.tail_rows(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 5)


# ---------------------------------------------------------------- skew: hot keys through the chunked engine



@query("hot_key_running", """
SELECT event_id, event_type,
  CAST(row_number() OVER w AS BIGINT) AS n,
  round(sum(value) OVER w, 4) AS cum_value,
  CAST(count(value) OVER wi AS BIGINT) AS n_before,
  round(sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS roll3,
  round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 4) AS roll5_in,
  lag(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev_id,
  min(ts) OVER w AS first_ts
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       wi AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def hot_key_running(spark, d):
    """Running measures over five keys holding ~20% of the rows each, forced through the
    skew-safe chunked strategy (keys span range partitions: offsets + halo rows)."""
    ev = table(spark, d, "events").select("event_id", "event_type", "ts", "value")
    ms = [RN.row_number("n"), RN.cum_sum("cum_value", "value"), RN.cum_count("n_before", "value", inclusive=False),
          RN.rows_sum("roll3", "value", -2, 0), RN.rows_avg("roll5_in", "value", -5, -1), RN.lag("prev_id", "event_id", 1),
          RN.cum_min("first_ts", "ts")]
    out = RN.running(ev, "event_type", RN.order_cols("ts", "event_id"), ms, strategy="chunked")
    return out.select("event_id", "event_type", F.col("n").cast("bigint").alias("n"), r4("cum_value").alias("cum_value"),
                      F.col("n_before").cast("bigint").alias("n_before"), r4("roll3").alias("roll3"),
                      r4("roll5_in").alias("roll5_in"), "prev_id", "first_ts")


# ---------------------------------------------------------------- E1-E9 page extraction

from skein.sources import extract as EX  # noqa: E402


@query("page_links", """
SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages
""")
def page_links(spark, d):
    """E7 pattern with a link parser: one row per anchor of every page."""
    out = EX.parsed_rows(EX.extract(table(spark, d, "pages"), "links", keep=("page_id",)))
    return out.select("page_id", "href")


@query("page_titles", """
SELECT page_id, replace(replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')
       AS title FROM pages
""")
def page_titles(spark, d):
    """E7 pattern with a title parser (character references decoded)."""
    out = EX.parsed_rows(EX.extract(table(spark, d, "pages"), "title", keep=("page_id",)))
    return out.select("page_id", "title")


@query("page_errors", """
SELECT page_id, url, 'no rows parsed' AS _error FROM pages WHERE html NOT LIKE '%b-link_style_black%'
""")
def page_errors(spark, d):
    """E7 error side output: the event-list parser finds nothing on generic pages."""
    out = EX.extract(table(spark, d, "pages"), "events", keep=("page_id",))
    return out.where(F.col("_error").isNotNull()).select("page_id", "url", "_error")


def _fighter_pages(spark, d):
    c = table(spark, d, "customer")
    dob = F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_custkey").cast("int")), "MMM d, yyyy")
    reach = F.when(F.col("c_acctbal") < 0, F.lit("--")).otherwise(F.concat((F.col("c_nationkey") + 60).cast("string"), F.lit('"')))
    height = F.concat((5 + F.col("c_nationkey") % 2).cast("string"), F.lit("' "), (F.col("c_nationkey") % 12).cast("string"), F.lit('"'))
    li = lambda label, v: F.concat(F.lit('<li class="b-list__box-list-item"><i class="b-list__box-item-title">'), F.lit(label),
                                   F.lit("</i> "), v, F.lit("</li>"))
    html = F.concat(
        F.lit('<html><body><span class="b-content__title-highlight"> '), F.col("c_name"), F.lit(" </span>"),
        F.lit('<span class="b-content__title-record">Record: '), (F.col("c_custkey") % 30).cast("string"), F.lit("-"),
        F.col("c_nationkey").cast("string"), F.lit("-0</span>"),
        F.lit('<p class="b-content__Nickname">"'), F.col("c_mktsegment"), F.lit('"</p><ul>'),
        li("Height:", height), li("Reach:", reach), li("STANCE:", F.lower("c_mktsegment")), li("DOB:", dob),
        F.lit("</ul></body></html>"),
    )
    return c.select(F.col("c_custkey").alias("page_id"), F.concat(F.lit("/fighter/"), F.col("c_custkey").cast("string")).alias("url"),
                    html.alias("html"))


@query("page_record", """
SELECT '/fighter/' || c_custkey AS url, c_name AS full_name, c_mktsegment AS nickname,
  CAST(5 + c_nationkey % 2 AS VARCHAR) || ''' ' || CAST(c_nationkey % 12 AS VARCHAR) || '"' AS height,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey + 60 AS VARCHAR) || '"' END AS reach,
  lower(c_mktsegment) AS stance,
  strftime(DATE '1950-01-01' + CAST(c_custkey AS INTEGER), '%b ') || CAST(day(DATE '1950-01-01' + CAST(c_custkey AS INTEGER)) AS VARCHAR)
    || strftime(DATE '1950-01-01' + CAST(c_custkey AS INTEGER), ', %Y') AS date_of_birth,
  CAST(c_custkey % 30 AS VARCHAR) || '-' || CAST(c_nationkey AS VARCHAR) || '-0' AS record
FROM customer
""")
def page_record(spark, d):
    """E5 + E7: profile pages (built from customer rows) -> label/value records."""
    out = EX.parsed_rows(EX.extract(_fighter_pages(spark, d), "fighters"))
    return out.select("url", "full_name", "nickname", "height", "reach", "stance", "date_of_birth", "record")


# Pages hold at most 64 keys each (bounded groups by construction).
_PAGE_KEYS = 64


def _event_list_pages(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    rows = c.join(J.bounded_dim(n), c["c_nationkey"] == n["n_nationkey"]).join(J.bounded_dim(r), n["n_regionkey"] == r["r_regionkey"])
    date = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("c_custkey").cast("int")), "MMMM d, yyyy")
    item = F.struct(
        F.col("c_custkey").alias("k"),
        F.concat(F.lit('<a class="b-link b-link_style_black" href="/event/'), F.col("c_custkey").cast("string"), F.lit('"> '),
                 F.col("c_name"), F.lit(" </a>")).alias("a"),
        F.concat(F.lit('<span class="b-statistics__date"> '), date, F.lit(" </span>")).alias("s"),
        F.concat(F.lit('<td class="b-statistics__table-col b-statistics__table-col_style_big-top-padding"> '),
                 F.col("n_name"), F.lit(", "), F.col("r_name"), F.lit(" </td>")).alias("t"),
    )
    pages = rows.groupBy(F.floor(F.col("c_custkey") / _PAGE_KEYS).alias("page_id")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    upcoming_date = '<span class="b-statistics__date">Upcoming</span>'
    upcoming_loc = '<td class="b-statistics__table-col b-statistics__table-col_style_big-top-padding">TBD</td>'
    html = F.concat(
        F.lit("<html><body><table><tr>"),
        F.array_join(F.transform("items", lambda x: x["a"]), ""),
        F.lit(upcoming_date), F.array_join(F.transform("items", lambda x: x["s"]), ""),
        F.lit(upcoming_loc), F.array_join(F.transform("items", lambda x: x["t"]), ""),
        F.lit("</tr></table></body></html>"),
    )
    return pages.select("page_id", F.concat(F.lit("/events/"), F.col("page_id").cast("string")).alias("url"), html.alias("html"))


@query("page_table_zip", """
SELECT c_name AS event, '/event/' || c_custkey AS event_url,
  strftime(DATE '2000-01-01' + CAST(c_custkey AS INTEGER), '%B ') || CAST(day(DATE '2000-01-01' + CAST(c_custkey AS INTEGER)) AS VARCHAR)
    || strftime(DATE '2000-01-01' + CAST(c_custkey AS INTEGER), ', %Y') AS date,
  n_name || ', ' || r_name AS location
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def page_table_zip(spark, d):
    """E1 + E7: event-list pages (<= 64 events each, built from customer rows); names,
    links, dates and locations zipped positionally after skipping the upcoming entry."""
    out = EX.parsed_rows(EX.extract(_event_list_pages(spark, d), "events"))
    return out.select("event", "event_url", "date", "location")


_SECOND = "coalesce(fighter2_url, -fighter1_url)"  # a page always lists two: a made-up opponent for the only participant


def _results_pages(spark, d):
    m = matches(spark, d).withColumn("fighter2_url", F.expr(_SECOND))
    winner = F.when(F.col("fighter1_result") == "Win", "win").when(F.col("fighter1_result") == "Draw", "draw").otherwise("nc")
    imgs = F.concat(
        F.when(F.col("method") == "KO/TKO", F.lit('<img src="/i/belt.png"/>')).otherwise(F.lit("")),
        F.when(F.col("time_seconds") > 150, F.lit('<img src="/i/perf.png"/>')).otherwise(F.lit("")),
        F.when(F.col("time_seconds") < 30, F.lit('<img src="/i/fight.png"/>')).otherwise(F.lit("")),
    )
    row = F.concat(
        F.lit('<tr class="b-fight-details__table-row b-fight-details__table-row__hover js-fight-details-click" data-link="/fight/'),
        F.col("fight_url").cast("string"), F.lit('"><td><a class="b-flag"> '), winner, F.lit(" </a></td><td>"),
        F.lit('<a href="/fighter/'), F.col("fighter1_url").cast("string"), F.lit('">A</a><a href="/fighter/'),
        F.col("fighter2_url").cast("string"), F.lit('">B</a></td><td></td><td></td><td></td><td></td><td> Class '),
        (F.col("event_url") % 9).cast("string"), imgs, F.lit(" </td><td> "), F.col("method"),
        F.lit(" </td><td> "), (F.year("event_date") % 5 + 1).cast("string"), F.lit(" </td><td> "),
        F.concat((F.col("time_seconds") / 60).cast("int").cast("string"), F.lit(":"),
                 F.lpad((F.col("time_seconds") % 60).cast("int").cast("string"), 2, "0")),
        F.lit(" </td></tr>"),
    )
    item = F.struct(F.col("fight_url").alias("k"), row.alias("r"))
    pages = m.groupBy("event_url", F.floor(F.col("fight_url") / _PAGE_KEYS).alias("b")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    html = F.concat(F.lit("<html><body><table><tbody>"), F.array_join(F.transform("items", lambda x: x["r"]), ""),
                    F.lit("</tbody></table></body></html>"))
    return pages.select(F.concat(F.lit("/event/"), F.col("event_url").cast("string"), F.lit("/"), F.col("b").cast("string")).alias("url"),
                        html.alias("html"))


@query("page_results", f"""
WITH {MATCHES_SQL}
SELECT '/fight/' || fight_url AS fight_url,
  CASE WHEN fighter1_result = 'Win' THEN 'win' WHEN fighter1_result = 'Draw' THEN 'draw' ELSE 'nc' END AS winner,
  array_to_string(['/fighter/' || fighter1_url, '/fighter/' || {_SECOND}], '|') AS fighters_urls,
  'Class ' || CAST(event_url % 9 AS VARCHAR) AS weight_class, method,
  CAST(year(event_date) % 5 + 1 AS VARCHAR) AS round,
  CAST(CAST(trunc(time_seconds / 60) AS INTEGER) AS VARCHAR) || ':' || lpad(CAST(CAST(trunc(time_seconds % 60) AS INTEGER) AS VARCHAR), 2, '0') AS time,
  method = 'KO/TKO' AS title_fight, time_seconds > 150 AS perf_bonus, time_seconds < 30 AS fight_of_the_night
FROM m
""")
def page_results(spark, d):
    """E2 + E7: results pages (<= 64 matches each) -> one typed row per match row."""
    out = EX.parsed_rows(EX.extract(_results_pages(spark, d), "results"))
    # the link list is compared as one '|'-joined string (scalar columns only in the gate)
    return out.select("fight_url", "winner", F.array_join("fighters_urls", "|").alias("fighters_urls"), "weight_class",
                      "method", "round", "time", "title_fight", "perf_bonus", "fight_of_the_night")


# Round-table headers as displayed (two tables per round section).
_TOTALS_HEADERS = ["Fighter", "KD", "Sig. str.", "Sig. str. %", "Total str.", "Td %", "Td %", "Sub. att", "Rev.", "Ctrl"]
_STRIKES_HEADERS = ["Fighter", "Sig. str", "Sig. str. %", "Head", "Body", "Leg", "Distance", "Clinch", "Ground"]
_TARGETS = ["head", "body", "leg", "distance", "clinch", "ground"]


def _round_values(fu, ts, i, j):
    """Synthetic round statistics of participant j in round i of match fu (Spark side)."""
    s = lambda c: c.cast("string")
    a = (ts + i * j) % 40
    b = a + fu % 7
    tdv = (i + j) % 4
    vals = {
        "kd": s((fu + i + j) % 3),
        "sig_str": F.concat(s(a), F.lit(" of "), s(b)),
        "sig_str_pct": F.when(b == 0, F.lit("---")).otherwise(F.concat(s(F.floor(100 * a / b).cast("int")), F.lit("%"))),
        "total_str": F.concat(s(a + 5), F.lit(" of "), s(b + 9)),
        "td": F.concat(s(tdv), F.lit(" of "), s(tdv + 2)),
        "td_pct": F.concat(s(F.floor(100 * tdv / (tdv + 2)).cast("int")), F.lit("%")),
        "sub_att": s((fu + j) % 2),
        "rev": F.lit("0"),
        "ctrl": F.concat(s(i), F.lit(":"), F.lpad(s(fu % 60), 2, "0")),
    }
    for k, t in enumerate(_TARGETS, start=1):
        vals[t] = F.concat(s((a + k) % 10), F.lit(" of "), s((a + k) % 10 + k))
    return vals


def _round_pages(spark, d):
    m = matches(spark, d).select("fight_url", "fighter1_url", F.expr(_SECOND).alias("fighter2_url"),
                                 F.col("time_seconds").cast("int").alias("ts"))
    fu, ts = F.col("fight_url"), F.col("ts")
    fighters = F.concat(F.lit('<td><a href="/fighter/'), F.col("fighter1_url").cast("string"), F.lit('">A</a><a href="/fighter/'),
                        F.col("fighter2_url").cast("string"), F.lit('">B</a></td>'))

    totals_cols = ["kd", "sig_str", "sig_str_pct", "total_str", "td", "td_pct", "sub_att", "rev", "ctrl"]
    strikes_cols = ["sig_str", "sig_str_pct", *_TARGETS]
    # one row per (match, round): plain expressions (whole-stage codegen), then each
    # match's rounds (at most 3) are gathered in order.
    per_round = m.withColumn("i", F.explode(F.sequence(F.lit(1), (1 + fu % 3).cast("int"))))
    i = F.col("i")
    v1, v2 = _round_values(fu, ts, i, 1), _round_values(fu, ts, i, 2)

    def row(cols):
        cells = [F.concat(F.lit("<td><p> "), v1[c], F.lit(" </p><p> "), v2[c], F.lit(" </p></td>")) for c in cols]
        return F.concat(F.lit("<tr>"), fighters, *cells, F.lit("</tr>"))

    rows = per_round.select("fight_url", F.struct(i.alias("i"), row(totals_cols).alias("t"), row(strikes_cols).alias("s")).alias("r"))
    gathered = rows.groupBy("fight_url").agg(F.sort_array(F.collect_list("r")).alias("rs"))

    def table(headers, field):
        head = "".join(f"<th> {h} </th>" for h in headers)
        return F.concat(F.lit('<section class="b-fight-details__section js-fight-section"><table class="b-fight-details__table">'
                              f"<thead><tr>{head}</tr></thead><tbody>"), F.array_join(F.col(f"rs.{field}"), ""),
                        F.lit("</tbody></table></section>"))

    html = F.concat(F.lit('<html><body><a class="b-link" href="/fight/'), fu.cast("string"), F.lit('">Match</a>'),
                    table(_TOTALS_HEADERS, "t"), table(_STRIKES_HEADERS, "s"), F.lit("</body></html>"))
    return gathered.select(F.concat(F.lit("/fight/"), fu.cast("string"), F.lit("/rounds")).alias("url"), html.alias("html"))


def _round_values_sql(j: int) -> str:
    a = f"((ts + i * {j}) % 40)"
    b = f"({a} + fight_url % 7)"
    tdv = f"((i + {j}) % 4)"
    cols = {
        "kd": f"CAST((fight_url + i + {j}) % 3 AS VARCHAR)",
        "sig_str": f"CAST({a} AS VARCHAR) || ' of ' || CAST({b} AS VARCHAR)",
        "sig_str_pct": f"CASE WHEN {b} = 0 THEN '---' ELSE CAST((100 * {a}) // {b} AS VARCHAR) || '%' END",
        "total_str": f"CAST({a} + 5 AS VARCHAR) || ' of ' || CAST({b} + 9 AS VARCHAR)",
        "td": f"CAST({tdv} AS VARCHAR) || ' of ' || CAST({tdv} + 2 AS VARCHAR)",
        "td_pct": f"CAST((100 * {tdv}) // ({tdv} + 2) AS VARCHAR) || '%'",
        "sub_att": f"CAST((fight_url + {j}) % 2 AS VARCHAR)",
        "rev": "'0'",
        "ctrl": "CAST(i AS VARCHAR) || ':' || lpad(CAST(fight_url % 60 AS VARCHAR), 2, '0')",
    }
    for k, t in enumerate(_TARGETS, start=1):
        cols[t] = f"CAST(({a} + {k}) % 10 AS VARCHAR) || ' of ' || CAST(({a} + {k}) % 10 + {k} AS VARCHAR)"
    return ", ".join(f"{v} AS {k}" for k, v in cols.items())


@query("page_rounds", f"""
WITH {MATCHES_SQL},
mm AS (SELECT fight_url, fighter1_url, {_SECOND} AS fighter2_url, CAST(time_seconds AS INTEGER) AS ts FROM m),
r AS (SELECT mm.*, CAST(g.i AS BIGINT) AS i FROM mm, LATERAL (SELECT unnest(range(1, 2 + CAST(fight_url % 3 AS INTEGER))) AS i) g)
SELECT CAST(i AS INTEGER) AS round, '/fight/' || fight_url || '/rounds' AS fight_url, '/fighter/' || fighter1_url AS fighter,
       {_round_values_sql(1)} FROM r
UNION ALL
SELECT CAST(i AS INTEGER), '/fight/' || fight_url || '/rounds', '/fighter/' || fighter2_url, {_round_values_sql(2)} FROM r
""")
def page_rounds(spark, d):
    """E3 + E4 + E6 + E7: round pages (two tables per section, two stacked values per
    cell) -> one row per participant per round; the page URL is attached as fight_url."""
    out = EX.parsed_rows(EX.extract(_round_pages(spark, d), "rounds", attach="fight_url"))
    return out.select("round", "fight_url", "fighter", *EX.ROUND_FIELDS)


# ---------------------------------------------------------------- C1-C16 scalars, CL1-CL4 cleaners

from skein.operators import cleaners as CL  # noqa: E402
from skein.plans import rawdata as RD  # noqa: E402

_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


def q_strip(x):
    return f"trim({x}, {_WS})"


def q_num(x):
    return f"(CASE WHEN regexp_matches(CAST({x} AS VARCHAR), '{_NUM_RE}') THEN TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE) END)"


def q_loc(x, part, width=None):
    parts = f"list_transform(string_split({x}, ','), lambda e: {q_strip('e')})"
    if part == "city":
        return f"{parts}[1]"
    if width is None:
        if part == "state":
            return f"CASE WHEN len({parts}) >= 3 THEN {parts}[2] END"
        return f"CASE WHEN len({parts}) >= 3 THEN {parts}[len({parts})] WHEN len({parts}) = 2 THEN {parts}[2] END"
    if part == "state":
        return f"{parts}[2]" if width >= 3 else "CAST(NULL AS VARCHAR)"
    return f"{parts}[{width}]" if width >= 3 else (f"{parts}[2]" if width == 2 else "CAST(NULL AS VARCHAR)")


def q_height(x):
    pat = r"(\d+)'\s*(\d+)".replace("'", "''")
    return (f"(TRY_CAST(regexp_extract({x}, '{pat}', 1) AS DOUBLE) * 30.48 + "
            f"TRY_CAST(regexp_extract({x}, '{pat}', 2) AS DOUBLE) * 2.54)")


def q_reach(x):
    return f"({q_num(q_strip(f'replace({x}, chr(34), {chr(39)}{chr(39)})'))} * 2.54)"


def q_time(x):
    p = f"list_transform(string_split({x}, ':'), lambda e: {q_num('e')})"
    return (f"(CASE WHEN {x} IS NULL OR {q_strip(x)} = '' THEN NULL WHEN len({p}) = 2 THEN {p}[1] * 60 + {p}[2] "
            f"WHEN len({p}) = 3 THEN {p}[1] * 3600 + {p}[2] * 60 + {p}[3] END)")


def q_lines(x):
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda e: {q_strip('e')}), lambda e: e <> '')"


def q_method_type(x):
    return (f"(CASE WHEN {x} IN ('U-DEC', 'S-DEC', 'M-DEC') THEN 'Decision' WHEN {x} = 'KO/TKO' THEN 'Knockout' "
            f"WHEN {x} = 'SUB' THEN 'Submission' ELSE 'Other' END)")


def q_cap(x):
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


def q_date(x, fmt):
    return f"strftime(CAST(try_strptime({q_strip(f'replace({x}, chr(160), chr(32))')}, '{fmt}') AS DATE), '%Y-%m-%d')"


def q_label(x):
    return f"replace(replace({q_strip(f'lower(coalesce(CAST({x} AS VARCHAR), {chr(39)}{chr(39)}))')}, ' ', '_'), '''', '')"


def q_int(x):
    n = q_num(x)
    return f"(CASE WHEN {n} = floor({n}) THEN CAST({n} AS INTEGER) END)"


def q_pct(x):
    return q_num(f"replace({x}, '%', '')")


def q_frac(x, i):
    return f"TRY_CAST(regexp_extract({x}, '(\\d+)\\s*of\\s*(\\d+)', {i}) AS DOUBLE)"


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


@query("clean_location", f"""
WITH {RD.RAW_EVENTS_SQL}
SELECT event_url, {q_loc('location', 'city')} AS city, {q_loc('location', 'state')} AS state, {q_loc('location', 'country')} AS country
FROM re
""")
def clean_location(spark, d):
    """C1 per row: 3+ parts -> city/state/last, 2 -> city/country, 1 -> city."""
    loc = S.location_parts("location")
    return RD.raw_events(spark, d).select("event_url", loc["city"].alias("city"), loc["state"].alias("state"), loc["country"].alias("country"))


@query("clean_location_dataset", f"""
WITH {RD.RAW_EVENTS_SQL}
SELECT event_url, {q_loc('location', 'city', 4)} AS city, {q_loc('location', 'state', 4)} AS state,
       {q_loc('location', 'country', 4)} AS country
FROM re
""")
def clean_location_dataset(spark, d):
    """C1 with the column-wide width rule (widest row decides; here 4 parts)."""
    ev = RD.raw_events(spark, d)
    loc = S.location_parts("location", CL.location_width(ev))
    return ev.select("event_url", loc["city"].alias("city"), loc["state"].alias("state"), loc["country"].alias("country"))


@query("clean_height", f"WITH {RD.RAW_FIGHTERS_SQL} SELECT fighter_url, round({q_height('height')}, 4) AS height_cm FROM rf")
def clean_height(spark, d):
    """feet/inches text -> centimetres."""
    return RD.raw_fighters(spark, d).select("fighter_url", r4(S.height_to_cm("height")).alias("height_cm"))


@query("clean_reach", f"WITH {RD.RAW_FIGHTERS_SQL} SELECT fighter_url, round({q_reach('reach')}, 4) AS reach_cm FROM rf")
def clean_reach(spark, d):
    """Inches text -> centimetres."""
    return RD.raw_fighters(spark, d).select("fighter_url", r4(S.reach_to_cm("reach")).alias("reach_cm"))


@query("clean_time", f"WITH {RD.RAW_RESULTS_SQL} SELECT fight_url, time, {q_time('time')} AS time_seconds FROM rr")
def clean_time(spark, d):
    """C4: m:ss / h:mm:ss -> seconds."""
    return RD.raw_results(spark, d).select("fight_url", "time", S.time_to_seconds("time").alias("time_seconds"))


@query("clean_pct", f"WITH {RD.RAW_ROUNDS_SQL} SELECT fight_url, fighter, round, sig_str_pct, {q_pct('sig_str_pct')} AS pct FROM rw")
def clean_pct(spark, d):
    """C6: '37%' -> 37.0, '---' -> NULL."""
    return RD.raw_rounds(spark, d).select("fight_url", "fighter", "round", "sig_str_pct", S.parse_percentage("sig_str_pct").alias("pct"))


@query("clean_fraction", f"""
WITH {RD.RAW_ROUNDS_SQL}
SELECT fight_url, fighter, round, head, {q_frac('head', 1)} AS landed, {q_frac('head', 2)} AS attempted FROM rw
""")
def clean_fraction(spark, d):
    """C7: 'x of y' -> landed, attempted."""
    fr = S.parse_fraction("head")
    return RD.raw_rounds(spark, d).select("fight_url", "fighter", "round", "head", fr["landed"].alias("landed"),
                                          fr["attempted"].alias("attempted"))


@query("clean_method", f"""
WITH {RD.RAW_RESULTS_SQL}
SELECT fight_url, {q_lines('method')}[1] AS method_short, {q_lines('method')}[2] AS method_detail FROM rr
""")
def clean_method(spark, d):
    """Multi-line method -> short code and detail."""
    m = S.split_method("method")
    return RD.raw_results(spark, d).select("fight_url", m["short"].alias("method_short"), m["detail"].alias("method_detail"))


@query("method_type", f"""
WITH {RD.RAW_RESULTS_SQL}
SELECT fight_url, {q_method_type(q_lines('method') + '[1]')} AS method_type FROM rr
""")
def method_type_q(spark, d):
    """Method code -> Decision / Knockout / Submission / Other."""
    return RD.raw_results(spark, d).select("fight_url", S.method_type(S.split_method("method")["short"]).alias("method_type"))


@query("capitalize", f"WITH {RD.RAW_RESULTS_SQL} SELECT fight_url, {q_cap('winner')} AS result_type FROM rr")
def capitalize_q(spark, d):
    """C11: str.capitalize."""
    return RD.raw_results(spark, d).select("fight_url", S.capitalize("winner").alias("result_type"))


@query("outcomes", f"""
WITH {RD.RAW_RESULTS_SQL}
SELECT fight_url, CASE WHEN {q_cap('winner')} = 'Win' THEN 'Win' ELSE {q_cap('winner')} END AS fighter1_result,
       CASE WHEN {q_cap('winner')} = 'Win' THEN 'Loss' ELSE {q_cap('winner')} END AS fighter2_result FROM rr
""")
def outcomes(spark, d):
    """Win -> (Win, Loss); other labels shared."""
    o = S.participant_outcomes(S.capitalize("winner"))
    return RD.raw_results(spark, d).select("fight_url", o["first"].alias("fighter1_result"), o["second"].alias("fighter2_result"))


@query("clean_dates", f"""
WITH {RD.RAW_EVENTS_SQL}, {RD.RAW_FIGHTERS_SQL}
SELECT 'e' AS src, event_url AS k, {q_date('date', '%B %d, %Y')} AS day FROM re
UNION ALL
SELECT 'f', fighter_url, {q_date('date_of_birth', '%b %d, %Y')} FROM rf
""")
def clean_dates(spark, d):
    """Lenient dates in two formats (no-break spaces, blanks and junk -> NULL)."""
    e = RD.raw_events(spark, d).select(F.lit("e").alias("src"), F.col("event_url").alias("k"),
                                       _day(S.parse_date("date", "MMMM d, yyyy")).alias("day"))
    f = RD.raw_fighters(spark, d).select(F.lit("f").alias("src"), F.col("fighter_url").alias("k"),
                                         _day(S.parse_date("date_of_birth", "MMM d, yyyy")).alias("day"))
    return e.unionByName(f)


@query("to_number", f"""
WITH {RD.RAW_ROUNDS_SQL}
SELECT fight_url, fighter, round, {q_num('kd')} AS kd, {q_num('sub_att')} AS sub_att FROM rw
""")
def to_number(spark, d):
    """Lenient numeric ('1e0', ' 2 ' accepted; '3d' rejected)."""
    return RD.raw_rounds(spark, d).select("fight_url", "fighter", "round", S.to_number("kd").alias("kd"),
                                          S.to_number("sub_att").alias("sub_att"))


@query("list_pair", f"""
WITH {RD.RAW_RESULTS_SQL} SELECT fight_url, fighters_urls[1] AS fighter1_url, fighters_urls[2] AS fighter2_url FROM rr
""")
def list_pair(spark, d):
    """List positions 0 and 1 (NULL when short)."""
    return RD.raw_results(spark, d).select("fight_url", S.list_item("fighters_urls", 0).alias("fighter1_url"),
                                           S.list_item("fighters_urls", 1).alias("fighter2_url"))


@query("duration", f"""
WITH {RD.RAW_RESULTS_SQL}
SELECT fight_url, {q_time('time')} + ({q_int('round')} - 1) * 300 AS fight_duration_seconds FROM rr
""")
def duration(spark, d):
    """C14: time in final round + 300 s per earlier round."""
    rr = RD.raw_results(spark, d)
    rnd = S.to_number("round")
    rnd = F.when(rnd == F.floor(rnd), rnd.cast("int"))
    return rr.select("fight_url", S.fight_duration(S.time_to_seconds("time"), rnd).alias("fight_duration_seconds"))


@query("label", f"WITH {RD.RAW_RESULTS_SQL} SELECT fight_url, {q_label('weight_class')} AS label FROM rr")
def label(spark, d):
    """Category label cleaning."""
    return RD.raw_results(spark, d).select("fight_url", S.clean_label("weight_class").alias("label"))


@query("composite_label", f"""
WITH {RD.RAW_RESULTS_SQL}
SELECT fight_url, lower({q_cap('winner')}) || '_' || lower({q_method_type(q_lines('method') + '[1]')}) AS result_method FROM rr
""")
def composite_label(spark, d):
    """lower(result) || '_' || lower(method type)."""
    rr = RD.raw_results(spark, d)
    return rr.select("fight_url", S.composite_label(S.capitalize("winner"), S.method_type(S.split_method("method")["short"])).alias("result_method"))


@query("clean_events", f"""
WITH {RD.RAW_EVENTS_SQL}
SELECT event, event_url, {q_date('date', '%B %d, %Y')} AS date, location, {q_loc('location', 'city')} AS city,
       {q_loc('location', 'state')} AS state, {q_loc('location', 'country')} AS country FROM re
""")
def clean_events(spark, d):
    """CL1: events cleaner."""
    out = CL.clean_events(RD.raw_events(spark, d))
    return out.withColumn("date", _day("date"))


@query("clean_results", f"""
WITH {RD.RAW_RESULTS_SQL},
c AS (SELECT *, {q_time('time')} AS ts, {q_int('round')} AS rnd, {q_lines('method')} AS ml, {q_cap('winner')} AS rt FROM rr)
SELECT fight_url, event_url, weight_class, method, rnd AS round, time, title_fight, perf_bonus, fight_of_the_night,
       ts AS time_seconds, ts + (rnd - 1) * 300 AS fight_duration_seconds, ml[1] AS method_short, ml[2] AS method_detail,
       rt AS result_type, {q_method_type('ml[1]')} AS method_type, fighters_urls[1] AS fighter1_url,
       fighters_urls[2] AS fighter2_url, CASE WHEN rt = 'Win' THEN 'Win' ELSE rt END AS fighter1_result,
       CASE WHEN rt = 'Win' THEN 'Loss' ELSE rt END AS fighter2_result
FROM c
""")
def clean_results(spark, d):
    """CL2: results cleaner."""
    return CL.clean_results(RD.raw_results(spark, d))


@query("clean_fighters", f"""
WITH {RD.RAW_FIGHTERS_SQL}
SELECT full_name, fighter_url, nickname, height, reach, stance, {q_date('date_of_birth', '%b %d, %Y')} AS date_of_birth, record,
       round({q_height('height')}, 4) AS height_cm, round({q_reach('reach')}, 4) AS reach_cm FROM rf
""")
def clean_fighters(spark, d):
    """CL3: profile cleaner."""
    out = CL.clean_fighters(RD.raw_fighters(spark, d))
    return out.withColumns({"date_of_birth": _day("date_of_birth"), "height_cm": r4("height_cm"), "reach_cm": r4("reach_cm")})


def _clean_rounds_sql():
    cols = [f"{q_num('round')} AS round", "fight_url", "fighter", f"{q_num('kd')} AS kd", f"{q_num('sub_att')} AS sub_att",
            f"{q_num('rev')} AS rev", f"{q_time('ctrl')} AS ctrl_seconds", f"{q_pct('sig_str_pct')} AS sig_str_pct_num",
            f"{q_pct('td_pct')} AS td_pct_num"]
    for s in AG.FRACTION_STATS:
        cols += [f"{q_frac(s, 1)} AS {s}_landed", f"{q_frac(s, 2)} AS {s}_attempted"]
    return f"WITH {RD.RAW_ROUNDS_SQL} SELECT " + ", ".join(cols) + " FROM rw"


@query("clean_rounds", _clean_rounds_sql())
def clean_rounds(spark, d):
    """CL4: round-table cleaner (numbers, control seconds, percentages, 9 fraction pairs)."""
    return CL.clean_rounds(RD.raw_rounds(spark, d))


# ---------------------------------------------------------------- G3 / G4 composites

from skein.plans import jobs as PL  # noqa: E402


def _clean_results_body():
    return (f"c AS (SELECT *, {q_time('time')} AS ts, {q_int('round')} AS rnd, {q_lines('method')} AS ml, {q_cap('winner')} AS rt FROM rr),\n"
            "cr AS (SELECT fight_url, event_url, weight_class, method, rnd AS round, time, title_fight, perf_bonus, fight_of_the_night,\n"
            "  ts AS time_seconds, ts + (rnd - 1) * 300 AS fight_duration_seconds, ml[1] AS method_short, ml[2] AS method_detail,\n"
            f"  rt AS result_type, {q_method_type('ml[1]')} AS method_type, fighters_urls[1] AS fighter1_url,\n"
            "  fighters_urls[2] AS fighter2_url, CASE WHEN rt = 'Win' THEN 'Win' ELSE rt END AS fighter1_result,\n"
            "  CASE WHEN rt = 'Win' THEN 'Loss' ELSE rt END AS fighter2_result FROM c)")


_G3_OUT = [
    "total_fights_after", "cumulative_wins_after", "cumulative_losses_after", "win_rate_after", "avg_time_seconds_after",
    "total_fights_in", "cumulative_wins_in", "cumulative_losses_in", "win_rate_in", "avg_time_seconds_in",
    *[f"rolling_{w}_{k}" for w in (3, 5) for k in ("wins", "fights", "win_rate", "avg_time", "wins_in", "fights_in",
                                                    "win_rate_in", "avg_time_in")],
    "time_since_first_fight", "time_since_last_fight", *_OPP_COLS, *[f"total_{c}" for c in _OPP_COLS],
]
_G3_DOUBLES = {"win_rate_after", "avg_time_seconds_after", "win_rate_in", "avg_time_seconds_in",
               *[f"rolling_{w}_{k}" for w in (3, 5) for k in ("win_rate", "avg_time", "win_rate_in", "avg_time_in")]}


def _g3_sql():
    W = "(PARTITION BY fighter_url ORDER BY event_date ASC NULLS LAST, fight_url ROWS BETWEEN {} )"
    wa = W.format("UNBOUNDED PRECEDING AND CURRENT ROW")
    wi = W.format("UNBOUNDED PRECEDING AND 1 PRECEDING")
    wo = "(PARTITION BY fighter_url ORDER BY event_date ASC NULLS LAST, fight_url)"
    roll = []
    for w in (3, 5):
        fa, fi = W.format(f"{w - 1} PRECEDING AND CURRENT ROW"), W.format(f"{w} PRECEDING AND 1 PRECEDING")
        roll += [f"sum(win) OVER {fa} AS r{w}w", f"count(win) OVER {fa} AS r{w}f", f"avg(time_seconds) OVER {fa} AS r{w}t",
                 f"sum(win) OVER {fi} AS r{w}wi", f"count(win) OVER {fi} AS r{w}fi", f"avg(time_seconds) OVER {fi} AS r{w}ti"]
    k = "fighter_url IS NULL"
    nk = lambda e: f"CASE WHEN {k} THEN NULL ELSE {e} END"
    days = lambda a, b: f"CAST(floor((epoch_us(CAST({a} AS TIMESTAMP)) - epoch_us(CAST({b} AS TIMESTAMP))) / 86400000000) AS BIGINT)"
    fin = {
        "total_fights_after": nk("n"), "cumulative_wins_after": nk("w_a"), "cumulative_losses_after": nk("l_a"),
        "win_rate_after": nk("w_a / n"), "avg_time_seconds_after": nk("CASE WHEN tc_a > 0 THEN ts_a / tc_a END"),
        "total_fights_in": nk("n - 1"), "cumulative_wins_in": f"coalesce({nk('w_i')}, 0)",
        "cumulative_losses_in": f"coalesce({nk('l_i')}, 0)",
        "win_rate_in": nk("CASE WHEN n - 1 > 0 THEN coalesce(w_i, 0) / (n - 1) END"),
        "avg_time_seconds_in": nk("CASE WHEN tc_i > 0 THEN ts_i / tc_i END"),
        "time_since_first_fight": nk(days("event_date", "first_d")), "time_since_last_fight": nk(days("event_date", "prev_d")),
    }
    for w in (3, 5):
        fin.update({
            f"rolling_{w}_wins": nk(f"r{w}w"), f"rolling_{w}_fights": nk(f"r{w}f"),
            f"rolling_{w}_win_rate": nk(f"r{w}w / r{w}f"), f"rolling_{w}_avg_time": nk(f"r{w}t"),
            f"rolling_{w}_wins_in": nk(f"r{w}wi"), f"rolling_{w}_fights_in": nk(f"r{w}fi"),
            f"rolling_{w}_win_rate_in": nk(f"CASE WHEN r{w}fi > 0 THEN r{w}wi / r{w}fi END"), f"rolling_{w}_avg_time_in": nk(f"r{w}ti"),
        })
    fin_sql = ",\n  ".join(
        (f"round({v}, 4) AS {n}" if n in _G3_DOUBLES else f"CAST({v} AS BIGINT) AS {n}") for n, v in fin.items())
    ewin = "ORDER BY s.d DESC NULLS LAST, s.m DESC NULLS LAST"
    return f"""
WITH {RD.RAW_RESULTS_SQL}, {RD.RAW_EVENTS_SQL}, {RD.RAW_FIGHTERS_SQL},
{_clean_results_body()},
ce AS (SELECT event_url, CAST(try_strptime({q_strip("replace(date, chr(160), chr(32))")}, '%B %d, %Y') AS DATE) AS event_date FROM re),
wd AS (SELECT cr.*, ce.event_date FROM cr LEFT JOIN ce USING (event_url)),
lg3 AS (SELECT fight_url, event_date, fighter1_url AS fighter_url, fighter1_result AS result, time_seconds, 'fighter1' AS role,
              fighter2_url AS opp_url FROM wd
       UNION ALL SELECT fight_url, event_date, fighter2_url, fighter2_result, time_seconds, 'fighter2', fighter1_url FROM wd),
x AS (SELECT *, CASE WHEN result = 'Win' THEN 1 ELSE 0 END AS win, CASE WHEN result = 'Loss' THEN 1 ELSE 0 END AS loss FROM lg3),
o1 AS (SELECT x.*, row_number() OVER {wo} AS n,
   sum(win) OVER {wa} AS w_a, sum(loss) OVER {wa} AS l_a, sum(time_seconds) OVER {wa} AS ts_a, count(time_seconds) OVER {wa} AS tc_a,
   sum(win) OVER {wi} AS w_i, sum(loss) OVER {wi} AS l_i, sum(time_seconds) OVER {wi} AS ts_i, count(time_seconds) OVER {wi} AS tc_i,
   {", ".join(roll)}, min(event_date) OVER {wa} AS first_d, lag(event_date) OVER {wo} AS prev_d FROM x),
own AS (SELECT fight_url, fighter_url, opp_url, role, result, event_date,
  {fin_sql} FROM o1),
src AS (SELECT fighter_url AS k, event_date AS d, fight_url AS m,
          CASE WHEN total_fights_in > 0 THEN cumulative_wins_in END AS wi, CASE WHEN total_fights_in > 0 THEN cumulative_losses_in END AS li,
          cumulative_wins_after AS wa, cumulative_losses_after AS la FROM own WHERE fighter_url IS NOT NULL AND event_date IS NOT NULL),
bk AS (SELECT * FROM (SELECT l.fight_url, l.role, s.wi, s.li, row_number() OVER (PARTITION BY l.fight_url, l.role {ewin}) AS rn
        FROM own l LEFT JOIN src s ON s.k = l.opp_url AND s.d <= l.event_date) WHERE rn = 1),
fw AS (SELECT * FROM (SELECT l.fight_url, l.role, s.wa, s.la,
          row_number() OVER (PARTITION BY l.fight_url, l.role ORDER BY s.d ASC NULLS LAST, s.m ASC NULLS LAST) AS rn
        FROM own l LEFT JOIN src s ON s.k = l.opp_url AND s.d >= l.event_date) WHERE rn = 1),
oa AS (SELECT own.*, CAST(bk.wi AS BIGINT) AS opp_cumulative_wins_in, CAST(bk.li AS BIGINT) AS opp_cumulative_losses_in,
          CAST(fw.wa AS BIGINT) AS opp_cumulative_wins_after, CAST(fw.la AS BIGINT) AS opp_cumulative_losses_after
       FROM own JOIN bk USING (fight_url, role) JOIN fw USING (fight_url, role)),
tt AS (SELECT oa.*, {", ".join(f"CASE WHEN fighter_url IS NULL THEN NULL ELSE CAST(sum(coalesce({c}, 0)) OVER {wa} AS BIGINT) END AS total_{c}" for c in _OPP_COLS)}
       FROM oa),
fd AS (SELECT DISTINCT * FROM rf)
SELECT tt.fight_url, tt.fighter_url, tt.opp_url, tt.role, tt.result, strftime(tt.event_date, '%Y-%m-%d') AS event_date,
  {", ".join(f"tt.{c}" for c in _G3_OUT)}, fd.full_name, round({q_height('fd.height')}, 4) AS height_cm
FROM tt LEFT JOIN fd ON tt.fighter_url = fd.fighter_url
"""


@query("results_stats_full", _g3_sql())
def results_stats_full(spark, d, strategy=None):
    """G3 end to end: clean results (CL2) + events (CL1) + fighters (CL3) -> J1 -> P1 ->
    W6-W10 -> W11 (as-of) -> W12 -> J3."""
    cr = CL.clean_results(RD.raw_results(spark, d))
    ce = CL.clean_events(RD.raw_events(spark, d)).select("event_url", "date")
    cf = CL.clean_fighters(RD.raw_fighters(spark, d))
    return results_columns(PL.results_stats(cr, ce, cf, strategy=strategy))


def results_columns(out):
    cols = [r4double(F.col(c)).alias(c) if c in _G3_DOUBLES else F.col(c).cast("bigint").alias(c) for c in _G3_OUT]
    return out.select("fight_url", "fighter_url", "opp_url", "role", "result", _day("event_date").alias("event_date"), *cols,
                      "full_name", r4("height_cm").alias("height_cm"))


_G4_PAIRS = [f"{s}_{x}" for s in AG.FRACTION_STATS for x in ("landed", "attempted")]
_G4_ACCURACY = [f"{s.split('_')[0]}_accuracy" for s in AG.FRACTION_STATS]
_G4_SUMS = ["kd", "sub_att", "rev", "ctrl_seconds", "sig_str_pct_num", "td_pct_num", *_G4_PAIRS]
_G4_METRICS = ["round", *_G4_SUMS, *_G4_ACCURACY]  # every numeric column of the per-match table: 34


def _g4_cols():
    cols = []
    for m in _G4_METRICS:
        cols += [f"cum_{m}_current", f"avg_{m}_current", f"cum_{m}_in", f"avg_{m}_in"]
        cols += [f"rolling_{w}_{x}{m}_in" for w in (3, 5) for x in ("", "avg_")]
        cols += [f"opp_{x}_{m}_{t}" for t in ("in", "current") for x in ("cum", "avg")]
    return cols


def _g4_sql():
    Wf = "(PARTITION BY fighter ORDER BY event_date ASC NULLS LAST, fight_url ROWS BETWEEN {})"
    cur, inn = Wf.format("UNBOUNDED PRECEDING AND CURRENT ROW"), Wf.format("UNBOUNDED PRECEDING AND 1 PRECEDING")
    stat = []
    for m in _G4_METRICS:
        stat += [
            f"CASE WHEN {m} IS NOT NULL THEN sum({m}) OVER {cur} END AS cum_{m}_current",
            f"CASE WHEN {m} IS NOT NULL THEN sum({m}) OVER {cur} END / (fight_order + 1) AS avg_{m}_current",
            f"coalesce(sum({m}) OVER {inn}, 0) AS cum_{m}_in",
            f"CASE WHEN fight_order > 0 THEN coalesce(sum({m}) OVER {inn}, 0) / fight_order END AS avg_{m}_in",
        ]
        for w in (3, 5):
            spec = Wf.format(f"{w} PRECEDING AND 1 PRECEDING")
            stat += [f"sum({m}) OVER {spec} AS rolling_{w}_{m}_in", f"avg({m}) OVER {spec} AS rolling_{w}_avg_{m}_in"]
    in_names = [f"{x}_{m}_in" for m in _G4_METRICS for x in ("cum", "avg")]
    cur_names = [f"{x}_{m}_current" for m in _G4_METRICS for x in ("cum", "avg")]
    raw = ", ".join(f"{q_frac(s, i)} AS {s}_{x}" for s in AG.FRACTION_STATS for i, x in ((1, "landed"), (2, "attempted")))
    sums = ", ".join(f"coalesce(sum({m}), 0) AS {m}" for m in _G4_SUMS)
    ratios = ", ".join(f"CASE WHEN {s}_attempted > 0 THEN {s}_landed / {s}_attempted END AS {a}" for s, a in zip(AG.FRACTION_STATS, _G4_ACCURACY))
    out_cols = []
    for c in _g4_cols():
        src = ("bk" if c.endswith("_in") else "fw") + f".{c[4:]}" if c.startswith("opp_") else f"st.{c}"
        out_cols.append(f"round({src} + 1e-9, 4) AS {c}")
    return f"""
WITH {RD.RAW_RESULTS_SQL}, {RD.RAW_EVENTS_SQL}, {RD.RAW_FIGHTERS_SQL}, {RD.RAW_ROUNDS_SQL},
{_clean_results_body()},
crd AS (SELECT {q_num('round')} AS round, fight_url, fighter, {q_num('kd')} AS kd, {q_num('sub_att')} AS sub_att, {q_num('rev')} AS rev,
               {q_time('ctrl')} AS ctrl_seconds, {q_pct('sig_str_pct')} AS sig_str_pct_num, {q_pct('td_pct')} AS td_pct_num, {raw} FROM rw),
br AS (SELECT DISTINCT fight_url, event_url FROM cr),
ce AS (SELECT event_url, CAST(try_strptime({q_strip("replace(date, chr(160), chr(32))")}, '%B %d, %Y') AS DATE) AS date FROM re),
j AS (SELECT crd.*, ce.date AS event_date FROM crd LEFT JOIN br USING (fight_url) LEFT JOIN ce ON br.event_url = ce.event_url),
fa AS (SELECT fight_url, fighter, max(round) AS round, {sums}, max(event_date) AS event_date
       FROM j WHERE fight_url IS NOT NULL AND fighter IS NOT NULL GROUP BY fight_url, fighter),
fo AS (SELECT *, {ratios}, row_number() OVER (PARTITION BY fighter ORDER BY event_date ASC NULLS LAST, fight_url) - 1 AS fight_order FROM fa),
st AS (SELECT fight_url, fighter, event_date, round, fight_order, {", ".join(stat)},
              CAST(count(*) OVER {Wf.format('3 PRECEDING AND 1 PRECEDING')} AS BIGINT) AS rolling_3_fights_in,
              CAST(count(*) OVER {Wf.format('5 PRECEDING AND 1 PRECEDING')} AS BIGINT) AS rolling_5_fights_in FROM fo),
rk AS (SELECT fight_url, fighter, row_number() OVER (PARTITION BY fight_url ORDER BY fighter) AS rn,
              count(*) OVER (PARTITION BY fight_url) AS cnt FROM st),
op AS (SELECT a.fight_url, a.fighter, b.fighter AS opp_url FROM rk a LEFT JOIN rk b ON a.fight_url = b.fight_url AND b.rn = a.cnt + 1 - a.rn),
l AS (SELECT st.fight_url, st.fighter, st.event_date, op.opp_url FROM st JOIN op USING (fight_url, fighter)),
bk AS (SELECT * FROM (SELECT l.fight_url, l.fighter, {", ".join(f"s.{c}" for c in in_names)},
          row_number() OVER (PARTITION BY l.fight_url, l.fighter ORDER BY s.event_date DESC NULLS LAST, s.fight_url DESC NULLS LAST) AS rn
        FROM l LEFT JOIN st s ON s.fighter = l.opp_url AND s.event_date <= l.event_date) WHERE rn = 1),
fw AS (SELECT * FROM (SELECT l.fight_url, l.fighter, {", ".join(f"s.{c}" for c in cur_names)},
          row_number() OVER (PARTITION BY l.fight_url, l.fighter ORDER BY s.event_date ASC NULLS LAST, s.fight_url ASC NULLS LAST) AS rn
        FROM l LEFT JOIN st s ON s.fighter = l.opp_url AND s.event_date >= l.event_date) WHERE rn = 1),
fd AS (SELECT DISTINCT * FROM rf)
SELECT st.fight_url, st.fighter AS fighter_url, strftime(st.event_date, '%Y-%m-%d') AS event_date,
       l.opp_url, round(st.round, 4) AS round, st.rolling_3_fights_in, st.rolling_5_fights_in, {", ".join(out_cols)}, fd.full_name
FROM st JOIN l USING (fight_url, fighter) JOIN bk USING (fight_url, fighter) JOIN fw USING (fight_url, fighter)
LEFT JOIN fd ON st.fighter = fd.fighter_url
"""


@query("fight_stats_full", _g4_sql())
def fight_stats_full(spark, d):
    """G4 end to end: clean rounds (CL4) -> J2 -> J1 -> A1 -> A2 -> W13-W15 -> J8 -> W16 -> J3."""
    crd = CL.clean_rounds(RD.raw_rounds(spark, d))
    cr = CL.clean_results(RD.raw_results(spark, d))
    ce = CL.clean_events(RD.raw_events(spark, d)).select("event_url", "date")
    cf = CL.clean_fighters(RD.raw_fighters(spark, d))
    out = PL.fight_stats(crd, results=cr, events=ce, fighters=cf)
    return out.select("fight_url", "fighter_url", _day("event_date").alias("event_date"), "opp_url",
                      r4("round").alias("round"), "rolling_3_fights_in", "rolling_5_fights_in", *[r4up(c).alias(c) for c in _g4_cols()], "full_name")


# ---------------------------------------------------------------- G2 career table (star join + totals)

_CT_RESULT = ["draw", "loss", "nc", "win"]
_CT_RM = [f"{r}_{m}" for r in _CT_RESULT for m in ("decision", "knockout", "other", "submission")]
_CT_WEIGHT = [f"womens_{i}_class" for i in range(9)]
_CT_NUM = ["title_fight", "perf_bonus", "fight_of_the_night", "fight_duration_seconds"]


def _career_table_sql():
    wa = "(PARTITION BY fighter_url ORDER BY date ASC NULLS LAST, fight_url ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    dums = []
    for col, cats in (("result", _CT_RESULT), ("rm", _CT_RM), ("weight_class", _CT_WEIGHT)):
        for c in cats:
            dums.append(f"CAST(sum(CASE WHEN {q_label(col)} = '{c}' THEN 1 ELSE 0 END) OVER {wa} AS BIGINT) AS \"total_{c}\"")
    nums = [f"CAST(sum(CAST(coalesce({c}, FALSE) AS INTEGER)) OVER {wa} AS BIGINT) AS total_{c}" for c in _CT_NUM[:3]]
    nums.append(f"round(sum(coalesce(fight_duration_seconds, 0)) OVER {wa}, 4) AS total_fight_duration_seconds")
    return f"""
WITH {RD.RAW_RESULTS_SQL}, {RD.RAW_EVENTS_SQL}, {RD.RAW_FIGHTERS_SQL},
{_clean_results_body()},
ce AS (SELECT event, event_url, CAST(try_strptime({q_strip("replace(date, chr(160), chr(32))")}, '%B %d, %Y') AS DATE) AS date FROM re),
lgc AS (SELECT fight_url, event_url, weight_class, method_type, fight_duration_seconds, title_fight, perf_bonus, fight_of_the_night,
               fighter1_url AS fighter_url, fighter1_result AS result, fighter2_url AS opp_url FROM cr
        UNION ALL SELECT fight_url, event_url, weight_class, method_type, fight_duration_seconds, title_fight, perf_bonus,
               fight_of_the_night, fighter2_url, fighter2_result, fighter1_url FROM cr),
sj AS (SELECT lgc.*, f.full_name, o.full_name AS opp_full_name, ce.event, ce.date,
              lower(lgc.result) || '_' || lower(lgc.method_type) AS rm
       FROM lgc JOIN rf f ON lgc.fighter_url = f.fighter_url JOIN rf o ON lgc.opp_url = o.fighter_url
       JOIN ce ON lgc.event_url = ce.event_url)
SELECT fight_url, fighter_url, strftime(date, '%Y-%m-%d') AS date, opp_full_name, event,
  {", ".join(dums)}, {", ".join(nums)},
  CAST(row_number() OVER (PARTITION BY fighter_url ORDER BY date ASC NULLS LAST, fight_url) AS BIGINT) AS total_fights
FROM sj
"""


@query("career_table", _career_table_sql())
def career_table(spark, d):
    """Clean results -> P1 -> J4 star join (participant, role-playing opponent, event)
    -> C16 composite label -> W4 running totals by result, result+method, weight class and
    the bonus/duration sums."""
    cr = CL.clean_results(RD.raw_results(spark, d))
    cf = CL.clean_fighters(RD.raw_fighters(spark, d))
    ce = CL.clean_events(RD.raw_events(spark, d)).select("event", "event_url", "date")
    out = PL.career_table(cr, cf, ce, categories={"result": _CT_RESULT, "result_method": _CT_RM, "weight_class": _CT_WEIGHT})
    tot = [f"total_{c}" for c in _CT_RESULT + _CT_RM + _CT_WEIGHT]
    return out.select("fight_url", "fighter_url", _day("date").alias("date"), "opp_full_name", "event", *tot,
                      *[F.col(f"total_{c}").cast("bigint").alias(f"total_{c}") for c in _CT_NUM[:3]],
                      r4("total_fight_duration_seconds").alias("total_fight_duration_seconds"), "total_fights")


@query("hot_key_asof", """
WITH p AS (SELECT event_id, ts, value, value > 25 AS band FROM events WHERE event_type = 'purchase'),
v AS (SELECT ts, value > 25 AS band, event_id AS view_id, user_id AS view_user FROM events WHERE event_type = 'view')
SELECT p.event_id, p.ts, p.band, v.view_id, v.view_user
FROM p ASOF LEFT JOIN v ON p.band = v.band AND p.ts >= v.ts
""")
def hot_key_asof(spark, d):
    """J5 with a hot ``by`` key: two value bands of ~50% of the rows each, forced through
    the skew-safe chunked strategy (a band spans many range partitions)."""
    ev = table(spark, d, "events")
    band = (F.col("value") > 25).alias("band")
    p = ev.where(F.col("event_type") == "purchase").select("event_id", "ts", band)
    v = ev.where(F.col("event_type") == "view").select("ts", band, F.col("event_id").alias("view_id"), F.col("user_id").alias("view_user"))
    return AS.asof_join(p, v, on="ts", by="band", payload=["view_id", "view_user"], direction="backward",
                        right_ties=["view_id"], strategy="chunked")


def _with_strategy(fn, strategy):
    def run(spark, d):
        return fn(spark, d, strategy=strategy)

    run.__doc__ = f"{fn.__name__} with strategy={strategy!r}: both strategies meet the same oracle."
    return run


for _name in ("career_latest", "opponent_asof", "metric_rolling", "results_stats_full"):
    for _strategy in ("chunked", "window"):
        query(f"{_name}_{_strategy}", ORACLE[_name])(_with_strategy(QUERIES[_name], _strategy))
