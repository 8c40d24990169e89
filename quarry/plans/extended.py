"""Registered queries of the recommender and of the relational, temporal and SQL operators, with their DuckDB SQL.

Doubles are rounded in the output only (factors, scores and means to 6 places, sums of money to 2).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import sqlapi
from ..operators import recommend as rc
from ..operators import relational as rl
from ..operators import temporal as tp
from ..sources import tables as tb
from ..sources import typed as ty
from ..streaming import events as ev

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


# ---------------------------------------------------------------- recommender
RANK, SWEEPS, REG = 2, 2, 0.1
CANDIDATES, BEST = 50, 5


def _ratings(spark, sf):
    """Customer, part, and how often the customer ordered it."""
    li = tb.lineitem(spark, sf, "l_orderkey", "l_partkey")
    o = tb.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    d = li.join(o, li.l_orderkey == o.o_orderkey)
    return d.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).agg(F.count("*").alias("rating"))


def _factors(spark, sf):
    return rc.Factors(_ratings(spark, sf), RANK, SWEEPS, REG)


@_query
def als_factors(spark, sf):
    f = _factors(spark, sf)
    six = [F.round(f"f{k}", 6).alias(f"f{k}") for k in range(RANK)]
    users = f.users.select(F.lit("user").alias("side"), F.col("user").alias("id"), *six)
    return users.union(f.items.select(F.lit("item"), "item", *six))


@_query
def als_error(spark, sf):
    return _factors(spark, sf).error().withColumn("rmse", F.round("rmse", 6))


@_query
def als_recommendations(spark, sf):
    f = _factors(spark, sf)
    return f.recommend(f.popular(CANDIDATES), BEST)


def _seed_sql(k: int) -> str:
    digits = f"substr(md5(item::VARCHAR || ':{k}'), 1, 6)"
    return f"list_sum([(strpos('0123456789abcdef', substr({digits}, i, 1)) - 1) * pow(16, 6 - i) for i in [1, 2, 3, 4, 5, 6]]) / pow(2, 24)"


def _half_sql(name: str, fixed: str, side: str, other: str) -> str:
    """One half sweep at rank 2: sums of outer products, then a 2 x 2 system by its determinant."""
    return f"""{name} AS MATERIALIZED (
    SELECT {side}, (b0 * a11 - b1 * a01) / (a00 * a11 - a01 * a01) AS f0, (b1 * a00 - b0 * a01) / (a00 * a11 - a01 * a01) AS f1 FROM (
        SELECT {side}, sum(f0 * f0) + {REG} AS a00, sum(f0 * f1) AS a01, sum(f1 * f1) + {REG} AS a11, sum(rating * f0) AS b0, sum(rating * f1) AS b1
        FROM ratings JOIN {fixed} USING ({other}) GROUP BY {side}))"""


_ALS = f"""
WITH ratings AS MATERIALIZED (
    SELECT o_custkey AS "user", l_partkey AS item, count(*)::DOUBLE AS rating FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
v0 AS MATERIALIZED (SELECT item, {_seed_sql(0)} AS f0, {_seed_sql(1)} AS f1 FROM (SELECT DISTINCT item FROM ratings)),
{_half_sql("u1", "v0", '"user"', "item")},
{_half_sql("v1", "u1", "item", '"user"')},
{_half_sql("u2", "v1", '"user"', "item")},
{_half_sql("v2", "u2", "item", '"user"')}
"""
SQL["als_factors"] = _ALS + """
SELECT 'user' AS side, "user" AS id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM u2 UNION ALL SELECT 'item', item, round(f0, 6), round(f1, 6) FROM v2"""
SQL["als_error"] = _ALS + """
SELECT count(*) AS n, round(sqrt(avg(pow(rating - u2.f0 * v2.f0 - u2.f1 * v2.f1, 2))), 6) AS rmse FROM ratings JOIN u2 USING ("user") JOIN v2 USING (item)"""
SQL["als_recommendations"] = _ALS + f""",
popular AS (SELECT item FROM ratings GROUP BY item ORDER BY count(*) DESC, item LIMIT {CANDIDATES}),
scored AS (
    SELECT u2."user", v2.item, round(u2.f0 * v2.f0 + u2.f1 * v2.f1, 6) AS score FROM u2 CROSS JOIN (SELECT v2.* FROM v2 JOIN popular USING (item)) v2
    WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r."user" = u2."user" AND r.item = v2.item)),
best AS (SELECT "user", row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank, item, score FROM scored)
SELECT "user", rank::INT AS rank, item, score FROM best WHERE rank <= {BEST}"""

# ---------------------------------------------------------------- as-of join


@_query
def events_previous_other(spark, sf):
    """Each event with its user's last event before it of any other type."""
    e = tb.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    kinds = F.array(*[F.lit(r[0]) for r in e.select("event_type").distinct().orderBy("event_type").collect()])  # the few types
    others = F.explode(F.filter(kinds, lambda k: k != F.col("event_type"))).alias("for_type")
    right = e.select("user_id", "ts", "event_id", "event_type", "value", others)
    left = e.withColumn("for_type", F.col("event_type"))
    columns = {"event_id": "previous_id", "event_type": "previous_type", "value": "previous_value"}
    return tp.as_of_join(left, right, ["user_id", "for_type"], "ts", "ts", "event_id", columns, strict=True).drop("for_type", "ts")


SQL["events_previous_other"] = """
WITH kinds AS (SELECT DISTINCT event_type AS for_type FROM events),
others AS (SELECT e.*, for_type FROM events e JOIN kinds ON for_type <> event_type)
SELECT e.event_id, e.user_id, e.event_type, e.value, o.event_id AS previous_id, o.event_type AS previous_type, o.value AS previous_value
FROM events e ASOF LEFT JOIN others o ON e.user_id = o.user_id AND e.event_type = o.for_type AND e.ts > o.ts"""

# ---------------------------------------------------------------- interval join
SHIFT_DAYS = 9131  # 25 years: events of 2024 against orders of 1999


@_query
def orders_events_in_window(spark, sf):
    """Events in each order's window (by priority 10 days, 2 days or 6 hours from the order's date): count and sum of value."""
    hours = F.when(F.col("o_orderpriority") == "1-URGENT", 240).when(F.col("o_orderpriority") == "2-HIGH", 48).otherwise(6)
    o = tb.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("opened"),
                                             (F.col("o_orderdate") + F.make_dt_interval(hours=hours)).alias("closed"))
    e = tb.table(spark, sf, "events").select((F.col("ts") - F.make_dt_interval(F.lit(SHIFT_DAYS))).alias("moment"), "value")
    d = tp.interval_join(o, e, "opened", "closed", "moment", totals={"value": F.col("value")})
    return d.groupBy("o_orderkey").agg(F.sum("n_points").alias("n_events"), F.round(F.sum("value"), 2).alias("value"))


SQL["orders_events_in_window"] = f"""
WITH o AS (SELECT o_orderkey, o_orderdate AS opened, o_orderdate + to_hours(CASE o_orderpriority WHEN '1-URGENT' THEN 240 WHEN '2-HIGH' THEN 48 ELSE 6 END) AS closed FROM orders),
e AS (SELECT ts - to_days({SHIFT_DAYS}) AS moment, value FROM events)
SELECT o_orderkey, count(*) AS n_events, round(sum(value), 2) AS value FROM o JOIN e ON moment >= opened AND moment < closed GROUP BY o_orderkey"""

# ---------------------------------------------------------------- sessions and frames
GAP_SECONDS, FRAME_SECONDS = 1800, 6 * 3600


@_query
def event_sessions(spark, sf):
    """Sessions of a user's events (30 minutes): place and running value in the session, mean value of the user's last six hours."""
    e = tb.table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    d = tp.sessions(e, "user_id", "ts", "event_id", GAP_SECONDS)
    d = tp.running_sums(d, ["user_id", "session"], ["ts", "event_id"], "ts", {"place": F.lit(1).cast("long"), "running": F.col("value")}, 86_400)
    d = tp.range_mean(d, ["user_id"], "ts", "value", "mean_6h", FRAME_SECONDS)
    return d.select("event_id", "user_id", "session", "place", F.round("running", 4).alias("running"), F.round("mean_6h", 6).alias("mean_6h"))


@_query
def session_summary(spark, sf):
    """One row for each session, and how the user's sessions rank by length (dense, longest first)."""
    e = tb.table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    s = tp.sessions(e, "user_id", "ts", "event_id", GAP_SECONDS).groupBy("user_id", "session").agg(
        F.count("*").alias("n_events"), (tp.micros(F.max("ts")) - tp.micros(F.min("ts"))).alias("micros"), F.round(F.max("value"), 2).alias("top"))
    w = Window.partitionBy("user_id").orderBy(F.desc("n_events"))
    return s.withColumn("length_rank", F.dense_rank().over(w)).withColumn("next_events", F.lead("n_events").over(Window.partitionBy("user_id").orderBy("session")))


_SESSIONS = f"""
WITH g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last FROM events),
s AS (
    SELECT *, sum(CASE WHEN last IS NULL OR epoch_us(ts) - epoch_us(last) > {GAP_SECONDS}000000 THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM g)"""
SQL["event_sessions"] = _SESSIONS + f"""
SELECT event_id, user_id, session, row_number() OVER w AS place, round(sum(value) OVER (w ROWS UNBOUNDED PRECEDING), 4) AS running,
    round(avg(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {FRAME_SECONDS} SECONDS PRECEDING AND CURRENT ROW), 6) AS mean_6h
FROM s WINDOW w AS (PARTITION BY user_id, session ORDER BY ts, event_id)"""
SQL["session_summary"] = _SESSIONS + """,
t AS (SELECT user_id, session, count(*) AS n_events, epoch_us(max(ts)) - epoch_us(min(ts)) AS micros, round(max(value), 2) AS top FROM s GROUP BY ALL)
SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY n_events DESC)::INT AS length_rank, lead(n_events) OVER (PARTITION BY user_id ORDER BY session) AS next_events FROM t"""

# ---------------------------------------------------------------- grouping sets


def _sales(spark, sf):
    li = tb.lineitem(spark, sf, "l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    part = tb.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    supplier = tb.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    nation = tb.table(spark, sf, "nation").select("n_nationkey", F.col("n_name"), F.col("n_regionkey").alias("r_regionkey"))
    region = tb.table(spark, sf, "region").select("r_regionkey", "r_name")
    # supplier's place first: dimension with dimension
    return li.join(part, "l_partkey").join(supplier.join(nation, "n_nationkey").join(region, "r_regionkey"), "l_suppkey")


_SALES = """FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@_query
def sales_cube(spark, sf):
    """Lines, suppliers and quantity by brand, type and region, and over all of each."""
    return rl.cube(_sales(spark, sf), ["p_brand", "p_type", "r_name"], "l_suppkey", {"quantity": F.col("l_quantity")})


SQL["sales_cube"] = f"""
SELECT p_brand, p_type, r_name, grouping_id(p_brand, p_type, r_name) AS grouping_id, count(*) AS n, count(DISTINCT l_suppkey) AS n_distinct, sum(l_quantity) AS quantity
{_SALES} GROUP BY CUBE (p_brand, p_type, r_name)"""


@_query
def sales_rollup(spark, sf):
    """Region, nation and brand from the finest to all, and brand alone (grouping sets)."""
    d = _sales(spark, sf).groupBy("r_name", "n_name", "p_brand").agg(F.sum("l_quantity").alias("q"), F.count("*").alias("c"))
    d = d.groupingSets([["r_name", "n_name", "p_brand"], ["r_name", "n_name"], ["r_name"], ["p_brand"], []], "r_name", "n_name", "p_brand")
    return d.agg(F.grouping_id().alias("grouping_id"), F.sum("q").alias("quantity"), F.sum("c").alias("n"))


SQL["sales_rollup"] = f"""
SELECT r_name, n_name, p_brand, grouping_id(r_name, n_name, p_brand) AS grouping_id, sum(l_quantity) AS quantity, count(*) AS n
{_SALES} GROUP BY GROUPING SETS ((r_name, n_name, p_brand), (r_name, n_name), (r_name), (p_brand), ())"""

# ---------------------------------------------------------------- sketches
QUANTILE = 0.9


@_query
def event_sketches(spark, sf):
    """Distinct users and the 0.9 quantile of value by sketches of day and type, merged to types and to all: exact counts, and whether the
    estimates lie within 3 % (users: of the number; value: of the rank)."""
    e = tb.table(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_type", "user_id", "value")
    daily = rl.sketches(e, ["day", "event_type"], "user_id", "value")
    out = None
    for keys in (["day", "event_type"], ["event_type"], []):
        est = rl.estimates(rl.merged(daily, keys), QUANTILE)
        cut = est.select(*keys, "quantile", "n_distinct", F.col("n").alias("sketched"))
        rows = e.join(cut, keys) if keys else e.withColumns({c: F.lit(v) for c, v in cut.first().asDict().items()})  # over all: one row
        got = rows.groupBy(*[F.col(k) for k in keys]).agg(
            F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.first("n_distinct").alias("est"), F.first("sketched").alias("sketched"),
            F.sum((F.col("value") <= F.col("quantile")).cast("long")).alias("up_to"), F.sum((F.col("value") < F.col("quantile")).cast("long")).alias("below"))
        near = (F.col("below") / F.col("n") <= QUANTILE + 0.03) & (F.col("up_to") / F.col("n") >= QUANTILE - 0.03)
        got = got.select(*[F.col(k) if k in keys else F.lit(None).cast("date" if k == "day" else "string").alias(k) for k in ("day", "event_type")], "n", "users",
                         (F.abs(F.col("est") - F.col("users")) <= F.greatest(F.lit(1.0), 0.03 * F.col("users"))).alias("users_ok"),
                         near.alias("quantile_ok"), (F.col("sketched") == F.col("n")).alias("n_ok"))
        out = got if out is None else out.union(got)
    return out.withColumn("day", F.col("day").cast("string"))


SQL["event_sketches"] = """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, count(DISTINCT user_id) AS users, true AS users_ok, true AS quantile_ok, true AS n_ok
FROM events GROUP BY GROUPING SETS ((strftime(ts, '%Y-%m-%d'), event_type), (event_type), ())"""

# ---------------------------------------------------------------- top-k and total order
TOP_PARTS = 5


@_query
def top_parts_per_nation(spark, sf):
    """The five parts of each supplier nation with the most quantity (ties: more lines, then the smaller part)."""
    d = _sales(spark, sf).groupBy("n_name", "l_partkey").agg(F.sum("l_quantity").alias("quantity"), F.count("*").alias("n"))
    return rl.top_k(d, ["n_name"], [F.desc("quantity"), F.desc("n"), F.asc("l_partkey")], TOP_PARTS)


SQL["top_parts_per_nation"] = f"""
WITH t AS (SELECT n_name, l_partkey, sum(l_quantity) AS quantity, count(*) AS n {_SALES} GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY quantity DESC, n DESC, l_partkey)::INT AS rank FROM t)
SELECT * FROM r WHERE rank <= {TOP_PARTS}"""


@_query
def order_positions(spark, sf):
    """Every order's place by price (largest first), priority and key."""
    o = tb.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return rl.positions(o, [F.desc("o_totalprice"), F.asc("o_orderpriority"), F.desc("o_orderkey")])


SQL["order_positions"] = """
SELECT o_orderkey, o_totalprice, o_orderpriority, row_number() OVER (ORDER BY o_totalprice DESC, o_orderpriority, o_orderkey DESC) AS position FROM orders"""

# ---------------------------------------------------------------- differences


@_query
def order_changes(spark, sf):
    """Orders before and after: pending ones are not there before, low priorities not after; large ones are finished and have no priority any more."""
    o = tb.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    large = tb.table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") > 250_000).alias("large"))
    new = o.filter("o_orderpriority <> '5-LOW'").join(large, "o_orderkey").select(
        "o_orderkey", "o_custkey", F.when(F.col("large"), "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(~F.col("large"), F.col("o_orderpriority")).alias("o_orderpriority"))
    return rl.snapshot_diff(o.filter("o_orderstatus <> 'P'"), new, ["o_orderkey"])


SQL["order_changes"] = """
WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 1 AS x FROM orders WHERE o_orderstatus <> 'P'),
b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 250000 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_totalprice <= 250000 THEN o_orderpriority END AS o_orderpriority, 1 AS x FROM orders WHERE o_orderpriority <> '5-LOW'),
j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.x AS ax, b.x AS bx, a.o_custkey IS DISTINCT FROM b.o_custkey AS d1,
    a.o_orderstatus IS DISTINCT FROM b.o_orderstatus AS d2, a.o_orderpriority IS DISTINCT FROM b.o_orderpriority AS d3 FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT o_orderkey, CASE WHEN ax IS NULL THEN 'added' WHEN bx IS NULL THEN 'removed' ELSE 'changed' END AS change,
    CASE WHEN ax IS NULL OR bx IS NULL THEN '' ELSE concat_ws(',', CASE WHEN d1 THEN 'o_custkey' END, CASE WHEN d2 THEN 'o_orderstatus' END, CASE WHEN d3 THEN 'o_orderpriority' END) END AS columns
FROM j WHERE ax IS NULL OR bx IS NULL OR d1 OR d2 OR d3"""


def _word_bags(spark, sf):
    """Words of the texts by source as two multisets: those of longer and of shorter documents."""
    w = tb.table(spark, sf, "documents").select("source", "n_chars", F.explode(F.split(F.lower(F.trim("text")), r"[ \t\n\x0B\f\r]+")).alias("word"))
    return w.filter("n_chars >= 1000").select("source", "word"), w.filter("n_chars < 1000").select("source", "word")


@_query
def words_except_all(spark, sf):
    return rl.except_all(*_word_bags(spark, sf))


@_query
def words_intersect_all(spark, sf):
    return rl.intersect_all(*_word_bags(spark, sf))


_BAGS = r"""
WITH w AS (SELECT source, n_chars, unnest(string_split_regex(lower(trim(text)), '[ \t\n\x0B\f\r]+')) AS word FROM documents),
a AS (SELECT source, word FROM w WHERE n_chars >= 1000), b AS (SELECT source, word FROM w WHERE n_chars < 1000)"""
SQL["words_except_all"] = _BAGS + " SELECT source, word, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY source, word"
SQL["words_intersect_all"] = _BAGS + " SELECT source, word, count(*) AS n FROM (SELECT * FROM a INTERSECT ALL SELECT * FROM b) GROUP BY source, word"

# ---------------------------------------------------------------- streams
WINDOW_H, SLIDE_H, DELAY_H, WITHIN_H = 6, 2, 1, 6


def _arriving(spark, sf, *cols):
    """Events with a time, the folder in which they arrive, and whether they are of the first half of the time that all span."""
    e = tb.table(spark, sf, "events").filter("ts is not null").select("ts", *cols)
    first, last = e.agg(F.min("ts"), F.max("ts")).first()
    half = F.col("ts") < F.lit(first + (last - first) / 2 if first else None)
    # a time zone is what watermarks need; it is put on and taken off in the same session
    return e.withColumn("early", half).withColumn("ts", F.col("ts").cast("timestamp")), ty.new_folder(spark, "arriving")


def _in_two_runs(spark, path, first, second, flow):
    """What ``flow`` makes of the stream of ``path``, stopped after ``first`` has arrived and started again with the rest."""
    out, state = ty.new_folder(spark, "streamed"), ty.new_folder(spark, "state")
    for part in (first, second):
        part.write.mode("append").parquet(path)
        d = ev.run(flow(lambda: ev.source(spark, path, part.schema)), out, state)
    return d


@_query
def event_windows_streamed(spark, sf):
    """Events by type in windows of six hours, every two hours, of a stream in two runs; errors of the first half arrive
    with the second run, most too late for their windows."""
    e, path = _arriving(spark, sf, "event_type", "value")
    now = F.col("early") & (F.col("event_type") != "error")
    e, keys = e.withColumn("now", F.coalesce(now, F.lit(False))), ["event_type"]
    measures = [F.count(F.lit(1)).alias("n"), F.max("value").alias("top")]
    how = {"size": f"{WINDOW_H} hours", "slide": f"{SLIDE_H} hours", "delay": f"{DELAY_H} hours"}
    d = _in_two_runs(spark, path, e.filter("now"), e.filter("not now"), lambda s: ev.sliding_windows(s(), keys, measures, **how))
    d = ev.late_rows(d, spark.read.parquet(path), keys, **how)
    return d.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "event_type", "n", "top", "late")


SQL["event_windows_streamed"] = f"""
WITH e AS (SELECT *, event_type <> 'error' AND ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) AS early FROM events WHERE ts IS NOT NULL),
marks AS (SELECT date_trunc('milliseconds', max(ts) FILTER (WHERE early)) - INTERVAL {DELAY_H} HOUR AS one,
    date_trunc('milliseconds', max(ts)) - INTERVAL {DELAY_H} HOUR AS two FROM e),
w AS (SELECT e.*, time_bucket(INTERVAL {SLIDE_H} HOUR, ts) - k * INTERVAL {SLIDE_H} HOUR AS s FROM e, range({WINDOW_H // SLIDE_H}) r(k)),
m AS (SELECT w.*, s + INTERVAL {WINDOW_H} HOUR AS t, early OR s + INTERVAL {WINDOW_H} HOUR > one AS counted, two FROM w, marks)
SELECT strftime(s, '%Y-%m-%d %H:%M') AS window_start, event_type, CASE WHEN bool_or(counted) THEN count(*) FILTER (WHERE counted) END AS n,
    max(value) FILTER (WHERE counted) AS top, count(*) FILTER (WHERE NOT counted) AS late
FROM m WHERE t <= two GROUP BY s, event_type"""


@_query
def events_delivered_once(spark, sf):
    """Every event once, from a stream in two runs that brings each event of a run twice and the first run's again."""
    e, path = _arriving(spark, sf, "event_id", "user_id", "event_type")
    early, rest = e.filter("early"), e.filter("not early")
    d = _in_two_runs(spark, path, early.union(early), rest.union(rest).union(early), lambda s: ev.once(s(), ["event_id"]))
    return d.select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("second"))


SQL["events_delivered_once"] = "SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second FROM events WHERE ts IS NOT NULL"


@_query
def views_then_purchases_streamed(spark, sf):
    """Views with the purchases of their user in the next six hours, by a join of two streams in two runs."""
    e, path = _arriving(spark, sf, "event_id", "user_id", "event_type", "value")

    def flow(s):
        of = lambda t: s().filter(F.col("event_type") == t).select("event_id", "user_id", "ts", "value")
        return ev.followed_by(of("view"), of("purchase"), "user_id", 3600 * WITHIN_H)

    d = _in_two_runs(spark, path, e.filter("early"), e.filter("not early"), flow)
    return d.select(F.col("first_event_id").alias("view_id"), F.col("then_event_id").alias("purchase_id"), F.col("first_user_id").alias("user_id"), F.col("then_value").alias("value"))


SQL["views_then_purchases_streamed"] = f"""
SELECT a.event_id AS view_id, b.event_id AS purchase_id, a.user_id, b.value FROM events a JOIN events b ON a.user_id = b.user_id
    AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL {WITHIN_H} HOUR WHERE a.event_type = 'view' AND b.event_type = 'purchase'"""

# ---------------------------------------------------------------- the SQL surface


@_query
def sql_event_props(spark, sf):
    """Typed columns from the JSON of events, through SQL text, SQL-defined functions and views."""
    sqlapi.register(spark, {t: tb.table(spark, sf, t) for t in ("events", "orders", "customer")})
    return spark.sql(sqlapi.EVENT_PROPS)


SQL["sql_event_props"] = """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, CASE WHEN k < 10 THEN 'low' WHEN k < 50 THEN 'mid' ELSE 'high' END AS band, count(*) AS n, sum(k)::BIGINT AS k_sum, max(hour(ts))::INT AS last_hour
FROM (SELECT *, (props::JSON ->> '$.k')::BIGINT AS k FROM events) GROUP BY 1, 2, 3"""


@_query
def sql_customer_orders(spark, sf):
    """Orders of a year by segment through a SQL table function over a view."""
    sqlapi.register(spark, {t: tb.table(spark, sf, t) for t in ("events", "orders", "customer")})
    return spark.sql(sqlapi.CUSTOMER_ORDERS)


SQL["sql_customer_orders"] = """
SELECT c_mktsegment, quarter(o_orderdate)::INT AS quarter, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(strftime(o_orderdate, '%Y-%m-%d')) AS first_day
FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) = 1998 GROUP BY 1, 2"""

# ---------------------------------------------------------------- sinks and typed sources
_ORDER_ROW = "o_orderkey bigint, o_custkey bigint, price double, day date"


def _order_lines_again(spark, sf, fmt):
    """Orders as lines of text by status, written twice (the second time finished ones only, which are wrong at first), read back typed.

    Pending orders of low priority have no number for a price: rejects."""
    o = tb.table(spark, sf, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    price = F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    if fmt == "csv":
        line = lambda p: F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), p, "day")
    else:
        line = lambda p: F.format_string('{"o_orderkey":%d,"o_custkey":%d,"price":%s,"day":"%s"}', "o_orderkey", "o_custkey", p, "day")
    path = ty.new_folder(spark, "orders")
    first = F.when(F.col("o_orderstatus") == "F", F.lit("0")).otherwise(price)
    ty.write_partitioned(o.select(line(first).alias("value"), "o_orderstatus"), path, ["o_orderstatus"], "text")
    ty.write_partitioned(o.filter("o_orderstatus = 'F'").select(line(price).alias("value"), "o_orderstatus"), path, ["o_orderstatus"], "text")
    d = ty.read_typed(spark, path, fmt, spark.createDataFrame([], _ORDER_ROW).schema)
    return d.withColumn("day", F.col("day").cast("string"))


@_query
def orders_csv_again(spark, sf):
    return _order_lines_again(spark, sf, "csv")


@_query
def orders_json_again(spark, sf):
    return _order_lines_again(spark, sf, "json")


def _again_sql(line: str) -> str:
    return f"""
WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AS bad FROM orders)
SELECT CASE WHEN NOT bad THEN o_orderkey END AS o_orderkey, CASE WHEN NOT bad THEN o_custkey END AS o_custkey, CASE WHEN NOT bad THEN o_totalprice END AS price,
    CASE WHEN NOT bad THEN d END AS day, o_orderstatus, CASE WHEN bad THEN {line} END AS reject FROM o"""


SQL["orders_csv_again"] = _again_sql("o_orderkey || ',' || o_custkey || ',n/a,' || d")
SQL["orders_json_again"] = _again_sql("""'{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"price":n/a,"day":"' || d || '"}'""")
