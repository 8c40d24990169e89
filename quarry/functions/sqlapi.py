"""The SQL surface: views over tables and operators, and functions defined in SQL.

``register`` makes temporary views and functions of the session, so that the same
answers come from SQL text: ``spark.sql("SELECT ... FROM quarry_events")``. The functions are
SQL expressions that the optimizer inlines; no Python runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PROPS = "struct<k: bigint>"

#: name -> definition: scalar functions, then a table function over the views.
FUNCTIONS = {
    "quarry_props": f"(props STRING) RETURNS {PROPS.upper()} RETURN from_json(props, 'k BIGINT', map('mode', 'PERMISSIVE'))",
    "quarry_band": "(k BIGINT) RETURNS STRING RETURN element_at(map(0, 'low', 1, 'mid', 2, 'high'), CASE WHEN k < 10 THEN 0 WHEN k < 50 THEN 1 ELSE 2 END)",
    "quarry_jaccard": "(a ARRAY<STRING>, b ARRAY<STRING>) RETURNS DOUBLE RETURN CASE WHEN size(array_union(a, b)) = 0 THEN double('NaN') "
                      "ELSE size(array_intersect(a, b)) / size(array_union(a, b)) END",
    "quarry_words": r"(value STRING) RETURNS ARRAY<STRING> RETURN array_distinct(filter(split(lower(value), '[ \\t\\n\\x0B\\f\\r]+'), w -> w <> ''))",
}
TABLE_FUNCTIONS = {
    "quarry_orders_of": "(wanted INT) RETURNS TABLE (o_orderkey BIGINT, c_mktsegment STRING, o_orderdate TIMESTAMP, o_totalprice DOUBLE) "
                        "RETURN SELECT o_orderkey, c_mktsegment, CAST(o_orderdate AS TIMESTAMP), o_totalprice FROM quarry_orders JOIN quarry_customer ON o_custkey = c_custkey WHERE year(o_orderdate) = wanted",
}

EVENT_PROPS = """
SELECT date_format(ts, 'yyyy-MM-dd') AS day, event_type, quarry_band(p.k) AS band, count(*) AS n, sum(p.k) AS k_sum, max(hour(ts)) AS last_hour
FROM (SELECT ts, event_type, quarry_props(props) AS p FROM quarry_events) GROUP BY ALL"""

CUSTOMER_ORDERS = """
SELECT c_mktsegment, quarter(o_orderdate) AS quarter, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(date_format(o_orderdate, 'yyyy-MM-dd')) AS first_day
FROM quarry_orders_of(1998) GROUP BY ALL"""


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Views ``quarry_<table>`` and the functions; a table function is made where its views are."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"quarry_{name}")
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    if {"orders", "customer"} <= set(tables):
        for name, body in TABLE_FUNCTIONS.items():
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
