"""Panels, flows and allocation over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import effective_flag, growth_rate
from panelkit.operators import (
    coalesce_columns,
    densify,
    enrich,
    fill_nulls,
    flow_balance,
    lag_value,
    outer_panel,
    prorate_by_year,
    rejected_periods,
    semi_filter,
    union_distinct,
)
from panelkit.plans import gold
from panelkit.sources import checkpointed
from parity.registry import query
from parity.views import (
    cents,
    customer_year,
    funding,
    location,
    nation_year,
    routes,
    table,
    with_ctes,
)

ROUTES_SQL = """
    , summed AS (
      SELECT coalesce(p.year, s.year) AS year, coalesce(p.coo_iso, s.coo_iso) AS coo_iso,
             coalesce(p.coa_iso, s.coa_iso) AS coa_iso, coalesce(p.coo_name, s.coo_name) AS coo_name,
             coalesce(p.coa_name, s.coa_name) AS coa_name,
             coalesce(refugees, 0) AS refugees, coalesce(asylum_seekers, 0) AS asylum_seekers,
             coalesce(oip, 0) AS oip, coalesce(idps, 0) AS idps,
             coalesce(returned_refugees, 0) AS returned_refugees, coalesce(resettlement, 0) AS resettlement,
             coalesce(naturalisation, 0) AS naturalisation, coalesce(returned_idps, 0) AS returned_idps
      FROM population p FULL JOIN solutions s
        ON p.year = s.year AND p.coo_iso = s.coo_iso AND p.coa_iso = s.coa_iso),
    totals AS (
      SELECT *, refugees + asylum_seekers + oip + idps AS stock,
             returned_refugees + resettlement + naturalisation + returned_idps AS outflows
      FROM summed),
    routes AS (
      SELECT *, stock - lag(stock) OVER (PARTITION BY coo_iso, coa_iso ORDER BY year) + outflows AS inflows
      FROM totals)"""


@query(sql=with_ctes("population", "solutions", body=f"{ROUTES_SQL} SELECT * FROM routes"))
def route_matrix(spark: SparkSession, d: str) -> DataFrame:
    return gold.displacement(*routes(spark, d))


@query(sql=with_ctes("population", "solutions", body=f"""
    {ROUTES_SQL}
    SELECT year, coo_iso, coa_iso, stock, outflows,
           CASE WHEN inflows IS NOT NULL THEN greatest(0, inflows) END AS inflows
    FROM routes"""))
def route_matrix_floored(spark: SparkSession, d: str) -> DataFrame:
    floored = gold.displacement(*routes(spark, d), floor_zero=True)
    return floored.select("year", "coo_iso", "coa_iso", "stock", "outflows", "inflows")


HOSTS_SQL = f"""
    {ROUTES_SQL},
    host_names AS (SELECT coa_iso, min(coa_name) AS coa_name FROM routes WHERE coa_name IS NOT NULL GROUP BY 1),
    host_sums AS (
      SELECT coa_iso, year, CAST(sum(refugees) AS BIGINT) AS refugees_count,
             CAST(sum(asylum_seekers) AS BIGINT) AS asylum_seekers_count, CAST(sum(oip) AS BIGINT) AS oip_count,
             CAST(sum(idps) AS BIGINT) AS idps_count, CAST(sum(stock) AS BIGINT) AS total_hosted_stock,
             CAST(sum(inflows) AS BIGINT) AS total_inflows, CAST(sum(outflows) AS BIGINT) AS total_outflows
      FROM routes GROUP BY 1, 2),
    years AS (SELECT CAST(unnest(generate_series(min(year), max(year))) AS INT) AS year FROM routes),
    dense AS (
      SELECT coa_iso, coa_name, year, coalesce(refugees_count, 0) AS refugees_count,
             coalesce(asylum_seekers_count, 0) AS asylum_seekers_count, coalesce(oip_count, 0) AS oip_count,
             coalesce(idps_count, 0) AS idps_count, coalesce(total_hosted_stock, 0) AS total_hosted_stock,
             coalesce(total_inflows, 0) AS total_inflows, coalesce(total_outflows, 0) AS total_outflows
      FROM host_names CROSS JOIN years LEFT JOIN host_sums USING (coa_iso, year)),
    lagged AS (
      SELECT *, lag(total_hosted_stock) OVER (PARTITION BY coa_iso ORDER BY year) AS hosted_stock_lag1
      FROM dense),
    hosts AS (
      SELECT *, CASE WHEN hosted_stock_lag1 = 0 AND total_hosted_stock = 0 THEN 0e0
                     WHEN hosted_stock_lag1 <> 0
                     THEN (total_hosted_stock - hosted_stock_lag1) / hosted_stock_lag1 END AS growth_rate
      FROM lagged)"""


@query(sql=with_ctes("population", "solutions", body=f"{HOSTS_SQL} SELECT * FROM hosts"))
def host_aggregates(spark: SparkSession, d: str) -> DataFrame:
    """The routes are used three times over, so they are written first, as in the lakehouse."""
    return gold.host_aggregates(checkpointed(gold.displacement(*routes(spark, d))))


@query(sql=with_ctes("population", "solutions", body="""
    , stocks AS (
      SELECT coa_iso AS location_code, year,
             CAST(sum(refugees) + sum(asylum_seekers) AS BIGINT) AS stock_hosted
      FROM population WHERE coa_iso <> coo_iso GROUP BY 1, 2),
    left_ AS (
      SELECT coa_iso AS location_code, year,
             CAST(sum(coalesce(returned_refugees, 0) + coalesce(resettlement, 0)
                      + coalesce(naturalisation, 0)) AS BIGINT) AS tracked_outflow
      FROM solutions WHERE coa_iso <> coo_iso GROUP BY 1, 2),
    balanced AS (
      SELECT *, stock_hosted - lag(stock_hosted) OVER (PARTITION BY location_code ORDER BY year)
                + coalesce(tracked_outflow, 0) AS balance
      FROM stocks LEFT JOIN left_ USING (location_code, year))
    SELECT location_code, year, stock_hosted, tracked_outflow,
           CASE WHEN balance IS NOT NULL THEN greatest(0, balance) END AS real_inflow,
           CASE WHEN balance IS NOT NULL THEN greatest(0, -balance) END AS untracked_outflow
    FROM balanced"""))
def hosted_flows(spark: SparkSession, d: str) -> DataFrame:
    return gold.hosted_flows(*routes(spark, d))


@query(name="flow_balance", sql=with_ctes("customer_year", body="""
    , balanced AS (
      SELECT o_custkey, year, n_orders, settled,
             n_orders - lag(n_orders) OVER (PARTITION BY o_custkey ORDER BY year) + coalesce(settled, 0) AS balance
      FROM customer_year LEFT JOIN (
        SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year, count(*) AS settled
        FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2) USING (o_custkey, year))
    SELECT o_custkey, year, n_orders, settled, greatest(0, balance) AS real_inflow,
           greatest(0, -balance) AS untracked_outflow
    FROM balanced WHERE balance IS NOT NULL
    UNION ALL
    SELECT o_custkey, year, n_orders, settled, NULL, NULL FROM balanced WHERE balance IS NULL"""))
def flow_balance_by_customer(spark: SparkSession, d: str) -> DataFrame:
    """Orders placed as the stock, orders settled as the outflow; many customers shrink."""
    settled = table(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy(
        "o_custkey", F.year("o_orderdate").alias("year")
    ).agg(F.count(F.lit(1)).alias("settled"))
    stock = customer_year(spark, d).drop("amount_cents")
    both = outer_panel([stock, settled], ["o_custkey", "year"], anchors=[0])
    return flow_balance(both, ["o_custkey"], "year", "n_orders", "settled")


DENSE_SQL = """
    , years AS (SELECT CAST(unnest(generate_series(min(year), max(year))) AS INT) AS year FROM customer_year),
    dense AS (
      SELECT c.o_custkey, y.year, coalesce(n_orders, 0) AS n_orders, coalesce(amount_cents, 0) AS amount_cents
      FROM (SELECT DISTINCT o_custkey FROM customer_year) c CROSS JOIN years y
           LEFT JOIN customer_year t ON t.o_custkey = c.o_custkey AND t.year = y.year)"""


@query(sql=with_ctes("customer_year", body=f"{DENSE_SQL} SELECT * FROM dense"))
def dense_grid(spark: SparkSession, d: str) -> DataFrame:
    """Every customer in every year, 0 where nothing was ordered."""
    orders = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    return densify(
        customer_year(spark, d), "o_custkey", "year", {"n_orders": 0, "amount_cents": 0},
        entities=orders.select("o_custkey").distinct(), span=orders,
    )


@query(name="growth_rate", sql=with_ctes("customer_year", body=f"""
    {DENSE_SQL},
    lagged AS (SELECT *, lag(n_orders) OVER (PARTITION BY o_custkey ORDER BY year) AS n_orders_lag1 FROM dense)
    SELECT o_custkey, year, n_orders, n_orders_lag1,
           CASE WHEN n_orders_lag1 = 0 AND n_orders = 0 THEN 0e0
                WHEN n_orders_lag1 <> 0 THEN (n_orders - n_orders_lag1) / n_orders_lag1 END AS growth_rate
    FROM lagged"""))
def growth_rate_on_grid(spark: SparkSession, d: str) -> DataFrame:
    """Zero-safe growth on the dense grid: still zero, from zero, to zero."""
    lagged = lag_value(dense_grid(spark, d).drop("amount_cents"), ["o_custkey"], "year", "n_orders")
    return lagged.withColumn("growth_rate", growth_rate(F.col("n_orders"), F.col("n_orders_lag1")))


PANEL_SQL = """
    , bought AS (SELECT o_custkey, year, n_orders FROM customer_year),
    urgent AS (SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year, count(*) AS n_urgent,
                      CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS urgent_cents
               FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2),
    shipped AS (SELECT o_custkey, CAST(year(l_shipdate) AS INT) AS year, count(*) AS n_lines
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY 1, 2),
    panel AS (SELECT o_custkey, year, n_orders, coalesce(n_urgent, 0) AS n_urgent, urgent_cents, n_lines
              FROM bought FULL JOIN urgent USING (o_custkey, year) FULL JOIN shipped USING (o_custkey, year))"""


@query(sql=with_ctes("customer_year", body=f"""
    {PANEL_SQL}
    SELECT p.*, coalesce(c_name, 'unknown') AS c_name FROM panel p LEFT JOIN customer ON c_custkey = o_custkey"""))
def panel_outer(spark: SparkSession, d: str) -> DataFrame:
    """Three sources per customer and year; returns by the year of shipment open further keys."""
    orders = table(spark, d, "orders")
    urgent = orders.filter("o_orderpriority = '1-URGENT'").groupBy(
        "o_custkey", F.year("o_orderdate").alias("year")
    ).agg(F.count(F.lit(1)).alias("n_urgent"), F.sum(cents("o_totalprice")).alias("urgent_cents"))
    shipped = (
        table(spark, d, "lineitem").filter("l_returnflag = 'R'")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", F.year("l_shipdate").alias("year")).agg(F.count(F.lit(1)).alias("n_lines"))
    )
    bought = customer_year(spark, d).drop("amount_cents")
    panel = outer_panel([bought, urgent, shipped], ["o_custkey", "year"])
    names = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    named = enrich(fill_nulls(panel, 0, ["n_urgent"]), [names], ["o_custkey"]).withColumn("_none", F.lit("unknown"))
    return coalesce_columns(named, "c_name", "c_name", "_none")


@query(sql=with_ctes("customer_year", body=f"""
    {PANEL_SQL}
    SELECT o_custkey, year, n_lines, lag(n_lines) OVER (PARTITION BY o_custkey ORDER BY year) AS n_lines_lag1
    FROM panel"""))
def lag_panel(spark: SparkSession, d: str) -> DataFrame:
    """The lag runs over the joined panel, whose rows may come from any source."""
    panel = panel_outer(spark, d).select("o_custkey", "year", "n_lines")
    return lag_value(panel, ["o_custkey"], "year", "n_lines")


@query(sql=with_ctes("customer_year", body="""
    SELECT o_custkey, year, n_orders, amount_cents, c_mktsegment, n_name, r_name
    FROM customer_year LEFT JOIN customer ON o_custkey = c_custkey
         LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""))
def left_enrich(spark: SparkSession, d: str) -> DataFrame:
    places = table(spark, d, "nation").join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    ).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"
    )
    known = enrich(customer_year(spark, d), [customers], ["o_custkey"])
    return enrich(known, [places], ["c_nationkey"]).drop("c_nationkey")


@query(name="semi_filter", sql="""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def semi_filter_orders(spark: SparkSession, d: str) -> DataFrame:
    segment = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey")
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return semi_filter(orders, segment, ["o_custkey"])


@query(name="union_distinct", sql="""
    SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier""")
def nations_seen(spark: SparkSession, d: str) -> DataFrame:
    return union_distinct(
        [table(spark, d, "customer"), table(spark, d, "supplier")], [["c_nationkey"], ["s_nationkey"]], ["nationkey"]
    )


@query(name="effective_flag", sql=with_ctes("nation_year", "location", body="""
    SELECT t.location_code, t.year,
           CASE WHEN l.year IS NULL OR t.year < l.year THEN false ELSE coalesce(has_hrp, false) END AS has_hrp,
           CASE WHEN l.year IS NULL OR t.year < l.year THEN false ELSE coalesce(in_gho, false) END AS in_gho
    FROM nation_year t LEFT JOIN location l ON t.location_code = l.code"""))
def effective_flags(spark: SparkSession, d: str) -> DataFrame:
    entries = location(spark, d).select(
        F.col("code").alias("location_code"), "has_hrp", "in_gho", F.col("year").alias("effective")
    )
    return nation_year(spark, d).join(entries, "location_code", "left").select(
        "location_code", "year",
        effective_flag(F.col("year"), F.col("effective"), F.col("has_hrp")).alias("has_hrp"),
        effective_flag(F.col("year"), F.col("effective"), F.col("in_gho")).alias("in_gho"),
    )


# The SQL counts the days one by one, to check the closed form against.
@query(sql=with_ctes("funding", body="""
    , dated AS (
      SELECT *, date_diff('day', reference_period_start, reference_period_end) + 1 AS total_days
      FROM funding WHERE year(reference_period_start) <= year(reference_period_end)),
    days AS (
      SELECT o_orderkey, year(CAST(unnest(generate_series(reference_period_start, reference_period_end,
                                                          INTERVAL 1 DAY)) AS DATE)) AS y
      FROM dated WHERE year(reference_period_start) < year(reference_period_end)),
    shares AS (
      SELECT o_orderkey, CAST(y AS INT) AS alloc_year, count(*) / total_days AS share
      FROM days JOIN dated USING (o_orderkey) GROUP BY o_orderkey, y, total_days
      UNION ALL
      SELECT o_orderkey, CAST(year(reference_period_start) AS INT), 1e0
      FROM dated WHERE year(reference_period_start) = year(reference_period_end))
    SELECT location_code, o_orderkey, alloc_year AS year,
           share * funding_usd AS funding, share * requirements_usd AS requirements
    FROM shares JOIN dated USING (o_orderkey)"""))
def prorata_alloc(spark: SparkSession, d: str) -> DataFrame:
    appeals = funding(spark, d).drop("year", "ingested_at", "appeal_code")
    spread = prorate_by_year(
        appeals, "reference_period_start", "reference_period_end",
        {"funding": "funding_usd", "requirements": "requirements_usd"},
    )
    return spread.select("location_code", "o_orderkey", "year", "funding", "requirements")


@query(name="rejected_periods", sql=with_ctes("funding", body="""
    SELECT location_code, count(*) AS n_rejected FROM funding
    WHERE reference_period_end IS NULL OR year(reference_period_end) < year(reference_period_start)
    GROUP BY location_code"""))
def rejected_by_nation(spark: SparkSession, d: str) -> DataFrame:
    rejected = rejected_periods(funding(spark, d), "reference_period_start", "reference_period_end")
    return rejected.groupBy("location_code").agg(F.count(F.lit(1)).alias("n_rejected"))
