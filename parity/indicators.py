"""Indicators over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import (
    count_known,
    count_true,
    gap_ratio,
    guarded_ratio,
    log_index,
    per_capita,
    ratio,
    tier,
)
from panelkit.operators import (
    any_flag,
    appeal_funding,
    at_max_level,
    category_features,
    distribution,
    lag_value,
    minmax_score,
    outer_panel,
    peak_by,
    risk_profile,
    top,
    yoy_growth,
)
from panelkit.plans import gold
from panelkit.sources import checkpointed
from parity.registry import query, rnd
from parity.views import (
    cents,
    conflict_events,
    customer_year,
    foodsecurity,
    funding,
    nation_year,
    needs,
    povertyrate,
    table,
    wb_extreme_poverty,
    wb_mpm,
    with_ctes,
)

COVERAGE_SQL = """
    , totals AS (
      SELECT location_code, year, CAST(sum(CAST(round(funding_usd * 100) AS BIGINT)) AS BIGINT) / 1e2 AS received,
             CAST(sum(CAST(round(requirements_usd * 100) AS BIGINT)) AS BIGINT) / 1e2 AS required
      FROM funding GROUP BY 1, 2),
    covered AS (
      SELECT *, CASE WHEN required > 0 THEN received / required END AS coverage,
             CASE WHEN required > 0 THEN 1 - coalesce(received, 0) / required END AS gap
      FROM totals)"""


@query(sql=with_ctes("funding", body=f"""
    {COVERAGE_SQL}
    SELECT *, lag(coverage) OVER (PARTITION BY location_code ORDER BY year) AS coverage_lag1,
           CASE WHEN gap <= 0.3 THEN 'Low' WHEN gap <= 0.5 THEN 'Medium' WHEN gap <= 0.7 THEN 'High'
                WHEN gap IS NOT NULL THEN 'Critical' END AS gap_tier
    FROM covered"""))
def coverage_ratio(spark: SparkSession, d: str) -> DataFrame:
    def total(c):
        return F.sum(cents(c)) / 100.0

    totals = funding(spark, d).groupBy("location_code", "year").agg(
        total("funding_usd").alias("received"), total("requirements_usd").alias("required")
    )
    covered = totals.withColumns({
        "coverage": guarded_ratio(F.col("received"), F.col("required")),
        "gap": gap_ratio(F.col("required"), F.col("received")),
    }).withColumn("gap_tier", tier(F.col("gap"), gold.FUNDING_GAP_BOUNDS, inclusive=True))
    return lag_value(covered, ["location_code"], "year", "coverage")


APPEALS_SQL = f"""
    , newest AS (
      SELECT location_code, year, appeal_code, requirements_usd, funding_usd FROM (
        SELECT *, row_number() OVER (PARTITION BY location_code, year, appeal_code
                                     ORDER BY ingested_at DESC, requirements_usd DESC,
                                              funding_usd DESC NULLS LAST) AS v
        FROM funding WHERE requirements_usd > 0) WHERE v = 1),
    totals AS (
      SELECT location_code, year, count(appeal_code) AS num_appeals,
             {rnd("sum(CAST(round(requirements_usd * 100) AS BIGINT)) / 100", 2)} AS total_required_usd,
             {rnd("sum(CAST(round(funding_usd * 100) AS BIGINT)) / 100", 2)} AS total_received_usd
      FROM newest GROUP BY 1, 2),
    pct AS (
      SELECT *, {rnd("total_required_usd - total_received_usd", 2)} AS funding_gap_usd,
             {rnd("total_received_usd * 1e2 / total_required_usd", 2)} AS funding_coverage_pct
      FROM totals),
    appeals AS (
      SELECT *, funding_coverage_pct > 100 AS is_funding_anomalous,
             CASE WHEN year - lag(year) OVER w = 1 THEN lag(funding_coverage_pct) OVER w END AS funding_coverage_lag1
      FROM pct WINDOW w AS (PARTITION BY location_code ORDER BY year))"""


def rounded_money(df: DataFrame) -> DataFrame:
    """Sums of doubles to the cent, so that they do not depend on the order of the rows."""
    money = ("total_required_usd", "total_received_usd", "funding_gap_usd")
    return df.withColumns({c: F.round(c, 2) for c in money if c in df.columns})


@query(name="appeal_funding", sql=with_ctes("funding", body=f"{APPEALS_SQL} SELECT * FROM appeals"))
def appeals_by_nation(spark: SparkSession, d: str) -> DataFrame:
    return rounded_money(appeal_funding(
        funding(spark, d), ["location_code"], "year", "appeal_code", "requirements_usd", "funding_usd", "ingested_at"
    ))


@query(sql=with_ctes("funding", body="""
    SELECT location_code, year, arg_max_null(funding_usd, (ingested_at, coalesce(funding_usd, -1))) AS funding_outside_appeals_usd
    FROM funding WHERE appeal_code = 'Not specified' GROUP BY 1, 2"""))
def funding_outside_appeals(spark: SparkSession, d: str) -> DataFrame:
    return gold.funding_outside_appeals(funding(spark, d))


@query(sql="""
    SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM (
      SELECT *, max(l_linenumber) OVER (PARTITION BY l_suppkey, l_orderkey) AS top_line FROM lineitem)
    WHERE l_linenumber = top_line""")
def max_level_filter(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return at_max_level(lines, ["l_suppkey", "l_orderkey"], "l_linenumber")


CONFLICT_SQL = """
    , finest AS (
      SELECT * FROM (SELECT *, max(admin_level) OVER (PARTITION BY location_code, year) AS top FROM conflict_events)
      WHERE admin_level = top),
    conflict AS (
      SELECT location_code, year,
             CAST(coalesce(sum(fatalities) FILTER (event_type = 'political_violence'), 0) AS BIGINT) AS total_fatalities,
             CAST(coalesce(sum(events) FILTER (event_type = 'political_violence'), 0) AS BIGINT) AS violent_events,
             CAST(coalesce(sum(events) FILTER (event_type = 'civilian_targeting'), 0) AS BIGINT)
               AS civilian_targeting_events,
             CAST(coalesce(sum(fatalities) FILTER (event_type = 'civilian_targeting'), 0) AS BIGINT)
               AS civilian_targeting_fatalities,
             CAST(coalesce(sum(events) FILTER (event_type = 'demonstration'), 0) AS BIGINT) AS non_violent_events
      FROM finest GROUP BY 1, 2)"""


@query(sql=with_ctes("conflict_events", body=f"{CONFLICT_SQL} SELECT * FROM conflict"))
def conditional_pivot(spark: SparkSession, d: str) -> DataFrame:
    return gold.conflict_features(conflict_events(spark, d))


@query(sql="""
    SELECT l_partkey, CAST(sum(l_quantity) FILTER (l_returnflag = 'R') AS BIGINT) AS returned,
           CAST(sum(l_quantity) FILTER (l_returnflag = 'A') AS BIGINT) AS accepted
    FROM (SELECT *, max(l_linenumber) OVER (PARTITION BY l_partkey) AS top FROM lineitem)
    WHERE l_linenumber = top GROUP BY l_partkey""")
def category_features_by_part(spark: SparkSession, d: str) -> DataFrame:
    """Conditional sums over each part's highest line number; NULL instead of 0 to match the SQL."""
    lines = table(spark, d, "lineitem").select(
        "l_partkey", "l_linenumber", "l_returnflag", F.col("l_quantity").cast("bigint").alias("qty")
    )
    sums = category_features(
        lines, ["l_partkey"], "l_linenumber", "l_returnflag", {"returned": ("R", "qty"), "accepted": ("A", "qty")}
    )
    return sums.withColumns({c: F.nullif(c, F.lit(0)) for c in ("returned", "accepted")})


POVERTY_SQL = """
    , poverty AS (
      SELECT location_code, year, mpi, hdx_head, hdx_vuln, hdx_sev, mpm, ext_pov
      FROM (SELECT location_code, year, avg(mpi) AS mpi, avg(headcount_ratio) AS hdx_head,
                   avg(vulnerable_to_poverty) AS hdx_vuln, avg(in_severe_poverty) AS hdx_sev
            FROM povertyrate WHERE admin_level = 0 GROUP BY 1, 2)
           FULL JOIN (SELECT location_code, year, avg(mpm_value) AS mpm FROM wb_mpm GROUP BY 1, 2)
             USING (location_code, year)
           FULL JOIN (SELECT location_code, year, avg(extreme_poverty_value) AS ext_pov
                      FROM wb_extreme_poverty GROUP BY 1, 2) USING (location_code, year))"""


def _poverty(spark: SparkSession, d: str) -> DataFrame:
    return gold.poverty_features(povertyrate(spark, d), wb_mpm(spark, d), wb_extreme_poverty(spark, d))


@query(sql=with_ctes("povertyrate", "wb_mpm", "wb_extreme_poverty", body=f"{POVERTY_SQL} SELECT * FROM poverty"))
def poverty_avg(spark: SparkSession, d: str) -> DataFrame:
    return _poverty(spark, d)


@query(sql=with_ctes("foodsecurity", body="""
    SELECT location_code, year, max(population_in_phase) AS peak_population_phase3plus
    FROM foodsecurity WHERE admin_level = 0 AND ipc_phase = '3+' GROUP BY 1, 2"""))
def peak_filter(spark: SparkSession, d: str) -> DataFrame:
    return gold.food_security_features(foodsecurity(spark, d))


@query(sql="""
    SELECT o_custkey, max(o_totalprice) AS dearest_urgent FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P' GROUP BY o_custkey""")
def peak_by_customer(spark: SparkSession, d: str) -> DataFrame:
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") != "P")
    return peak_by(table(spark, d, "orders"), ["o_custkey"], "o_totalprice", urgent, "dearest_urgent")


@query(sql=with_ctes("foodsecurity", body="""
    SELECT location_code, year, bool_or(ipc_phase IN ('3', '3+', '4', '5')) AS has_food_crisis
    FROM foodsecurity WHERE ipc_type = 'current' AND admin_level = 0 GROUP BY 1, 2"""))
def food_crisis(spark: SparkSession, d: str) -> DataFrame:
    return gold.food_crisis(foodsecurity(spark, d))


@query(sql="""
    SELECT l_orderkey, bool_or(coalesce(nullif(l_returnflag, 'N') = 'R', false)) AS has_return
    FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1""")
def any_flag_by_order(spark: SparkSession, d: str) -> DataFrame:
    """Whether an open order has a returned line; an unknown flag does not count."""
    lines = table(spark, d, "lineitem").filter("l_linestatus = 'O'")
    return any_flag(lines, ["l_orderkey"], F.nullif("l_returnflag", F.lit("N")) == "R", "has_return")


def _need(status: str) -> str:
    return f"""coalesce(max(population) FILTER (population_status = '{status}' AND category = 'total'),
                        max(population) FILTER (population_status = '{status}' AND coalesce(category, '') = ''))"""


NEEDS_SQL = f"""
    , metrics AS (
      SELECT location_code, year, {_need('AFF')} AS population_affected, {_need('INN')} AS population_in_need,
             {_need('TGT')} AS population_targeted, {_need('REA')} AS population_reached
      FROM needs WHERE sector_code = 'Intersectoral' AND admin_level = 0 GROUP BY 1, 2),
    gaps AS (
      SELECT *, population_in_need - population_targeted AS aid_gap,
             {rnd("population_in_need / nullif(population_targeted, 0)", 3)} AS aid_gap_ratio,
             CASE WHEN population_reached <> 0 THEN population_in_need - population_reached END AS response_gap
      FROM metrics),
    bounds AS (
      SELECT year, min(aid_gap) AS g0, max(aid_gap) AS g1, min(aid_gap_ratio) AS r0, max(aid_gap_ratio) AS r1
      FROM gaps GROUP BY year),
    scored AS (
      SELECT gaps.*, {rnd("(aid_gap - g0) / nullif(g1 - g0, 0)", 3)} AS score_gap_absolute,
             {rnd("(aid_gap_ratio - r0) / nullif(r1 - r0, 0)", 3)} AS score_gap_ratio
      FROM gaps JOIN bounds USING (year))"""


@query(sql=with_ctes("needs", body=f"{NEEDS_SQL} SELECT * FROM scored"))
def needs_fallback(spark: SparkSession, d: str) -> DataFrame:
    return gold.scored_needs(checkpointed(gold.needs_gaps(needs(spark, d))))


@query(name="minmax_score", sql=with_ctes("customer_year", body=f"""
    SELECT o_custkey, year, n_orders, amount_cents,
           {rnd('''(n_orders - min(n_orders) OVER y)
                   / nullif(max(n_orders) OVER y - min(n_orders) OVER y, 0)''', 3)} AS score_orders,
           {rnd('''1 - (amount_cents - min(amount_cents) OVER y)
                   / nullif(max(amount_cents) OVER y - min(amount_cents) OVER y, 0)''', 3)} AS score_amount
    FROM customer_year WINDOW y AS (PARTITION BY year)"""))
def minmax_by_year(spark: SparkSession, d: str) -> DataFrame:
    return minmax_score(
        customer_year(spark, d), "year", {"score_orders": "n_orders", "score_amount": "amount_cents"}, 3, ["score_amount"]
    )


@query(name="risk_profile", sql="""
    WITH profile AS (
      SELECT s_suppkey AS supplier, CAST(year(l_shipdate) AS INT) AS year,
             CAST(sum(l_quantity) FILTER (l_returnflag = 'R') AS BIGINT) AS returned,
             CAST(sum(l_quantity) AS BIGINT) AS sold, count(DISTINCT l_partkey) AS parts
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
    bounds AS (
      SELECT year, min(returned) AS r0, max(returned) AS r1, min(sold) AS s0, max(sold) AS s1,
             min(parts) AS p0, max(parts) AS p1
      FROM profile GROUP BY year),
    scored AS (
      SELECT supplier, year, {returned} AS score_returned, {sold} AS score_sold, {parts} AS score_parts
      FROM profile JOIN bounds USING (year))
    SELECT *, CAST((score_returned IS NOT NULL)::INT + (score_sold IS NOT NULL)::INT
                   + (score_parts IS NOT NULL)::INT AS INT) AS evaluable_dimensions
    FROM scored""".format(
        returned=rnd("(returned - r0) / nullif(r1 - r0, 0)", 4),
        sold=rnd("1 - (sold - s0) / nullif(s1 - s0, 0)", 4),
        parts=rnd("1 - (parts - p0) / nullif(p1 - p0, 0)", 4),
    ))
def supplier_risk(spark: SparkSession, d: str) -> DataFrame:
    """Many returns, few sales and few parts are the bad ends."""
    profile = table(spark, d, "lineitem").groupBy(
        F.col("l_suppkey").alias("supplier"), F.year("l_shipdate").alias("year")
    ).agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).cast("bigint").alias("returned"),
        F.sum("l_quantity").cast("bigint").alias("sold"),
        F.count_distinct("l_partkey").alias("parts"),
    )
    return risk_profile(profile, "supplier", "year", {"returned": True, "sold": False, "parts": False})


PRESSURE_SQL = f"""
    , served AS (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1),
    stock AS (
      SELECT s_nationkey, CAST(year(l_shipdate) AS INT) AS year, CAST(sum(l_quantity) AS BIGINT) AS stock
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
    pressure AS (
      SELECT n_name AS location_code, year, stock, customers, CAST(stock AS DOUBLE) / (customers * 2e5) AS per_capita
      FROM stock JOIN nation ON s_nationkey = n_nationkey LEFT JOIN served ON c_nationkey = n_nationkey),
    indexed AS (
      SELECT *, least(1e2, {rnd("25e0 * log10(1e0 + stock / nullif(customers, 0))", 2)}) AS log_index,
             {rnd("stock * 1e3 / nullif(customers, 0)", 3)} AS per_1000
      FROM pressure),
    tiered AS (
      SELECT *, CASE WHEN per_capita < 0.0005 THEN 'Low' WHEN per_capita < 0.001 THEN 'Medium'
                     WHEN per_capita < 0.002 THEN 'High' WHEN per_capita IS NOT NULL THEN 'Critical' END AS tier
      FROM indexed)"""


def _pressure(spark: SparkSession, d: str) -> DataFrame:
    served = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("s_nationkey")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    stock = table(spark, d, "lineitem").join(
        table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    ).groupBy("s_nationkey", F.year("l_shipdate").alias("year")).agg(
        F.sum("l_quantity").cast("bigint").alias("stock")
    )
    names = table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("location_code"))
    return stock.join(names, "s_nationkey").join(served, "s_nationkey", "left").select(
        "location_code", "year", "stock", "customers",
        ratio(F.col("stock"), F.col("customers") * 2e5).alias("per_capita"),
    )


@query(sql=f"WITH _unused AS (SELECT 1) {PRESSURE_SQL} SELECT * EXCLUDE (tier) FROM tiered")
def pressure_index(spark: SparkSession, d: str) -> DataFrame:
    return _pressure(spark, d).withColumns({
        "log_index": log_index(ratio(F.col("stock"), F.col("customers"))),
        "per_1000": per_capita(F.col("stock"), F.col("customers")),
    })


@query(sql=f"WITH _unused AS (SELECT 1) {PRESSURE_SQL} SELECT location_code, year, per_capita, tier FROM tiered")
def pressure_tiers(spark: SparkSession, d: str) -> DataFrame:
    pressure = _pressure(spark, d).select("location_code", "year", "per_capita")
    return pressure.withColumn("tier", tier(F.col("per_capita"), (0.0005, 0.001, 0.002)))


@query(sql=f'WITH _unused AS (SELECT 1) {PRESSURE_SQL} SELECT tier, count(*) AS "count" FROM tiered GROUP BY tier')
def tier_distribution(spark: SparkSession, d: str) -> DataFrame:
    return distribution(pressure_tiers(spark, d), "tier")


@query(sql="""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def top_orders(spark: SparkSession, d: str) -> DataFrame:
    """The preview of a report: the twenty largest orders."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top(orders, [F.desc("o_totalprice"), "o_orderkey"], 20)


@query(sql="""
    WITH bought AS (SELECT c_nationkey AS k, CAST(year(o_orderdate) AS INT) AS year, count(*) AS hosted
                    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    people AS (SELECT c_nationkey AS k, count(*) AS population FROM customer GROUP BY 1),
    sold AS (SELECT s_nationkey AS k, CAST(year(l_shipdate) AS INT) AS year, count(*) AS internal
             FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
    joined AS (SELECT k, year, internal, hosted, coalesce(internal, 0) + coalesce(hosted, 0) AS burden
               FROM bought FULL JOIN sold USING (k, year))
    SELECT joined.*, {per_1000} AS per_1000 FROM joined LEFT JOIN people USING (k)""".format(
        per_1000=rnd("burden * 1e3 / population", 3)))
def burden(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    bought = table(spark, d, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    ).groupBy("k", F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("hosted"))
    sold = table(spark, d, "lineitem").join(
        table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    ).groupBy(F.col("s_nationkey").alias("k"), F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("internal")
    )
    people = customers.groupBy("k").agg(F.count(F.lit(1)).alias("population"))
    total = F.coalesce("internal", F.lit(0)) + F.coalesce("hosted", F.lit(0))
    both = outer_panel([sold, bought], ["k", "year"]).withColumn("burden", total)
    return both.join(people, "k", "left").withColumn(
        "per_1000", per_capita(F.col("burden"), F.col("population"))
    ).drop("population")


@query(sql=with_ctes("customer_year", body=f"""
    , flags AS (
      SELECT o_custkey, year, growth > 0 AS is_rising, share < 40 AS is_unsettled, urgent AS has_urgent
      FROM (SELECT t.*, CASE WHEN year - lag(year) OVER w = 1 AND lag(n_orders) OVER w >= 1
                             THEN {rnd("(n_orders - lag(n_orders) OVER w) * 1e2 / nullif(lag(n_orders) OVER w, 0)", 2)}
                        END AS growth
            FROM (SELECT * FROM customer_year JOIN (
                    SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year,
                           CASE WHEN count(*) > 1 THEN count(*) FILTER (o_orderstatus = 'F') * 1e2 / count(*) END AS share,
                           bool_or(o_orderpriority = '1-URGENT') AS urgent
                    FROM orders GROUP BY 1, 2) USING (o_custkey, year)) t
            WINDOW w AS (PARTITION BY o_custkey ORDER BY year)))
    SELECT *, CAST(coalesce(is_rising, false)::INT + coalesce(is_unsettled, false)::INT
                   + coalesce(has_urgent, false)::INT AS INT) AS active,
           CAST((is_rising IS NOT NULL)::INT + (is_unsettled IS NOT NULL)::INT
                + (has_urgent IS NOT NULL)::INT AS INT) AS evaluable
    FROM flags"""))
def risk_conditions(spark: SparkSession, d: str) -> DataFrame:
    n, settled = F.count(F.lit(1)), F.count_if(F.col("o_orderstatus") == "F")
    yearly = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        n.alias("n_orders"), F.when(n > 1, settled * 100.0 / n).alias("share"),
        F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("has_urgent"),
    )
    grown = yoy_growth(yearly, ["o_custkey"], "year", "n_orders", min_base=1)
    flags = grown.select(
        "o_custkey", "year", (F.col("n_orders_growth_pct") > 0).alias("is_rising"),
        (F.col("share") < 40).alias("is_unsettled"), "has_urgent",
    )
    conditions = [F.col(c) for c in ("is_rising", "is_unsettled", "has_urgent")]
    return flags.withColumns({"active": count_true(*conditions), "evaluable": count_known(*conditions)})
