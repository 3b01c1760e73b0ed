"""Series operators and trends over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import (
    backtest,
    fit_ols,
    lag_value,
    lead_value,
    long_form,
    moving_avg,
    naive_projection,
    trend_forecast,
    summarise,
    yoy_growth,
)
from panelkit.plans import gold
from parity.registry import query, rnd
from parity.views import customer_year, nation_month, nation_year, table, with_ctes

CUSTOMER = "PARTITION BY o_custkey ORDER BY year"


@query(sql=with_ctes("customer_year", body="""
    SELECT o_custkey, year, n_orders, lag(n_orders) OVER w AS n_orders_lag1,
           CASE WHEN year - lag(year) OVER w = 1 THEN lag(amount_cents) OVER w END AS amount_before,
           lag(n_orders, 2) OVER w AS n_orders_lag2, lead(n_orders) OVER w AS n_orders_lead1
    FROM customer_year WINDOW w AS (PARTITION BY o_custkey ORDER BY year)"""))
def lag_lead(spark: SparkSession, d: str) -> DataFrame:
    df = customer_year(spark, d)
    df = lag_value(df, ["o_custkey"], "year", "n_orders")
    df = lag_value(df, ["o_custkey"], "year", "amount_cents", guard_gap=True, out="amount_before")
    df = lag_value(df, ["o_custkey"], "year", "n_orders", n=2)
    return lead_value(df, ["o_custkey"], "year", "n_orders").drop("amount_cents")


GROWTH_SQL = f"""
    SELECT *, {rnd("growth - lag(growth) OVER w", 2)} AS raw_acceleration FROM (
      SELECT *, CASE WHEN year - prev_year = 1 AND abs(lag1) >= {{base}}
                     THEN {rnd("(v - lag1) * 1e2 / nullif(lag1, 0)", 2)} END AS growth
      FROM (SELECT k, year, v, lag(v) OVER w AS lag1, lag(year) OVER w AS prev_year FROM series
            WINDOW w AS (PARTITION BY k ORDER BY year)))
    WINDOW w AS (PARTITION BY k ORDER BY year)"""


@query(name="yoy_growth", sql=with_ctes("customer_year", body=f"""
    , series AS (SELECT o_custkey AS k, year, amount_cents AS v FROM customer_year),
    grown AS ({GROWTH_SQL.format(base=100000)})
    SELECT k AS o_custkey, year, v AS amount_cents, lag1 AS amount_cents_lag1,
           growth AS amount_cents_growth_pct,
           CASE WHEN year - prev_year = 1 THEN raw_acceleration END AS amount_cents_acceleration
    FROM grown"""))
def growth_by_customer(spark: SparkSession, d: str) -> DataFrame:
    df = customer_year(spark, d).drop("n_orders")
    return yoy_growth(df, ["o_custkey"], "year", "amount_cents", min_base=100000)


@query(name="naive_projection", sql=with_ctes("customer_year", body=f"""
    SELECT o_custkey, year, amount_cents, avg3 AS amount_cents_avg3, projection AS amount_cents_projection,
           {rnd("abs(projection - avg3) * 1e2 / nullif(avg3, 0)", 1)} AS amount_cents_divergence_pct
    FROM (SELECT *, CASE WHEN year - lag(year) OVER w = 1 AND lag(amount_cents) OVER w <> 0
                         THEN greatest(0, 2 * amount_cents - lag(amount_cents) OVER w) END AS projection,
                 round(avg(amount_cents) OVER (PARTITION BY o_custkey ORDER BY year
                                               RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 0) AS avg3
          FROM customer_year WINDOW w AS (PARTITION BY o_custkey ORDER BY year))"""))
def projection_by_customer(spark: SparkSession, d: str) -> DataFrame:
    df = customer_year(spark, d).drop("n_orders")
    return naive_projection(df, ["o_custkey"], "year", "amount_cents")


@query(sql=with_ctes("customer_year", body=f"""
    SELECT o_custkey, year, n_orders,
           {rnd('''avg(n_orders) OVER (PARTITION BY o_custkey ORDER BY year
                                       RANGE BETWEEN 3 PRECEDING AND CURRENT ROW)''', 2)} AS n_orders_avg4
    FROM customer_year"""))
def moving_avg_range(spark: SparkSession, d: str) -> DataFrame:
    return moving_avg(
        customer_year(spark, d).drop("amount_cents"), ["o_custkey"], "year", "n_orders", span=4, digits=2
    )


@query(sql=with_ctes("nation_year", body=f"""
    , series AS (SELECT location_code AS k, year, amount_cents / 1e2 AS v FROM nation_year),
    grown AS ({GROWTH_SQL.format(base=1000)})
    SELECT k AS location_code, year, v AS revenue, lag1 AS revenue_lag1, growth AS revenue_growth_pct,
           CASE WHEN year - prev_year = 1 THEN raw_acceleration END AS revenue_acceleration,
           avg3 AS revenue_avg3, projection AS revenue_projection,
           {rnd("abs(projection - avg3) * 1e2 / nullif(avg3, 0)", 1)} AS revenue_divergence_pct
    FROM (SELECT *, CASE WHEN year - prev_year = 1 AND lag1 <> 0
                         THEN greatest(0e0, v + (v - lag1)) END AS projection,
                 round(avg(v) OVER (PARTITION BY k ORDER BY year
                                    RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 0) AS avg3
          FROM grown)"""))
def revenue_trend(spark: SparkSession, d: str) -> DataFrame:
    """Yearly revenue per nation with growth, acceleration, moving average and projection."""
    revenue = nation_year(spark, d).select("location_code", "year", (F.col("amount_cents") / 100).alias("revenue"))
    grown = yoy_growth(revenue, ["location_code"], "year", "revenue")
    return naive_projection(grown, ["location_code"], "year", "revenue")


def _fit_sql(rows: str, min_obs: int) -> str:
    """SQL for the least-squares fit of v on x per group g1, g2 of ``rows``, by explicit residuals."""
    return f"""
    means AS (SELECT g1, g2, count(v) AS n, avg(x) AS mx, avg(v) AS my, max(x) AS last_x
              FROM {rows} GROUP BY g1, g2 HAVING count(v) >= {min_obs} AND var_samp(v) > 0),
    slopes AS (SELECT g1, g2, n, my, last_x, sum((x - mx) * (v - my)) / sum((x - mx) * (x - mx)) AS slope, mx
               FROM {rows} JOIN means USING (g1, g2) GROUP BY g1, g2, n, mx, my, last_x),
    lines AS (SELECT *, my - slope * mx AS intercept FROM slopes),
    residuals AS (SELECT g1, g2, n, last_x, slope, intercept,
                         sum((v - intercept - slope * x) * (v - intercept - slope * x)) AS ssr,
                         sum((v - my) * (v - my)) AS sst
                  FROM {rows} JOIN lines USING (g1, g2) GROUP BY g1, g2, n, last_x, slope, intercept),
    scored AS (SELECT *, {rnd("1 - ssr / sst", 4)} AS r2, {rnd("sqrt(ssr / (n - 2))", 2)} AS se
               FROM residuals),
    fits AS (SELECT *, {rnd("1 - (1 - r2) * (n - 1) / (n - 2)", 4)} AS r2_adj FROM scored)"""


MONTHS_SQL = """
    , stacked AS (
      SELECT location_code AS g1, 'n_orders' AS g2, month AS x, CAST(n_orders AS DOUBLE) AS v FROM nation_month
      UNION ALL
      SELECT location_code, 'revenue', month, amount_cents / 1e8 FROM nation_month)"""


def _months(spark: SparkSession, d: str) -> DataFrame:
    return nation_month(spark, d).select(
        "location_code", "month", "n_orders", (F.col("amount_cents") / 1e8).alias("revenue")
    )


@query(sql=with_ctes("nation_month", body=f"""
    {MONTHS_SQL}, {_fit_sql("stacked", 8)}
    SELECT g1 AS location_code, g2 AS variable_name, n AS n_observations, {rnd("slope", 6)} AS slope,
           {rnd("intercept", 6)} AS intercept, r2 AS r_squared, r2_adj AS r_squared_adjusted,
           se AS standard_error
    FROM fits"""))
def ols_fit(spark: SparkSession, d: str) -> DataFrame:
    series = long_form(_months(spark, d), "location_code", "month", ["n_orders", "revenue"])
    fit = fit_ols(series, ["location_code", "variable_name"], "month", "value", 8)
    return fit.withColumns({c: F.round(c, 6) for c in ("slope", "intercept")})


@query(sql=with_ctes("customer_year", body=f"""
    , points AS (SELECT o_custkey AS g1, 0 AS g2, year - 1995 AS x, amount_cents / 99991e3 AS v FROM customer_year),
    {_fit_sql("points", 5)}
    SELECT g1 AS o_custkey, n AS n_observations, {rnd("slope", 6)} AS slope, {rnd("intercept", 6)} AS intercept,
           r2 AS r_squared, se AS standard_error
    FROM fits"""))
def ols_by_customer(spark: SparkSession, d: str) -> DataFrame:
    """Many short series with gaps. The prime unit keeps slopes off exact halves when rounded."""
    points = customer_year(spark, d).select(
        "o_custkey", (F.col("year") - 1995).alias("t"), (F.col("amount_cents") / 99991e3).alias("value")
    )
    fit = fit_ols(points, ["o_custkey"], "t", "value", 5)
    return fit.withColumns({c: F.round(c, 6) for c in ("slope", "intercept")}).drop("r_squared_adjusted")


@query(sql="""
    WITH points AS (
      SELECT c_nationkey AS nation, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) // 7 AS BIGINT) AS week,
             count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    -- Whole numbers of 10^12 and more, a step of 10^7 a week and a few units beside the line; sums are exact.
    series AS (SELECT nation, CAST(week AS HUGEINT) AS x, CAST(10000000 * (week - 1300) + n % 7 AS HUGEINT) AS y FROM points),
    sums AS (
      SELECT nation, CAST(count(*) AS HUGEINT) AS n, count(*) * sum(x * x) - sum(x) * sum(x) AS sxx,
             count(*) * sum(x * y) - sum(x) * sum(y) AS sxy, count(*) * sum(y * y) - sum(y) * sum(y) AS syy
      FROM series GROUP BY 1 HAVING count(*) >= 8),
    errors AS (SELECT *, CAST(sxx * syy - sxy * sxy AS DOUBLE) / CAST(n * sxx AS DOUBLE) AS unexplained FROM sums)
    SELECT nation, CAST(n AS BIGINT) AS n_observations, round(CAST(sxy AS DOUBLE) / CAST(sxx AS DOUBLE), 3) AS slope,
           round(1 - unexplained / (CAST(syy AS DOUBLE) / n), 4) AS r_squared,
           round(sqrt(unexplained / (n - 2)), 2) AS standard_error
    FROM errors""")
def ols_one_pass(spark: SparkSession, d: str) -> DataFrame:
    """Nearly straight series of values around 10^12: the residuals are twelve digits smaller, and have to be right."""
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    week = F.floor(F.unix_date(F.col("o_orderdate").cast("date")) / 7)
    points = orders.groupBy(F.col("c_nationkey").alias("nation"), week.alias("week")).agg(F.count(F.lit(1)).alias("n"))
    value = F.lit(1e12) + 1e7 * (F.col("week") - 1300) + F.col("n") % 7
    fit = fit_ols(points.withColumn("value", value), ["nation"], "week", "value", 8)
    return fit.withColumn("slope", F.round("slope", 3)).drop("intercept", "r_squared_adjusted")


FORECAST_SQL = f"""
    SELECT g1 AS location_code, g2 AS variable_name, CAST(n AS INT) AS n_observations,
           last_x AS last_observed_year, {rnd("slope", 4)} AS slope, {rnd("intercept", 4)} AS intercept,
           r2 AS r_squared, r2_adj AS r_squared_adjusted, se AS standard_error,
           last_x + 1 AS forecast_year,
           {rnd("greatest(0, intercept + slope * (last_x + 1))", 2)} AS predicted_value,
           {rnd("greatest(0, intercept + slope * (last_x + 1) - 1.96e0 * se)", 2)} AS predicted_lower_95,
           {rnd("intercept + slope * (last_x + 1) + 1.96e0 * se", 2)} AS predicted_upper_95
    FROM fits"""


@query(
    name="trend_forecast", sql=with_ctes("nation_month", body=f"{MONTHS_SQL}, {_fit_sql('stacked', 8)} {FORECAST_SQL}")
)
def monthly_trend_forecast(spark: SparkSession, d: str) -> DataFrame:
    return trend_forecast(_months(spark, d), "location_code", "month", ["n_orders", "revenue"])


BACKTEST_SQL = f"""
    , series AS (SELECT *, max(x) OVER (PARTITION BY g1, g2) - 3 AS split, lag(v) OVER w AS lag1,
                        lag(v, 2) OVER w AS lag2
                 FROM stacked WINDOW w AS (PARTITION BY g1, g2 ORDER BY x)),
    train AS (SELECT g1, g2, x, v FROM series WHERE x <= split), {_fit_sql("train", 5)},
    tested AS (SELECT g1, g2, n, r2, v, abs(v - greatest(0, intercept + slope * x)) AS e,
                      CASE WHEN lag2 IS NOT NULL THEN abs(v - greatest(0, 2 * lag1 - lag2)) END AS e0
               FROM series JOIN fits USING (g1, g2) WHERE x > split),
    errors AS (SELECT g1, g2, n, r2, count(*) AS n_test, avg(e) AS mae, avg(e0) AS mae0,
                      avg(CASE WHEN abs(v) >= 1 THEN e * 1e2 / abs(v) END) AS mape,
                      avg(CASE WHEN abs(v) >= 1 THEN e0 * 1e2 / abs(v) END) AS mape0
               FROM tested GROUP BY g1, g2, n, r2 HAVING avg(e0) IS NOT NULL),
    validation AS (
    SELECT g1 AS location_code, g2 AS variable_name, CAST(n AS INT) AS n_train_observations,
           CAST(n_test AS INT) AS n_test_points, r2 AS train_r_squared, {rnd("mae", 2)} AS regression_mae,
           {rnd("mape", 2)} AS regression_mape, {rnd("mae0", 2)} AS naive_mae, {rnd("mape0", 2)} AS naive_mape,
           mae < mae0 AS beats_naive, {rnd("(mae0 - mae) * 1e2 / nullif(mae0, 0)", 2)} AS improvement_pct
    FROM errors)"""


@query(name="backtest", sql=with_ctes("nation_month", body=f"{MONTHS_SQL} {BACKTEST_SQL} SELECT * FROM validation"))
def monthly_backtest(spark: SparkSession, d: str) -> DataFrame:
    return backtest(_months(spark, d), "location_code", "month", ["n_orders", "revenue"])


@query(sql=with_ctes("nation_month", body=f"""
    {MONTHS_SQL}, {_fit_sql("stacked", 8)}
    SELECT g2 AS variable_name, count(*) AS entities, {rnd("avg(n)", 1)} AS mean_observations,
           {rnd("avg(r2)", 3)} AS r_squared_mean, {rnd("min(r2)", 3)} AS r_squared_min,
           {rnd("max(r2)", 3)} AS r_squared_max
    FROM fits GROUP BY g2"""))
def trend_quality(spark: SparkSession, d: str) -> DataFrame:
    return summarise(monthly_trend_forecast(spark, d), ["variable_name"], gold.TREND_SUMMARY)


@query(sql=with_ctes("nation_month", body=f"""
    {MONTHS_SQL} {BACKTEST_SQL}
    SELECT variable_name, count(*) AS entities, count(*) FILTER (beats_naive) AS wins,
           {rnd("count(*) FILTER (beats_naive) * 1e2 / count(*)", 1)} AS win_rate_pct,
           {rnd("avg(regression_mape)", 1)} AS regression_mape, {rnd("avg(naive_mape)", 1)} AS naive_mape
    FROM validation GROUP BY variable_name"""))
def backtest_quality(spark: SparkSession, d: str) -> DataFrame:
    return summarise(monthly_backtest(spark, d), ["variable_name"], gold.VALIDATION_SUMMARY)
