"""The gold tables of the lakehouse, fed from the driver tables in the shape of the feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.plans import gold
from panelkit.sources import checkpointed
from parity.indicators import APPEALS_SQL, CONFLICT_SQL, NEEDS_SQL, POVERTY_SQL, rounded_money
from parity.panels import HOSTS_SQL
from parity.registry import query, rnd
from parity.series import GROWTH_SQL
from parity.views import (
    conflict_events,
    foodsecurity,
    funding,
    location,
    nation_year,
    needs,
    place_reports,
    povertyrate,
    routes,
    wb_extreme_poverty,
    wb_gdp,
    wb_mpm,
    wb_population,
    with_ctes,
)

FUNDED_SQL = """
    , spread AS (
      SELECT location_code, y,
             CASE WHEN year(reference_period_start) = year(reference_period_end) THEN 1e0
                  ELSE (date_diff('day', greatest(reference_period_start, make_date(y, 1, 1)),
                                  least(reference_period_end, make_date(y, 12, 31))) + 1)
                       / (date_diff('day', reference_period_start, reference_period_end) + 1) END AS share,
             funding_usd, requirements_usd
      FROM (SELECT *, unnest(generate_series(year(reference_period_start), year(reference_period_end))) AS y
            FROM funding WHERE year(reference_period_start) <= year(reference_period_end))),
    spent AS (
      SELECT location_code, CAST(y AS INT) AS year, sum(share * funding_usd) AS funding_received_usd,
             sum(share * requirements_usd) AS requirements_usd
      FROM spread GROUP BY 1, 2),
    funded AS (
      SELECT *, CASE WHEN requirements_usd > 0 THEN funding_received_usd / requirements_usd END
                AS funding_coverage_pct
      FROM spent)"""


def _rounded(df: DataFrame) -> DataFrame:
    """Sums of shares rounded, so that they do not depend on the order of the rows."""
    digits = {
        "funding_received_usd": 2, "requirements_usd": 2, "funding_coverage_pct": 6,
        "funding_coverage_lag1": 6, "funding_gap": 6,
    }
    return df.withColumns({c: F.round(c, n) for c, n in digits.items() if c in df.columns})


@query(sql=with_ctes("funding", body=f"""
    {FUNDED_SQL}
    SELECT location_code, year, {rnd("funding_received_usd", 2)} AS funding_received_usd,
           {rnd("requirements_usd", 2)} AS requirements_usd,
           {rnd("funding_coverage_pct", 6)} AS funding_coverage_pct,
           {rnd("lag(funding_coverage_pct) OVER (PARTITION BY location_code ORDER BY year)", 6)}
             AS funding_coverage_lag1
    FROM funded"""))
def funding_features(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(gold.funding_features(funding(spark, d)))


FACTS_SQL = f"""
    {CONFLICT_SQL} {POVERTY_SQL} {FUNDED_SQL},
    food AS (
      SELECT location_code, year, max(population_in_phase) AS peak_population_phase3plus
      FROM foodsecurity WHERE admin_level = 0 AND ipc_phase = '3+' GROUP BY 1, 2),
    facts AS (
      SELECT location_code, l.name AS location_name, year, coalesce(total_fatalities, 0) AS total_fatalities,
             coalesce(violent_events, 0) AS violent_events,
             coalesce(civilian_targeting_events, 0) AS civilian_targeting_events,
             coalesce(civilian_targeting_fatalities, 0) AS civilian_targeting_fatalities,
             coalesce(non_violent_events, 0) AS non_violent_events, mpi, hdx_head, hdx_vuln, hdx_sev, mpm,
             ext_pov, peak_population_phase3plus, funding_received_usd, requirements_usd,
             funding_coverage_pct,
             lag(funding_coverage_pct) OVER (PARTITION BY location_code ORDER BY year) AS funding_coverage_lag1,
             total_population, gdp_per_capita,
             CASE WHEN l.effective IS NULL OR year < l.effective THEN false
                  ELSE coalesce(l.has_hrp, false) END AS has_hrp,
             CASE WHEN l.effective IS NULL OR year < l.effective THEN false
                  ELSE coalesce(l.in_gho, false) END AS in_gho
      FROM conflict FULL JOIN poverty USING (location_code, year) FULL JOIN food USING (location_code, year)
           FULL JOIN funded USING (location_code, year) FULL JOIN wb_population USING (location_code, year)
           FULL JOIN wb_gdp USING (location_code, year)
           LEFT JOIN (SELECT code, name, has_hrp, in_gho, year AS effective FROM location) l
             ON l.code = location_code)"""
FACT_VIEWS = (
    "conflict_events", "povertyrate", "wb_mpm", "wb_extreme_poverty", "funding", "foodsecurity",
    "wb_population", "wb_gdp", "location",
)
ROUNDED_SQL = f"""
    {rnd("funding_received_usd", 2)} AS funding_received_usd,
    {rnd("requirements_usd", 2)} AS requirements_usd"""


def _facts(spark: SparkSession, d: str) -> DataFrame:
    """The reports are written as they are, one row per line, so that lines are read once for the features."""
    reports, yearly = checkpointed(place_reports(spark, d)), checkpointed(nation_year(spark, d))
    return gold.country_fact(
        gold.conflict_features(conflict_events(spark, d, reports)),
        gold.poverty_features(povertyrate(spark, d, reports), wb_mpm(spark, d, reports), wb_extreme_poverty(spark, d, reports)),
        gold.food_security_features(foodsecurity(spark, d, reports)),
        gold.funding_features(funding(spark, d)),
        wb_population(spark, d, yearly),
        wb_gdp(spark, d, yearly),
        location(spark, d),
    )


@query(sql=with_ctes(*FACT_VIEWS, body=f"""
    {FACTS_SQL}
    SELECT * EXCLUDE (funding_received_usd, requirements_usd, funding_coverage_pct, funding_coverage_lag1),
           {ROUNDED_SQL}, {rnd("funding_coverage_pct", 6)} AS funding_coverage_pct,
           {rnd("funding_coverage_lag1", 6)} AS funding_coverage_lag1
    FROM facts"""))
def country_fact(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_facts(spark, d))


@query(sql=with_ctes(*FACT_VIEWS, "population", "solutions", body=f"""
    {HOSTS_SQL} {FACTS_SQL},
    measured AS (
      SELECT h.*, f.* EXCLUDE (location_code, location_name, year),
             refugees_count + asylum_seekers_count + oip_count AS cross_border_stock,
             total_hosted_stock / nullif(total_population, 0) AS pressure_per_capita,
             total_hosted_stock / nullif(gdp_per_capita, 0) AS pressure_per_gdp_per_capita,
             funding_received_usd IS NOT NULL OR requirements_usd IS NOT NULL AS has_funding_data,
             CASE WHEN requirements_usd > 0
                  THEN 1 - coalesce(funding_received_usd, 0) / requirements_usd END AS gap
      FROM hosts h LEFT JOIN facts f ON f.location_code = h.coa_iso AND f.year = h.year)
    SELECT coa_iso, coa_name, year, false AS is_forecast, refugees_count, asylum_seekers_count, oip_count,
           idps_count, cross_border_stock, total_hosted_stock, hosted_stock_lag1, total_inflows,
           total_outflows, growth_rate, pressure_per_capita,
           CASE WHEN pressure_per_capita < 0.005 THEN 'Low' WHEN pressure_per_capita < 0.02 THEN 'Medium'
                WHEN pressure_per_capita < 0.05 THEN 'High'
                WHEN pressure_per_capita IS NOT NULL THEN 'Critical' END AS pressure_per_capita_tier,
           pressure_per_gdp_per_capita,
           least(1e2, {rnd("25e0 * log10(1e0 + pressure_per_gdp_per_capita)", 2)}) AS pressure_per_gdp_log_index,
           CASE WHEN pressure_per_gdp_per_capita < 10 THEN 'Low'
                WHEN pressure_per_gdp_per_capita < 100 THEN 'Medium'
                WHEN pressure_per_gdp_per_capita < 500 THEN 'High'
                WHEN pressure_per_gdp_per_capita IS NOT NULL THEN 'Critical' END
             AS pressure_per_gdp_per_capita_tier,
           has_funding_data, {rnd("gap", 6)} AS funding_gap,
           CASE WHEN gap <= 0.3 THEN 'Low' WHEN gap <= 0.5 THEN 'Medium' WHEN gap <= 0.7 THEN 'High'
                WHEN gap IS NOT NULL THEN 'Critical' END AS funding_gap_tier,
           total_population, gdp_per_capita, {ROUNDED_SQL}, has_hrp, in_gho, mpi, hdx_head, hdx_vuln,
           hdx_sev, mpm, ext_pov, peak_population_phase3plus
    FROM measured"""))
def host_pressure_indices(spark: SparkSession, d: str) -> DataFrame:
    """As in the lakehouse, the routes and the facts are written before the next step reads them."""
    hosts = gold.host_aggregates(checkpointed(gold.displacement(*routes(spark, d))))
    return _rounded(gold.host_pressure_indices(hosts, checkpointed(_facts(spark, d))))


AID_VIEWS = (
    "population", "solutions", "needs", "conflict_events", "foodsecurity", "funding", "wb_gdp", "wb_mpm",
    "wb_extreme_poverty", "wb_population",
)
AID_SQL = f"""
    {APPEALS_SQL} {NEEDS_SQL},
    series AS (SELECT coo_iso AS k, year, CAST(sum(idps) AS BIGINT) AS v FROM population
               WHERE coa_iso = coo_iso GROUP BY 1, 2),
    grown AS ({GROWTH_SQL.format(base=1000)}),
    internal AS (
      SELECT k AS location_code, year, v AS internal_idps, lag1 AS internal_idps_lag1,
             growth AS idps_yoy_growth_pct,
             CASE WHEN year - prev_year = 1 THEN raw_acceleration END AS idps_acceleration,
             round(avg(v) OVER (PARTITION BY k ORDER BY year RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 0)
               AS idps_moving_avg_3y,
             CASE WHEN year - prev_year = 1 AND lag1 <> 0 THEN greatest(0, v + (v - lag1)) END
               AS idps_naive_projection_1y
      FROM grown),
    hosted AS (SELECT coa_iso AS location_code, year, CAST(sum(refugees) + sum(asylum_seekers) AS BIGINT)
                      AS stock_hosted FROM population WHERE coa_iso <> coo_iso GROUP BY 1, 2),
    departed AS (SELECT coa_iso AS location_code, year,
                        CAST(sum(coalesce(returned_refugees, 0) + coalesce(resettlement, 0)
                                 + coalesce(naturalisation, 0)) AS BIGINT) AS tracked_outflow
                 FROM solutions WHERE coa_iso <> coo_iso GROUP BY 1, 2),
    flows AS (SELECT *, stock_hosted - lag(stock_hosted) OVER (PARTITION BY location_code ORDER BY year)
                        + coalesce(tracked_outflow, 0) AS balance
              FROM hosted LEFT JOIN departed USING (location_code, year)),
    conflicts AS (
      SELECT *, CASE WHEN year - lag(year) OVER w = 1 THEN lag(conflict_events_total) OVER w END
                AS conflict_events_lag1
      FROM (SELECT location_code, year, CAST(sum(events) AS BIGINT) AS conflict_events_total,
                   CAST(sum(fatalities) AS BIGINT) AS conflict_fatalities_total
            FROM conflict_events GROUP BY 1, 2)
      WINDOW w AS (PARTITION BY location_code ORDER BY year)),
    crisis AS (SELECT location_code, year, bool_or(ipc_phase IN ('3', '3+', '4', '5')) AS has_food_crisis
               FROM foodsecurity WHERE ipc_type = 'current' AND admin_level = 0 GROUP BY 1, 2),
    outside AS (
      SELECT location_code, year, arg_max_null(funding_usd, (ingested_at, coalesce(funding_usd, -1)))
               AS funding_outside_appeals_usd
      FROM funding WHERE appeal_code = 'Not specified' GROUP BY 1, 2),
    joined AS (
      SELECT *, coalesce(internal_idps, 0) + coalesce(stock_hosted, 0) AS total_displacement_burden
      FROM internal FULL JOIN flows USING (location_code, year) LEFT JOIN scored USING (location_code, year)
           LEFT JOIN conflicts USING (location_code, year) LEFT JOIN crisis USING (location_code, year)
           LEFT JOIN appeals USING (location_code, year) LEFT JOIN outside USING (location_code, year)
           LEFT JOIN wb_gdp USING (location_code, year) LEFT JOIN wb_mpm USING (location_code, year)
           LEFT JOIN wb_extreme_poverty USING (location_code, year)
           LEFT JOIN wb_population USING (location_code, year)),
    aid AS (
      SELECT * EXCLUDE (balance, mpm_value, extreme_poverty_value), mpm_value AS mpi,
             extreme_poverty_value AS extreme_poverty,
             {rnd("abs(idps_naive_projection_1y - idps_moving_avg_3y) * 1e2 / nullif(idps_moving_avg_3y, 0)", 1)}
               AS projection_divergence_pct,
             CASE WHEN balance IS NOT NULL THEN greatest(0, balance) END AS real_inflow,
             CASE WHEN balance IS NOT NULL THEN greatest(0, -balance) END AS untracked_outflow,
             {rnd("total_displacement_burden * 1e3 / nullif(total_population, 0)", 3)}
               AS displaced_per_1000_inhabitants,
             idps_yoy_growth_pct > 0 AS is_idps_rising, funding_coverage_pct < 50 AS is_underfunded,
             CAST(coalesce(idps_yoy_growth_pct > 0, false)::INT + coalesce(funding_coverage_pct < 50, false)::INT
                  + coalesce(has_food_crisis, false)::INT AS INT) AS active_risk_conditions,
             CAST((idps_yoy_growth_pct IS NOT NULL)::INT + (funding_coverage_pct IS NOT NULL)::INT
                  + (has_food_crisis IS NOT NULL)::INT AS INT) AS evaluable_risk_conditions
      FROM joined WHERE year BETWEEN 1996 AND 2001)"""


def _aid(spark: SparkSession, d: str) -> DataFrame:
    """Reports, yearly sums and appeals are each written once for the blocks that read them."""
    reports, yearly = checkpointed(place_reports(spark, d)), checkpointed(nation_year(spark, d))
    appeals = funding(spark, d).select(
        "location_code", "year", "appeal_code", "ingested_at", "requirements_usd", "funding_usd"
    )
    return gold.aid_demand(
        *routes(spark, d), checkpointed(gold.needs_gaps(needs(spark, d, reports))), conflict_events(spark, d, reports),
        foodsecurity(spark, d, reports), checkpointed(appeals), wb_gdp(spark, d, yearly), wb_mpm(spark, d, reports),
        wb_extreme_poverty(spark, d, reports), wb_population(spark, d, yearly), first_year=1996, last_year=2001,
    )


@query(sql=with_ctes(*AID_VIEWS, body=f"{AID_SQL} SELECT * FROM aid"))
def aid_demand(spark: SparkSession, d: str) -> DataFrame:
    """The whole composition; the years are cut after the lags."""
    return rounded_money(_aid(spark, d))


def _score(variable: str, high_is_worse: bool) -> str:
    position = (
        f"({variable} - min({variable}) OVER y) / nullif(max({variable}) OVER y - min({variable}) OVER y, 0)"
    )
    return rnd(position if high_is_worse else f"1 - {position}", 4)


@query(sql=with_ctes(*AID_VIEWS, body=f"""
    {AID_SQL},
    profile AS (
      SELECT location_code, year,
             {", ".join(f"{_score(v, worse)} AS score_{v}" for v, worse in gold.RISK_DIRECTIONS.items())}
      FROM aid WINDOW y AS (PARTITION BY year))
    SELECT *, CAST({" + ".join(f"(score_{v} IS NOT NULL)::INT" for v in gold.RISK_DIRECTIONS)} AS INT)
              AS evaluable_dimensions
    FROM profile"""))
def aid_risk_profile(spark: SparkSession, d: str) -> DataFrame:
    return gold.risk_profile(checkpointed(_aid(spark, d)))
