"""The gold tables as functions of the silver tables.

Column names, codes and thresholds here are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import (
    count_known,
    count_true,
    effective_flag,
    gap_ratio,
    growth_rate,
    guarded_ratio,
    log_index,
    null_if,
    per_capita,
    ratio,
    tier,
)
from panelkit.operators.allocation import prorate_by_year
from panelkit.operators.cleaning import conform, latest_value, one_per_key, require_not_null, tag
from panelkit.operators.flows import flow_balance, route_matrix
from panelkit.operators.forest import ForestRun, ForestSpec, run_forest
from panelkit.operators.indicators import (
    any_flag,
    appeal_funding,
    category_features,
    minmax_score,
    needs_metrics,
    peak_by,
    response_gaps,
)
from panelkit.operators.indicators import risk_profile as _risk_profile
from panelkit.operators.panels import averages_panel, densify, outer_panel
from panelkit.operators.series import lag_value, naive_projection, yoy_growth
from panelkit.operators.trend import backtest
from panelkit.operators.trend import trend_forecast as _trend_forecast
from panelkit.sources.tables import between_years

PLACE_YEAR = ["location_code", "year"]
STOCKS = ("refugees", "asylum_seekers", "oip", "idps")
OUTFLOWS = ("returned_refugees", "resettlement", "naturalisation", "returned_idps")

CONFLICT_FEATURES = {
    "total_fatalities": ("political_violence", "fatalities"),
    "violent_events": ("political_violence", "events"),
    "civilian_targeting_events": ("civilian_targeting", "events"),
    "civilian_targeting_fatalities": ("civilian_targeting", "fatalities"),
    "non_violent_events": ("demonstration", "events"),
}
POVERTY_RATES = {
    "mpi": "mpi",
    "hdx_head": "headcount_ratio",
    "hdx_vuln": "vulnerable_to_poverty",
    "hdx_sev": "in_severe_poverty",
}
CRISIS_PHASES = ("3", "3+", "4", "5")
NEED_STATUSES = {
    "population_affected": "AFF",
    "population_in_need": "INN",
    "population_targeted": "TGT",
    "population_reached": "REA",
}
PER_CAPITA_BOUNDS = (0.005, 0.02, 0.05)
PER_GDP_BOUNDS = (10.0, 100.0, 500.0)
FUNDING_GAP_BOUNDS = (0.3, 0.5, 0.7)
MIN_BASE_FOR_GROWTH = 1000
UNDERFUNDED_BELOW_PCT = 50
FIRST_YEAR, LAST_YEAR = 2000, 2025

TREND_VARIABLES = (
    "internal_idps", "total_displacement_burden", "funding_coverage_pct", "conflict_events_total",
)
BACKTEST_VARIABLES = ("internal_idps", "total_displacement_burden", "conflict_events_total")
# What the reports say about fits and their validation, per variable.
TREND_SUMMARY = {
    "entities": ("rows", "*"),
    "mean_observations": ("mean", "n_observations", 1),
    "r_squared_mean": ("mean", "r_squared", 3),
    "r_squared_min": ("min", "r_squared", 3),
    "r_squared_max": ("max", "r_squared", 3),
}
VALIDATION_SUMMARY = {
    "entities": ("rows", "*"),
    "wins": ("true", "beats_naive"),
    "win_rate_pct": ("true_pct", "beats_naive", 1),
    "regression_mape": ("mean", "regression_mape", 1),
    "naive_mape": ("mean", "naive_mape", 1),
}
# Whether a high value is the worse one.
RISK_DIRECTIONS = {
    "internal_idps": True,
    "total_displacement_burden": True,
    "aid_gap": True,
    "conflict_events_total": True,
    "funding_coverage_pct": False,
    "gdp_per_capita": False,
    "extreme_poverty": True,
}

PRESSURE_FOREST = ForestSpec(
    entity="coa_iso",
    period="year",
    tier="pressure_per_capita_tier",
    features=(
        "pressure_per_capita", "tier_code", "pressure_per_gdp_per_capita", "growth_rate",
        "funding_gap", "has_funding_data", "has_hrp", "in_gho", "gdp_per_capita",
    ),
    flags=("has_funding_data", "has_hrp", "in_gho"),
    filled=("growth_rate", "pressure_per_gdp_per_capita", "funding_gap", "gdp_per_capita"),
)


def conflict_features(conflict_events: DataFrame) -> DataFrame:
    """Events and fatalities by kind, from the finest administrative level reported."""
    return category_features(conflict_events, PLACE_YEAR, "admin_level", "event_type", CONFLICT_FEATURES)


def poverty_features(povertyrate: DataFrame, mpm: DataFrame, extreme_poverty: DataFrame) -> DataFrame:
    """National poverty measures of three sources."""

    def yearly(df: DataFrame) -> DataFrame:
        return df.withColumn("year", F.col("year").cast("int"))

    return averages_panel(
        [
            (yearly(povertyrate.filter("admin_level = 0")), POVERTY_RATES),
            (yearly(mpm), {"mpm": "mpm_value"}),
            (yearly(extreme_poverty), {"ext_pov": "extreme_poverty_value"}),
        ],
        PLACE_YEAR,
    )


def food_security_features(foodsecurity: DataFrame) -> DataFrame:
    """Worst national count of people in phase 3 or above."""
    national_crisis = (F.col("admin_level") == 0) & (F.col("ipc_phase") == "3+")
    return peak_by(
        foodsecurity, PLACE_YEAR, "population_in_phase", national_crisis, "peak_population_phase3plus"
    )


def funding_features(funding: DataFrame) -> DataFrame:
    """Funding and requirements spread over the years of each appeal; coverage is a fraction."""
    spread = prorate_by_year(
        # The year of the period's start gives way to the years the period covers.
        funding.select(
            "location_code", "reference_period_start", "reference_period_end", "funding_usd", "requirements_usd"
        ),
        "reference_period_start",
        "reference_period_end",
        {"_funding": "funding_usd", "_requirements": "requirements_usd"},
    )
    yearly = spread.groupBy(*PLACE_YEAR).agg(
        F.sum("_funding").alias("funding_received_usd"), F.sum("_requirements").alias("requirements_usd")
    )
    covered = yearly.withColumn(
        "funding_coverage_pct", guarded_ratio(F.col("funding_received_usd"), F.col("requirements_usd"))
    )
    return lag_value(covered, ["location_code"], "year", "funding_coverage_pct", out="funding_coverage_lag1")


def displacement(population: DataFrame, solutions: DataFrame, floor_zero: bool = False) -> DataFrame:
    """Stocks, outflows and implied inflows per origin, host and year."""
    return route_matrix(
        population, solutions, ["coo_iso", "coa_iso"], "year", STOCKS, OUTFLOWS,
        {"coo_name": "coo_name", "coa_name": "coa_name"}, floor_zero,
    )


def host_aggregates(displaced: DataFrame) -> DataFrame:
    """Totals per host for every year of the data, with the growth of the stock.

    Hosts without a name anywhere are left out; years without data count as 0.
    """
    totals = {
        "refugees_count": "refugees",
        "asylum_seekers_count": "asylum_seekers",
        "oip_count": "oip",
        "idps_count": "idps",
        "total_hosted_stock": "stock",
        "total_inflows": "inflows",
        "total_outflows": "outflows",
    }
    sums = displaced.groupBy("coa_iso", "year").agg(*[F.sum(c).alias(out) for out, c in totals.items()])
    # Distinct first: the minimum over text then runs on a few rows per host.
    named = require_not_null(displaced.select("coa_iso", "coa_name").distinct(), ["coa_name"])
    hosts = named.groupBy("coa_iso").agg(F.min("coa_name").alias("coa_name"))
    dense = densify(sums, "coa_iso", "year", {out: 0 for out in totals}, hosts, displaced)
    lagged = lag_value(dense, ["coa_iso"], "year", "total_hosted_stock", out="hosted_stock_lag1")
    return lagged.withColumn(
        "growth_rate", growth_rate(F.col("total_hosted_stock"), F.col("hosted_stock_lag1"))
    ).select(
        "coa_iso", "coa_name", "year", "refugees_count", "asylum_seekers_count", "oip_count", "idps_count",
        "total_hosted_stock", "hosted_stock_lag1", "total_inflows", "total_outflows", "growth_rate",
    )


def country_fact(
    conflict: DataFrame,
    poverty: DataFrame,
    food_security: DataFrame,
    funding: DataFrame,
    wb_population: DataFrame,
    wb_gdp: DataFrame,
    location: DataFrame,
) -> DataFrame:
    """All features of a country-year found in any source.

    No reported conflict means none; the other measures stay unknown. The response-plan flags
    hold from the year in which the country's entry in the location table takes effect.
    """
    panel = outer_panel(
        [
            conflict,
            poverty,
            food_security,
            funding.drop("funding_coverage_lag1"),
            wb_population.select(*PLACE_YEAR, "total_population"),
            wb_gdp.select(*PLACE_YEAR, "gdp_per_capita"),
        ],
        PLACE_YEAR,
    ).fillna(0, subset=list(CONFLICT_FEATURES))
    entries = one_per_key(location, ["code"], [F.col("year").asc_nulls_last(), F.col("name")]).select(
        F.col("code").alias("location_code"),
        F.col("name").alias("location_name"),
        F.col("has_hrp").alias("_hrp"),
        F.col("in_gho").alias("_gho"),
        F.col("year").alias("_effective"),
    )
    flagged = panel.join(entries, "location_code", "left").withColumns({
        "has_hrp": effective_flag(F.col("year"), F.col("_effective"), F.col("_hrp")),
        "in_gho": effective_flag(F.col("year"), F.col("_effective"), F.col("_gho")),
    })
    # Lagged on the whole panel, where the previous row may come from any source.
    lagged = lag_value(flagged, ["location_code"], "year", "funding_coverage_pct", out="funding_coverage_lag1")
    return lagged.select(
        "location_code", "location_name", "year", *CONFLICT_FEATURES, "mpi", "hdx_head", "hdx_vuln",
        "hdx_sev", "mpm", "ext_pov", "peak_population_phase3plus", "funding_received_usd",
        "requirements_usd", "funding_coverage_pct", "funding_coverage_lag1", "total_population",
        "gdp_per_capita", "has_hrp", "in_gho",
    )


def host_pressure_indices(hosts: DataFrame, facts: DataFrame) -> DataFrame:
    """Pressure of hosting relative to population, income and funding, with tiers."""
    panel = hosts.join(facts.withColumnRenamed("location_code", "coa_iso"), ["coa_iso", "year"], "left")
    stock = F.col("total_hosted_stock")
    required, received = F.col("requirements_usd"), F.col("funding_received_usd")
    measured = panel.withColumns({
        "coa_name": F.coalesce("coa_name", "location_name"),
        "cross_border_stock": F.col("refugees_count") + F.col("asylum_seekers_count") + F.col("oip_count"),
        "pressure_per_capita": ratio(stock, F.col("total_population")),
        "pressure_per_gdp_per_capita": ratio(stock, F.col("gdp_per_capita")),
        "has_funding_data": received.isNotNull() | required.isNotNull(),
        "funding_gap": gap_ratio(required, received),
    }).withColumns({
        "pressure_per_gdp_log_index": log_index(F.col("pressure_per_gdp_per_capita")),
        "pressure_per_capita_tier": tier(F.col("pressure_per_capita"), PER_CAPITA_BOUNDS),
        "pressure_per_gdp_per_capita_tier": tier(F.col("pressure_per_gdp_per_capita"), PER_GDP_BOUNDS),
        "funding_gap_tier": tier(F.col("funding_gap"), FUNDING_GAP_BOUNDS, inclusive=True),
    })
    return tag(measured, is_forecast=False).select(
        "coa_iso", "coa_name", "year", "is_forecast", "refugees_count", "asylum_seekers_count",
        "oip_count", "idps_count", "cross_border_stock", "total_hosted_stock", "hosted_stock_lag1",
        "total_inflows", "total_outflows", "growth_rate", "pressure_per_capita",
        "pressure_per_capita_tier", "pressure_per_gdp_per_capita", "pressure_per_gdp_log_index",
        "pressure_per_gdp_per_capita_tier", "has_funding_data", "funding_gap", "funding_gap_tier",
        "total_population", "gdp_per_capita", "funding_received_usd", "requirements_usd", "has_hrp",
        "in_gho", "mpi", "hdx_head", "hdx_vuln", "hdx_sev", "mpm", "ext_pov",
        "peak_population_phase3plus",
    )


def pressure_forecast(indices: DataFrame, spec: ForestSpec = PRESSURE_FOREST) -> tuple[ForestRun, DataFrame]:
    """Fit the tier forest on the observed rows; return it and the forecast as rows of the table."""
    run = run_forest(indices.filter(~F.col("is_forecast")), spec)
    rows = conform(run.forecast, indices.schema, {
        "coa_iso": F.col("coa_iso"),
        "coa_name": F.col("coa_name"),
        "year": F.col("forecast_period"),
        "is_forecast": F.lit(True),
        "pressure_per_capita_tier": F.col("predicted_tier"),
    })
    return run, rows


# -- aid demand -------------------------------------------------------------------------------


def _as_long(column: str):
    return null_if(F.col(column).cast("string"), "-", "bigint")


def internal_displacement(population: DataFrame) -> DataFrame:
    """Internally displaced per country and year, their trend and a naive projection."""
    yearly = (
        population.filter(F.col("coa_iso") == F.col("coo_iso"))
        .groupBy(F.col("coo_iso").alias("location_code"), "year")
        .agg(F.sum(_as_long("idps")).alias("internal_idps"))
    )
    grown = yoy_growth(
        yearly, ["location_code"], "year", "internal_idps", MIN_BASE_FOR_GROWTH,
        "internal_idps_lag1", "idps_yoy_growth_pct", "idps_acceleration",
    )
    return naive_projection(
        grown, ["location_code"], "year", "internal_idps", 3,
        "idps_moving_avg_3y", "idps_naive_projection_1y", "projection_divergence_pct",
    )


def hosted_flows(population: DataFrame, solutions: DataFrame) -> DataFrame:
    """Refugees and asylum seekers hosted, and the balance of arrivals and departures.

    The stock is unknown where one of the two groups is never reported.
    """
    crossed = F.col("coa_iso") != F.col("coo_iso")
    by_host = [F.col("coa_iso").alias("location_code"), "year"]
    stock = population.filter(crossed).groupBy(*by_host).agg(
        (F.sum(_as_long("refugees")) + F.sum(_as_long("asylum_seekers"))).alias("stock_hosted")
    )
    left = sum((F.coalesce(_as_long(c), F.lit(0)) for c in OUTFLOWS[:3]), F.lit(0))
    outflow = solutions.filter(crossed).groupBy(*by_host).agg(F.sum(left).alias("tracked_outflow"))
    joined = outer_panel([stock, outflow], PLACE_YEAR, anchors=[0])
    return flow_balance(joined, ["location_code"], "year", "stock_hosted", "tracked_outflow")


def needs_gaps(needs: DataFrame) -> DataFrame:
    """People in need, targeted and reached, and the gaps between them."""
    national = needs.filter((F.col("sector_code") == "Intersectoral") & (F.col("admin_level") == 0))
    metrics = needs_metrics(
        national, PLACE_YEAR, "population_status", "category", "population", NEED_STATUSES
    )
    return response_gaps(metrics, "population_in_need", "population_targeted", "population_reached")


def scored_needs(gaps: DataFrame) -> DataFrame:
    """The gaps with their rank within the year. They are read twice: write them first if needs are many."""
    return minmax_score(gaps, "year", {"score_gap_absolute": "aid_gap", "score_gap_ratio": "aid_gap_ratio"}, 3)


def conflict_totals(conflict_events: DataFrame) -> DataFrame:
    """All events and fatalities of every level and kind, with the previous year's events."""
    totals = conflict_events.groupBy(*PLACE_YEAR).agg(
        F.sum("events").alias("conflict_events_total"), F.sum("fatalities").alias("conflict_fatalities_total")
    )
    return lag_value(
        totals, ["location_code"], "year", "conflict_events_total", guard_gap=True, out="conflict_events_lag1"
    )


def food_crisis(foodsecurity: DataFrame) -> DataFrame:
    """Whether a current national assessment found a crisis; only where there is an assessment."""
    current = foodsecurity.filter((F.col("ipc_type") == "current") & (F.col("admin_level") == 0))
    return any_flag(current, PLACE_YEAR, F.col("ipc_phase").isin(*CRISIS_PHASES), "has_food_crisis")


def funding_outside_appeals(funding: DataFrame) -> DataFrame:
    """Newest amount of funding not tied to an appeal."""
    newest = latest_value(
        funding.filter(F.col("appeal_code") == "Not specified"), PLACE_YEAR, ["funding_usd"], "ingested_at"
    )
    return newest.withColumnRenamed("funding_usd", "funding_outside_appeals_usd")


def aid_demand(
    population: DataFrame,
    solutions: DataFrame,
    gaps: DataFrame,
    conflict_events: DataFrame,
    foodsecurity: DataFrame,
    funding: DataFrame,
    wb_gdp: DataFrame,
    wb_mpm: DataFrame,
    wb_extreme_poverty: DataFrame,
    wb_population: DataFrame,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
) -> DataFrame:
    """Everything about a country-year with displaced people: trend, flows, needs, funding, risk.

    The keys are those with internal or hosted displaced; the other blocks are looked up. Years
    are cut at the end, as earlier ones are needed for the lags. ``gaps`` are those of ``needs_gaps``.
    """
    population = require_not_null(population, ["coo_iso", "coa_iso", "year"])
    solutions = require_not_null(solutions, ["coo_iso", "coa_iso", "year"])
    gaps, conflict_events, foodsecurity = (
        require_not_null(df, PLACE_YEAR) for df in (gaps, conflict_events, foodsecurity)
    )
    funding = require_not_null(funding, [*PLACE_YEAR, "appeal_code"])

    # Regional aggregates among the indicators need no filter of their own: they are no country of
    # the population table, and only keys from there are kept below.
    def indicator(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
        return require_not_null(df, PLACE_YEAR).select(*PLACE_YEAR, F.col(column).alias(out or column))

    appeals = appeal_funding(
        funding, ["location_code"], "year", "appeal_code", "requirements_usd", "funding_usd", "ingested_at"
    )
    master = outer_panel(
        [
            internal_displacement(population),
            hosted_flows(population, solutions),
            scored_needs(gaps),
            conflict_totals(conflict_events),
            food_crisis(foodsecurity),
            appeals,
            funding_outside_appeals(funding),
            indicator(wb_gdp, "gdp_per_capita"),
            indicator(wb_mpm, "mpm_value", "mpi"),
            indicator(wb_extreme_poverty, "extreme_poverty_value", "extreme_poverty"),
            indicator(wb_population, "total_population"),
        ],
        PLACE_YEAR,
        anchors=[0, 1],
    )
    return between_years(_with_risk(_with_burden(master)), first_year, last_year)


def _with_burden(df: DataFrame) -> DataFrame:
    zero = F.lit(0)
    return df.withColumn(
        "total_displacement_burden",
        F.coalesce(F.col("internal_idps"), zero) + F.coalesce(F.col("stock_hosted"), zero),
    ).withColumn(
        "displaced_per_1000_inhabitants",
        per_capita(F.col("total_displacement_burden"), F.col("total_population")),
    )


def _with_risk(df: DataFrame) -> DataFrame:
    flags = [F.col(c) for c in ("is_idps_rising", "is_underfunded", "has_food_crisis")]
    return df.withColumns({
        "is_idps_rising": F.col("idps_yoy_growth_pct") > 0,
        "is_underfunded": F.col("funding_coverage_pct") < UNDERFUNDED_BELOW_PCT,
    }).withColumns({
        "active_risk_conditions": count_true(*flags),
        "evaluable_risk_conditions": count_known(*flags),
    })


def trend_forecast(aid: DataFrame) -> DataFrame:
    return _trend_forecast(aid, "location_code", "year", TREND_VARIABLES)


def model_validation(aid: DataFrame) -> DataFrame:
    return backtest(aid, "location_code", "year", BACKTEST_VARIABLES)


def risk_profile(aid: DataFrame) -> DataFrame:
    return _risk_profile(aid, "location_code", "year", RISK_DIRECTIONS)
