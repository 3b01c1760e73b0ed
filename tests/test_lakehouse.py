"""A small world of all sixteen feeds, from JSON messages to every gold table."""

import json

import pytest
from pyspark.sql import functions as F

from panelkit.operators.forest import ForestSpec
from panelkit.plans import gold, lakehouse
from panelkit.plans.incremental import refresh_facts
from panelkit.plans.silver import refine, refresh_silver
from panelkit.sources import FEEDS
from tests.conftest import rows

YEARS = range(2008, 2020)
HOSTS = ("AAA", "BBB", "CCC")


def span(first, last=None):
    return {
        "reference_period_start": f"{first}-01-01T00:00:00",
        "reference_period_end": f"{last or first}-12-31T00:00:00",
    }


def place(code, level=0):
    return {
        "location_code": code, "location_name": f"Land {code}", "admin1_code": f"{code}1" if level else None,
        "admin1_name": None, "admin2_code": None, "admin2_name": None, "admin_level": level, "resource_hdx_id": "r",
    }


def bank(code, year, value):
    return {"indicator": {"id": "i", "value": "v"}, "country": {"id": code[:2], "value": f"Land {code}"},
            "countryiso3code": code, "date": str(year), "value": value, "unit": "", "obs_status": "", "decimal": 0}


def route(year, coo, coa, **measures):
    return {"year": year, "coo_iso": coo, "coo_name": f"Land {coo}", "coa_iso": coa,
            "coa_name": None if coa == "CCC" else f"Land {coa}", **measures}


def messages():
    feeds = {topic: [] for topic in FEEDS}
    for i, year in enumerate(YEARS):
        for j, code in enumerate(HOSTS):
            # CCC's name is unknown, and BBB is not reported in 2012
            if (code, year) != ("BBB", 2012):
                feeds["population"].append(route(
                    year, "AAA", code, refugees=0 if code == "AAA" else 1000 * (i + 1) * (j + 1),
                    asylum_seekers="10", idps=2000 + 500 * i if code == "AAA" else 0, oip="-" if j == 1 else "5",
                ))
            feeds["solutions"].append(route(
                year, "AAA", code, returned_refugees="-" if i % 2 else "100", resettlement=str(i),
                naturalisation="-", returned_idps="50" if code == "AAA" else "0",
            ))
            for topic, value in (
                ("worldbank_population", 1e6 * (j + 1)), ("worldbank_gdp", 500.0 + 10 * i + 100 * j),
                ("worldbank_mpi", 0.1 * j), ("worldbank_extreme_poverty", None if j == 2 else 20.0 + i),
            ):
                feeds[topic].append(bank(code, year, value))
            for kind in ("political_violence", "civilian_targeting", "demonstration"):
                for level in (0, 1):
                    feeds["conflict_events"].append(
                        {**place(code, level), "event_type": kind, "events": 10 + i + j, "fatalities": None if level else 3,
                         **span(year)})
            for phase in ("1", "3", "3+", "all"):
                feeds["food_security"].append(
                    {**place(code), "ipc_phase": phase, "ipc_type": "current", "population_in_phase": 100 * (j + 1),
                     "population_fraction_in_phase": 0.1, **span(year)})
            feeds["funding"].append({
                "resource_hdx_id": "r", "location_code": code, "location_name": "x",
                "appeal_code": "Not specified" if j == 2 else f"P{year}", "appeal_name": "O'Hara", "appeal_type": "HRP",
                "requirements_usd": 0.0 if j == 2 else 1000.0, "funding_usd": 100.0 * (i % 12), "funding_pct": 1.0,
                **span(year, year + 1 if j else year)})
            for status, n in (("INN", 900 + i), ("TGT", 500), ("REA", 300)):
                feeds["humanitarian_needs"].append(
                    {**place(code), "sector_code": "Intersectoral", "sector_name": "s", "category": "total",
                     "population_status": status, "population": n * (j + 1), **span(year)})
            feeds["poverty_rate"].append(
                {**place(code), "mpi": 0.2, "headcount_ratio": 30.0, "intensity_of_deprivation": 1.0,
                 "vulnerable_to_poverty": 2.0, "in_severe_poverty": 3.0, **span(year)})
            feeds["idps"].append(
                {**place(code), "reporting_round": 1, "assessment_type": "a", "operation": "o", "population": 5, **span(year)})
            feeds["operational_presence"].append(
                {**place(code), "org_acronym": "ORG", "org_name": "o", "sector_code": "s", "sector_name": "s",
                 "org_type_code": "1", "org_type_description": "d", **span(year)})
            feeds["national_risk"].append(
                {**place(code), "risk_class": 1, "global_rank": 2, "overall_risk": 3.0, **span(year)})
    feeds["sector"] = [{"code": "s", "name": "Sector"}]
    feeds["location"] = [
        {"id": 1, "code": "AAA", "name": "Land AAA", "has_hrp": True, "in_gho": None, "from_cods": True, **span(2015)},
        {"id": 3, "code": "CCC", "name": "Land CCC", "has_hrp": False, "in_gho": True, "from_cods": True, **span(2000)},
    ]
    return feeds


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    from panelkit.sources import TableStore

    folder = tmp_path_factory.mktemp("lake")
    store = TableStore(spark, str(folder / "tables"))
    options = {}
    for topic, records in messages().items():
        inbox = folder / topic
        inbox.mkdir()
        lines = [json.dumps(r) for r in records] + (['{"cut": "short'] if topic == "funding" else [])
        (inbox / "1.json").write_text("\n".join(lines))
        options[topic] = {"path": str(inbox)}
    lakehouse.refresh_bronze(store, "text", options)
    lakehouse.refresh_all_silver(store, since="2000-01-01")
    lakehouse.refresh_features(store)
    small = ForestSpec(**{**gold.PRESSURE_FOREST.__dict__, "num_trees": 5, "min_instances": 1, "partitions": 1})
    lakehouse.refresh_pressure_forecast(store, small)
    run = lakehouse.refresh_pressure_forecast(store, small)
    lakehouse.refresh_aid(store)
    lakehouse.refresh_reports(store, run, small)
    for _ in range(2):
        lakehouse.refresh_quarantine(store, "2000-01-01", (lakehouse.PRESSURE_TABLE, small))
    return store


def test_every_table_is_in_the_catalog(lake, spark):
    for layer, names in (
        ("silver", ["population", "funding", "sector"]),
        ("gold", ["gold_country_fact", "gold_displacement", "gold_host_pressure_indices", "aid_demand_analysis", "risk_profile"]),
        ("reports", ["country_fact_coverage", "funding_gap_tier_distribution", "trend_quality", "pressure_classification", "pressure_confusion", "pressure_macro_f1"]),
    ):
        for name in names:
            assert spark.table(f"{layer}.{name}").count() == lake.read(layer, name).count() > 0, name


def test_nothing_is_lost_without_notice(lake):
    found = lake.read("quarantine", "rejected")
    bad = found.filter("source = 'funding.bad_json'")
    assert [json.loads(r.record) for r in bad.collect()] == [{"bad_record": '{"cut": "short'}]
    bronze = lake.read("bronze", "funding", FEEDS["funding"].bronze_schema)
    assert bronze.filter("bad_record IS NULL").count() + bad.count() == len(messages()["funding"]) + 1
    assert found.groupBy("source", "record").count().filter("count > 1").count() == 0


def test_quarantine_looks_at_each_batch_once(lake):
    lakehouse.refresh_quarantine(lake)
    before = lake.version("quarantine", "rejected")
    assert set(before.marks) == {f"bronze/{f.table}" for f in FEEDS.values()} | {"silver/funding"}
    count = lake.read("quarantine", "rejected").count()
    lakehouse.refresh_quarantine(lake)
    assert lake.version("quarantine", "rejected") == before and lake.read("quarantine", "rejected").count() == count


def test_a_refresh_without_news_writes_no_facts(lake):
    before = [lake.version("gold", t) for t in ("gold_country_fact", "gold_funding_features")]
    refresh_silver(lake, FEEDS["funding"])
    taken = lake.version("silver", "funding")
    assert taken.marks["bronze"] and refresh_facts(lake) == {}
    refresh_silver(lake, FEEDS["funding"])
    assert lake.version("silver", "funding") == taken
    assert [lake.version("gold", t) for t in ("gold_country_fact", "gold_funding_features")] == before


def test_bronze_is_read_by_the_day_of_ingestion(lake):
    from panelkit.sources import read_since

    bronze = lake.read("bronze", "population", FEEDS["population"].bronze_schema)
    plan = read_since(bronze)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingested_on" in plan


def test_silver_holds_one_row_per_key(lake):
    for feed in FEEDS.values():
        table = lake.read("silver", feed.table)
        keys = [*dict.fromkeys([*feed.keys, *([] if feed.year_rule == "none" else ["year"])])]
        assert table.count() > 0
        assert table.groupBy(*keys).count().filter("count > 1").count() == 0, feed.table
    population = lake.read("silver", "population")
    assert population.filter("coa_iso = 'BBB'").select("oip").distinct().collect() == [(None,)]
    assert population.schema["oip"].dataType.simpleString() == "int"


def test_displacement_and_hosts(lake):
    first = lake.read("gold", "gold_displacement").filter("coa_iso = 'BBB' AND year IN (2008, 2011, 2012, 2013)")
    assert rows(first.select("year", "stock", "inflows", "outflows"), "year") == [
        (2008, 2010, None, 100), (2011, 8010, 2003, 3), (2012, 0, -8010 + 104, 104), (2013, 12010, 12010 + 5, 5),
    ]
    hosts = lake.read("gold", "gold_host_aggregates")
    # the host without a name is left out, the others have every year
    assert {r[0] for r in hosts.select("coa_iso").distinct().collect()} == {"AAA", "BBB"}
    assert hosts.count() == 2 * len(YEARS)
    routes = lake.read("gold", "gold_displacement").filter("coa_iso <> 'CCC'")
    by_host = routes.groupBy("coa_iso", "year").agg(F.sum("inflows").alias("i"))
    off = hosts.join(by_host, ["coa_iso", "year"]).filter("total_inflows <> coalesce(i, 0)")
    assert off.count() == 0


def test_facts(lake):
    facts = lake.read("gold", "gold_country_fact")
    assert facts.count() == 3 * len(YEARS) + 2  # two appeals run into 2020
    a = facts.filter("location_code = 'AAA' AND year IN (2014, 2015)")
    columns = ["year", "has_hrp", "in_gho", "total_fatalities", "violent_events", "funding_coverage_pct",
               "funding_coverage_lag1", "mpi", "peak_population_phase3plus"]
    assert rows(a.select(*columns), "year") == [
        (2014, False, False, 0, 16, 0.6, 0.5, 0.2, 100), (2015, True, False, 0, 17, 0.7, 0.6, 0.2, 100),
    ]
    assert facts.filter("location_code = 'BBB' AND (has_hrp OR in_gho)").count() == 0
    beyond = facts.filter("year = 2020 AND location_code = 'BBB'").first()
    assert beyond["total_population"] is None and beyond["violent_events"] == 0
    assert beyond["requirements_usd"] == pytest.approx(1000 * 366 / 731)


def test_pressure_and_forecast(lake):
    table = lake.read("gold", "gold_host_pressure_indices", is_forecast="boolean")
    observed, forecast = table.filter("NOT is_forecast"), table.filter("is_forecast")
    assert observed.count() == 2 * len(YEARS)
    last = observed.filter("coa_iso = 'BBB' AND year = 2019").first()
    assert last["pressure_per_capita"] == pytest.approx(24010 / 2e6)
    assert last["pressure_per_capita_tier"] == "Medium"
    assert last["cross_border_stock"] == 24010 and last["has_funding_data"]
    assert rows(forecast.select("coa_iso", "coa_name", "year", "total_hosted_stock"), "coa_iso") == [
        ("AAA", "Land AAA", 2020, None), ("BBB", "Land BBB", 2020, None),
    ]
    assert forecast.filter("pressure_per_capita_tier IS NULL").count() == 0


def test_aid_chain(lake):
    aid = lake.read("gold", "aid_demand_analysis")
    assert len(aid.columns) == 44
    assert aid.count() == 3 * len(YEARS) - 1
    a = aid.filter("location_code = 'AAA' AND year = 2010").first()
    assert (a["internal_idps"], a["internal_idps_lag1"], a["idps_yoy_growth_pct"]) == (3000, 2500, 20.0)
    assert (a["idps_acceleration"], a["idps_moving_avg_3y"], a["idps_naive_projection_1y"]) == (-5.0, 2500.0, 3500)
    assert (a["stock_hosted"], a["total_displacement_burden"], a["projection_divergence_pct"]) == (None, 3000, 40.0)
    assert (a["displaced_per_1000_inhabitants"], a["aid_gap"], a["score_gap_absolute"]) == (3.0, 402, 0.0)
    assert (a["funding_coverage_pct"], a["is_underfunded"], a["has_food_crisis"]) == (20.0, True, True)
    assert (a["active_risk_conditions"], a["evaluable_risk_conditions"]) == (3, 3)
    b = aid.filter("location_code = 'BBB' AND year = 2013").first()
    # 2012 is missing: the flow balance takes the last known stock all the same
    assert (b["stock_hosted"], b["real_inflow"], b["untracked_outflow"]) == (12010, 4005, 0)
    c = aid.filter("location_code = 'CCC' AND year = 2010").first()
    assert (c["num_appeals"], c["funding_outside_appeals_usd"], c["evaluable_risk_conditions"]) == (None, 200.0, 1)
    trends = lake.read("gold", "trend_forecast")
    assert trends.filter("variable_name = 'internal_idps'").select("predicted_value").collect() == [(8000.0,)]
    validation = lake.read("gold", "model_validation")
    assert validation.filter("variable_name = 'internal_idps'").first()["regression_mae"] == 0.0
    profile = lake.read("gold", "risk_profile")
    assert profile.count() == aid.count()
    assert profile.filter("evaluable_dimensions > 7 OR score_aid_gap > 1").count() == 0


def test_second_silver_run_changes_nothing(lake):
    before = rows(lake.read("silver", "funding").drop("ingested_at"), "location_code", "year", "appeal_code")
    refresh_silver(lake, FEEDS["funding"], since="2000-01-01", mode="merge")
    assert rows(lake.read("silver", "funding").drop("ingested_at"), "location_code", "year", "appeal_code") == before


def test_refine_keeps_only_the_newest_version(lake):
    feed = FEEDS["worldbank_gdp"]
    bronze = lake.read("bronze", feed.table)
    newer = bronze.withColumns({
        "gdp_per_capita": F.col("gdp_per_capita") * 2, "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY"),
    })
    refined = refine(bronze.unionByName(newer), feed)
    assert refined.count() == bronze.count()
    assert refined.agg(F.sum("gdp_per_capita")).first() == newer.agg(F.sum("gdp_per_capita")).first()
