"""The sixteen feeds: raw schema, kept fields, cleaning rules and business key of each.

Everything in the tables below is a fixed value: field names, types, key columns and table names
have to be exactly these for the feeds' JSON to parse and the tables to carry the right columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Literal

from pyspark.sql.types import DataType, DateType, IntegerType, StringType, StructType, TimestampType, VariantType

# Columns of raw tables besides those of the feed: the text of a record that is no JSON, fields that the feed's schema
# did not know, when a record came, and the day of that, by which the tables are partitioned.
BAD_RECORD, UNKNOWN, INGESTED_AT, INGESTED_ON = "bad_record", "unknown_fields", "ingested_at", "ingested_on"

YearRule = Literal["native", "period_start", "period_span", "none"]


@dataclass(frozen=True)
class FeedSpec:
    """One feed. ``ddl`` is the schema of its JSON, ``mapping`` takes JSON paths to column names."""

    topic: str
    table: str
    ddl: str
    mapping: Mapping[str, str]
    not_null: tuple[str, ...]
    keys: tuple[str, ...]
    year_rule: YearRule
    placeholder_ints: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> StructType:
        """Schema of the JSON."""
        return StructType.fromDDL(self.ddl)

    @property
    def bronze_schema(self) -> StructType:
        """Schema of the table of raw rows."""
        table = StructType()
        for path, name in self.mapping.items():
            table.add(name, type_at(self.schema, path))
        table = table.add(BAD_RECORD, StringType()).add(UNKNOWN, VariantType())
        return table.add(INGESTED_AT, TimestampType()).add(INGESTED_ON, DateType())

    @property
    def silver_schema(self) -> StructType:
        """Schema of the cleaned table."""
        table = StructType()
        for column in self.bronze_schema.fields:
            if column.name in (BAD_RECORD, UNKNOWN, INGESTED_ON):
                continue
            table.add(column.name, IntegerType() if column.name in self.placeholder_ints else column.dataType)
        parts = {"period_start": ("year", "month", "day"), "period_span": ("year",)}
        for name in parts.get(self.year_rule, ()):
            table.add(name, IntegerType())
        return table


def type_at(schema: StructType, path: str) -> DataType:
    """Type of a field given by its dotted path."""
    return reduce(lambda found, name: found[name].dataType, path.split("."), schema)


PLACE = "location_code STRING, location_name STRING"
ADMIN1 = f"{PLACE}, admin1_code STRING, admin1_name STRING"
ADMIN2 = f"{ADMIN1}, admin2_code STRING, admin2_name STRING"
PERIOD = "reference_period_start STRING, reference_period_end STRING"
ROUTE = (
    "year INT, coo_id STRING, coo_name STRING, coo STRING, coo_iso STRING, "
    "coa_id STRING, coa_name STRING, coa STRING, coa_iso STRING"
)
WORLD_BANK = (
    "indicator STRUCT<id: STRING, value: STRING>, country STRUCT<id: STRING, value: STRING>, "
    "countryiso3code STRING, date INT, value DOUBLE, unit STRING, obs_status STRING, decimal INT"
)
PERIOD_KEY = ("reference_period_start", "reference_period_end")
ADMIN1_KEY = ("location_code", "admin1_code", "admin_level")
ADMIN2_KEY = ("location_code", "admin1_code", "admin2_code", "admin_level")
ROUTE_KEY = ("year", "coo_iso", "coa_iso")


def _feed(topic, ddl, not_null, keys, year_rule, table=None, placeholder_ints=(), mapping=None):
    names = [column.split()[0] for column in ddl.split(", ")]
    return FeedSpec(
        topic=topic,
        table=table or topic,
        ddl=ddl,
        mapping=mapping or {name: name for name in names},
        not_null=tuple(not_null),
        keys=tuple(keys),
        year_rule=year_rule,
        placeholder_ints=tuple(placeholder_ints),
    )


def _world_bank(topic, value, table=None):
    key = ("location_code", "year")
    return _feed(
        topic, WORLD_BANK, (*key, value), key, "native", table,
        mapping={
            "countryiso3code": "location_code",
            "country.value": "location_name",
            "date": "year",
            "value": value,
        },
    )


_SPECS = (
    _feed(
        "population",
        f"{ROUTE}, refugees INT, asylum_seekers INT, returned_refugees INT, idps INT, "
        "returned_idps INT, stateless INT, ooc INT, oip STRING, hst INT",
        ROUTE_KEY, ROUTE_KEY, "native", placeholder_ints=("oip",),
    ),
    _feed(
        "solutions",
        f"{ROUTE}, returned_refugees STRING, resettlement STRING, naturalisation STRING, "
        "returned_idps STRING",
        ROUTE_KEY, ROUTE_KEY, "native",
        placeholder_ints=("returned_refugees", "resettlement", "naturalisation", "returned_idps"),
    ),
    _world_bank("worldbank_population", "total_population"),
    _world_bank("worldbank_gdp", "gdp_per_capita"),
    _world_bank("worldbank_mpi", "mpm_value", table="worldbank_mpm"),
    _world_bank("worldbank_extreme_poverty", "extreme_poverty_value"),
    _feed(
        "conflict_events",
        f"{ADMIN2}, admin_level INT, resource_hdx_id STRING, event_type STRING, events INT, "
        f"fatalities INT, {PERIOD}",
        ("location_code", "event_type"), (*ADMIN2_KEY, "event_type", *PERIOD_KEY), "period_start",
    ),
    _feed(
        "poverty_rate",
        f"{ADMIN1}, admin_level INT, resource_hdx_id STRING, mpi DOUBLE, headcount_ratio DOUBLE, "
        "intensity_of_deprivation DOUBLE, vulnerable_to_poverty DOUBLE, in_severe_poverty DOUBLE, "
        f"{PERIOD}",
        ("location_code",), (*ADMIN1_KEY, *PERIOD_KEY), "period_span", table="povertyrate",
    ),
    _feed(
        "food_security",
        f"{ADMIN2}, admin_level INT, resource_hdx_id STRING, ipc_phase STRING, ipc_type STRING, "
        f"population_in_phase INT, population_fraction_in_phase DOUBLE, {PERIOD}",
        ("location_code", "population_in_phase"),
        (*ADMIN2_KEY, "ipc_phase", "ipc_type", *PERIOD_KEY), "period_span", table="foodsecurity",
    ),
    _feed(
        "funding",
        f"resource_hdx_id STRING, {PLACE}, appeal_code STRING, appeal_name STRING, "
        "appeal_type STRING, requirements_usd DOUBLE, funding_usd DOUBLE, funding_pct DOUBLE, "
        f"{PERIOD}",
        ("location_code", "appeal_code"),
        ("location_code", "appeal_code", "appeal_type", *PERIOD_KEY), "period_start",
    ),
    _feed(
        "idps",
        f"{ADMIN2}, admin_level INT, resource_hdx_id STRING, reporting_round INT, "
        f"assessment_type STRING, operation STRING, population INT, {PERIOD}",
        ("location_code", "population"),
        (*ADMIN2_KEY, "reporting_round", "assessment_type", "operation", *PERIOD_KEY), "period_start",
    ),
    _feed(
        "humanitarian_needs",
        f"{ADMIN2}, admin_level INT, resource_hdx_id STRING, sector_code STRING, "
        "sector_name STRING, category STRING, population_status STRING, population INT, "
        f"{PERIOD}",
        ("location_code", "population", "sector_code"),
        (*ADMIN2_KEY, "sector_code", "category", "population_status", *PERIOD_KEY), "period_start",
    ),
    _feed(
        "operational_presence",
        f"{ADMIN2}, admin_level INT, resource_hdx_id STRING, org_acronym STRING, org_name STRING, "
        "sector_code STRING, sector_name STRING, org_type_code STRING, "
        f"org_type_description STRING, {PERIOD}",
        ("location_code", "sector_code", "org_acronym"),
        (*ADMIN2_KEY, "org_acronym", "org_type_code", "sector_code", *PERIOD_KEY), "period_start",
    ),
    _feed("sector", "code STRING, name STRING", ("code",), ("code",), "none"),
    _feed(
        "location",
        f"id INT, code STRING, name STRING, has_hrp BOOLEAN, in_gho BOOLEAN, from_cods BOOLEAN, {PERIOD}",
        ("code",), ("code", *PERIOD_KEY), "period_start",
    ),
    _feed(
        "national_risk",
        f"{PLACE}, risk_class INT, global_rank INT, overall_risk DOUBLE, "
        "hazard_exposure_risk DOUBLE, vulnerability_risk DOUBLE, coping_capacity_risk DOUBLE, "
        "meta_missing_indicators_pct DOUBLE, meta_avg_recentness_years DOUBLE, "
        f"{PERIOD}, resource_hdx_id STRING",
        ("location_code", "overall_risk"), ("location_code", *PERIOD_KEY), "period_start",
    ),
)

FEEDS: dict[str, FeedSpec] = {spec.topic: spec for spec in _SPECS}
