from datetime import datetime

from pyspark.sql import functions as F

from panelkit import operators as op
from panelkit.plans import gold
from tests.conftest import rows

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_at_max_level_keeps_ties_and_null_keys(frame):
    df = frame(
        "k STRING, l INT, v INT", ("a", 0, 1), ("a", 2, 2), ("a", 2, 3), (None, 1, 4), (None, 0, 5), ("b", None, 6)
    )
    assert rows(op.at_max_level(df, ["k"], "l").select("v"), "v") == [(2,), (3,), (4,)]


def test_conflict_features_use_the_finest_level(frame):
    events = frame(
        "location_code STRING, year INT, admin_level INT, event_type STRING, events INT, fatalities INT",
        ("AFG", 2020, 0, "political_violence", 100, 100),
        ("AFG", 2020, 2, "political_violence", 3, None),
        ("AFG", 2020, 2, "civilian_targeting", None, 2),
        ("AFG", 2020, 2, "demonstration", 4, 1),
        ("AFG", 2020, 2, "unheard_of", 9, 9),
        ("AFG", 2021, 0, "demonstration", 1, None),
        ("AFG", None, None, "demonstration", 1, None),
    )
    assert rows(gold.conflict_features(events), "year") == [
        ("AFG", 2020, 0, 3, 0, 2, 4), ("AFG", 2021, 0, 0, 0, 0, 1),
    ]
    # the other table adds up every level and kind
    totals = rows(gold.conflict_totals(events.filter("year IS NOT NULL")), "year")
    assert totals == [("AFG", 2020, 116, 112, None), ("AFG", 2021, 1, None, 116)]


def test_peak_and_flag(frame):
    ipc = frame(
        "location_code STRING, year INT, admin_level INT, ipc_phase STRING, ipc_type STRING, population_in_phase INT",
        ("A", 2020, 0, "3+", "current", 5), ("A", 2020, 0, "3+", "first projection", 8), ("A", 2020, 1, "3+", "current", 99),
        ("B", 2020, 0, "1", "current", 7), ("B", 2020, 0, None, "current", 7), ("C", 2020, 0, "4", "first projection", 2),
        ("D", 2020, 0, "5", "current", 2),
    )
    assert rows(gold.food_security_features(ipc)) == [("A", 2020, 8)]
    assert rows(gold.food_crisis(ipc), "location_code") == [
        ("A", 2020, True), ("B", 2020, False), ("D", 2020, True),
    ]


NEEDS = "location_code STRING, year INT, sector_code STRING, admin_level INT, population_status STRING, category STRING, population INT"


def test_needs_gaps_and_scores(frame):
    def need(place, status, population, category="total", sector="Intersectoral", level=0):
        return (place, 2020, sector, level, status, category, population)

    needs = frame(
        NEEDS,
        need("A", "INN", 100), need("A", "TGT", 40), need("A", "REA", 0), need("A", "INN", 999, None),
        need("B", "INN", 50, ""), need("B", "TGT", 0), need("B", "REA", 20), need("B", "INN", 999, "men"),
        need("C", "INN", 80), need("C", "TGT", 60), need("C", "INN", 999, level=1), need("C", "INN", 999, sector="Food"),
        need("D", "AFF", 5),
    )
    columns = ["population_in_need", "aid_gap", "aid_gap_ratio", "response_gap", "score_gap_absolute", "score_gap_ratio"]
    assert rows(gold.scored_needs(gold.needs_gaps(needs)).select("location_code", *columns), "location_code") == [
        ("A", 100, 60, 2.5, None, 1.0, 1.0),
        ("B", 50, 50, None, 30, 0.75, None),
        ("C", 80, 20, 1.333, None, 0.0, 0.0),
        ("D", None, None, None, None, None, None),
    ]


def test_score_without_spread_or_value_is_null(frame):
    df = frame(
        "k STRING, y INT, v INT", ("a", 2000, 5), ("a", 2001, 1), ("b", 2001, 3), ("c", 2001, None), ("d", 2001, 9),
        ("e", None, 1), ("f", None, 2),
    )
    scored = op.minmax_score(df, "y", {"s": "v", "inv": "v"}, 3, ["inv"])
    assert rows(scored.select("k", "y", "s", "inv"), "y", "k") == [
        ("e", None, 0.0, 1.0), ("f", None, 1.0, 0.0), ("a", 2000, None, None), ("a", 2001, 0.0, 1.0),
        ("b", 2001, 0.25, 0.75), ("c", 2001, None, None), ("d", 2001, 1.0, 0.0),
    ]


def test_score_of_extreme_integers(frame):
    df = frame("y INT, v BIGINT", (1, -(2**63)), (1, 0), (1, 2**63 - 1))
    assert rows(op.minmax_score(df, "y", {"s": "v"}).select("s"), "s") == [(0.0,), (0.5,), (1.0,)]


def test_risk_profile_counts_known_dimensions(frame):
    df = frame("k STRING, y INT, hi INT, lo DOUBLE", ("a", 1, 10, 1.0), ("b", 1, 20, None), ("c", 1, None, 3.0))
    profile = op.risk_profile(df, "k", "y", {"hi": True, "lo": False})
    assert rows(profile, "k") == [("a", 1, 0.0, 1.0, 2), ("b", 1, 1.0, None, 1), ("c", 1, None, 0.0, 1)]


def test_appeal_funding(frame):
    schema = "place STRING, year INT, appeal STRING, need DOUBLE, got DOUBLE, at TIMESTAMP"
    df = frame(
        schema,
        ("A", 2020, "p", 100.0, 50.0, T1), ("A", 2020, "p", 200.0, 50.0, T2), ("A", 2020, "q", 50.0, 250.0, None),
        ("A", 2020, "zero", 0.0, 9.0, T1), ("A", 2020, "none", None, 9.0, T1),
        ("A", 2021, "p", 10.0, 5.0, T1), ("A", 2023, "p", 10.0, None, T1),
    )
    funded = op.appeal_funding(df, ["place"], "year", "appeal", "need", "got", "at")
    columns = [c for c in funded.columns if c != "place"]
    assert columns == [
        "year", "num_appeals", "total_required_usd", "total_received_usd", "funding_gap_usd",
        "funding_coverage_pct", "is_funding_anomalous", "funding_coverage_lag1",
    ]
    assert rows(funded.select(*columns), "year") == [
        (2020, 2, 250.0, 300.0, -50.0, 120.0, True, None),
        (2021, 1, 10.0, 5.0, 5.0, 50.0, False, 120.0),
        (2023, 1, 10.0, None, None, None, None, None),
    ]


def test_reports(frame):
    df = frame("k STRING, y INT, v DOUBLE", ("a", 1, 1.0), ("a", 2, None), ("b", 3, 2.0))
    assert rows(op.quality_report(df, "k", "y", ["v"], ["v"])) == [(3, 2, 1, 3, 2, 1.5)]
    assert rows(op.coverage_report(df, ["k", "v"])) == [(100.0, 66.7)]
    assert rows(op.coverage_report(df.limit(0), ["k"])) == [(None,)]
    assert rows(op.distribution(df, "k")) == [("a", 2), ("b", 1)]
    assert rows(op.top(df, [F.desc("y")], 1)) == [("b", 3, 2.0)]


def test_classification_report_matches_counts(frame):
    df = frame("a DOUBLE, p DOUBLE", *([(0.0, 0.0)] * 3 + [(0.0, 1.0)] + [(1.0, 0.0)] * 2 + [(1.0, 1.0)] * 2))
    report = op.classification_report(df, "a", "p", [0.0, 1.0, 2.0])
    assert rows(report.select("label", "support", "predicted", "hits", F.round("f1", 4)), "label") == [
        (0.0, 4, 5, 3, 0.6667), (1.0, 4, 3, 2, 0.5714), (2.0, 0, 0, 0, 0.0),
    ]
    assert rows(op.macro_f1(report).select(F.round("macro_f1", 4))) == [(0.4127,)]
    assert rows(op.confusion(df, "a", "p", [0, 1]), "a") == [(0.0, 3, 1, 0), (1.0, 2, 2, 0)]
