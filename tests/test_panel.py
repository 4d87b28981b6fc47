"""The seven results on the golden fixture, read from CSV."""

from __future__ import annotations

import pytest
from fixture_panel import HISTORY, SNAPSHOT
from podium.functions.continents import (
    AFRICA_UNDERSCORED,
    EUROPE_SENTENCE_CASE,
    continent_rules,
)
from podium.plans import Panel, clean_history, clean_snapshot, run_report
from podium.plans.panel import HISTORY_COLUMNS, SNAPSHOT_COLUMNS
from podium.sources import list_files, read_csv, read_parquet


@pytest.fixture(scope="module")
def csv_paths(tmp_path_factory):
    folder = tmp_path_factory.mktemp("panel")
    (folder / "snapshot.csv").write_text(SNAPSHOT)
    (folder / "history.csv").write_text(HISTORY)
    return str(folder / "snapshot.csv"), str(folder / "history.csv")


@pytest.fixture(scope="module")
def panel(spark, csv_paths):
    snapshot, history = (read_csv(spark, p) for p in csv_paths)
    return Panel(clean_snapshot(snapshot), clean_history(history), no_continent=None)


def rows(df):
    return [tuple(r) for r in df.collect()]


def schema_of(columns, strings, ints=0):
    types = ["string"] * strings + ["int"] * ints + ["double"] * (len(columns) - strings - ints)
    return ", ".join(f"`{c}` {t}" for c, t in zip(columns, types))


def test_happiest(panel):
    assert rows(panel.happiest()) == [("Finland", 7.8)]


def test_happiest_per_continent(panel):
    assert set(rows(panel.happiest_per_continent())) == {
        ("Europe", "Finland", 7.8),
        ("Oceania", "New Zealand", 7.3),
        ("America", "Canada", 7.1),
        ("Asia", "Israel", 7.2),
        ("Africa", "South Africa", 4.9),
        (None, "Atlantis", None),
    }


def test_happiest_per_continent_other_spelling(panel):
    other = Panel(
        panel.snapshot,
        panel.history,
        rules=continent_rules(AFRICA_UNDERSCORED, EUROPE_SENTENCE_CASE),
    )
    got = set(rows(other.happiest_per_continent()))
    assert ("Africa", "Egypt", 4.3) in got
    assert ("Other", "Atlantis", None) in got
    assert len(got) == 6


def test_first_place_counts(panel):
    df = panel.first_place_counts()
    assert df.columns == ["country_name", "count"]
    assert rows(df) == [("Finland", 3), ("Japan", 1), ("Luxland", 1), ("Norway", 1)]


def test_rank_of_richest(panel):
    assert rows(panel.rank_of_richest()) == [("Luxland", 4)]


def test_gdp_change(panel):
    prev, curr, pct, direction = rows(panel.gdp_change())[0]
    assert (prev, curr) == (pytest.approx(10.95), pytest.approx(10.29))
    assert pct == pytest.approx(-6.027397, abs=1e-6)
    assert direction == "down"


def test_longest_lived(panel):
    assert rows(panel.longest_lived()) == [("Japan", pytest.approx(75.1))]
    assert rows(panel.longest_lived_in_year()) == [("Luxland", 76.0, 2019)]
    assert rows(panel.longest_lived_followup()) == [("Japan", 75.0, 2019)]


def test_report_writes_results_and_manifest(spark, csv_paths, tmp_path):
    out = str(tmp_path / "out")
    manifest = dict(rows(run_report(spark, *csv_paths, out)))
    assert manifest == {
        "happiest": 1,
        "happiest_per_continent": 6,
        "first_place_counts": 4,
        "rank_of_richest": 1,
        "gdp_change": 1,
        "longest_lived": 1,
        "longest_lived_in_year": 1,
        "longest_lived_followup": 1,
    }
    assert rows(read_parquet(spark, out + "/happiest")) == [("Finland", 7.8)]
    files = list_files(spark, out).collect()
    assert len(files) >= 8 and all(f.length > 0 for f in files)
    # Writing again replaces; given schemas replace inference.
    again = run_report(
        spark,
        *csv_paths,
        out,
        snapshot_schema=schema_of(SNAPSHOT_COLUMNS, strings=2),
        history_schema=schema_of(HISTORY_COLUMNS, strings=1, ints=1),
        no_continent="Nowhere",
    )
    assert dict(rows(again)) == manifest
    written = read_parquet(spark, out + "/happiest_per_continent").collect()
    continents = {r.continent for r in written}
    assert "Nowhere" in continents and None not in continents
