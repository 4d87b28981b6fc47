"""The whole analysis: a one-year snapshot and a multi-year history in, the
answers to the panel's questions out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.classify import Rule, classify
from podium.functions.continents import continent_rules
from podium.operators.aggregate import argmax_per_group, pct_change
from podium.operators.columns import align_and_union, normalize_columns, project
from podium.operators.rank import first_place_counts, rank_of_argmax
from podium.operators.topk import best_mean, filtered_top1, top1, winner_rows
from podium.sources.scratch import materialize, scratch_scope
from podium.sources.tables import read_csv, results_manifest, write_parquet

# The headers of the two input files.
SNAPSHOT_COLUMNS = (
    "Country name",
    "Regional indicator",
    "Ladder score",
    "Logged GDP per capita",
    "Healthy life expectancy",
)
HISTORY_COLUMNS = (
    "Country name",
    "year",
    "Life Ladder",
    "Log GDP per capita",
    "Healthy life expectancy at birth",
)


def clean_snapshot(raw: DataFrame) -> DataFrame:
    return normalize_columns(project(raw, *SNAPSHOT_COLUMNS))


def clean_history(raw: DataFrame) -> DataFrame:
    return normalize_columns(project(raw, *HISTORY_COLUMNS))


@dataclass(frozen=True)
class Panel:
    """A cleaned snapshot and history, and one method per question.

    Results are lazy, but for ``first_place_counts`` and
    ``longest_lived_followup``, which find the yearly maxima and the winner when
    called. ``costly`` inputs (aggregates, joins) are not computed twice: results
    that read them twice write the few columns they need first.
    """

    snapshot: DataFrame
    history: DataFrame
    snapshot_year: int = 2021
    base_year: int = 2020
    after_year: int = 2016
    lookup_year: int = 2019
    rules: Sequence[Rule] = field(default_factory=continent_rules)
    no_continent: str | None = "Other"
    digits: int | None = None
    costly: bool = False

    def staged(self, folder: str | None = None) -> Panel:
        """The same panel, both tables written once to the shared folder.

        Results then read pruned columns and pushed-down years instead of
        computing the inputs again, and a lost executor recomputes neither.
        ``folder`` is one of a ``scratch_scope``, which deletes them at its end.
        """
        return replace(
            self,
            snapshot=materialize(self.snapshot, "snapshot", folder=folder),
            history=materialize(self.history, "history", folder=folder),
            costly=False,
        )

    def _once(self, rows: DataFrame, name: str) -> DataFrame:
        return materialize(rows, name) if self.costly else rows

    def happiest(self) -> DataFrame:
        """Q1: the entity with the best score of the snapshot."""
        rows = project(self.snapshot, "country_name", "ladder_score")
        return top1(rows, "ladder_score", ["country_name"])

    def happiest_per_continent(self) -> DataFrame:
        """Q2: the entity with the best score in each continent."""
        continent = classify(
            self.rules, F.col("regional_indicator"), F.col("country_name"), self.no_continent
        )
        rows = self.snapshot.withColumn("continent", continent)
        # A snapshot is one year: too small for pruning to pay for a second pass.
        return argmax_per_group(rows, "continent", "country_name", "ladder_score", prune=False)

    def first_place_counts(self) -> DataFrame:
        """Q3: how many years each entity was first, snapshot year included."""
        rows = align_and_union(
            self.snapshot,
            self.history,
            ["country_name", "life_ladder", "year"],
            cohort=("year", self.snapshot_year),
            snapshot_names={"ladder_score": "life_ladder"},
        )
        return first_place_counts(
            self._once(rows, "scores"), "year", "life_ladder", "country_name"
        )

    def rank_of_richest(self) -> DataFrame:
        """Q4: the score rank, in the base year, of the entity with the highest GDP."""
        rows = project(self.history, "country_name", "year", "log_gdp_per_capita", "life_ladder")
        rows = rows.where(F.col("year") == self.base_year)
        return rank_of_argmax(
            self._once(rows, "base-year"),
            "year",
            self.base_year,
            "log_gdp_per_capita",
            "life_ladder",
            ["country_name"],
        )

    def gdp_change(self) -> DataFrame:
        """Q5: percent change of the mean (logged) GDP, base year to snapshot year."""
        columns = ["year", "log_gdp_per_capita"]
        rows = align_and_union(
            self.snapshot,
            self.history.where(F.col("year") == self.base_year),
            columns,
            cohort=("year", self.snapshot_year),
            snapshot_names={"logged_gdp_per_capita": "log_gdp_per_capita"},
        )
        return pct_change(
            rows,
            "log_gdp_per_capita",
            F.col("year") == self.base_year,
            F.col("year") == self.snapshot_year,
            mean_digits=self.digits,
            pct_digits=self.digits,
        )

    def longest_lived(self) -> DataFrame:
        """Q6a: the entity with the best mean life expectancy after ``after_year``."""
        return self._longest_lived(self._life())

    def _longest_lived(self, life: DataFrame) -> DataFrame:
        return best_mean(
            life,
            F.col("year") > self.after_year,
            "country_name",
            "healthy_life_expectancy",
            "avg_healthy_life_expectancy",
            self.digits,
        )

    def longest_lived_in_year(self) -> DataFrame:
        """Q6b: the best life expectancy of the lookup year, whoever has it."""
        return filtered_top1(
            self._life(),
            F.col("year") == self.lookup_year,
            "healthy_life_expectancy",
            ["country_name"],
        )

    def longest_lived_followup(self) -> DataFrame:
        """Q6b read literally: the Q6a winner's own value in the lookup year."""
        life = self._once(self._life(), "life")
        return winner_rows(
            life, self._longest_lived(life), "country_name", F.col("year") == self.lookup_year
        )

    def _life(self) -> DataFrame:
        return align_and_union(
            self.snapshot,
            self.history,
            ["country_name", "healthy_life_expectancy", "year"],
            cohort=("year", self.snapshot_year),
            history_names={"healthy_life_expectancy_at_birth": "healthy_life_expectancy"},
        )

    def results(self) -> dict[str, DataFrame]:
        return {
            "happiest": self.happiest(),
            "happiest_per_continent": self.happiest_per_continent(),
            "first_place_counts": self.first_place_counts(),
            "rank_of_richest": self.rank_of_richest(),
            "gdp_change": self.gdp_change(),
            "longest_lived": self.longest_lived(),
            "longest_lived_in_year": self.longest_lived_in_year(),
            "longest_lived_followup": self.longest_lived_followup(),
        }


def run_report(
    spark: SparkSession,
    snapshot_csv: str,
    history_csv: str,
    out_dir: str,
    *,
    snapshot_schema: str | None = None,
    history_schema: str | None = None,
    **options,
) -> DataFrame:
    """Read both CSV files, write every result below ``out_dir``, return the manifest.

    The cleaned tables are staged first, so the CSV text is parsed once (twice
    without schemas). ``options`` are those of ``Panel``.
    """
    snapshot = clean_snapshot(read_csv(spark, snapshot_csv, snapshot_schema))
    history = clean_history(read_csv(spark, history_csv, history_schema))
    paths = {}
    with scratch_scope(spark, "panel") as folder:
        panel = Panel(snapshot, history, **options).staged(folder)
        for name, result in panel.results().items():
            paths[name] = f"{out_dir}/{name}"
            write_parquet(result, paths[name])
    return results_manifest(spark, paths)
