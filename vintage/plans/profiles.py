"""The profile comparison job (two releases of a people-profile dataset)
over the derived fixtures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.operators import compare as cmp
from vintage.operators.distribution import union_all
from vintage.sources.fixtures import Fixtures

BASE, NEW = "base", "new"
COUNTRY = "NATION_1"           # single-country pipelines (the original job: United States)
STINT_WINDOW = ("1998-01-01", "1998-01-31")   # employed throughout (2023-01-01 .. 2023-12-31)
# Confidence gates. Location fields need location confidence
# >= 89; the occupation group needs occupation confidence >= 7; school names
# need school confidence >= 72 in the domestic country, else international
# school confidence >= 70.
LOCATION_GATE = 89
OCCUPATION_GATE = 7
SCHOOL_GATE_DOMESTIC = 72
SCHOOL_GATE_INTERNATIONAL = 70
DOMESTIC_NAMES = ("united states", "us", "usa")


def occupation_gate() -> Column:
    """C8 for the occupation group."""
    return F.col("onet_confidence") >= OCCUPATION_GATE


def location_gate() -> Column:
    """C8 for location fields."""
    return F.col("location_confidence") >= LOCATION_GATE


def school_gate(country_col: str = "country") -> Column:
    """Row-wise, so one job serves every country."""
    domestic = F.lower(F.trim(F.col(country_col))).isin(*DOMESTIC_NAMES)
    return (F.when(domestic, F.col("school_confidence") >= SCHOOL_GATE_DOMESTIC)
            .otherwise(F.col("intl_school_confidence") >= SCHOOL_GATE_INTERNATIONAL))


class ProfilesJob:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.fx = Fixtures(spark, root)

    @property
    def releases(self) -> dict[str, DataFrame]:
        """The experience table: one row per stint."""
        return {BASE: self.fx.profiles_base(), NEW: self.fx.profiles_new()}

    @property
    def education(self) -> dict[str, DataFrame]:
        """One row per education entry, with a country column of its own."""
        return {BASE: self.fx.education_base(), NEW: self.fx.education_new()}

    @property
    def persons(self) -> dict[str, DataFrame]:
        """One row per person."""
        return {BASE: self.fx.persons_base(), NEW: self.fx.persons_new()}

    def value_counts(self) -> DataFrame:
        return cmp.release_value_counts(self.releases, "soc2_name", gate=occupation_gate())

    def list_value_counts(self) -> DataFrame:
        return cmp.release_list_value_counts(self.releases, "degree_list")

    def value_counts_with_benchmark(self) -> DataFrame:
        return cmp.release_value_counts_with_benchmark(
            self.releases, "soc2_name", self.fx.bench_counts(), ("country", COUNTRY))

    def coverage(self) -> DataFrame:
        """Occupation group: covered = not the exact 'Unclassified' (S6)."""
        return cmp.release_coverage(self.releases, F.col("soc2_name") != "Unclassified",
                                    gate=occupation_gate())

    def coverage_country_gate(self) -> DataFrame:
        return cmp.release_coverage(self.education, F.col("school_name").isNotNull(), gate=school_gate())

    def occupation_share(self, strict: bool = False) -> DataFrame:
        return cmp.release_share_vs_benchmark(
            self.releases, "soc2_name", self.fx.bench_share(), "label", ["share_a", "share_b"],
            ("country", COUNTRY), gate=occupation_gate(), strict=strict)

    def industry_share(self) -> DataFrame:
        return cmp.stint_industry_share(self.releases, self.fx.bench_map(), STINT_WINDOW[0],
                                        STINT_WINDOW[1], ("country", COUNTRY))

    def matrix_tables(self) -> list[tuple[dict[str, DataFrame], dict[str, Column | None], dict[str, Column | None]]]:
        """The matrix: per base table its plain fields and its list-valued
        fields, each with its gate."""
        place = location_gate()
        return [
            (self.releases, {"soc2_name": occupation_gate(), "onet_name": None, "suboccupation": None,
                             "standard_title": None, "naics2_name": None, "company_name": None}, {}),
            (self.education, {"degree_per_entry": None, "degree_per_id": None, "major_name": None,
                              "school_name": school_gate()}, {"degree_list": None}),
            (self.persons, {"state": place, "county": place, "city": place}, {})]

    def matrix_long(self) -> DataFrame:
        """Every field's value counts: one scan per base table and release,
        one exchange per base table."""
        return union_all([cmp.release_matrix_long(releases, fields, list_fields=lists)
                          for releases, fields, lists in self.matrix_tables()])

    def matrix_kpi(self) -> DataFrame:
        """Every field's coverage. Covered is any value, for the occupation
        group any but the exact 'Unclassified' (S6)."""
        def test(name: str) -> Column:
            return F.col(name) != "Unclassified" if name == "soc2_name" else F.col(name).isNotNull()

        return union_all([cmp.release_matrix_kpi(releases, {n: (test(n), g) for n, g in {**fields, **lists}.items()})
                          for releases, fields, lists in self.matrix_tables()])
