"""The postings comparison jobs (three-source and four-source) over the
derived fixtures: source registry, field specs and every pipeline as a
method returning a lazy DataFrame."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.functions.expr import drop_suffix, left, map_lookup, norm, null_if_any, recode, title_case
from vintage.operators import benchmark as bm
from vintage.operators.chain import recounted
from vintage.operators.changes import code_agreement, code_changes, code_pairs, with_code_names
from vintage.operators.compare import release_value_counts
from vintage.operators.coverage import coverage, coverage_pct, field_coverage_by_source
from vintage.operators.distribution import (coverage_matrix, distribution, distribution_anchored,
                                            distribution_matrix, union_all)
from vintage.operators.joins import lookup, norm_join
from vintage.operators.labels import label_union
from vintage.operators.salary import (direct_coverage, salary_buckets, salary_buckets_wide, salary_coverage,
                                      salary_median_by_group, salary_outliers, salary_stats)
from vintage.operators.trends import monthly_totals_spine, monthly_with_benchmark, yearly_totals
from vintage.session import checkpoint_dir
from vintage.sources.fixtures import Fixtures
from vintage.sources.ordered import read_ordered, write_ordered
from vintage.sources.releases import Releases
from vintage.sources.staging import dataset_state
from vintage.spec import FieldSpec, Period, Source

# Parameters of the test job (the original job's values are in comments).
US = "United States"
MIN_YEAR = 1996            # first year of the "full" sources (2015)
COMPARE_YEAR = 2000        # distribution year (2025)
CHANGES_YEAR = 1999        # code-change year (2024)
AS_OF = "2001-06-30"       # replaces the wall clock of the monthly spine
UNCLASSIFIED = ("%Unclassified%",)
# Degree texts that mean "no requirement" in the releases, and
# the vendor's two degree labels recoded onto the releases' spelling.
NO_DEGREE = ["No Education Found", "None", "No Education Listed"]
# The four-source job keeps "no requirement" as one value.
RELEASE_DEGREE_RECODE = {"NO EDUCATION FOUND": "NO EDUCATION LISTED",
                         "NO EDUCATION LISTED": "NO EDUCATION LISTED"}
VENDOR_DEGREE_RECODE = {"HIGH SCHOOL OR GED": "HIGH SCHOOL/GED",
                        "PH.D. OR PROFESSIONAL DEGREE": "DOCTORATE DEGREE"}
# Bound on a plausible yearly amount, characters of a detailed code.
SALARY_CAP = 500_000
CODE_WIDTH = 7
# Country name -> short code of the salary coverage table.
COUNTRY_CODES = {"United States": "US", "United Kingdom": "UK", "Hong Kong": "HK"}
# Test parameters: sector schemes for the fixture's industry names and codes.
FIXTURE_SECTOR_MAP = {"AMERICA": "Sector A", "EUROPE": "Sector E", "ASIA": "Sector A",
                      "AUTOMOBILE": "Sector A", "BUILDING": "Sector B", "MACHINERY": "Sector M",
                      "HOUSEHOLD": "Sector H"}
FIXTURE_CODE_SECTOR_MAP = {"1-URGENT": "Sector A", "2-HIGH": "Sector B", "3-MEDIUM": "Sector E",
                           "4-NOT SPECIFIED": "Sector Z"}


class PostingsJob:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.fx = Fixtures(spark, root)

    # ------------------------------------------------------------- sources
    @cached_property
    def lookup(self) -> DataFrame:
        return self.fx.onet_lookup()

    @cached_property
    def _marks(self) -> dict:
        """Crosswalk membership as a flag, one transform per side, kept
        so views of the same table apply it once. The crosswalk's keys are
        de-duplicated first (partial aggregation before the shuffle), so an
        id paired many times is one row on the build side and the left join
        cannot fan out."""
        def mark(xcol: str, id_col: str):
            def f(df: DataFrame) -> DataFrame:
                keys = (self.fx.xwalk().select(F.col(xcol).alias(id_col)).distinct()
                        .withColumn("_in_xwalk", F.lit(True)))
                return df.join(keys, id_col, "left")
            return f
        return {"v1": mark("release_id", "job_id"), "ext": mark("ext_id", "id")}

    @property
    def v1(self) -> Source:
        return Source("v1", self.fx.postings_v1, "job_id", "post_date", ("country", US))

    @property
    def v2(self) -> Source:
        return Source("v2", self.fx.postings_v2, "job_id", "post_date", ("country", US))

    @property
    def ext(self) -> Source:
        return Source("ext", self.fx.postings_ext, "id", "posted")

    @property
    def three(self) -> list[Source]:
        return [self.v1, self.v2, self.ext]

    @property
    def four(self) -> list[Source]:
        """Matched overlap (through the crosswalk, no period) and full sets."""
        in_xwalk = lambda: F.col("_in_xwalk")
        return [
            Source("overlap_v1", self.fx.postings_v1, "job_id", "post_date", ("country", US),
                   timeless=True, table="v1", mark=self._marks["v1"], member=in_xwalk),
            Source("overlap_ext", self.fx.postings_ext, "id", "posted",
                   timeless=True, table="ext", mark=self._marks["ext"], member=in_xwalk),
            Source("full_v1", self.fx.postings_v1, "job_id", "post_date", ("country", US), table="v1"),
            Source("full_ext", self.fx.postings_ext, "id", "posted", table="ext"),
        ]

    # -------------------------------------------------------------- fields
    def _soc2_prep(self, df: DataFrame) -> DataFrame:
        """Enrichment: the occupation group of the posting's code (left
        join; an unknown code leaves the group NULL, so the posting is in
        the totals but not counted)."""
        lu = self.lookup.select("onet_code", F.col("soc2_name").alias("lu_soc2"))
        return lookup(df, lu, "onet_code")

    _soc2_prep.marks_copies = True

    def field(self, name: str) -> FieldSpec:
        all3 = ("v1", "v2", "ext")
        if name == "industry":
            return FieldSpec(name, {s: "naics2_name" for s in all3}, exclude=UNCLASSIFIED)
        if name == "employer":
            return FieldSpec(name, {s: "company_name" for s in all3}, exclude=UNCLASSIFIED,
                             extra={"v1": lambda: F.col("naics4") != "5613",
                                    "v2": lambda: F.col("naics4") != "5613"})
        if name == "degree":
            rel = lambda df: null_if_any("min_degree", NO_DEGREE)
            ven = lambda df: recode("min_degree", VENDOR_DEGREE_RECODE, key=norm("min_degree"))
            return FieldSpec(name, {"v1": rel, "v2": rel, "ext": ven})
        if name == "soc2":
            return FieldSpec(name, {s: "lu_soc2" for s in all3},
                             prep={s: self._soc2_prep for s in all3}, exclude=UNCLASSIFIED)
        if name == "city":
            return FieldSpec(name, {"v1": "city", "v2": "city",
                                    "ext": lambda df: drop_suffix("city_name", 4)})
        if name in ("state", "msa"):
            return FieldSpec(name, {s: name for s in all3})
        if name in ("onet_name", "title"):
            return FieldSpec(name, {s: name for s in all3}, exclude=UNCLASSIFIED)
        raise KeyError(name)

    def _hierarchy_prep(self, df: DataFrame) -> DataFrame:
        """Enrichment: the sector of the release's detailed industry code."""
        return lookup(df, self.fx.naics_hierarchy().withColumnRenamed("naics2_name", "h_naics2"), "naics6")

    _hierarchy_prep.marks_copies = True

    def overlap_field(self, name: str) -> FieldSpec:
        """A field of the four-source job: the release's and the vendor's
        spelling, each for its matched and its full set."""
        def spec(release, vendor, release_prep=None, vendor_prep=None, exclude=()):
            preps = {"overlap_v1": release_prep, "full_v1": release_prep,
                     "overlap_ext": vendor_prep, "full_ext": vendor_prep}
            return FieldSpec(name, {"overlap_v1": release, "full_v1": release,
                                    "overlap_ext": vendor, "full_ext": vendor},
                             prep={s: p for s, p in preps.items() if p}, exclude=exclude)

        if name == "industry":
            return spec("h_naics2", "naics2_name", self._hierarchy_prep, exclude=UNCLASSIFIED)
        if name == "degree":
            return spec(lambda df: recode("min_degree", RELEASE_DEGREE_RECODE, key=norm("min_degree")),
                        self.field(name).exprs["ext"])
        if name == "soc2":
            return spec("lu_soc2", "lu_soc2", self._soc2_prep, self._soc2_prep, UNCLASSIFIED)
        if name in ("city", "state", "msa", "onet_name", "title"):
            three = self.field(name)
            return spec(three.exprs["v1"], three.exprs["ext"], exclude=three.exclude)
        raise KeyError(name)

    # ------------------------------------------------------------ totals
    def totals_yearly(self) -> DataFrame:
        return yearly_totals(self.three, Period.since(MIN_YEAR))

    def totals_monthly_spine(self) -> DataFrame:
        return monthly_totals_spine(self.spark, self.three, Period.since(MIN_YEAR), AS_OF)

    def overlap_totals_yearly(self) -> DataFrame:
        return yearly_totals(self.four, Period.since(MIN_YEAR))

    def overlap_totals_monthly(self) -> DataFrame:
        return monthly_totals_spine(self.spark, self.four, Period.since(MIN_YEAR), AS_OF)

    # ------------------------------------------------- coverage / distribution
    def coverage(self, field: str = "industry") -> DataFrame:
        return coverage(self.three, self.field(field), Period.since(MIN_YEAR))

    def kpi_cards(self, field: str = "industry") -> DataFrame:
        return coverage_pct(self.coverage(field))

    def distribution(self, field: str = "industry") -> DataFrame:
        return distribution(self.three, self.field(field), Period.year(COMPARE_YEAR))

    def distribution_top_anchor(self, field: str = "employer", k: int = 25) -> DataFrame:
        return distribution_anchored(self.three, self.field(field), Period.year(COMPARE_YEAR),
                                     anchor="ext", k=k)

    MATRIX_FIELDS = ("industry", "employer", "degree", "onet_name", "soc2", "city", "state", "msa", "title")
    OVERLAP_FIELDS = ("industry", "degree", "onet_name", "soc2", "city", "state", "msa", "title")

    def distribution_matrix(self) -> DataFrame:
        """Every field's distribution in one job (one scan per source)."""
        return distribution_matrix(self.three, [self.field(f) for f in self.MATRIX_FIELDS],
                                   Period.year(COMPARE_YEAR))

    def coverage_matrix(self) -> DataFrame:
        return coverage_matrix(self.three, [self.field(f) for f in self.MATRIX_FIELDS],
                               Period.since(MIN_YEAR))

    def overlap_coverage(self) -> DataFrame:
        return coverage(self.four, self.overlap_field("industry"), Period.since(MIN_YEAR))

    def overlap_distribution(self) -> DataFrame:
        return distribution(self.four, self.overlap_field("industry"), Period.since(MIN_YEAR))

    def overlap_distribution_matrix(self) -> DataFrame:
        """Every four-source field's distribution in one job (one scan per table)."""
        return distribution_matrix(self.four, [self.overlap_field(f) for f in self.OVERLAP_FIELDS],
                                   Period.since(MIN_YEAR))

    def overlap_coverage_matrix(self) -> DataFrame:
        return coverage_matrix(self.four, [self.overlap_field(f) for f in self.OVERLAP_FIELDS],
                               Period.since(MIN_YEAR))

    def field_coverage_by_source(self) -> DataFrame:
        """Occupation over all rows of the vendor table and of the
        classifier's output, industry over one year of the three sources."""
        occupation = {"ext": self.fx.postings_ext().select(F.col("onet_name").alias("occupation")),
                      "classifier": self.fx.classifier().select(F.col("top1_code").alias("occupation"))}
        industry = {s.name: s.scoped(Period.year(CHANGES_YEAR)) for s in self.three}
        return field_coverage_by_source(occupation, {"occupation": F.col("occupation")}).unionByName(
            field_coverage_by_source(industry, {"industry": F.col("naics2_name")}))

    # ------------------------------------------------------------ changes
    @staticmethod
    def _stored(source: Source, frame: DataFrame) -> Source:
        """The source over another layout of its table."""
        return replace(source, frame=lambda: frame)

    def _pairs(self) -> DataFrame:
        return union_all([
            code_pairs(self._stored(self.v1, part["postings_v1"]).scoped(Period.year(CHANGES_YEAR)).select("job_id", "onet_code"),
                       part["postings_v2"], "job_id", "onet_code") for part in self.fx.family("by_job")])

    def code_changes_top(self) -> DataFrame:
        return code_changes(self._pairs(), 30)

    def code_agreement(self) -> DataFrame:
        return code_agreement(self._pairs())

    def code_changes_lookup(self) -> DataFrame:
        return with_code_names(code_changes(self._pairs(), 30), self.lookup, "onet_code", "onet_name")

    def _classifier_pairs(self) -> DataFrame:
        """The classifier's output as the newer release, paired by description."""
        return union_all([
            code_pairs(self._stored(self.v1, part["postings_v1"]).scoped(Period.year(CHANGES_YEAR)).select("desc_id", "onet_code"),
                       part["classifier"].withColumnRenamed("top1_code", "onet_code"), "desc_id", "onet_code")
            for part in self.fx.family("by_description")])

    def classifier_changes(self) -> DataFrame:
        return with_code_names(code_changes(self._classifier_pairs(), 30), self.lookup, "onet_code", "onet_name")

    def classifier_agreement(self) -> DataFrame:
        return code_agreement(self._classifier_pairs())

    # ------------------------------------------------------------- salary
    @cached_property
    def _salary(self) -> list[DataFrame]:
        return [part["salary"] for part in self.fx.family("by_description")]

    def _salary_postings(self, period: Period | None, keep_soc2: bool = False, everywhere: bool = False,
                         names: tuple[str, ...] = ("v1", "v2")) -> dict[str, list[DataFrame]]:
        """Parts of the releases' postings beside those of the salary table."""
        out = {}
        for s in (self.v1, self.v2):
            if s.name not in names:
                continue
            s = replace(s, country=None) if everywhere else s
            parts = [self._stored(s, part[f"postings_{s.name}"]).scoped(period) for part in self.fx.family("by_description")]
            out[s.name] = [self._soc2_prep(df) for df in parts] if keep_soc2 else parts
        return out

    def salary_stats(self) -> DataFrame:
        return salary_stats(self._salary_postings(None), self._salary)

    def salary_stats_with_vendor(self) -> DataFrame:
        """The notebook's variant: the vendor's own ``salary_from`` beside
        the release's annualised side-table salaries."""
        return salary_stats(self._salary_postings(None, names=("v1",)), self._salary,
                            direct={"ext": (self.fx.postings_ext(), "salary_from")})

    def salary_buckets(self) -> DataFrame:
        return salary_buckets(self._salary_postings(Period.year(COMPARE_YEAR)), self._salary)

    def salary_median_by_group(self) -> DataFrame:
        return salary_median_by_group(self._salary_postings(Period.year(COMPARE_YEAR), True),
                                      self._salary, "lu_soc2").withColumnRenamed("lu_soc2", "soc2")

    def salary_buckets_with_vendor(self) -> DataFrame:
        p = Period.year(COMPARE_YEAR)
        return salary_buckets_wide(self._salary_postings(p, names=("v1",)), self._salary,
                                   {"ext": (self.ext.scoped(p), "salary_from")})

    def salary_median_with_vendor(self) -> DataFrame:
        """The notebook's variant: the vendor's own amounts beside the
        release's annualised ones up to the sanity bound."""
        p = Period.year(COMPARE_YEAR)
        return salary_median_by_group(
            self._salary_postings(p, True, names=("v1",)), self._salary, "lu_soc2", cap=SALARY_CAP,
            direct={"ext": (self._soc2_prep(self.ext.scoped(p)), "salary_from")}).withColumnRenamed("lu_soc2", "soc2")

    def salary_coverage_with_vendor(self) -> DataFrame:
        p = Period.year(COMPARE_YEAR)
        vendor = {"US": p.apply(self.fx.postings_ext(), "posted"), "UK": p.apply(self.fx.postings_ext_uk(), "posted"),
                  "HK": p.apply(self.fx.postings_ext_global().filter(F.col("country") == "Hong Kong"), "posted")}
        release = salary_coverage(self._salary_postings(p, everywhere=True, names=("v1",)), self._salary,
                                  "country", COUNTRY_CODES)
        return direct_coverage("ext", vendor, "salary_from").unionByName(release)

    def salary_coverage(self) -> DataFrame:
        p = Period.year(COMPARE_YEAR)
        return salary_coverage(self._salary_postings(p, everywhere=True), self._salary, "country", COUNTRY_CODES)

    def salary_outliers(self, highest: bool) -> DataFrame:
        return salary_outliers(self._salary_postings(None, names=("v1",))["v1"], self._salary, 20, highest)

    # ----------------------------------------------------- releases, order
    @cached_property
    def releases(self) -> Releases:
        """The postings releases found by version, under one schema."""
        return Releases(self.spark, self.fx.release_root(), "postings", {"state_name": "state"}, {"country": US})

    CHAIN_FIELDS = {"state": None, "min_degree": None}

    def release_chain_counts(self) -> DataFrame:
        """P1 over all releases, whatever their schemas."""
        return release_value_counts(self.releases.aligned(), "state", exclude=UNCLASSIFIED)

    def release_chain_incremental(self) -> DataFrame:
        """P1 / P7 over a growing chain: the first two releases are counted,
        then the third comes; ``releases_read`` says how many were read for it."""
        rel = self.releases
        store = f"{checkpoint_dir(self.spark).rstrip('/')}/vintage-chain/{uuid.uuid4().hex}"
        kinds = {c: rel.schema[c].simpleString() for c in self.CHAIN_FIELDS}
        rows = {v: (f"{dataset_state(self.spark, f'{self.fx.release_root()}/{v}')} {kinds}", lambda df=df: df) for v, df in rel.aligned().items()}
        recounted(self.spark, store, dict(list(rows.items())[:2]), self.CHAIN_FIELDS)
        counts, read = recounted(self.spark, store, rows, self.CHAIN_FIELDS)
        return counts.withColumn("releases_read", F.lit(len(read)).cast("bigint"))

    def _in_order(self, df: DataFrame, order: list, keys: list[str]) -> DataFrame:
        table = f"{checkpoint_dir(self.spark).rstrip('/')}/vintage-ordered/{uuid.uuid4().hex}"
        write_ordered(df, table, order, keys)
        return read_ordered(self.spark, table)

    def ordered_distribution(self) -> DataFrame:
        """An employer table in display order: by the vendor's count, then
        the release's, unknown counts last, then by name."""
        d = self.distribution("employer").select("field_value", F.nullif(F.col("ext_count"), F.lit(0)).alias("ext_count"),
                                                 F.nullif(F.col("v1_count"), F.lit(0)).alias("v1_count"))
        return self._in_order(d, [F.col("ext_count").desc_nulls_last(), F.col("v1_count").desc_nulls_last(), F.col("field_value").asc_nulls_last()],
                              ["ext_count", "v1_count", "field_value"])

    def ordered_totals(self) -> DataFrame:
        """Yearly totals by source, then year."""
        return self._in_order(self.totals_yearly(), [F.col("source").asc(), F.col("yr").asc()], ["source", "yr"])

    def label_shares(self) -> DataFrame:
        """Industries of three tables that spell them differently."""
        p = Period.year(COMPARE_YEAR)
        ext = self.ext.scoped(p).select(title_case("naics2_name").alias("label"))
        return label_union({"v1": (self.v1.scoped(p), "naics2_name", None), "v2": (self.v2.scoped(p), "naics2_name", None), "ext": (ext, "label", None)})

    # --------------------------------------------------------- benchmarks
    def series_mean(self) -> DataFrame:
        return bm.series_annual_mean(bm.series_from_payload(self.fx.series_json()), "2024")

    def wide_month_unpivot(self) -> DataFrame:
        return bm.wide_monthly_to_long(self.fx.bench_wide())

    def coded_benchmark(self, level: str = "major") -> DataFrame:
        return bm.coded_benchmark(self.fx.bench_occ(), level)

    def state_share(self, notebook: bool = False) -> DataFrame:
        bench = self.coded_benchmark().select(F.col("occ_title").alias("state"),
                                              F.col("tot_emp").alias("bench_count"))
        if notebook:
            return bm.state_share(self.three, self.field("state"), Period.year(CHANGES_YEAR), bench,
                                  measure="rows", total_scope="benchmark", rounding="half_even")
        return bm.state_share(self.three, self.field("state"), Period.year(CHANGES_YEAR), bench)

    def monthly_benchmark_long(self) -> DataFrame:
        full = [s for s in self.four if s.name.startswith("full_")]
        return monthly_with_benchmark(full, Period.since(MIN_YEAR), self.wide_month_unpivot(),
                                      bench_name="benchmark")

    def monthly_benchmark_wide(self) -> DataFrame:
        from vintage.operators.reshape import pivot_unique
        return pivot_unique(self.monthly_benchmark_long(), ["month_start"], "source",
                            ["benchmark", "full_v1", "full_ext"], "cnt", check=True)

    def sector_share(self) -> DataFrame:
        full = [s for s in self.four if s.name.startswith("full_")]
        f = self.overlap_field("industry")
        sector_field = FieldSpec("sector", {
            "full_v1": lambda df: map_lookup(norm("h_naics2"), FIXTURE_SECTOR_MAP),
            "full_ext": lambda df: map_lookup(norm("naics2_name"), FIXTURE_SECTOR_MAP)},
            prep={"full_v1": f.prep["full_v1"]}, normalize=False)
        bench = bm.official_by_sector(self.fx.openings_industry(), FIXTURE_CODE_SECTOR_MAP,
                                      region="Total US", year=str(CHANGES_YEAR))
        return bm.share_comparison(full, sector_field, Period.year(CHANGES_YEAR), bench,
                                   label="sector", bench_name="benchmark")

    def _employer_prep(self, df: DataFrame) -> DataFrame:
        """Enrichment: the sector of the employer, whose imputed key replaces
        the posting's own where there is one (D16)."""
        e = self.fx.employers().select("employer_key", F.col("naics6").alias("emp_naics6"))
        h = self.fx.naics_hierarchy().select(F.col("naics6").alias("emp_naics6"),
                                             F.col("naics2_name").alias("emp_naics2"))
        keyed = (df.join(self.fx.imputed().select("job_id", "imputed_key"), "job_id", "left")
                 .withColumn("employer_key", F.coalesce(F.col("imputed_key").cast("bigint"),
                                                        F.col("naics6").cast("bigint"))))
        return keyed.join(e, "employer_key", "left").join(h, "emp_naics6", "left")

    def sector_share_rows(self) -> DataFrame:
        """P27 by row count over three sources: the newer release takes its
        sector from the imputed employer."""
        def sector(name: str):
            return lambda df: map_lookup(norm(name), FIXTURE_SECTOR_MAP)

        f = FieldSpec("sector", {"ext": sector("naics2_name"), "v1": sector("naics2_name"), "v2": sector("emp_naics2")},
                      prep={"v2": self._employer_prep}, normalize=False)
        bench = bm.official_by_sector(self.fx.openings_industry(), FIXTURE_CODE_SECTOR_MAP,
                                      region="Total US", year=str(CHANGES_YEAR))
        return bm.share_comparison([self.ext, self.v1, self.v2], f, Period.year(CHANGES_YEAR), bench,
                                   label="sector", bench_name="benchmark", measure="rows")

    def sector_rollup_map(self) -> DataFrame:
        counts = distribution(self.three, self.field("industry"), Period.year(COMPARE_YEAR),
                              long=True)
        return bm.rollup_through_map(counts, FIXTURE_SECTOR_MAP)

    def group_share_vs_employment(self) -> DataFrame:
        full = [s for s in self.four if s.name.startswith("full_")]
        f = FieldSpec("soc2", {"full_v1": "lu_soc2", "full_ext": "lu_soc2"},
                      prep={"full_v1": self._soc2_prep, "full_ext": self._soc2_prep})
        bench = self.coded_benchmark().select(norm("occ_title").alias("label"),
                                              F.col("tot_emp").cast("double").alias("n"))
        return bm.share_comparison(full, f, Period.since(MIN_YEAR), bench, label="soc2_name",
                                   bench_name="employment")

    def group_share_rows(self) -> DataFrame:
        """P29 by row count: the newer release takes its occupation group
        from the classifier's code."""
        def classified(df: DataFrame) -> DataFrame:
            names = self.lookup.select(F.col("onet_code").alias("top1_code"), F.col("soc2_name").alias("cls_soc2"))
            return df.join(self.fx.classifier().join(names, "top1_code"), "desc_id", "left")

        v2_all = Source("v2", self.fx.postings_v2, "job_id", "post_date")
        f = FieldSpec("soc2", {"v1": "lu_soc2", "v2": "cls_soc2", "ext": "lu_soc2"},
                      prep={"v1": self._soc2_prep, "v2": classified, "ext": self._soc2_prep}, normalize=False)
        return bm.share_comparison([self.ext, self.v1, v2_all], f, Period.year(COMPARE_YEAR), None,
                                   label="soc2_name", measure="rows")

    def truncated_code_share(self, width: int = CODE_WIDTH) -> DataFrame:
        """Rows per occupation code of ``width`` characters, beside the
        employment of the detailed occupations. v1 carries the code; v2
        takes it from the classifier's output joined on the description id
        (D19); the vendor names its occupation, matched to the lookup's name
        by normalised text (D17)."""
        v2_all = Source("v2", self.fx.postings_v2, "job_id", "post_date")
        cls = self.fx.classifier()
        lu = self.lookup.select(F.col("onet_code").alias("lu_code"), "onet_name")
        f = FieldSpec("code1", {"v1": lambda df: left("onet_code", width),
                                "v2": lambda df: left("top1_code", width),
                                "ext": lambda df: left("lu_code", width)},
                      prep={"v2": lambda df: df.join(cls, "desc_id", "left"),
                            "ext": lambda df: norm_join(df, lu, "onet_code", "onet_name", "left")},
                      normalize=False)
        bench = self.coded_benchmark("detailed").select(F.col("occ_code").alias("label"),
                                                        F.col("tot_emp").cast("double").alias("n"))
        return bm.share_comparison([self.v1, v2_all, self.ext], f, Period.year(COMPARE_YEAR), bench,
                                   label="code", bench_name="employment", measure="rows")

    def imputed_key_join(self) -> DataFrame:
        return bm.imputed_industry(self.fx.postings_v2(), self.fx.imputed(), self.fx.employers(),
                                   self.fx.naics_hierarchy(), Period.year(COMPARE_YEAR))
