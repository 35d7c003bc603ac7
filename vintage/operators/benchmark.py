"""Official statistics: loaders (A6-A10, P23, P25, P28) and comparisons of
source shares against them (P24, P27, P29, P30, E12, D16).

Benchmarks are small by nature (states, sectors, occupation groups, months),
but nothing here assumes it: they are ordinary DataFrames combined with the
sources through unions and aggregations, so no join relies on a side being
small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.functions.expr import half_even, map_lookup, pct_round, pct_round_even, to_number
from vintage.operators.distribution import union_all, value_counts
from vintage.operators.reshape import wide
from vintage.spec import FieldSpec, Period, Source

# Two-digit state FIPS code -> state name.
STATE_FIPS = {
    "01": "ALABAMA", "02": "ALASKA", "04": "ARIZONA", "05": "ARKANSAS",
    "06": "CALIFORNIA", "08": "COLORADO", "09": "CONNECTICUT", "10": "DELAWARE",
    "11": "DISTRICT OF COLUMBIA", "12": "FLORIDA", "13": "GEORGIA", "15": "HAWAII",
    "16": "IDAHO", "17": "ILLINOIS", "18": "INDIANA", "19": "IOWA",
    "20": "KANSAS", "21": "KENTUCKY", "22": "LOUISIANA", "23": "MAINE",
    "24": "MARYLAND", "25": "MASSACHUSETTS", "26": "MICHIGAN", "27": "MINNESOTA",
    "28": "MISSISSIPPI", "29": "MISSOURI", "30": "MONTANA", "31": "NEBRASKA",
    "32": "NEVADA", "33": "NEW HAMPSHIRE", "34": "NEW JERSEY", "35": "NEW MEXICO",
    "36": "NEW YORK", "37": "NORTH CAROLINA", "38": "NORTH DAKOTA", "39": "OHIO",
    "40": "OKLAHOMA", "41": "OREGON", "42": "PENNSYLVANIA", "44": "RHODE ISLAND",
    "45": "SOUTH CAROLINA", "46": "SOUTH DAKOTA", "47": "TENNESSEE", "48": "TEXAS",
    "49": "UTAH", "50": "VERMONT", "51": "VIRGINIA", "53": "WASHINGTON",
    "54": "WEST VIRGINIA", "55": "WISCONSIN", "56": "WYOMING",
}

# Upper-cased two-digit industry name -> openings sector.
NAICS2_SECTOR_MAP = {
    "MINING, QUARRYING, AND OIL AND GAS EXTRACTION": "Mining, Quarrying, and Oil and Gas Extraction",
    "UTILITIES": "Transportation, Warehousing, and Utilities",
    "CONSTRUCTION": "Construction",
    "MANUFACTURING": "Manufacturing",
    "WHOLESALE TRADE": "Wholesale Trade",
    "RETAIL TRADE": "Retail Trade",
    "TRANSPORTATION AND WAREHOUSING": "Transportation, Warehousing, and Utilities",
    "INFORMATION": "Information",
    "FINANCE AND INSURANCE": "Finance and Insurance",
    "REAL ESTATE AND RENTAL AND LEASING": "Real Estate and Rental and Leasing",
    "PROFESSIONAL, SCIENTIFIC, AND TECHNICAL SERVICES": "Professional and Business Services",
    "MANAGEMENT OF COMPANIES AND ENTERPRISES": "Professional and Business Services",
    "ADMINISTRATIVE AND SUPPORT AND WASTE MANAGEMENT AND REMEDIATION SERVICES":
        "Professional and Business Services",
    "EDUCATIONAL SERVICES": "Educational Services",
    "HEALTH CARE AND SOCIAL ASSISTANCE": "Health Care and Social Assistance",
    "ARTS, ENTERTAINMENT, AND RECREATION": "Arts, Entertainment, and Recreation",
    "ACCOMMODATION AND FOOD SERVICES": "Accommodation and Food Services",
    "OTHER SERVICES (EXCEPT PUBLIC ADMINISTRATION)": "Other Services (except Public Administration)",
    "PUBLIC ADMINISTRATION": "Public Administration",
}

# Official industry code -> openings sector.
OPENINGS_CODE_SECTOR_MAP = {
    "110099": "Mining, Quarrying, and Oil and Gas Extraction",
    "230000": "Construction",
    "300000": "Manufacturing",
    "420000": "Wholesale Trade",
    "440000": "Retail Trade",
    "480099": "Transportation, Warehousing, and Utilities",
    "510000": "Information",
    "520000": "Finance and Insurance",
    "530000": "Real Estate and Rental and Leasing",
    "540099": "Professional and Business Services",
    "610000": "Educational Services",
    "620000": "Health Care and Social Assistance",
    "710000": "Arts, Entertainment, and Recreation",
    "720000": "Accommodation and Food Services",
    "810000": "Other Services (except Public Administration)",
    "900000": "Public Administration",
}

MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
ANNUAL_PERIOD = "M13"


# ------------------------------------------------------------------ loaders
def read_series_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses (``Results.series[].data[]``) -> long
    ``(series_id, year, period, value)``; the HTTP fetch is not part of the
    engine, the responses are files."""
    raw = spark.read.option("multiLine", True).json(path)
    s = raw.select(F.explode("Results.series").alias("s"))
    d = s.select(F.col("s.seriesID").alias("series_id"), F.explode("s.data").alias("d"))
    return d.select("series_id", F.col("d.year").alias("year"), F.col("d.period").alias("period"),
                    to_number(F.col("d.value")).alias("value"))


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """A6 input: a wide table exported as CSV (header row; every cell read
    as text, numbers coerced later with ``try_cast``)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def series_from_payload(df: DataFrame, key: str = "$.k") -> DataFrame:
    """Series rows whose value sits in a JSON text column ``payload``."""
    return df.select("series_id", "year", "period",
                     to_number(F.get_json_object("payload", key)).alias("value"))


def series_annual_mean(series: DataFrame, year: str, scale: float = 1000.0,
                       state_map: Mapping[str, str] = STATE_FIPS) -> DataFrame:
    """Monthly values of ``year`` (the annual ``M13`` row excluded),
    times ``scale``, averaged per series and rounded half-to-even; the
    series id's characters 10-11 are the state code. Output
    ``(state, bench_count)``; series of unknown states are dropped."""
    f = series.filter((F.col("year") == year) & (F.col("period") != ANNUAL_PERIOD)
                      & F.col("value").isNotNull())
    mean = f.groupBy("series_id").agg(F.avg(F.col("value") * scale).alias("m"))
    state = map_lookup(F.substring("series_id", 10, 2), state_map)
    return (mean.select(state.alias("state"), half_even("m", 0).cast("bigint").alias("bench_count"))
            .filter(F.col("state").isNotNull()))


def wide_monthly_to_long(df: DataFrame, scale: int = 1000) -> DataFrame:
    """Year rows x month columns -> ``(month, posting_count)``.
    Non-numeric year labels (notes) and empty cells are dropped; counts are
    scaled and truncated to integers."""
    year_col = df.columns[0]
    months = [c for c in df.columns[1:] if c in MONTH_ABBR]
    long_df = df.unpivot([year_col], months, "month_name", "value")
    yr = to_number(year_col).cast("int")
    mnum = F.array_position(F.array(*[F.lit(m) for m in MONTH_ABBR]), F.col("month_name"))
    month = F.try_to_date(F.format_string("%04d-%02d-01", yr, mnum.cast("int")), "yyyy-MM-dd")
    return (long_df.select(month.alias("month"), to_number(F.col("value").cast("string")).alias("value"))
            .filter(F.col("month").isNotNull() & F.col("value").isNotNull())
            .select("month", (F.col("value") * scale).cast("bigint").alias("posting_count")))


def coded_benchmark(df: DataFrame, level: str = "major") -> DataFrame:
    """Keep one ``o_group`` level, coerce ``tot_emp`` (suppressed
    ``**`` -> dropped), truncate to an integer."""
    return (df.filter(F.col("o_group") == level)
            .select("occ_code", "occ_title", to_number("tot_emp").alias("tot_emp"))
            .filter(F.col("tot_emp").isNotNull())
            .select("occ_code", "occ_title", F.col("tot_emp").cast("bigint").alias("tot_emp")))


def official_by_sector(openings: DataFrame, code_map: Mapping[str, str] = OPENINGS_CODE_SECTOR_MAP,
                       region: str = "Total US", year: str = "2024") -> DataFrame:
    """A9 / P27 benchmark side: openings of the listed codes for one region
    and (string) year, summed per sector -> ``(label, n)``."""
    f = openings.filter((F.col("state_text") == region) & F.col("industry_code").isin(list(code_map))
                        & (F.col("year") == year))
    return (f.groupBy(map_lookup("industry_code", code_map).alias("label"))
            .agg(F.round(F.sum("job_openings"), 6).alias("n")).filter(F.col("label").isNotNull()))


# --------------------------------------------------------------- comparisons
def state_share(sources: Sequence[Source], field: FieldSpec, period: Period,
                bench: DataFrame, measure: str = "distinct", total_scope: str = "all",
                rounding: str = "half_up") -> DataFrame:
    """Per benchmark state, the benchmark count and each source's count,
    with percent shares rounded to one decimal.

    Two variants of the original (S11): the job counts distinct ids, takes
    each source's total over all its states (also those missing from the
    benchmark), rounds half-up and shows a missing state as 0
    (``total_scope='all'``); the notebook counts rows, totals only the
    benchmark's states, rounds half-to-even and leaves a missing state NULL
    (``measure='rows', total_scope='benchmark', rounding='half_even'``).
    """
    if total_scope not in ("all", "benchmark"):
        raise ValueError(f"total_scope must be 'all' or 'benchmark', not {total_scope!r}")
    rnd = pct_round if rounding == "half_up" else pct_round_even
    counts = value_counts(sources, field, period, measure).withColumnRenamed("field_value", "state")
    b = bench.select("state", F.col("bench_count").cast("bigint").alias("bench_count"))
    if total_scope == "benchmark":
        counts = counts.join(b.select("state"), "state", "left_semi")
    tot = counts.groupBy("source").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(tot), "source").select(
        "source", "state", "n", F.when(F.col("total") > 0, rnd("n", "total", 1)).alias("pct"))
    names = [s.name for s in sources]
    out = b.join(wide(shares, ["state"], "source", names, {"n": None, "pct": None}), "state", "left")
    btot = b.agg(F.sum("bench_count").alias("total")).scalar()
    cols = [F.col("state"), F.col("bench_count"),
            F.when(btot > 0, rnd(F.col("bench_count"), btot, 1)).otherwise(0.0).alias("bench_pct")]
    for n in names:
        count, pct = F.col(f"{n}_n"), F.col(f"{n}_pct")
        if total_scope == "all":
            count, pct = F.coalesce(count, F.lit(0)), F.coalesce(pct, F.lit(0.0))
        cols += [count.cast("bigint").alias(f"{n}_count"), pct.alias(f"{n}_pct")]
    return out.select(*cols)


def share_comparison(sources: Sequence[Source], field: FieldSpec, period: Period,
                     bench: DataFrame | None, label: str, bench_name: str = "benchmark",
                     measure: str = "distinct") -> DataFrame:
    """Counts of each label per source (and the benchmark's
    value), with shares of each source's classified total; the label list is
    the union over all of them (benchmark NULL labels dropped).

    Everything is one long frame ``(source, label, n)`` turned wide by one
    conditional aggregation; no full outer join.
    """
    counts = value_counts(sources, field, period, measure).select(
        "source", F.col("field_value").alias("label"), F.col("n").cast("double").alias("n"))
    frames = [counts]
    names = [s.name for s in sources]
    if bench is not None:
        frames.append(bench.filter(F.col("label").isNotNull()).select(
            F.lit(bench_name).alias("source"), "label", F.col("n").cast("double").alias("n")))
        names = [bench_name] + names
    long_df = union_all(frames)
    tot = long_df.groupBy("source").agg(F.sum("n").alias("total"))
    long_df = long_df.join(F.broadcast(tot), "source").withColumn(
        "pct", F.round(F.when(F.col("total") > 0, F.col("n") / F.col("total")).otherwise(F.lit(0.0)), 10))
    w = wide(long_df, ["label"], "source", names, {"n": 0.0, "pct": 0.0})
    cols = [F.col("label").alias(label)]
    for n in names:
        cnt = F.col(f"{n}_n")
        if n != bench_name:
            cnt = cnt.cast("bigint")
        cols += [cnt.alias(f"{n}_count"), F.col(f"{n}_pct").alias(f"{n}_pct")]
    return w.select(*cols)


def rollup_through_map(counts_long: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Value counts rolled up to sectors through a dict; unmapped
    values are dropped. Input ``(source, field_value, n, ...)``; output
    ``(source, sector, n, pct)`` with shares of the mapped total."""
    m = counts_long.select("source", map_lookup("field_value", mapping).alias("sector"), "n")
    agg = m.filter(F.col("sector").isNotNull()).groupBy("source", "sector").agg(
        F.sum("n").alias("n"))
    tot = agg.groupBy("source").agg(F.sum("n").alias("_t"))
    return agg.join(F.broadcast(tot), "source").select(
        "source", "sector", "n", (F.col("n") / F.col("_t") * 100).alias("pct"))


def imputed_industry(postings: DataFrame, imputed: DataFrame, employers: DataFrame,
                     hierarchy: DataFrame, period: Period, country: str = "United States",
                     own_key: str = "naics6") -> DataFrame:
    """Industry of each posting's employer, where an imputed employer
    key replaces the posting's own key when present (left, left on
    ``COALESCE(imputed, own)``, then inner to the hierarchy). Output
    ``(naics2_name, posting_count, pct)``."""
    p = period.apply(postings.filter(F.col("country") == country), "post_date").select(
        "job_id", F.col(own_key).alias("own_key"))
    j = p.join(imputed.select("job_id", "imputed_key"), "job_id", "left")
    j = j.withColumn("employer_key", F.coalesce(F.col("imputed_key").cast("bigint"),
                                                F.col("own_key").cast("bigint")))
    e = employers.select(F.col("employer_key").cast("bigint").alias("employer_key"),
                         F.col("naics6").alias("emp_naics6"))
    j = j.join(e, "employer_key", "left").filter(F.col("emp_naics6").isNotNull())
    h = hierarchy.select(F.col("naics6").alias("emp_naics6"), "naics2_name")
    counts = j.join(h, "emp_naics6").groupBy("naics2_name").agg(
        F.count(F.lit(1)).alias("posting_count"))
    total = counts.agg(F.sum("posting_count").alias("total")).scalar()
    return counts.select("naics2_name", "posting_count",
                         (F.col("posting_count") / total * 100).alias("pct"))
