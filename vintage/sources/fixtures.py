"""Stand-in inputs derived from the driver's TPC-H-like tables.

The comparison jobs read releases of a profile dataset, releases of a
postings dataset, a vendor postings table, a salary side table, lookups,
an id crosswalk and official statistics. None of these ship with the
tests, so each is derived here, lazily, from the driver tables; the same
recipes exist as SQL text in ``oracle_queries.py`` for the DuckDB oracle.
NULLs, sentinels and duplicates are injected by rules on key columns so the
null-sensitive semantics are exercised. All frames grow with the input
tables.
"""

from __future__ import annotations

import functools
import inspect
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.sources import positions
from vintage.sources.colocated import Parts, colocated
from vintage.sources.staging import staged, staged_folder
from vintage.sources.tables import Tables

# Relations the queries read, with the columns their stored files are
# sorted by (within each file, so min/max statistics skip row groups).
STAGED = {
    "profiles_base": (), "profiles_new": (), "education_base": (), "education_new": (),
    "persons_base": (), "persons_new": (),
    # in the order of ``orders_geo``, whose files they are cut from
    "postings_v1": (), "postings_v2": (), "postings_ext": ("posted",),
    "postings_ext_uk": ("posted",), "postings_ext_global": ("posted",),
    "salary": (), "xwalk": ("release_id",), "onet_lookup": (), "naics_hierarchy": (),
    "bench_occ": (), "bench_wide": (), "bench_map": (), "series_json": (), "bench_counts": (),
    "bench_share": (), "openings_industry": (), "imputed": (), "employers": (),
    "classifier": ("desc_id",),
}
# Of these, rows of one stored join or, for ``salary``, which is stored in its
# family, of one input table, without another join: read from it.
VIEWS = {"profiles_base", "profiles_new", "education_base", "education_new", "persons_base", "persons_new", "salary"}
# Tables stored with positions of their ids (exact distinct counts); the
# releases take theirs from ``orders_geo``.
POSITIONED = {"postings_ext": "id"}
# Tables stored side by side by the key that joins them (key, columns of each).
FAMILIES = {
    "by_job": ("job_id", {"postings_v1": ("job_id", "post_date", "country", "onet_code"),
                          "postings_v2": ("job_id", "onet_code")}),
    "by_description": ("desc_id", {"postings_v1": ("desc_id", "post_date", "country", "onet_code"),
                                   "postings_v2": ("desc_id", "post_date", "country", "onet_code"),
                                   "salary": ("desc_id", "salary_per", "parsed_salary_min"),
                                   "classifier": ("desc_id", "top1_code")}),
}


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _place(geo: DataFrame, unknown: Column | None = None) -> list[Column]:
    """The positions of the rows' ids, where ``geo`` is stored with them; a
    row whose id becomes NULL (``unknown``) has none. Cutting rows leaves an id
    that occurs once as it is."""
    if positions.POS not in geo.columns:
        return []
    cond = F.lit(False) if unknown is None else unknown
    return [F.when(~cond, F.col(positions.POS)).alias(positions.POS), (F.col(positions.ONCE) & ~cond).alias(positions.ONCE)]


class Recipes:
    """Derived relations over one dataset directory, as lazy plans."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.t = Tables(spark, root)

    # ---------------------------------------------------------------- profiles
    def stints(self) -> DataFrame:
        l = self.t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                   "l_quantity", "l_shipdate")
        o = self.t.orders.select("o_orderkey", "o_orderdate")
        p = self.t.part.select("p_partkey", "p_size", "p_type", "p_brand", "p_name")
        s = self.t.supplier.select("s_suppkey", "s_name", "s_nationkey")
        n = self.t.nation.select("n_nationkey", "n_name")
        j = (l.join(o, o.o_orderkey == l.l_orderkey)
             .join(p, p.p_partkey == l.l_partkey)
             .join(s, s.s_suppkey == l.l_suppkey)
             .join(n, n.n_nationkey == s.s_nationkey))
        return j.select(
            _null_when(F.col("l_partkey") % 41 == 0, F.col("l_orderkey")).alias("person_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("n_name").alias("country"),
            "p_size", "p_type", "p_brand", "p_name",
            F.col("l_quantity").cast("int").alias("qty"),
            F.col("s_name").alias("company_name"),
            _null_when(F.col("l_suppkey") % 13 == 0, F.col("l_suppkey")).alias("company_id"),
            F.col("o_orderdate").alias("start_date"),
            _null_when(F.col("l_linenumber") % 3 == 0, F.col("l_shipdate")).alias("end_date"),
        )

    def _profile(self, df: DataFrame, soc2: Column, school_mod: int, city_mod: int,
                 degree_list: Column) -> DataFrame:
        size = F.col("p_size")
        return df.select(
            "person_id", "country", "company_name", "company_id", "start_date", "end_date",
            soc2.alias("soc2_name"),
            _null_when(size % 13 == 0, F.concat(F.col("p_type"), F.lit(" worker"))).alias("onet_name"),
            F.when(size % 11 == 1, F.lit("unclassified role")).otherwise(F.col("p_brand")).alias("suboccupation"),
            _null_when(size % 17 == 0, F.col("p_name")).alias("standard_title"),
            F.floor(F.col("qty") / 5).cast("int").alias("onet_confidence"),
            (F.col("qty") * 2).alias("location_confidence"),
            (F.col("qty") * 2).alias("school_confidence"),
            (100 - F.col("qty") * 2).alias("intl_school_confidence"),
            _null_when(size % school_mod == 0, F.col("p_name")).alias("school_name"),
            _null_when(size % city_mod == 0, F.col("p_brand")).alias("city"),
            degree_list.alias("degree_list"),
            F.when(size % 6 == 0, F.lit('"[""]')).when(size % 11 == 0, F.lit(None))
             .otherwise(F.col("p_name")).alias("education_raw"),
            _null_when(size % 8 == 0, (size % 8).cast("string")).alias("naics2_code"),
            _null_when(size % 8 == 0, F.concat(F.lit("Industry "), (size % 8).cast("string")))
            .alias("naics2_name"),
        )

    def profiles_base(self) -> DataFrame:
        size = F.col("p_size")
        soc2 = (F.when(size % 10 == 0, F.lit(None)).when(size % 10 == 1, F.lit("Unclassified"))
                .when(size % 10 == 2, F.lit("Other (unclassified)")).otherwise(F.col("p_type")))
        degree = _null_when(size % 7 == 0, F.concat(
            F.col("p_type"), F.lit(", "), F.col("p_brand"),
            F.when(size % 5 == 0, F.lit(", ")).otherwise(F.lit(""))))
        return self._profile(self.stints().filter(F.col("line_no") <= 5), soc2, 12, 14, degree)

    def profiles_new(self) -> DataFrame:
        size = F.col("p_size")
        soc2 = (F.when(size % 9 == 0, F.lit(None)).when(size % 9 == 1, F.lit("Unclassified"))
                .when(F.col("p_type") == "PROMO", F.lit("PROMOTIONAL")).otherwise(F.col("p_type")))
        degree = _null_when(size % 7 == 0, F.concat(F.col("p_type"), F.lit(", "), F.col("p_brand")))
        return self._profile(self.stints().filter(F.col("line_no") >= 2), soc2, 15, 16, degree)

    def _education(self, df: DataFrame, mod: int) -> DataFrame:
        """One row per education entry; two countries take the domestic gate."""
        size = F.col("p_size")
        return df.select(
            "person_id",
            F.when(F.col("country") == "NATION_1", "United States").when(F.col("country") == "NATION_2", " usa ")
             .otherwise(F.col("country")).alias("country"),
            (F.col("qty") * 2).alias("school_confidence"),
            (100 - F.col("qty") * 2).alias("intl_school_confidence"),
            _null_when(size % mod == 0, F.col("p_type")).alias("degree_per_entry"),
            F.when(size % 9 == 0, F.lit(None)).when(size % 9 == 1, F.lit("Unclassified degree"))
             .otherwise(F.col("p_brand")).alias("degree_per_id"),
            _null_when(size % mod == 1, F.concat(F.col("p_type"), F.lit(", "), F.col("p_brand"))).alias("degree_list"),
            F.when(size % 6 == 0, F.lit('"[""]')).when(size % 11 == 0, F.lit(None))
             .otherwise(F.col("p_name")).alias("education_raw"),
            _null_when(size % 11 == 0, F.concat(F.lit("Major "), (size % 23).cast("string"))).alias("major_name"),
            _null_when(size % mod == 2, F.col("p_name")).alias("school_name"))

    def education_base(self) -> DataFrame:
        return self._education(self.stints().filter(F.col("line_no") <= 4), 7)

    def education_new(self) -> DataFrame:
        return self._education(self.stints().filter(F.col("line_no") >= 2), 8)

    def _persons(self, df: DataFrame, mod: int) -> DataFrame:
        """One row per person."""
        ck = F.col("custkey")
        return df.select(
            F.col("job_id").alias("person_id"), "country", (ck % 100).alias("location_confidence"),
            _null_when(ck % mod == 0, F.col("nation_name")).alias("state"),
            F.when(ck % 23 == 0, F.lit("Unclassified county")).otherwise(F.col("segment")).alias("county"),
            _null_when(ck % mod == 1, F.concat(F.col("nation_name"), F.lit(" City "), (ck % 7).cast("string")))
            .alias("city"))

    def persons_base(self) -> DataFrame:
        return self._persons(self.orders_geo().filter(F.col("status") != "F"), 19)

    def persons_new(self) -> DataFrame:
        return self._persons(self.orders_geo().filter(F.col("status") != "P"), 21)

    # ---------------------------------------------------------------- postings
    def orders_geo(self) -> DataFrame:
        o = self.t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus",
                                 "o_custkey")
        c = self.t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
        n = self.t.nation.select("n_nationkey", "n_name", "n_regionkey")
        r = self.t.region.select("r_regionkey", "r_name")
        j = (o.join(c, c.c_custkey == o.o_custkey)
             .join(n, n.n_nationkey == c.c_nationkey)
             .join(r, r.r_regionkey == n.n_regionkey))
        return j.select(
            F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").alias("post_date"),
            F.col("o_orderpriority").alias("prio"), F.col("o_orderstatus").alias("status"),
            F.col("c_name").alias("cust_name"), F.col("c_mktsegment").alias("segment"),
            F.col("c_custkey").alias("custkey"), F.col("n_nationkey").alias("nationkey"),
            F.col("n_name").alias("nation_name"),
            F.when(F.col("r_name") == "AMERICA", "United States")
             .when(F.col("r_name") == "EUROPE", "United Kingdom")
             .when(F.col("r_name") == "ASIA", "Hong Kong")
             .otherwise(F.col("r_name")).alias("country"),
        )

    def postings_v1(self) -> DataFrame:
        ck, jid = F.col("custkey"), F.col("job_id")
        # the older release was cut before July 2001
        geo = self.orders_geo()
        return geo.filter(F.col("post_date") < F.to_timestamp_ntz(F.lit("2001-07-01"))).select(
            _null_when(jid % 37 == 0, jid).alias("job_id"), jid.alias("desc_id"), "post_date", "country",
            F.col("nationkey").alias("naics6"),
            F.when(ck % 9 == 0, F.lit(None)).when(ck % 9 == 1, F.lit(" unclassified "))
             .otherwise(F.concat(F.lit("  "), F.col("segment"))).alias("naics2_name"),
            F.when(ck % 17 == 0, F.lit(None)).when(ck % 17 == 1, F.lit("5613"))
             .otherwise(F.lit("1111")).alias("naics4"),
            F.col("cust_name").alias("company_name"),
            F.when(F.col("status") == "F", "No Education Found")
             .when(F.col("status") == "P", "High School/GED")
             .otherwise("Doctorate Degree").alias("min_degree"),
            _null_when(jid % 13 == 0, F.col("prio")).alias("onet_code"),
            _null_when(jid % 19 == 0, F.col("nation_name")).alias("state"),
            F.col("segment").alias("city"),
            F.when(jid % 13 == 0, F.lit(None)).when(jid % 17 == 1, F.lit("Unclassified occupation"))
             .otherwise(F.concat(F.upper("prio"), F.lit(" "))).alias("onet_name"),
            _null_when(jid % 29 == 0, F.concat(F.col("nation_name"), F.lit(" Metro"))).alias("msa"),
            F.when(ck % 21 == 0, F.lit(None)).when(ck % 21 == 1, F.lit(" unclassified title"))
             .otherwise(F.concat(F.col("segment"), F.lit(" "), F.col("status"))).alias("title"),
            *_place(geo, jid % 37 == 0),
        )

    def postings_v2(self) -> DataFrame:
        ck, jid = F.col("custkey"), F.col("job_id")
        # the newer release drops one data-quality class of postings
        geo = self.orders_geo()
        return geo.filter(~((F.col("status") == "P") & (F.col("prio") == "5-LOW"))).select(
            "job_id", jid.alias("desc_id"), "post_date", "country",
            F.col("nationkey").alias("naics6"),
            _null_when(ck % 11 == 0, F.col("segment")).alias("naics2_name"),
            F.when(ck % 17 == 0, F.lit(None)).when(ck % 17 == 2, F.lit("5613"))
             .otherwise(F.lit("1111")).alias("naics4"),
            F.col("cust_name").alias("company_name"),
            F.when(F.col("status") == "F", "None")
             .when(F.col("status") == "P", "High School/GED")
             .otherwise("Doctorate Degree").alias("min_degree"),
            F.when(jid % 11 == 0, F.lit(None)).when(jid % 5 == 0, F.lit("1-URGENT"))
             .otherwise(F.col("prio")).alias("onet_code"),
            _null_when(jid % 23 == 0, F.col("nation_name")).alias("state"),
            F.col("segment").alias("city"),
            _null_when(jid % 11 == 0, F.upper("prio")).alias("onet_name"),
            _null_when(jid % 31 == 0, F.concat(F.col("nation_name"), F.lit(" Metro"))).alias("msa"),
            _null_when(ck % 22 == 0, F.concat(F.col("segment"), F.lit(" "), F.col("status"))).alias("title"),
            *_place(geo),
        )

    def postings_ext(self) -> DataFrame:
        l = self.t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate",
                                   "l_extendedprice")
        g = self.orders_geo().filter(F.col("country") == "United States")
        j = l.join(g, g.job_id == l.l_orderkey)
        ln = F.col("l_linenumber")
        return j.select(
            # ids that are unknown, negative or very large
            F.when(F.col("l_partkey") % 97 == 0, F.lit(None)).when(F.col("l_partkey") % 89 == 0, -F.col("job_id"))
             .when(F.col("l_partkey") % 83 == 0, F.col("job_id") + F.lit(9 * 10 ** 18)).otherwise(F.col("job_id")).alias("id"),
            F.col("l_shipdate").alias("posted"), F.col("cust_name").alias("company_name"),
            _null_when(F.col("l_partkey") % 10 == 0, F.col("segment")).alias("naics2_name"),
            F.when(F.col("status") == "F", "High school or GED")
             .when(F.col("status") == "P", "Ph.D. or professional degree")
             .otherwise("Unspecified").alias("min_degree"),
            _null_when(F.col("job_id") % 13 == 0, F.col("prio")).alias("onet_code"),
            F.col("nation_name").alias("state"),
            F.concat(F.col("segment"), F.lit(", US")).alias("city_name"),
            F.when(ln == 7, F.lit(None)).when(ln == 6, F.lit(0.0))
             .otherwise(F.col("l_extendedprice") * 3).alias("salary_from"),
            _null_when(F.col("job_id") % 13 == 0, F.col("prio")).alias("onet_name"),
            _null_when(F.col("l_partkey") % 14 == 0, F.concat(F.col("nation_name"), F.lit(" Metro"))).alias("msa"),
            _null_when(F.col("l_partkey") % 15 == 0, F.concat(F.col("segment"), F.lit(" "), F.col("status"))).alias("title"),
        )

    def _postings_abroad(self, scope: Column) -> DataFrame:
        """The vendor's tables of other countries: only what the salary
        coverage reads."""
        l = self.t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
        g = self.orders_geo().filter(scope).select("job_id", "country")
        ln = F.col("l_linenumber")
        return l.join(g, g.job_id == l.l_orderkey).select(
            F.col("job_id").alias("id"), F.col("l_shipdate").alias("posted"), "country",
            F.when(ln >= 5, F.lit(None)).when(ln == 4, F.lit(0.0))
             .otherwise(F.col("l_extendedprice") * 2).alias("salary_from"))

    def postings_ext_uk(self) -> DataFrame:
        return self._postings_abroad(F.col("country") == "United Kingdom")

    def postings_ext_global(self) -> DataFrame:
        return self._postings_abroad(~F.col("country").isin("United States", "United Kingdom"))

    def salary(self) -> DataFrame:
        ln, q, px = F.col("l_linenumber"), F.col("l_quantity"), F.col("l_extendedprice")
        per = (F.when(ln == 1, "Year").when(ln == 2, "HOUR").when(ln == 3, "week")
               .when(ln == 4, "day").when(ln == 5, "month").when(ln == 6, "piece"))
        amount = (F.when(q < 3, F.lit(None)).when(q < 5, F.lit(0.0))
                  .when(ln == 2, px / 1000).when(ln.isin(3, 4), px / 100)
                  .when(ln == 5, px / 10).otherwise(px * 3))
        return self.t.lineitem.select(F.col("l_orderkey").alias("desc_id"),
                                      per.alias("salary_per"), amount.alias("parsed_salary_min"))

    def xwalk(self) -> DataFrame:
        return (self.t.lineitem.filter(F.col("l_linenumber").isin(1, 2))
                .select(F.col("l_orderkey").alias("release_id"), F.col("l_orderkey").alias("ext_id")))

    def onet_lookup(self) -> DataFrame:
        p = F.col("o_orderpriority")
        return self.t.orders.select(
            p.alias("onet_code"),
            F.concat(F.upper(p), F.lit(" ")).alias("onet_name"),
            F.when(p.isin("1-URGENT", "2-HIGH"), "Management").when(p == "3-MEDIUM", "Sales")
             .otherwise("Military Specific").alias("soc2_name"),
        ).distinct()

    def naics_hierarchy(self) -> DataFrame:
        n = self.t.nation.select("n_nationkey", "n_regionkey")
        r = self.t.region.select("r_regionkey", "r_name")
        return n.join(r, r.r_regionkey == n.n_regionkey).select(
            F.col("n_nationkey").alias("naics6"), F.col("r_name").alias("naics2_name"))

    # -------------------------------------------------------------- benchmarks
    def bench_occ(self) -> DataFrame:
        """Employment by occupation: one row per nation, sized by its customers."""
        k = F.col("n_nationkey")
        codes = F.array(*[F.lit(c) for c in ("1-URGEN", "2-HIGH", "3-MEDIU", "4-NOT S", "6-NONE")])
        n = self.t.nation.select("n_nationkey", "n_name")
        c = self.t.customer.select("c_custkey", "c_nationkey")
        per = (n.join(c, c.c_nationkey == n.n_nationkey, "left")
               .groupBy("n_nationkey", "n_name").agg(F.count("c_custkey").alias("cnt")))
        return per.select(
            F.when(k % 5 == 4, "detailed").otherwise("major").alias("o_group"),
            F.col("n_name").alias("occ_title"),
            F.element_at(codes, (F.floor(k / 5) % 5 + 1).cast("int")).alias("occ_code"),
            F.when(k % 6 == 5, F.lit("**")).otherwise((1000 + 37 * F.col("cnt")).cast("string"))
            .alias("tot_emp"),
        )

    def bench_wide(self) -> DataFrame:
        o = self.t.orders.select("o_orderdate")
        y, m = F.year("o_orderdate"), F.month("o_orderdate")

        def month_count(i):
            return F.count(F.when(m == i, 1)).cast("double") / 8

        names = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
        agg = o.groupBy(y.alias("y")).agg(*[month_count(i + 1).alias(n) for i, n in enumerate(names)])
        body = agg.select(F.col("y").cast("string").alias("year_label"),
                          *[F.when(F.col("y") == 1997, F.lit(None)).otherwise(F.col(n)).alias(n) if n == "Mar"
                            else F.col(n) for n in names])
        note = self.spark.createDataFrame([("Original Data Value", *[None] * 12)],
                                          "year_label string, " + ", ".join(f"{n} double" for n in names))
        return body.unionByName(note)

    def bench_map(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self.t.nation.select(
            F.concat(F.lit("B"), (k % 4).cast("string")).alias("bls_code"),
            F.concat(F.lit("Sector "), (k % 4).cast("string")).alias("industry"),
            (k % 8).cast("string").alias("naics2_code"),
            (F.lit(0.05) * (1 + k % 4)).cast("double").alias("bls_pct"),
        )

    def series_json(self) -> DataFrame:
        e = self.t.events.select("user_id", "event_type", "props", "ts")
        return e.select(
            F.concat(F.lit("JTS000000"), F.lpad((F.col("user_id") % 60).cast("string"), 2, "0"),
                     F.lit("0000000JOL")).alias("series_id"),
            F.year("ts").cast("string").alias("year"),
            F.when(F.col("event_type") == "error", "M13").otherwise("M01").alias("period"),
            F.col("props").alias("payload"),
        )

    def bench_counts(self) -> DataFrame:
        p = self.t.part.select("p_type")
        body = p.groupBy(F.when(F.col("p_type") == "LARGE", "Benchmark only")
                         .otherwise(F.col("p_type")).alias("label")).agg(
            (F.count(F.lit(1)) * 10).alias("cnt"))
        extra = self.spark.createDataFrame([(None, 7)], "label string, cnt bigint")
        return body.unionByName(extra)

    def bench_share(self) -> DataFrame:
        p = self.t.part.select("p_type", "p_size")
        return p.groupBy(F.when(F.col("p_type") == "LARGE", "Benchmark only")
                         .otherwise(F.col("p_type")).alias("label")).agg(
            (F.count(F.lit(1)).cast("double") / 40).alias("share_a"),
            (F.sum("p_size").cast("double") / 900).alias("share_b"))

    def openings_industry(self) -> DataFrame:
        """Official openings by industry, monthly rows with a string year and
        a region column (A9 shape): one row per order."""
        o = self.t.orders.select("o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
        return o.select(
            F.when(F.col("o_orderstatus") == "F", "Total US").otherwise("Other").alias("state_text"),
            F.col("o_orderpriority").alias("industry_code"),
            F.year("o_orderdate").cast("string").alias("year"),
            (F.col("o_totalprice") / 1000).alias("job_openings"),
        )

    def imputed(self) -> DataFrame:
        return self.orders_geo().select(
            "job_id", _null_when(F.col("job_id") % 4 != 0, F.col("custkey") % 50).alias("imputed_key"))

    def classifier(self) -> DataFrame:
        """An occupation classifier's output: top code per description."""
        o = self.t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
        return o.select(F.col("o_orderkey").alias("desc_id"),
                        F.when(F.col("o_custkey") % 7 == 0, F.lit(None)).when(F.col("o_custkey") % 5 == 0, F.lit("2-HIGH"))
                         .otherwise(F.col("o_orderpriority")).alias("top1_code"))

    def employers(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.t.supplier.select(
            k.alias("employer_key"), _null_when(k % 6 == 0, F.col("s_nationkey")).alias("naics6"))


class StoredJoins(Recipes):
    """The recipes over their two common joins, each stored once: what is
    derived from one of them shuffles nothing of it again. Their rows are
    wide, so ``stints`` is written in the order it is joined; ``orders_geo`` is
    ranged by id, with positions, and its parts are small enough to sort."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.root = root

    def stints(self) -> DataFrame:
        return staged(self.spark, self.root, "stints", lambda: Recipes.stints(self), (), _recipe_text())

    def orders_geo(self) -> DataFrame:
        return staged(self.spark, self.root, "orders_geo", lambda: positions.laid_out(Recipes.orders_geo(self), "job_id"),
                      ("post_date",), _recipe_text())


@functools.cache
def _recipe_text() -> str:
    return inspect.getsource(sys.modules[__name__]) + inspect.getsource(positions)


class Fixtures:
    """The relations the queries read. With ``staged=True`` (default) each is
    written once under the shared checkpoint folder and read back as a
    stored table (``VIEWS`` are read from what they are rows of); with ``staged=False`` it is the lazy recipe itself."""

    def __init__(self, spark: SparkSession, root: str, staged: bool = True):
        self.spark = spark
        self.root = root
        self.recipes = StoredJoins(spark, root) if staged else Recipes(spark, root)
        self.is_staged = staged

    def release_root(self) -> str:
        """A folder of three releases of ``postings`` whose schemas drift: a
        key widens, a column is renamed, columns go and come."""
        def make(path: str) -> None:
            r = self.recipes
            r.postings_v1().select("job_id", "country", F.col("naics6").cast("int").alias("naics6"), "state", "min_degree", "msa") \
                .write.parquet(f"{path}/r1/postings")
            r.postings_v2().select("job_id", "country", F.col("naics6").cast("bigint").alias("naics6"), F.col("state").alias("state_name"), "min_degree") \
                .write.parquet(f"{path}/r2/postings")
            r.postings_ext().select(F.col("id").alias("Job_ID"), F.col("state").alias("State_Name"), "min_degree", "title") \
                .write.parquet(f"{path}/r10/postings")
            # a version without the table
            r.naics_hierarchy().write.parquet(f"{path}/r3/hierarchy")
        return staged_folder(self.spark, self.root, "releases", make, _recipe_text())

    def family(self, name: str) -> Parts:
        """The parts of a family of ``FAMILIES``, a frame per member."""
        key, columns = FAMILIES[name]
        members = {m: lambda m=m, c=c: getattr(self, m)().select(*c) for m, c in columns.items()}
        if not self.is_staged:
            return [{m: build() for m, build in members.items()}]
        return colocated(self.spark, self.root, name, key, members, _recipe_text())

    def __getattr__(self, name: str):
        if name.startswith("_") or name not in STAGED:
            raise AttributeError(name)
        build = getattr(self.recipes, name)
        if not self.is_staged or name in VIEWS:
            return build
        if name in POSITIONED:
            plain = build
            build = lambda: positions.laid_out(plain(), POSITIONED[name])
        return lambda: staged(self.spark, self.root, name, build, STAGED[name], _recipe_text())
