"""DuckDB oracle: for every query key, an independent SQL statement over the
driver's tables (pre-registered views) that computes the same result the
way the original jobs do: one CTE per source, FULL / LEFT joins on the
value, scalar totals. The Spark side (``vintage``) uses a different plan
(unions and single aggregations), so agreement checks the semantics.

Fixture recipes first (same rows as ``vintage.sources.fixtures``), then one
statement per key. Oracle typing: DuckDB gives HUGEINT for sums of integers
and ``count_if``, BIGINT for ``year()``, TIMESTAMP for ``date_trunc`` and
rounds in ``CAST(double AS BIGINT)``, so those are cast explicitly.
"""

from __future__ import annotations

import datetime as dt

# The jobs' parameters, written out here so that a wrong one is noticed.
AS_OF = "2001-06-30"
STINT_WINDOW = ("1998-01-01", "1998-01-31")
SECTOR_MAP = {"AMERICA": "Sector A", "EUROPE": "Sector E", "ASIA": "Sector A", "AUTOMOBILE": "Sector A",
              "BUILDING": "Sector B", "MACHINERY": "Sector M", "HOUSEHOLD": "Sector H"}
CODE_SECTOR_MAP = {"1-URGENT": "Sector A", "2-HIGH": "Sector B", "3-MEDIUM": "Sector E",
                   "4-NOT SPECIFIED": "Sector Z"}
# State codes of the official series.
STATES = {
    "01": "ALABAMA", "02": "ALASKA", "04": "ARIZONA", "05": "ARKANSAS", "06": "CALIFORNIA", "08": "COLORADO",
    "09": "CONNECTICUT", "10": "DELAWARE", "11": "DISTRICT OF COLUMBIA", "12": "FLORIDA", "13": "GEORGIA",
    "15": "HAWAII", "16": "IDAHO", "17": "ILLINOIS", "18": "INDIANA", "19": "IOWA", "20": "KANSAS",
    "21": "KENTUCKY", "22": "LOUISIANA", "23": "MAINE", "24": "MARYLAND", "25": "MASSACHUSETTS",
    "26": "MICHIGAN", "27": "MINNESOTA", "28": "MISSISSIPPI", "29": "MISSOURI", "30": "MONTANA",
    "31": "NEBRASKA", "32": "NEVADA", "33": "NEW HAMPSHIRE", "34": "NEW JERSEY", "35": "NEW MEXICO",
    "36": "NEW YORK", "37": "NORTH CAROLINA", "38": "NORTH DAKOTA", "39": "OHIO", "40": "OKLAHOMA",
    "41": "OREGON", "42": "PENNSYLVANIA", "44": "RHODE ISLAND", "45": "SOUTH CAROLINA", "46": "SOUTH DAKOTA",
    "47": "TENNESSEE", "48": "TEXAS", "49": "UTAH", "50": "VERMONT", "51": "VIRGINIA", "53": "WASHINGTON",
    "54": "WEST VIRGINIA", "55": "WISCONSIN", "56": "WYOMING",
}

# --------------------------------------------------------------- fixtures
FIXTURES: dict[str, str] = {
    "fx_stints": """
SELECT CASE WHEN l.l_partkey % 41 = 0 THEN NULL ELSE l.l_orderkey END AS person_id, l.l_linenumber AS line_no, n.n_name AS country,
       p.p_size AS p_size, p.p_type AS p_type, p.p_brand AS p_brand, p.p_name AS p_name,
       CAST(l.l_quantity AS INT) AS qty, s.s_name AS company_name,
       CASE WHEN l.l_suppkey % 13 = 0 THEN NULL ELSE l.l_suppkey END AS company_id,
       o.o_orderdate AS start_date,
       CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE l.l_shipdate END AS end_date
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "fx_profiles_base": """
SELECT person_id, country, company_name, company_id, start_date, end_date,
       CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 1 THEN 'Unclassified'
            WHEN p_size % 10 = 2 THEN 'Other (unclassified)' ELSE p_type END AS soc2_name,
       CASE WHEN p_size % 13 = 0 THEN NULL ELSE p_type || ' worker' END AS onet_name,
       CASE WHEN p_size % 11 = 1 THEN 'unclassified role' ELSE p_brand END AS suboccupation,
       CASE WHEN p_size % 17 = 0 THEN NULL ELSE p_name END AS standard_title,
       CAST(floor(qty / 5) AS INT) AS onet_confidence,
       qty * 2 AS location_confidence, qty * 2 AS school_confidence,
       100 - qty * 2 AS intl_school_confidence,
       CASE WHEN p_size % 12 = 0 THEN NULL ELSE p_name END AS school_name,
       CASE WHEN p_size % 14 = 0 THEN NULL ELSE p_brand END AS city,
       CASE WHEN p_size % 7 = 0 THEN NULL
            ELSE p_type || ', ' || p_brand || CASE WHEN p_size % 5 = 0 THEN ', ' ELSE '' END END AS degree_list,
       CASE WHEN p_size % 6 = 0 THEN '"[""]' WHEN p_size % 11 = 0 THEN NULL ELSE p_name END AS education_raw,
       CASE WHEN p_size % 8 = 0 THEN NULL ELSE CAST(p_size % 8 AS STRING) END AS naics2_code,
       CASE WHEN p_size % 8 = 0 THEN NULL ELSE 'Industry ' || CAST(p_size % 8 AS STRING) END AS naics2_name
FROM fx_stints WHERE line_no <= 5""",
    "fx_profiles_new": """
SELECT person_id, country, company_name, company_id, start_date, end_date,
       CASE WHEN p_size % 9 = 0 THEN NULL WHEN p_size % 9 = 1 THEN 'Unclassified'
            WHEN p_type = 'PROMO' THEN 'PROMOTIONAL' ELSE p_type END AS soc2_name,
       CASE WHEN p_size % 13 = 0 THEN NULL ELSE p_type || ' worker' END AS onet_name,
       CASE WHEN p_size % 11 = 1 THEN 'unclassified role' ELSE p_brand END AS suboccupation,
       CASE WHEN p_size % 17 = 0 THEN NULL ELSE p_name END AS standard_title,
       CAST(floor(qty / 5) AS INT) AS onet_confidence,
       qty * 2 AS location_confidence, qty * 2 AS school_confidence,
       100 - qty * 2 AS intl_school_confidence,
       CASE WHEN p_size % 15 = 0 THEN NULL ELSE p_name END AS school_name,
       CASE WHEN p_size % 16 = 0 THEN NULL ELSE p_brand END AS city,
       CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_type || ', ' || p_brand END AS degree_list,
       CASE WHEN p_size % 6 = 0 THEN '"[""]' WHEN p_size % 11 = 0 THEN NULL ELSE p_name END AS education_raw,
       CASE WHEN p_size % 8 = 0 THEN NULL ELSE CAST(p_size % 8 AS STRING) END AS naics2_code,
       CASE WHEN p_size % 8 = 0 THEN NULL ELSE 'Industry ' || CAST(p_size % 8 AS STRING) END AS naics2_name
FROM fx_stints WHERE line_no >= 2""",
    "fx_orders_geo": """
SELECT o.o_orderkey AS job_id, o.o_orderdate AS post_date, o.o_orderpriority AS prio,
       o.o_orderstatus AS status, c.c_name AS cust_name, c.c_mktsegment AS segment,
       c.c_custkey AS custkey, n.n_nationkey AS nationkey, n.n_name AS nation_name,
       CASE r.r_name WHEN 'AMERICA' THEN 'United States' WHEN 'EUROPE' THEN 'United Kingdom'
            WHEN 'ASIA' THEN 'Hong Kong' ELSE r.r_name END AS country
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "fx_education_base": """
SELECT person_id, CASE country WHEN 'NATION_1' THEN 'United States' WHEN 'NATION_2' THEN ' usa ' ELSE country END AS country,
       qty * 2 AS school_confidence, 100 - qty * 2 AS intl_school_confidence,
       CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_type END AS degree_per_entry,
       CASE WHEN p_size % 9 = 0 THEN NULL WHEN p_size % 9 = 1 THEN 'Unclassified degree' ELSE p_brand END AS degree_per_id,
       CASE WHEN p_size % 7 = 1 THEN NULL ELSE p_type || ', ' || p_brand END AS degree_list,
       CASE WHEN p_size % 6 = 0 THEN '"[""]' WHEN p_size % 11 = 0 THEN NULL ELSE p_name END AS education_raw,
       CASE WHEN p_size % 11 = 0 THEN NULL ELSE 'Major ' || CAST(p_size % 23 AS STRING) END AS major_name,
       CASE WHEN p_size % 7 = 2 THEN NULL ELSE p_name END AS school_name
FROM fx_stints WHERE line_no <= 4""",
    "fx_education_new": """
SELECT person_id, CASE country WHEN 'NATION_1' THEN 'United States' WHEN 'NATION_2' THEN ' usa ' ELSE country END AS country,
       qty * 2 AS school_confidence, 100 - qty * 2 AS intl_school_confidence,
       CASE WHEN p_size % 8 = 0 THEN NULL ELSE p_type END AS degree_per_entry,
       CASE WHEN p_size % 9 = 0 THEN NULL WHEN p_size % 9 = 1 THEN 'Unclassified degree' ELSE p_brand END AS degree_per_id,
       CASE WHEN p_size % 8 = 1 THEN NULL ELSE p_type || ', ' || p_brand END AS degree_list,
       CASE WHEN p_size % 6 = 0 THEN '"[""]' WHEN p_size % 11 = 0 THEN NULL ELSE p_name END AS education_raw,
       CASE WHEN p_size % 11 = 0 THEN NULL ELSE 'Major ' || CAST(p_size % 23 AS STRING) END AS major_name,
       CASE WHEN p_size % 8 = 2 THEN NULL ELSE p_name END AS school_name
FROM fx_stints WHERE line_no >= 2""",
    "fx_persons_base": """
SELECT job_id AS person_id, country, custkey % 100 AS location_confidence,
       CASE WHEN custkey % 19 = 0 THEN NULL ELSE nation_name END AS state,
       CASE WHEN custkey % 23 = 0 THEN 'Unclassified county' ELSE segment END AS county,
       CASE WHEN custkey % 19 = 1 THEN NULL ELSE nation_name || ' City ' || CAST(custkey % 7 AS STRING) END AS city
FROM fx_orders_geo WHERE status <> 'F'""",
    "fx_persons_new": """
SELECT job_id AS person_id, country, custkey % 100 AS location_confidence,
       CASE WHEN custkey % 21 = 0 THEN NULL ELSE nation_name END AS state,
       CASE WHEN custkey % 23 = 0 THEN 'Unclassified county' ELSE segment END AS county,
       CASE WHEN custkey % 21 = 1 THEN NULL ELSE nation_name || ' City ' || CAST(custkey % 7 AS STRING) END AS city
FROM fx_orders_geo WHERE status <> 'P'""",
    "fx_postings_v1": """
SELECT CASE WHEN job_id % 37 = 0 THEN NULL ELSE job_id END AS job_id, job_id AS desc_id, post_date, country, nationkey AS naics6,
       CASE WHEN custkey % 9 = 0 THEN NULL WHEN custkey % 9 = 1 THEN ' unclassified ' ELSE '  ' || segment END AS naics2_name,
       CASE WHEN custkey % 17 = 0 THEN NULL WHEN custkey % 17 = 1 THEN '5613' ELSE '1111' END AS naics4,
       cust_name AS company_name,
       CASE status WHEN 'F' THEN 'No Education Found' WHEN 'P' THEN 'High School/GED' ELSE 'Doctorate Degree' END AS min_degree,
       CASE WHEN job_id % 13 = 0 THEN NULL ELSE prio END AS onet_code,
       CASE WHEN job_id % 19 = 0 THEN NULL ELSE nation_name END AS state,
       segment AS city,
       CASE WHEN job_id % 13 = 0 THEN NULL WHEN job_id % 17 = 1 THEN 'Unclassified occupation' ELSE upper(prio) || ' ' END AS onet_name,
       CASE WHEN job_id % 29 = 0 THEN NULL ELSE nation_name || ' Metro' END AS msa,
       CASE WHEN custkey % 21 = 0 THEN NULL WHEN custkey % 21 = 1 THEN ' unclassified title' ELSE segment || ' ' || status END AS title
FROM fx_orders_geo WHERE post_date < TIMESTAMP '2001-07-01'""",
    "fx_postings_v2": """
SELECT job_id, job_id AS desc_id, post_date, country, nationkey AS naics6,
       CASE WHEN custkey % 11 = 0 THEN NULL ELSE segment END AS naics2_name,
       CASE WHEN custkey % 17 = 0 THEN NULL WHEN custkey % 17 = 2 THEN '5613' ELSE '1111' END AS naics4,
       cust_name AS company_name,
       CASE status WHEN 'F' THEN 'None' WHEN 'P' THEN 'High School/GED' ELSE 'Doctorate Degree' END AS min_degree,
       CASE WHEN job_id % 11 = 0 THEN NULL WHEN job_id % 5 = 0 THEN '1-URGENT' ELSE prio END AS onet_code,
       CASE WHEN job_id % 23 = 0 THEN NULL ELSE nation_name END AS state,
       segment AS city,
       CASE WHEN job_id % 11 = 0 THEN NULL ELSE upper(prio) END AS onet_name,
       CASE WHEN job_id % 31 = 0 THEN NULL ELSE nation_name || ' Metro' END AS msa,
       CASE WHEN custkey % 22 = 0 THEN NULL ELSE segment || ' ' || status END AS title
FROM fx_orders_geo WHERE NOT (status = 'P' AND prio = '5-LOW')""",
    "fx_postings_ext": """
SELECT CASE WHEN l.l_partkey % 97 = 0 THEN NULL WHEN l.l_partkey % 89 = 0 THEN -g.job_id
            WHEN l.l_partkey % 83 = 0 THEN g.job_id + 9000000000000000000 ELSE g.job_id END AS id,
       l.l_shipdate AS posted, g.cust_name AS company_name,
       CASE WHEN l.l_partkey % 10 = 0 THEN NULL ELSE g.segment END AS naics2_name,
       CASE status WHEN 'F' THEN 'High school or GED' WHEN 'P' THEN 'Ph.D. or professional degree' ELSE 'Unspecified' END AS min_degree,
       CASE WHEN g.job_id % 13 = 0 THEN NULL ELSE g.prio END AS onet_code,
       g.nation_name AS state, g.segment || ', US' AS city_name,
       CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_linenumber = 6 THEN 0.0 ELSE l.l_extendedprice * 3 END AS salary_from,
       CASE WHEN g.job_id % 13 = 0 THEN NULL ELSE g.prio END AS onet_name,
       CASE WHEN l.l_partkey % 14 = 0 THEN NULL ELSE g.nation_name || ' Metro' END AS msa,
       CASE WHEN l.l_partkey % 15 = 0 THEN NULL ELSE g.segment || ' ' || status END AS title
FROM lineitem l JOIN fx_orders_geo g ON g.job_id = l.l_orderkey
WHERE g.country = 'United States'""",
    "fx_postings_ext_uk": """
SELECT g.job_id AS id, l.l_shipdate AS posted, g.country,
       CASE WHEN l.l_linenumber >= 5 THEN NULL WHEN l.l_linenumber = 4 THEN 0.0 ELSE l.l_extendedprice * 2 END AS salary_from
FROM lineitem l JOIN fx_orders_geo g ON g.job_id = l.l_orderkey WHERE g.country = 'United Kingdom'""",
    "fx_postings_ext_global": """
SELECT g.job_id AS id, l.l_shipdate AS posted, g.country,
       CASE WHEN l.l_linenumber >= 5 THEN NULL WHEN l.l_linenumber = 4 THEN 0.0 ELSE l.l_extendedprice * 2 END AS salary_from
FROM lineitem l JOIN fx_orders_geo g ON g.job_id = l.l_orderkey
WHERE g.country NOT IN ('United States', 'United Kingdom')""",
    "fx_salary": """
SELECT l_orderkey AS desc_id,
       CASE l_linenumber WHEN 1 THEN 'Year' WHEN 2 THEN 'HOUR' WHEN 3 THEN 'week' WHEN 4 THEN 'day'
            WHEN 5 THEN 'month' WHEN 6 THEN 'piece' ELSE NULL END AS salary_per,
       CASE WHEN l_quantity < 3 THEN NULL WHEN l_quantity < 5 THEN 0.0
            WHEN l_linenumber = 2 THEN l_extendedprice / 1000 WHEN l_linenumber IN (3, 4) THEN l_extendedprice / 100
            WHEN l_linenumber = 5 THEN l_extendedprice / 10 ELSE l_extendedprice * 3 END AS parsed_salary_min
FROM lineitem""",
    "fx_xwalk": """
SELECT l_orderkey AS release_id, l_orderkey AS ext_id FROM lineitem WHERE l_linenumber IN (1, 2)""",
    "fx_onet_lookup": """
SELECT DISTINCT o_orderpriority AS onet_code, upper(o_orderpriority) || ' ' AS onet_name,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Management'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'Sales' ELSE 'Military Specific' END AS soc2_name
FROM orders""",
    "fx_naics_hierarchy": """
SELECT n_nationkey AS naics6, r_name AS naics2_name FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "fx_bench_occ": """
SELECT CASE WHEN n.n_nationkey % 5 = 4 THEN 'detailed' ELSE 'major' END AS o_group, n.n_name AS occ_title,
       CASE CAST(floor(n.n_nationkey / 5) AS BIGINT) % 5 WHEN 0 THEN '1-URGEN' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIU'
            WHEN 3 THEN '4-NOT S' ELSE '6-NONE' END AS occ_code,
       CASE WHEN n.n_nationkey % 6 = 5 THEN '**' ELSE CAST(1000 + 37 * count(c.c_custkey) AS STRING) END AS tot_emp
FROM nation n LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_nationkey, n.n_name""",
    "fx_bench_wide": """
SELECT CAST(year(o_orderdate) AS STRING) AS year_label,
       CAST(count(CASE WHEN month(o_orderdate) = 1 THEN 1 END) AS DOUBLE) / 8 AS Jan,
       CAST(count(CASE WHEN month(o_orderdate) = 2 THEN 1 END) AS DOUBLE) / 8 AS Feb,
       CASE WHEN year(o_orderdate) = 1997 THEN NULL
            ELSE CAST(count(CASE WHEN month(o_orderdate) = 3 THEN 1 END) AS DOUBLE) / 8 END AS Mar,
       CAST(count(CASE WHEN month(o_orderdate) = 4 THEN 1 END) AS DOUBLE) / 8 AS Apr,
       CAST(count(CASE WHEN month(o_orderdate) = 5 THEN 1 END) AS DOUBLE) / 8 AS May,
       CAST(count(CASE WHEN month(o_orderdate) = 6 THEN 1 END) AS DOUBLE) / 8 AS Jun,
       CAST(count(CASE WHEN month(o_orderdate) = 7 THEN 1 END) AS DOUBLE) / 8 AS Jul,
       CAST(count(CASE WHEN month(o_orderdate) = 8 THEN 1 END) AS DOUBLE) / 8 AS Aug,
       CAST(count(CASE WHEN month(o_orderdate) = 9 THEN 1 END) AS DOUBLE) / 8 AS Sep,
       CAST(count(CASE WHEN month(o_orderdate) = 10 THEN 1 END) AS DOUBLE) / 8 AS Oct,
       CAST(count(CASE WHEN month(o_orderdate) = 11 THEN 1 END) AS DOUBLE) / 8 AS Nov,
       CAST(count(CASE WHEN month(o_orderdate) = 12 THEN 1 END) AS DOUBLE) / 8 AS Dec
FROM orders GROUP BY year(o_orderdate)
UNION ALL SELECT 'Original Data Value', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
    "fx_bench_map": """
SELECT 'B' || CAST(n_nationkey % 4 AS STRING) AS bls_code, 'Sector ' || CAST(n_nationkey % 4 AS STRING) AS industry,
       CAST(n_nationkey % 8 AS STRING) AS naics2_code, CAST(0.05 * (1 + n_nationkey % 4) AS DOUBLE) AS bls_pct
FROM nation""",
    "fx_series_json": """
SELECT 'JTS000000' || lpad(CAST(user_id % 60 AS STRING), 2, '0') || '0000000JOL' AS series_id,
       CAST(year(ts) AS STRING) AS year,
       CASE WHEN event_type = 'error' THEN 'M13' ELSE 'M01' END AS period, props AS payload
FROM events""",
    "fx_bench_counts": """
SELECT CASE WHEN p_type = 'LARGE' THEN 'Benchmark only' ELSE p_type END AS label, count(*) * 10 AS cnt
FROM part GROUP BY p_type
UNION ALL SELECT NULL, 7""",
    "fx_bench_share": """
SELECT CASE WHEN p_type = 'LARGE' THEN 'Benchmark only' ELSE p_type END AS label,
       CAST(count(*) AS DOUBLE) / 40 AS share_a, CAST(sum(p_size) AS DOUBLE) / 900 AS share_b
FROM part GROUP BY p_type""",
    "fx_openings_industry": """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'Total US' ELSE 'Other' END AS state_text,
       o_orderpriority AS industry_code, CAST(year(o_orderdate) AS STRING) AS year,
       o_totalprice / 1000 AS job_openings
FROM orders""",
    "fx_imputed": """
SELECT job_id, CASE WHEN job_id % 4 <> 0 THEN NULL ELSE custkey % 50 END AS imputed_key FROM fx_orders_geo""",
    "fx_classifier": """
SELECT o_orderkey AS desc_id, CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 5 = 0 THEN '2-HIGH' ELSE o_orderpriority END AS top1_code
FROM orders""",
    "fx_employers": """
SELECT s_suppkey AS employer_key, CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE s_nationkey END AS naics6 FROM supplier""",
}

_DEPS = {
    "fx_profiles_base": ["fx_stints"], "fx_profiles_new": ["fx_stints"],
    "fx_education_base": ["fx_stints"], "fx_education_new": ["fx_stints"],
    "fx_persons_base": ["fx_orders_geo"], "fx_persons_new": ["fx_orders_geo"],
    "fx_postings_v1": ["fx_orders_geo"], "fx_postings_v2": ["fx_orders_geo"],
    "fx_postings_ext": ["fx_orders_geo"], "fx_postings_ext_uk": ["fx_orders_geo"],
    "fx_postings_ext_global": ["fx_orders_geo"], "fx_imputed": ["fx_orders_geo"],
}


def _with(names: list[str], body: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({FIXTURES[n]}\n)" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def _vals(mapping: dict[str, str], k: str, v: str) -> str:
    rows = ", ".join("('{}', '{}')".format(a.replace("'", "''"), b.replace("'", "''"))
                     for a, b in mapping.items())
    return f"(VALUES {rows}) AS m({k}, {v})"


def _case(expr: str, mapping: dict[str, str]) -> str:
    whens = " ".join("WHEN '{}' THEN '{}'".format(a, b) for a, b in mapping.items())
    return f"CASE {expr} {whens} ELSE NULL END"


US = "'United States'"
Y0, YC, YX = 1996, 2000, 1999
C1 = "'NATION_1'"
PROFILES = ["fx_profiles_base", "fx_profiles_new"]


# ------------------------------------------------------------ profile job
def _p1(field: str, gate: str, table: str = "profiles") -> str:
    g = f" AND {gate}" if gate else ""
    ctes = []
    for r in ("base", "new"):
        ctes.append(f"""{r} AS (SELECT country, {field} AS field_value, count(*) AS cnt
  FROM fx_{table}_{r}
  WHERE {field} IS NOT NULL AND {field} NOT ILIKE '%unclassified%'{g}
  GROUP BY 1, 2)""")
    return "WITH " + ",\n".join(ctes) + """
SELECT COALESCE(base.country, new.country) AS country,
       COALESCE(base.field_value, new.field_value) AS field_value,
       COALESCE(base.cnt, 0) AS cnt_base, COALESCE(new.cnt, 0) AS cnt_new
FROM base FULL OUTER JOIN new ON base.country = new.country AND base.field_value = new.field_value"""


SCHOOL_GATE = ("CASE WHEN lower(trim(country)) IN ('united states', 'us', 'usa') "
               "THEN school_confidence >= 72 ELSE intl_school_confidence >= 70 END")


def _p4(test: str, gate: str, table: str = "profiles") -> str:
    g = f"WHERE {gate}" if gate else ""
    ctes = [f"""c_{r} AS (SELECT country, count(*) FILTER (WHERE {test}) AS nn, count(*) AS total
  FROM fx_{table}_{r} {g} GROUP BY country)""" for r in ("base", "new")]
    return "WITH " + ",\n".join(ctes) + """
SELECT COALESCE(c_base.country, c_new.country) AS country,
       c_base.nn / NULLIF(c_base.total, 0) AS coverage_base,
       c_new.nn / NULLIF(c_new.total, 0) AS coverage_new,
       COALESCE(c_base.total, 0) AS profiles_base, COALESCE(c_new.total, 0) AS profiles_new
FROM c_base FULL OUTER JOIN c_new ON c_base.country = c_new.country"""


def _p2(table: str = "profiles") -> str:
    ctes = [f"""{r} AS (SELECT country, field_value, count(*) AS cnt FROM (
    SELECT country, trim(x) AS field_value FROM (
      SELECT country, unnest(string_split(degree_list, ', ')) AS x FROM fx_{table}_{r}
      WHERE degree_list IS NOT NULL AND degree_list NOT ILIKE '%unclassified%'
        AND education_raw <> '"[""]'))
  WHERE field_value IS NOT NULL GROUP BY 1, 2)""" for r in ("base", "new")]
    return "WITH " + ",\n".join(ctes) + """
SELECT COALESCE(base.country, new.country) AS country,
       COALESCE(base.field_value, new.field_value) AS field_value,
       COALESCE(base.cnt, 0) AS cnt_base, COALESCE(new.cnt, 0) AS cnt_new
FROM base FULL OUTER JOIN new ON base.country = new.country AND base.field_value = new.field_value"""


def _p3() -> str:
    ctes = [f"""{r} AS (SELECT soc2_name AS field_value, COALESCE(soc2_name, '__NULL__') AS join_key,
    count(*) AS cnt FROM fx_profiles_{r}
  WHERE country = {C1} AND soc2_name IS NOT NULL AND soc2_name NOT ILIKE '%unclassified%'
  GROUP BY 1, 2)""" for r in ("base", "new")]
    return "WITH " + ",\n".join(ctes) + """,
bench AS (SELECT label AS field_value, COALESCE(label, '__NULL__') AS join_key, cnt FROM fx_bench_counts)
SELECT COALESCE(base.field_value, new.field_value, bench.field_value) AS field_value,
       COALESCE(base.cnt, 0) AS cnt_base, COALESCE(new.cnt, 0) AS cnt_new,
       CAST(COALESCE(bench.cnt, 0) AS BIGINT) AS cnt_benchmark
FROM base FULL OUTER JOIN new ON base.join_key = new.join_key
FULL OUTER JOIN bench ON COALESCE(base.join_key, new.join_key) = bench.join_key"""


def _p5() -> str:
    ctes = [f"""{r}_ver AS (SELECT soc2_name,
    round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 0) AS pct_{r}
  FROM fx_profiles_{r} WHERE country = {C1} AND onet_confidence >= 7 GROUP BY soc2_name)"""
            for r in ("base", "new")]
    return "WITH " + ",\n".join(ctes) + """
SELECT COALESCE(base_ver.soc2_name, new_ver.soc2_name, b.label) AS soc2_name,
       COALESCE(pct_base, 0) AS pct_base, COALESCE(pct_new, 0) AS pct_new,
       COALESCE(share_a, 0) AS share_a, COALESCE(share_b, 0) AS share_b
FROM base_ver FULL JOIN new_ver ON base_ver.soc2_name = new_ver.soc2_name
FULL JOIN fx_bench_share b ON b.label = COALESCE(base_ver.soc2_name, new_ver.soc2_name)"""


def _p6() -> str:
    p0, p1 = STINT_WINDOW
    ctes = []
    for r in ("base", "new"):
        ctes.append(f"""{r}_exp AS (SELECT person_id, naics2_code FROM fx_profiles_{r}
  WHERE company_id IS NOT NULL AND naics2_code IS NOT NULL AND country = {C1}
    AND start_date <= TIMESTAMP '{p0}' AND (end_date >= TIMESTAMP '{p1}' OR end_date IS NULL)),
{r}_perc AS (SELECT naics2_code, count(DISTINCT person_id) / ttl AS perc_{r}
  FROM {r}_exp, (SELECT count(DISTINCT person_id) AS ttl FROM {r}_exp)
  GROUP BY naics2_code, ttl)""")
    return "WITH " + ",\n".join(ctes) + """
SELECT bls_code, m.industry, round(avg(m.bls_pct), 10) AS perc_bls,
       round(sum(base_perc.perc_base), 10) AS perc_base, round(sum(new_perc.perc_new), 10) AS perc_new
FROM fx_bench_map m
LEFT JOIN new_perc ON new_perc.naics2_code = m.naics2_code
LEFT JOIN base_perc ON base_perc.naics2_code = m.naics2_code
GROUP BY bls_code, m.industry"""


# Field -> (base table, gate); degree_list is the list-valued one.
_MATRIX = {"soc2_name": ("profiles", "onet_confidence >= 7"), "onet_name": ("profiles", ""),
           "suboccupation": ("profiles", ""), "standard_title": ("profiles", ""), "naics2_name": ("profiles", ""),
           "company_name": ("profiles", ""), "degree_per_entry": ("education", ""),
           "degree_per_id": ("education", ""), "major_name": ("education", ""),
           "school_name": ("education", SCHOOL_GATE), "degree_list": ("education", ""),
           "state": ("persons", "location_confidence >= 89"), "county": ("persons", "location_confidence >= 89"),
           "city": ("persons", "location_confidence >= 89")}


def _matrix_long() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{f}' AS field, * FROM ({_p2(t) if f == 'degree_list' else _p1(f, g, t)})"
        for f, (t, g) in _MATRIX.items())


def _matrix_kpi() -> str:
    return "\nUNION ALL\n".join(
        "SELECT '{}' AS field, * FROM ({})".format(
            f, _p4("soc2_name <> 'Unclassified'" if f == "soc2_name" else f"{f} IS NOT NULL", g, t))
        for f, (t, g) in _MATRIX.items())


# ------------------------------------------------------------ postings job
def _norm(e: str) -> str:
    return f"upper(trim({e}))"


# Source registry of the oracle: table alias, id, date, country filter.
SRC = {
    "v1": ("fx_postings_v1 v1", "v1", "job_id", "post_date", f"v1.country = {US}"),
    "v2": ("fx_postings_v2 v2", "v2", "job_id", "post_date", f"v2.country = {US}"),
    "ext": ("fx_postings_ext ext", "ext", "id", "posted", ""),
}


def _where(*conds: str) -> str:
    c = [x for x in conds if x]
    return ("WHERE " + " AND ".join(c)) if c else ""


def _year_ge(alias: str, date: str, y: int) -> str:
    return f"year({alias}.{date}) >= {y}"


def _year_eq(alias: str, date: str, y: int) -> str:
    return f"year({alias}.{date}) = {y}"


def _kpi3(exprs: dict[str, str], froms: dict[str, str] | None = None, exclude: bool = False,
          extra: dict[str, str] | None = None) -> str:
    froms = froms or {}
    extra = extra or {}
    parts = []
    for s, (tbl, a, idc, dt, cty) in SRC.items():
        v = _norm(exprs[s])
        ex = f"{v} NOT LIKE '%UNCLASSIFIED%'" if exclude else ""
        ew = extra.get(s, "")
        parts.append(f"""SELECT '{s}' AS source,
  (SELECT count(DISTINCT {a}.{idc}) FROM {tbl} {_where(cty, _year_ge(a, dt, Y0), ew)}) AS total,
  (SELECT count(DISTINCT {a}.{idc}) FROM {froms.get(s, tbl)} {_where(cty, _year_ge(a, dt, Y0), f'{v} IS NOT NULL', ex, ew)}) AS covered""")
    return "\nUNION ALL\n".join(parts)


def _dist3(exprs: dict[str, str], froms: dict[str, str] | None = None, exclude: bool = False,
           extra: dict[str, str] | None = None, top_anchor: str | None = None, k: int = 25) -> str:
    froms = froms or {}
    extra = extra or {}
    ctes = []
    for s, (tbl, a, idc, dt, cty) in SRC.items():
        v = _norm(exprs[s])
        ex = f"{v} NOT LIKE '%UNCLASSIFIED%'" if exclude else ""
        ew = extra.get(s, "")
        lim = f" ORDER BY 2 DESC, 1 LIMIT {k}" if s == top_anchor else ""
        ctes.append(f"""{s}_ind AS (SELECT {v} AS field_value, count(DISTINCT {a}.{idc}) AS {s}_count
  FROM {froms.get(s, tbl)} {_where(cty, _year_eq(a, dt, YC), f'{v} IS NOT NULL', ex, ew)} GROUP BY 1{lim})""")
        ctes.append(f"""{s}_total AS (SELECT count(DISTINCT {a}.{idc}) AS total_{s} FROM {tbl}
  {_where(cty, _year_eq(a, dt, YC), ew)})""")
    names = list(SRC)
    if top_anchor:
        base = f"{top_anchor}_ind"
        src_list = f"(SELECT field_value FROM {base}) av"
    else:
        src_list = "(" + " UNION ".join(f"SELECT field_value FROM {s}_ind" for s in names) + ") av"
    sel = ["av.field_value"]
    for s in names:
        sel.append(f"COALESCE({s}_ind.{s}_count, 0) AS {s}_count")
        sel.append(f"CASE WHEN {s}_total.total_{s} > 0 THEN COALESCE({s}_ind.{s}_count, 0) / {s}_total.total_{s} ELSE 0 END AS {s}_frac")
    joins = " ".join(f"LEFT JOIN {s}_ind ON av.field_value IS NOT DISTINCT FROM {s}_ind.field_value" for s in names)
    cross = " ".join(f"CROSS JOIN {s}_total" for s in names)
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(sel)}\nFROM {src_list} {joins} {cross}"


_F_INDUSTRY = {"v1": "v1.naics2_name", "v2": "v2.naics2_name", "ext": "ext.naics2_name"}
_F_EMPLOYER = {"v1": "v1.company_name", "v2": "v2.company_name", "ext": "ext.company_name"}
_X_EMPLOYER = {"v1": "v1.naics4 != '5613'", "v2": "v2.naics4 != '5613'"}
_F_DEGREE = {
    "v1": "NULLIF(NULLIF(NULLIF(v1.min_degree, 'No Education Found'), 'None'), 'No Education Listed')",
    "v2": "NULLIF(NULLIF(NULLIF(v2.min_degree, 'No Education Found'), 'None'), 'No Education Listed')",
    "ext": """CASE WHEN upper(trim(ext.min_degree)) = 'HIGH SCHOOL OR GED' THEN 'HIGH SCHOOL/GED'
      WHEN upper(trim(ext.min_degree)) = 'PH.D. OR PROFESSIONAL DEGREE' THEN 'DOCTORATE DEGREE'
      ELSE ext.min_degree END"""}
_F_SOC2 = {"v1": "lu1.soc2_name", "v2": "lu2.soc2_name", "ext": "lu3.soc2_name"}
_FROM_SOC2 = {"v1": "fx_postings_v1 v1 JOIN fx_onet_lookup lu1 ON lu1.onet_code = v1.onet_code",
              "v2": "fx_postings_v2 v2 JOIN fx_onet_lookup lu2 ON lu2.onet_code = v2.onet_code",
              "ext": "fx_postings_ext ext JOIN fx_onet_lookup lu3 ON lu3.onet_code = ext.onet_code"}
_F_CITY = {"v1": "v1.city", "v2": "v2.city", "ext": "substr(ext.city_name, 1, length(ext.city_name) - 4)"}
_F_STATE = {"v1": "v1.state", "v2": "v2.state", "ext": "ext.state"}

POSTINGS = ["fx_postings_v1", "fx_postings_v2", "fx_postings_ext"]


_FIELDS = {
    "industry": dict(exprs=_F_INDUSTRY, exclude=True),
    "employer": dict(exprs=_F_EMPLOYER, exclude=True, extra=_X_EMPLOYER),
    "degree": dict(exprs=_F_DEGREE),
    "soc2": dict(exprs=_F_SOC2, froms=_FROM_SOC2, exclude=True),
    "city": dict(exprs=_F_CITY),
    "state": dict(exprs=_F_STATE),
    "onet_name": dict(exprs={s: f"{s}.onet_name" for s in ("v1", "v2", "ext")}, exclude=True),
    "msa": dict(exprs={s: f"{s}.msa" for s in ("v1", "v2", "ext")}),
    "title": dict(exprs={s: f"{s}.title" for s in ("v1", "v2", "ext")}, exclude=True),
}


def _dist_matrix() -> str:
    return "\nUNION ALL\n".join(f"SELECT '{f}' AS field, * FROM ({_dist3(**kw)})" for f, kw in _FIELDS.items())


def _kpi_matrix() -> str:
    return "\nUNION ALL\n".join(f"SELECT '{f}' AS field, * FROM ({_kpi3(**kw)})" for f, kw in _FIELDS.items())


def _totals_yearly() -> str:
    parts = []
    for s, (tbl, a, idc, dt, cty) in SRC.items():
        parts.append(f"""SELECT '{s}' AS source, CAST(year({a}.{dt}) AS INTEGER) AS yr, count(DISTINCT {a}.{idc}) AS cnt
FROM {tbl} {_where(cty, _year_ge(a, dt, Y0))} GROUP BY 2""")
    return "\nUNION ALL\n".join(parts)


def _spine_bounds() -> tuple[str, str]:
    d = dt.date.fromisoformat(AS_OF)
    last = dt.date(d.year, d.month, 1)
    y, m = last.year, last.month - 11
    while m <= 0:
        m += 12
        y -= 1
    return dt.date(y, m, 1).isoformat(), last.isoformat()


def _monthly(sources: dict[str, tuple[str, str, str, str, str]]) -> str:
    first, last = _spine_bounds()
    parts = []
    for s, (tbl, a, idc, dt, cond) in sources.items():
        parts.append(f"""SELECT '{s}' AS source, m.month_start, COALESCE(d.cnt, 0) AS cnt FROM months m
LEFT JOIN (SELECT CAST(date_trunc('month', {a}.{dt}) AS DATE) AS month_start, count(DISTINCT {a}.{idc}) AS cnt
  FROM {tbl} {_where(cond, f"{a}.{dt} >= TIMESTAMP '{first}'")} GROUP BY 1) d USING (month_start)""")
    return (f"WITH months AS (SELECT CAST(m AS DATE) AS month_start FROM generate_series("
            f"DATE '{first}', DATE '{last}', INTERVAL 1 MONTH) t(m))\n" + "\nUNION ALL\n".join(parts))


SRC4 = {
    "overlap_v1": ("fx_postings_v1 v1 JOIN fx_xwalk xw ON xw.release_id = v1.job_id", "v1", "job_id", "post_date",
                   f"v1.country = {US}"),
    "overlap_ext": ("fx_postings_ext ext JOIN fx_xwalk xw ON xw.ext_id = ext.id", "ext", "id", "posted", ""),
    "full_v1": ("fx_postings_v1 v1", "v1", "job_id", "post_date", f"v1.country = {US} AND year(v1.post_date) >= {Y0}"),
    "full_ext": ("fx_postings_ext ext", "ext", "id", "posted", f"year(ext.posted) >= {Y0}"),
}


def _overlap_yearly() -> str:
    parts = []
    for s, (tbl, a, idc, dt, cond) in SRC4.items():
        parts.append(f"""SELECT '{s}' AS source, CAST(year({a}.{dt}) AS INTEGER) AS yr, count(DISTINCT {a}.{idc}) AS cnt
FROM {tbl} {_where(cond)} GROUP BY 2""")
    return "\nUNION ALL\n".join(parts)


_H = "JOIN fx_naics_hierarchy h ON h.naics6 = v1.naics6"
_F4 = {"overlap_v1": ("h.naics2_name", f"fx_postings_v1 v1 JOIN fx_xwalk xw ON xw.release_id = v1.job_id {_H}"),
       "overlap_ext": ("ext.naics2_name", "fx_postings_ext ext JOIN fx_xwalk xw ON xw.ext_id = ext.id"),
       "full_v1": ("h.naics2_name", f"fx_postings_v1 v1 {_H}"),
       "full_ext": ("ext.naics2_name", "fx_postings_ext ext")}


# Four-source fields: (v1 expression, ext expression, join of v1, join of ext, exclude unclassified).
_FIELDS4 = {
    "industry": ("h.naics2_name", "ext.naics2_name", _H, "", True),
    "degree": ("""CASE WHEN upper(trim(v1.min_degree)) IN ('NO EDUCATION FOUND', 'NO EDUCATION LISTED')
      THEN 'NO EDUCATION LISTED' ELSE v1.min_degree END""", _F_DEGREE["ext"], "", "", False),
    "onet_name": ("v1.onet_name", "ext.onet_name", "", "", True),
    "soc2": ("lu.soc2_name", "lu.soc2_name", "JOIN fx_onet_lookup lu ON lu.onet_code = v1.onet_code",
             "JOIN fx_onet_lookup lu ON lu.onet_code = ext.onet_code", True),
    "city": ("v1.city", _F_CITY["ext"], "", "", False),
    "state": ("v1.state", "ext.state", "", "", False),
    "msa": ("v1.msa", "ext.msa", "", "", False),
    "title": ("v1.title", "ext.title", "", "", True),
}


def _overlap_matrix(one) -> str:
    parts = []
    for f, (e1, e2, j1, j2, exclude) in _FIELDS4.items():
        f4 = {s: ((e1, f"{tbl} {j1}") if a == "v1" else (e2, f"{tbl} {j2}")) for s, (tbl, a, *_) in SRC4.items()}
        parts.append(f"SELECT '{f}' AS field, * FROM ({one(f4, exclude)})")
    return "\nUNION ALL\n".join(parts)


def _overlap_kpi(f4: dict = _F4, exclude: bool = True) -> str:
    parts = []
    for s, (tbl, a, idc, dt, cond) in SRC4.items():
        e, frm = f4[s]
        v = _norm(e)
        ex = f"{v} NOT LIKE '%UNCLASSIFIED%'" if exclude else ""
        parts.append(f"""SELECT '{s}' AS source,
  (SELECT count(DISTINCT {a}.{idc}) FROM {tbl} {_where(cond)}) AS total,
  (SELECT count(DISTINCT {a}.{idc}) FROM {frm} {_where(cond, f'{v} IS NOT NULL', ex)}) AS covered""")
    return "\nUNION ALL\n".join(parts)


def _overlap_dist(f4: dict = _F4, exclude: bool = True) -> str:
    ctes = []
    for s, (tbl, a, idc, dt, cond) in SRC4.items():
        e, frm = f4[s]
        v = _norm(e)
        ex = f"{v} NOT LIKE '%UNCLASSIFIED%'" if exclude else ""
        ctes.append(f"""{s}_ind AS (SELECT {v} AS field_value, count(DISTINCT {a}.{idc}) AS {s}_count
  FROM {frm} {_where(cond, f'{v} IS NOT NULL', ex)} GROUP BY 1)""")
        ctes.append(f"""{s}_total AS (SELECT count(DISTINCT {a}.{idc}) AS total_{s} FROM {tbl} {_where(cond)})""")
    names = list(SRC4)
    sel = ["av.field_value"]
    for s in names:
        sel.append(f"COALESCE({s}_ind.{s}_count, 0) AS {s}_count")
        sel.append(f"CASE WHEN {s}_total.total_{s} > 0 THEN COALESCE({s}_ind.{s}_count, 0) / {s}_total.total_{s} ELSE 0 END AS {s}_frac")
    av = "(" + " UNION ".join(f"SELECT field_value FROM {s}_ind" for s in names) + ") av"
    joins = " ".join(f"LEFT JOIN {s}_ind ON av.field_value IS NOT DISTINCT FROM {s}_ind.field_value" for s in names)
    cross = " ".join(f"CROSS JOIN {s}_total" for s in names)
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(sel)} FROM {av} {joins} {cross}"


# ------------------------------------------------------------------ changes
def _pairs_where() -> str:
    return (f"v1.country = {US} AND year(v1.post_date) = {YX} "
            "AND v1.onet_code IS NOT NULL AND v2.onet_code IS NOT NULL")


def _changes() -> str:
    return f"""SELECT v1.onet_code AS old_code, v2.onet_code AS new_code, count(*) AS posting_count
FROM fx_postings_v1 v1 JOIN fx_postings_v2 v2 ON v2.job_id = v1.job_id
WHERE {_pairs_where()} AND v1.onet_code != v2.onet_code
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 30"""


def _agreement() -> str:
    return f"""SELECT CAST(sum(CASE WHEN v1.onet_code = v2.onet_code THEN 1 ELSE 0 END) AS BIGINT) AS same_code,
  CAST(sum(CASE WHEN v1.onet_code != v2.onet_code THEN 1 ELSE 0 END) AS BIGINT) AS different_code,
  count(*) AS total_matched,
  sum(CASE WHEN v1.onet_code = v2.onet_code THEN 1 ELSE 0 END) / count(*) * 100 AS pct_same,
  sum(CASE WHEN v1.onet_code != v2.onet_code THEN 1 ELSE 0 END) / count(*) * 100 AS pct_changed
FROM fx_postings_v1 v1 JOIN fx_postings_v2 v2 ON v2.job_id = v1.job_id
WHERE {_pairs_where()}"""


_CLS = f"""FROM fx_postings_v1 v1 JOIN fx_classifier occ ON occ.desc_id = v1.desc_id
LEFT JOIN fx_onet_lookup a ON a.onet_code = v1.onet_code LEFT JOIN fx_onet_lookup b ON b.onet_code = occ.top1_code
WHERE v1.country = {US} AND year(v1.post_date) = {YX} AND v1.onet_code IS NOT NULL AND occ.top1_code IS NOT NULL"""


def _classifier_changes() -> str:
    return f"""SELECT v1.onet_code AS old_code, a.onet_name AS old_name, occ.top1_code AS new_code,
  b.onet_name AS new_name, count(*) AS posting_count
{_CLS} AND v1.onet_code != occ.top1_code
GROUP BY 1, 2, 3, 4 ORDER BY 5 DESC, 1, 3 LIMIT 30"""


def _classifier_agreement() -> str:
    return f"""SELECT CAST(sum(CASE WHEN v1.onet_code = occ.top1_code THEN 1 ELSE 0 END) AS BIGINT) AS same_code,
  CAST(sum(CASE WHEN v1.onet_code != occ.top1_code THEN 1 ELSE 0 END) AS BIGINT) AS different_code,
  count(*) AS total_matched,
  sum(CASE WHEN v1.onet_code = occ.top1_code THEN 1 ELSE 0 END) / count(*) * 100 AS pct_same,
  sum(CASE WHEN v1.onet_code != occ.top1_code THEN 1 ELSE 0 END) / count(*) * 100 AS pct_changed
{_CLS}"""


def _changes_lookup() -> str:
    return f"""WITH ch AS ({_changes()})
SELECT ch.old_code, a.onet_name AS old_name, ch.new_code, b.onet_name AS new_name, ch.posting_count
FROM ch LEFT JOIN fx_onet_lookup a ON a.onet_code = ch.old_code
LEFT JOIN fx_onet_lookup b ON b.onet_code = ch.new_code"""


# ------------------------------------------------------------------- salary
YEARLY = """CASE WHEN lower(sal.salary_per) = 'year' THEN sal.parsed_salary_min
  WHEN lower(sal.salary_per) = 'hour' THEN sal.parsed_salary_min * 2000
  WHEN lower(sal.salary_per) = 'week' THEN sal.parsed_salary_min * 50
  WHEN lower(sal.salary_per) = 'day' THEN sal.parsed_salary_min * 260
  WHEN lower(sal.salary_per) = 'month' THEN sal.parsed_salary_min * 12
  {piece}ELSE sal.parsed_salary_min END"""
YEARLY_JOB = YEARLY.format(piece="WHEN lower(sal.salary_per) = 'piece' THEN NULL\n  ")
YEARLY_RAW = YEARLY.format(piece="")
SAL_OK = "sal.parsed_salary_min IS NOT NULL AND sal.parsed_salary_min > 0"


def _salary_stats() -> str:
    parts = []
    for s in ("v1", "v2"):
        parts.append(f"""SELECT '{s}' AS source, min(y) AS min_salary, max(y) AS max_salary,
  round(avg(y), 2) AS avg_salary, round(median(y), 2) AS median_salary,
  count(*) AS n_postings_with_salary, count(y) AS n_values
FROM (SELECT {YEARLY_JOB} AS y FROM fx_postings_{s} p JOIN fx_salary sal ON sal.desc_id = p.desc_id
      WHERE {SAL_OK} AND p.country = {US})""")
    return "\nUNION ALL\n".join(parts)


def _salary_stats_vendor() -> str:
    return f"""SELECT 'v1' AS source, min(y) AS min_salary, max(y) AS max_salary,
  round(avg(y), 2) AS avg_salary, round(median(y), 2) AS median_salary,
  count(*) AS n_postings_with_salary, count(y) AS n_values
FROM (SELECT {YEARLY_JOB} AS y FROM fx_postings_v1 p JOIN fx_salary sal ON sal.desc_id = p.desc_id
      WHERE {SAL_OK} AND p.country = {US})
UNION ALL
SELECT 'ext', min(salary_from), max(salary_from), round(avg(salary_from), 2),
  round(median(salary_from), 2), count(*), count(salary_from)
FROM fx_postings_ext WHERE salary_from IS NOT NULL AND salary_from > 0"""


def _salary_buckets() -> str:
    parts = []
    for s in ("v1", "v2"):
        parts.append(f"""SELECT '{s}' AS source,
  CASE WHEN y > 200000 THEN 210000 ELSE CAST(floor(y / 10000) * 10000 AS BIGINT) END AS salary_bucket,
  count(*) AS cnt
FROM (SELECT {YEARLY_JOB} AS y FROM fx_postings_{s} p JOIN fx_salary sal ON sal.desc_id = p.desc_id
      WHERE {SAL_OK} AND p.country = {US} AND year(p.post_date) = {YC})
WHERE y IS NOT NULL GROUP BY 1, 2""")
    return ("WITH b AS (" + "\nUNION ALL\n".join(parts) + """)
SELECT source, salary_bucket, cnt, cnt / sum(cnt) OVER (PARTITION BY source) * 100 AS pct FROM b""")


def _salary_by_group() -> str:
    parts = []
    for s in ("v1", "v2"):
        parts.append(f"""SELECT '{s}' AS source, lu.soc2_name AS soc2, round(median({YEARLY_JOB}), 2) AS median_salary,
  count(*) AS n_postings
FROM fx_postings_{s} p JOIN fx_onet_lookup lu ON lu.onet_code = p.onet_code
JOIN fx_salary sal ON sal.desc_id = p.desc_id
WHERE {SAL_OK} AND p.country = {US} AND lu.soc2_name IS NOT NULL AND year(p.post_date) = {YC}
GROUP BY 1, 2""")
    return "\nUNION ALL\n".join(parts)


_BUCKET = "CASE WHEN {y} > 200000 THEN 210000 ELSE CAST(floor({y} / 10000) * 10000 AS BIGINT) END"


def _salary_buckets_vendor() -> str:
    return f"""WITH e AS (SELECT {_BUCKET.format(y="salary_from")} AS salary_bucket, count(*) AS n FROM fx_postings_ext
  WHERE salary_from IS NOT NULL AND salary_from > 0 AND year(posted) = {YC} GROUP BY 1),
r AS (SELECT {_BUCKET.format(y="y")} AS salary_bucket, count(*) AS n
  FROM (SELECT {YEARLY_JOB} AS y FROM fx_postings_v1 p JOIN fx_salary sal ON sal.desc_id = p.desc_id
        WHERE {SAL_OK} AND p.country = {US} AND year(p.post_date) = {YC}) GROUP BY 1)
SELECT COALESCE(e.salary_bucket, r.salary_bucket) AS salary_bucket,
  COALESCE(e.n / (SELECT sum(n) FROM e) * 100, 0) AS ext_pct, COALESCE(r.n / (SELECT sum(n) FROM r) * 100, 0) AS v1_pct
FROM e FULL JOIN r ON e.salary_bucket IS NOT DISTINCT FROM r.salary_bucket"""


def _salary_median_vendor() -> str:
    return f"""SELECT 'ext' AS source, lu.soc2_name AS soc2, round(median(p.salary_from), 2) AS median_salary, count(*) AS n_postings
FROM fx_postings_ext p JOIN fx_onet_lookup lu ON lu.onet_code = p.onet_code
WHERE p.salary_from IS NOT NULL AND p.salary_from > 0 AND year(p.posted) = {YC} AND lu.soc2_name IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'v1', lu.soc2_name, round(median(s.y), 2), count(*)
FROM (SELECT p.onet_code, {YEARLY_JOB} AS y FROM fx_postings_v1 p JOIN fx_salary sal ON sal.desc_id = p.desc_id
      WHERE {SAL_OK} AND p.country = {US} AND year(p.post_date) = {YC}) s
JOIN fx_onet_lookup lu ON lu.onet_code = s.onet_code WHERE s.y IS NOT NULL AND s.y <= 500000 GROUP BY 2"""


def _salary_coverage_vendor() -> str:
    parts = []
    for code, table, extra in (("US", "fx_postings_ext", ""), ("UK", "fx_postings_ext_uk", ""),
                               ("HK", "fx_postings_ext_global", " AND country = 'Hong Kong'")):
        ok = "sum(CASE WHEN salary_from IS NOT NULL AND salary_from > 0 THEN 1 ELSE 0 END)"
        parts.append(f"""SELECT 'ext' AS source, '{code}' AS country, count(*) AS total_postings,
  CAST({ok} AS BIGINT) AS postings_with_salary, {ok} / count(*) * 100 AS pct_with_salary
FROM {table} WHERE year(posted) = {YC}{extra} HAVING count(*) > 0""")
    parts.append(_salary_coverage(("v1",)))
    return "\nUNION ALL\n".join(parts)


def _salary_coverage(sources: tuple = ("v1", "v2")) -> str:
    parts = []
    for s in sources:
        parts.append(f"""SELECT '{s}' AS source,
  CASE WHEN p.country = 'United States' THEN 'US' WHEN p.country = 'United Kingdom' THEN 'UK'
       WHEN p.country = 'Hong Kong' THEN 'HK' END AS country,
  count(*) AS total_postings,
  CAST(sum(CASE WHEN {SAL_OK} THEN 1 ELSE 0 END) AS BIGINT) AS postings_with_salary,
  sum(CASE WHEN {SAL_OK} THEN 1 ELSE 0 END) / count(*) * 100 AS pct_with_salary
FROM fx_postings_{s} p LEFT JOIN fx_salary sal ON sal.desc_id = p.desc_id
WHERE p.country IN ('United States', 'United Kingdom', 'Hong Kong') AND year(p.post_date) = {YC}
GROUP BY 1, 2""")
    return "\nUNION ALL\n".join(parts)


def _outliers(desc: bool) -> str:
    d = "DESC" if desc else "ASC"
    return f"""SELECT sal.desc_id, sal.parsed_salary_min, sal.salary_per, {YEARLY_RAW} AS yearly_salary_min
FROM fx_postings_v1 p JOIN fx_salary sal ON sal.desc_id = p.desc_id
WHERE {SAL_OK} AND p.country = {US}
ORDER BY yearly_salary_min {d}, sal.desc_id ASC, sal.salary_per ASC NULLS LAST, sal.parsed_salary_min ASC
LIMIT 20"""


# --------------------------------------------------------------- benchmarks
def _series_mean() -> str:
    return f"""SELECT m.state, CAST(round_even(avg(TRY_CAST(json_extract_string(payload, '$.k') AS DOUBLE) * 1000), 0) AS BIGINT) AS bench_count
FROM fx_series_json s JOIN {_vals(STATES, 'code', 'state')} ON m.code = substr(s.series_id, 10, 2)
WHERE s.year = '2024' AND s.period <> 'M13' AND TRY_CAST(json_extract_string(payload, '$.k') AS DOUBLE) IS NOT NULL
GROUP BY s.series_id, m.state"""


def _wide_unpivot() -> str:
    return """SELECT make_date(CAST(TRY_CAST(year_label AS DOUBLE) AS INTEGER),
      CASE month_name WHEN 'Jan' THEN 1 WHEN 'Feb' THEN 2 WHEN 'Mar' THEN 3 WHEN 'Apr' THEN 4 WHEN 'May' THEN 5 WHEN 'Jun' THEN 6 WHEN 'Jul' THEN 7 WHEN 'Aug' THEN 8 WHEN 'Sep' THEN 9 WHEN 'Oct' THEN 10 WHEN 'Nov' THEN 11 WHEN 'Dec' THEN 12 END, 1) AS month,
  CAST(trunc(value * 1000) AS BIGINT) AS posting_count
FROM (UNPIVOT fx_bench_wide ON Jan, Feb, Mar, Apr, May, Jun, Jul, Aug, Sep, Oct, Nov, Dec INTO NAME month_name VALUE value)
WHERE TRY_CAST(year_label AS DOUBLE) IS NOT NULL AND value IS NOT NULL"""


def _coded(level: str = "major") -> str:
    return f"""SELECT occ_code, occ_title, CAST(trunc(TRY_CAST(tot_emp AS DOUBLE)) AS BIGINT) AS tot_emp
FROM fx_bench_occ WHERE o_group = '{level}' AND TRY_CAST(tot_emp AS DOUBLE) IS NOT NULL"""


def _r1(n: str, d: str, scale: int = 1) -> str:
    """Percent rounded to ``scale`` decimals, rounding the scaled ratio."""
    f = 100 * 10 ** scale
    return f"round(CAST({n} AS DOUBLE) * {f} / {d}, 0) / {10 ** scale}"


def _state_share() -> str:
    ctes = [f"bench AS (SELECT occ_title AS state, tot_emp AS bench_count FROM ({_coded()}))",
            "bench_total AS (SELECT sum(bench_count) AS total FROM bench)"]
    for s, (tbl, a, idc, dt, cty) in SRC.items():
        ctes.append(f"""{s}_state AS (SELECT upper(trim({a}.state)) AS state, count(DISTINCT {a}.{idc}) AS n
  FROM {tbl} {_where(f'{a}.state IS NOT NULL', cty, _year_eq(a, dt, YX))} GROUP BY 1)""")
        ctes.append(f"{s}_t AS (SELECT sum(n) AS total FROM {s}_state)")
    sel = ["b.state", "b.bench_count",
           f"CASE WHEN bt.total > 0 THEN {_r1('b.bench_count', 'bt.total')} ELSE 0 END AS bench_pct"]
    joins, cross = [], ["CROSS JOIN bench_total bt"]
    for s in SRC:
        sel.append(f"COALESCE({s}.n, 0) AS {s}_count")
        sel.append(f"CASE WHEN {s}t.total > 0 THEN {_r1(f'COALESCE({s}.n, 0)', f'{s}t.total')} ELSE 0 END AS {s}_pct")
        joins.append(f"LEFT JOIN {s}_state {s} ON b.state = {s}.state")
        cross.append(f"CROSS JOIN {s}_t {s}t")
    return ("WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(sel)} FROM bench b "
            + " ".join(joins) + " " + " ".join(cross))


def _state_share_rows() -> str:
    ctes = [f"bench AS (SELECT occ_title AS state, tot_emp AS bench_count FROM ({_coded()}))"]
    for s, (tbl, a, idc, dt, cty) in SRC.items():
        ctes.append(f"""{s}_state AS (SELECT upper(trim({a}.state)) AS state, count(*) AS n
  FROM {tbl} {_where(f'{a}.state IS NOT NULL', cty, _year_eq(a, dt, YX))} GROUP BY 1)""")
    j = ("j AS (SELECT b.state, b.bench_count, " + ", ".join(f"{s}.n AS {s}_count" for s in SRC)
         + " FROM bench b " + " ".join(f"LEFT JOIN {s}_state {s} ON b.state = {s}.state" for s in SRC) + ")")
    ctes.append(j)

    def pct(c: str) -> str:
        return f"round_even(CAST({c} AS DOUBLE) * 1000 / sum({c}) OVER (), 0) / 10"
    sel = ["state", "bench_count", f"CASE WHEN sum(bench_count) OVER () > 0 THEN {pct('bench_count')} ELSE 0 END AS bench_pct"]
    for s in SRC:
        sel += [f"{s}_count", f"{pct(f'{s}_count')} AS {s}_pct"]
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(sel)} FROM j"


def _share_cmp(label: str, parts: dict[str, str], bench: str | None, bench_name: str) -> str:
    """Shares of classified totals per source plus an optional benchmark,
    over the union of labels (``parts``: source -> SELECT label, n)."""
    ctes = []
    names = ([bench_name] if bench else []) + list(parts)
    if bench:
        ctes.append(f"{bench_name}_c AS ({bench})")
    for s, q in parts.items():
        ctes.append(f"{s}_c AS ({q})")
    for s in names:
        ctes.append(f"{s}_t AS (SELECT sum(n) AS total FROM {s}_c)")
    av = "(" + " UNION ".join(f"SELECT label FROM {s}_c WHERE label IS NOT NULL" for s in names) + ") av"
    sel = [f"av.label AS {label}"]
    for s in names:
        cnt = f"COALESCE({s}.n, 0)"
        if s != bench_name:
            cnt = f"CAST({cnt} AS BIGINT)"
        else:
            cnt = f"CAST({cnt} AS DOUBLE)"
        sel.append(f"{cnt} AS {s}_count")
        sel.append(f"round(CASE WHEN {s}t.total > 0 THEN COALESCE({s}.n, 0) / {s}t.total ELSE 0 END, 10) AS {s}_pct")
    joins = " ".join(f"LEFT JOIN {s}_c {s} ON av.label = {s}.label" for s in names)
    cross = " ".join(f"CROSS JOIN {s}_t {s}t" for s in names)
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(sel)} FROM {av} {joins} {cross}"


def _sector_share() -> str:
    sec_v1 = _case(_norm("h.naics2_name"), SECTOR_MAP)
    sec_ext = _case(_norm("ext.naics2_name"), SECTOR_MAP)
    code = _case("j.industry_code", CODE_SECTOR_MAP)
    keys = ", ".join(f"'{k}'" for k in CODE_SECTOR_MAP)
    bench = (f"SELECT {code} AS label, round(sum(j.job_openings), 6) AS n FROM fx_openings_industry j "
             f"WHERE j.state_text = 'Total US' AND j.industry_code IN ({keys}) AND j.year = '{YX}' GROUP BY 1")
    parts = {
        "full_v1": (f"SELECT {sec_v1} AS label, count(DISTINCT v1.job_id) AS n FROM fx_postings_v1 v1 {_H} "
                    f"WHERE v1.country = {US} AND year(v1.post_date) >= {Y0} AND year(v1.post_date) = {YX} "
                    f"AND {sec_v1} IS NOT NULL GROUP BY 1"),
        "full_ext": (f"SELECT {sec_ext} AS label, count(DISTINCT ext.id) AS n FROM fx_postings_ext ext "
                     f"WHERE year(ext.posted) >= {Y0} AND year(ext.posted) = {YX} AND {sec_ext} IS NOT NULL GROUP BY 1"),
    }
    return _share_cmp("sector", parts, bench, "benchmark")


def _sector_share_rows() -> str:
    def counted(value: str, rest: str) -> str:
        return (f"SELECT * FROM (SELECT {_case(_norm(value), SECTOR_MAP)} AS label, count(*) AS n {rest} GROUP BY 1) "
                "WHERE label IS NOT NULL")
    parts = {
        "ext": counted("ext.naics2_name", f"FROM fx_postings_ext ext WHERE year(ext.posted) = {YX}"),
        "v1": counted("v1.naics2_name", f"FROM fx_postings_v1 v1 WHERE v1.country = {US} AND year(v1.post_date) = {YX}"),
        "v2": counted("h.naics2_name", f"""FROM fx_postings_v2 v2 LEFT JOIN fx_imputed i ON i.job_id = v2.job_id
LEFT JOIN fx_employers e ON COALESCE(i.imputed_key, v2.naics6) = e.employer_key
JOIN fx_naics_hierarchy h ON h.naics6 = e.naics6 WHERE v2.country = {US} AND year(v2.post_date) = {YX}""")}
    keys = ", ".join(f"'{k}'" for k in CODE_SECTOR_MAP)
    bench = f"""SELECT label, round(sum(n), 6) AS n FROM (
  SELECT {_case("j.industry_code", CODE_SECTOR_MAP)} AS label, j.job_openings AS n FROM fx_openings_industry j
  WHERE j.state_text = 'Total US' AND j.industry_code IN ({keys}) AND j.year = '{YX}') GROUP BY 1"""
    return _share_cmp("sector", parts, bench, "benchmark")


def _group_share() -> str:
    bench = f"SELECT upper(trim(occ_title)) AS label, CAST(tot_emp AS DOUBLE) AS n FROM ({_coded()})"
    parts = {
        "full_v1": (f"SELECT upper(trim(lu.soc2_name)) AS label, count(DISTINCT v1.job_id) AS n FROM fx_postings_v1 v1 "
                    f"JOIN fx_onet_lookup lu ON lu.onet_code = v1.onet_code "
                    f"WHERE v1.country = {US} AND year(v1.post_date) >= {Y0} AND lu.soc2_name IS NOT NULL GROUP BY 1"),
        "full_ext": (f"SELECT upper(trim(lu.soc2_name)) AS label, count(DISTINCT ext.id) AS n FROM fx_postings_ext ext "
                     f"JOIN fx_onet_lookup lu ON lu.onet_code = ext.onet_code "
                     f"WHERE year(ext.posted) >= {Y0} AND lu.soc2_name IS NOT NULL GROUP BY 1"),
    }
    return _share_cmp("soc2_name", parts, bench, "employment")


def _group_share_rows() -> str:
    parts = {
        "ext": f"""SELECT lu.soc2_name AS label, count(*) AS n FROM fx_postings_ext ext
JOIN fx_onet_lookup lu ON lu.onet_code = ext.onet_code WHERE lu.soc2_name IS NOT NULL AND year(ext.posted) = {YC} GROUP BY 1""",
        "v1": f"""SELECT lu.soc2_name AS label, count(*) AS n FROM fx_postings_v1 v1
JOIN fx_onet_lookup lu ON lu.onet_code = v1.onet_code
WHERE lu.soc2_name IS NOT NULL AND v1.country = {US} AND year(v1.post_date) = {YC} GROUP BY 1""",
        "v2": f"""SELECT lu.soc2_name AS label, count(*) AS n FROM fx_classifier occ
JOIN fx_postings_v2 p ON p.desc_id = occ.desc_id JOIN fx_onet_lookup lu ON lu.onet_code = occ.top1_code
WHERE occ.top1_code IS NOT NULL AND year(p.post_date) = {YC} GROUP BY 1"""}
    return _share_cmp("soc2_name", parts, None, "")


def _truncated() -> str:
    parts = {
        "v1": (f"SELECT left(v1.onet_code, 7) AS label, count(*) AS n FROM fx_postings_v1 v1 "
               f"WHERE v1.onet_code IS NOT NULL AND v1.country = {US} AND year(v1.post_date) = {YC} GROUP BY 1"),
        "v2": (f"SELECT left(occ.top1_code, 7) AS label, count(*) AS n FROM fx_classifier occ "
               f"JOIN fx_postings_v2 p ON p.desc_id = occ.desc_id "
               f"WHERE occ.top1_code IS NOT NULL AND year(p.post_date) = {YC} GROUP BY 1"),
        "ext": (f"SELECT left(lu.onet_code, 7) AS label, count(*) AS n FROM fx_postings_ext ext "
                f"JOIN fx_onet_lookup lu ON upper(trim(ext.onet_code)) = upper(trim(lu.onet_name)) "
                f"WHERE ext.onet_code IS NOT NULL AND year(ext.posted) = {YC} GROUP BY 1"),
    }
    bench = f"SELECT occ_code AS label, sum(tot_emp) AS n FROM ({_coded('detailed')}) GROUP BY 1"
    return _share_cmp("code", parts, bench, "employment")


def _rollup() -> str:
    d = _dist3(_F_INDUSTRY, exclude=True)
    parts = []
    for s in SRC:
        parts.append(f"SELECT '{s}' AS source, field_value, {s}_count AS n FROM d WHERE {s}_count > 0")
    return f"""WITH d AS ({d}),
l AS ({' UNION ALL '.join(parts)}),
m AS (SELECT source, {_case('field_value', SECTOR_MAP)} AS sector, n FROM l),
a AS (SELECT source, sector, CAST(sum(n) AS BIGINT) AS n FROM m WHERE sector IS NOT NULL GROUP BY 1, 2)
SELECT source, sector, n, n / sum(n) OVER (PARTITION BY source) * 100 AS pct FROM a"""


def _imputed() -> str:
    return f"""WITH c AS (SELECT h.naics2_name, count(*) AS posting_count
FROM fx_postings_v2 posts
LEFT JOIN fx_imputed miss ON posts.job_id = miss.job_id
LEFT JOIN fx_employers emps ON COALESCE(miss.imputed_key, posts.naics6) = emps.employer_key
JOIN fx_naics_hierarchy h ON h.naics6 = emps.naics6
WHERE emps.naics6 IS NOT NULL AND posts.country = {US} AND year(posts.post_date) = {YC}
GROUP BY 1)
SELECT naics2_name, posting_count, posting_count / sum(posting_count) OVER () * 100 AS pct FROM c"""


def _field_cov() -> str:
    parts = [("ext", "occupation", "fx_postings_ext", "onet_name", ""),
             ("classifier", "occupation", "fx_classifier", "top1_code", ""),
             ("ext", "industry", "fx_postings_ext", "naics2_name", f"WHERE year(posted) = {YX}")]
    parts += [(s, "industry", f"fx_postings_{s}", "naics2_name", f"WHERE country = {US} AND year(post_date) = {YX}")
              for s in ("v1", "v2")]
    return "\nUNION ALL\n".join(f"""SELECT '{s}' AS source, '{f}' AS field, count(*) AS total_rows,
  CAST(COALESCE(sum(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS with_value,
  sum(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END) / NULLIF(count(*), 0) * 100 AS pct_with_value
FROM {t} {w}""" for s, f, t, c, w in parts)


# --------------------------------------------------------- stats and views
def _loglog() -> str:
    return f"""WITH s AS ({_state_share()})
SELECT count(*) AS n,
  CASE WHEN count(*) >= 2 THEN round(pow(corr(log10(bench_pct), log10(v1_pct)), 2), 6) END AS r2
FROM s WHERE bench_pct > 0 AND v1_pct > 0"""


def _top_pp() -> str:
    return f"""WITH s AS ({_sector_share()})
SELECT sector, full_v1_pct * 100 AS a_pct, benchmark_pct * 100 AS b_pct,
  (full_v1_pct - benchmark_pct) * 100 AS pp_diff
FROM s ORDER BY abs(pp_diff) DESC, sector ASC NULLS LAST LIMIT 25"""


def _agreement_stats(medians: str, a: str, b: str) -> str:
    return f"""WITH g AS ({medians}),
w AS (SELECT soc2, max(CASE WHEN source = '{a}' THEN median_salary END) AS a,
             max(CASE WHEN source = '{b}' THEN median_salary END) AS b FROM g GROUP BY soc2),
f AS (SELECT a, b, abs(a - b) AS abs_diff, (a - b) / a * 100 AS pct_diff FROM w
      WHERE NOT COALESCE(regexp_matches(lower(soc2), 'military|unclassified'), false) AND a > 0 AND b > 0)
SELECT count(*) AS n, round(corr(a, b), 6) AS pearson_r, round(regr_slope(b, a), 6) AS slope,
  round(regr_intercept(b, a), 4) AS intercept, round(avg(abs_diff), 4) AS mean_abs_diff,
  round(median(abs_diff), 4) AS median_abs_diff, round(avg(pct_diff), 4) AS mean_pct_diff,
  round(median(pct_diff), 4) AS median_pct_diff FROM f"""


def _top_share_within() -> str:
    return f"""WITH c AS ({_p1('soc2_name', 'onet_confidence >= 7')}),
t AS (SELECT country, sum(cnt_base) AS tb, sum(cnt_new) AS tn FROM c GROUP BY country),
r AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY cnt_new DESC, field_value ASC NULLS LAST) AS rn FROM c),
k AS (SELECT * FROM r WHERE rn <= 25)
SELECT k.country, field_value, cnt_base, cnt_new,
  cnt_base / NULLIF(sum(cnt_base) OVER (PARTITION BY k.country), 0) AS share_within_top_base,
  cnt_base / NULLIF(t.tb, 0) AS share_of_total_base,
  cnt_new / NULLIF(sum(cnt_new) OVER (PARTITION BY k.country), 0) AS share_within_top_new,
  cnt_new / NULLIF(t.tn, 0) AS share_of_total_new
FROM k JOIN t ON k.country = t.country"""


def _relative_change() -> str:
    return f"""WITH c AS ({_p1('soc2_name', 'onet_confidence >= 7')}),
d AS (SELECT country, field_value, cnt_base, cnt_new,
        CAST((cnt_new - cnt_base) * 100 AS DOUBLE) / NULLIF(cnt_base, 0) AS pct_change FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY abs(pct_change) DESC, field_value ASC NULLS LAST) AS rn
      FROM d WHERE pct_change IS NOT NULL)
SELECT country, field_value, cnt_base, cnt_new, pct_change FROM r WHERE rn <= 20"""


def _pp_pairs() -> str:
    pairs = [("v1", "v2"), ("v1", "ext"), ("v2", "ext")]
    parts = [f"""SELECT field_value, '{a}-{b}' AS pair, {a}_frac * 100 AS a_pct, {b}_frac * 100 AS b_pct,
  ({a}_frac - {b}_frac) * 100 AS pp_diff FROM d""" for a, b in pairs]
    return f"""WITH d AS ({_dist3(_F_INDUSTRY, exclude=True)}),
l AS ({' UNION ALL '.join(parts)}),
r AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY abs(pp_diff) DESC, field_value ASC NULLS LAST) AS rn FROM l)
SELECT field_value, pair, a_pct, b_pct, pp_diff FROM r WHERE rn <= 15"""


LADDER = ["SMALL", "MEDIUM", "STANDARD"]


def _long_view() -> str:
    lad = ", ".join(f"'{x}'" for x in LADDER)
    return f"""WITH c AS ({_p3()}),
l AS (SELECT COALESCE(CAST(field_value AS VARCHAR), '<NULL>') AS field_value,
        CASE WHEN list_position([{lad}], COALESCE(CAST(field_value AS VARCHAR), '<NULL>')) > 0
             THEN list_position([{lad}], COALESCE(CAST(field_value AS VARCHAR), '<NULL>'))
             ELSE {len(LADDER) + 1} END AS sort_rank,
        cnt_base, cnt_new, cnt_benchmark FROM c)
SELECT field_value, 'Base release' AS version, cnt_base AS value, CAST(sort_rank AS BIGINT) AS sort_rank FROM l
UNION ALL SELECT field_value, 'New release', cnt_new, CAST(sort_rank AS BIGINT) FROM l
UNION ALL SELECT field_value, 'Benchmark', cnt_benchmark, CAST(sort_rank AS BIGINT) FROM l"""


def _kpi_cards() -> str:
    return f"""WITH k AS ({_kpi3(_F_INDUSTRY, exclude=True)})
SELECT source, total, covered, CASE WHEN total > 0 THEN {_r1('covered', 'total')} END AS pct_covered FROM k"""


def oracle_sql() -> dict[str, str]:
    P = PROFILES
    P3 = [*P, "fx_education_base", "fx_education_new", "fx_persons_base", "fx_persons_new"]
    q = {
        "value_counts_two_releases": _with(P, _p1("soc2_name", "onet_confidence >= 7")),
        "value_counts_list_field": _with(P, _p2()),
        "value_counts_with_benchmark": _with(P + ["fx_bench_counts"], _p3()),
        "coverage_two_releases": _with(P, _p4("soc2_name <> 'Unclassified'", "onet_confidence >= 7")),
        "coverage_country_gate": _with(P3[2:4], _p4("school_name IS NOT NULL", SCHOOL_GATE, "education")),
        "occupation_share_benchmark": _with(P + ["fx_bench_share"], _p5()),
        "industry_share_stints": _with(P + ["fx_bench_map"], _p6()),
        "profile_matrix_long": _with(P3, _matrix_long()),
        "profile_matrix_kpi": _with(P3, _matrix_kpi()),
        "totals_yearly": _with(POSTINGS, _totals_yearly()),
        "totals_monthly_spine": _with(POSTINGS, _monthly(SRC)),
        "coverage_three_sources": _with(POSTINGS, _kpi3(_F_INDUSTRY, exclude=True)),
        "postings_field_matrix": _with(POSTINGS + ["fx_onet_lookup"], _dist_matrix()),
        "postings_kpi_matrix": _with(POSTINGS + ["fx_onet_lookup"], _kpi_matrix()),
        "coverage_extra_filter": _with(POSTINGS, _kpi3(_F_EMPLOYER, exclude=True, extra=_X_EMPLOYER)),
        "distribution_three_sources": _with(POSTINGS, _dist3(_F_INDUSTRY, exclude=True)),
        "distribution_recode": _with(POSTINGS, _dist3(_F_DEGREE)),
        "distribution_lookup_join": _with(POSTINGS + ["fx_onet_lookup"],
                                          _dist3(_F_SOC2, _FROM_SOC2, exclude=True)),
        "distribution_city_trim": _with(POSTINGS, _dist3(_F_CITY)),
        "distribution_top_anchor": _with(POSTINGS, _dist3(_F_EMPLOYER, exclude=True, extra=_X_EMPLOYER,
                                                          top_anchor="ext")),
        "code_changes_top": _with(POSTINGS[:2], _changes()),
        "code_agreement": _with(POSTINGS[:2], _agreement()),
        "code_changes_lookup": _with(POSTINGS[:2] + ["fx_onet_lookup"], _changes_lookup()),
        "overlap_totals_yearly": _with(POSTINGS + ["fx_xwalk"], _overlap_yearly()),
        "overlap_totals_monthly": _with(POSTINGS + ["fx_xwalk"], _monthly(SRC4)),
        "overlap_coverage": _with(POSTINGS + ["fx_xwalk", "fx_naics_hierarchy"], _overlap_kpi()),
        "overlap_distribution": _with(POSTINGS + ["fx_xwalk", "fx_naics_hierarchy"], _overlap_dist()),
        "overlap_field_matrix": _with(POSTINGS + ["fx_xwalk", "fx_naics_hierarchy", "fx_onet_lookup"],
                                      _overlap_matrix(_overlap_dist)),
        "overlap_kpi_matrix": _with(POSTINGS + ["fx_xwalk", "fx_naics_hierarchy", "fx_onet_lookup"],
                                    _overlap_matrix(_overlap_kpi)),
        "salary_stats": _with(POSTINGS[:2] + ["fx_salary"], _salary_stats()),
        "salary_buckets": _with(POSTINGS[:2] + ["fx_salary"], _salary_buckets()),
        "salary_stats_with_vendor": _with(POSTINGS + ["fx_salary"], _salary_stats_vendor()),
        "salary_median_by_group": _with(POSTINGS[:2] + ["fx_salary", "fx_onet_lookup"], _salary_by_group()),
        "salary_coverage": _with(POSTINGS[:2] + ["fx_salary"], _salary_coverage()),
        "salary_outliers_high": _with(["fx_postings_v1", "fx_salary"], _outliers(True)),
        "salary_outliers_low": _with(["fx_postings_v1", "fx_salary"], _outliers(False)),
        "series_json_mean": _with(["fx_series_json"], _series_mean()),
        "state_share_benchmark": _with(POSTINGS + ["fx_bench_occ"], _state_share()),
        "state_share_rows_variant": _with(POSTINGS + ["fx_bench_occ"], _state_share_rows()),
        "wide_month_unpivot": _with(["fx_bench_wide"], _wide_unpivot()),
        "coded_benchmark_load": _with(["fx_bench_occ"], _coded()),
        "sector_share_benchmark": _with(POSTINGS + ["fx_naics_hierarchy", "fx_openings_industry"],
                                        _sector_share()),
        "sector_share_rows": _with(POSTINGS + ["fx_imputed", "fx_employers", "fx_naics_hierarchy",
                                               "fx_openings_industry"], _sector_share_rows()),
        "sector_rollup_map": _with(POSTINGS, _rollup()),
        "group_share_vs_employment": _with(POSTINGS + ["fx_onet_lookup", "fx_bench_occ"], _group_share()),
        "truncated_code_share": _with(POSTINGS + ["fx_classifier", "fx_onet_lookup", "fx_bench_occ"], _truncated()),
        "loglog_r2": _with(POSTINGS + ["fx_bench_occ"], _loglog()),
        "top_pp_diff": _with(POSTINGS + ["fx_naics_hierarchy", "fx_openings_industry"], _top_pp()),
        "agreement_stats": _with(POSTINGS[:2] + ["fx_salary", "fx_onet_lookup"], _agreement_stats(_salary_by_group(), "v1", "v2")),
        "agreement_stats_with_vendor": _with(POSTINGS + ["fx_salary", "fx_onet_lookup"],
                                             _agreement_stats(_salary_median_vendor(), "ext", "v1")),
        "salary_buckets_with_vendor": _with(POSTINGS + ["fx_salary"], _salary_buckets_vendor()),
        "salary_median_with_vendor": _with(POSTINGS + ["fx_salary", "fx_onet_lookup"], _salary_median_vendor()),
        "salary_coverage_with_vendor": _with(POSTINGS + ["fx_postings_ext_uk", "fx_postings_ext_global", "fx_salary"],
                                             _salary_coverage_vendor()),
        "classifier_changes": _with(POSTINGS[:1] + ["fx_classifier", "fx_onet_lookup"], _classifier_changes()),
        "classifier_agreement": _with(POSTINGS[:1] + ["fx_classifier", "fx_onet_lookup"], _classifier_agreement()),
        "group_share_rows": _with(POSTINGS + ["fx_classifier", "fx_onet_lookup"], _group_share_rows()),
        "loglog_r2_employment": _with(POSTINGS + ["fx_classifier", "fx_onet_lookup", "fx_bench_occ"], f"""
SELECT count(*) AS n, round(power(corr(log10(employment_pct), log10(v2_pct)), 2), 6) AS r2
FROM ({_truncated()}) WHERE employment_pct > 0 AND v2_pct > 0"""),
        "top_pp_diff_employment": _with(POSTINGS + ["fx_classifier", "fx_onet_lookup", "fx_bench_occ"], f"""
SELECT code, v2_pct * 100 AS a_pct, employment_pct * 100 AS b_pct, (v2_pct - employment_pct) * 100 AS pp_diff
FROM ({_truncated()}) ORDER BY abs((v2_pct - employment_pct) * 100) DESC, code NULLS LAST LIMIT 25"""),
        "field_coverage_by_source": _with(POSTINGS + ["fx_classifier"], _field_cov()),
        "top_values_share_within": _with(P, _top_share_within()),
        "relative_change_top": _with(P, _relative_change()),
        "pp_diff_pairs": _with(POSTINGS, _pp_pairs()),
        "long_view_ordered": _with(P + ["fx_bench_counts"], _long_view()),
        "kpi_cards": _with(POSTINGS, _kpi_cards()),
        "imputed_key_join": _with(["fx_postings_v2", "fx_imputed", "fx_employers", "fx_naics_hierarchy"],
                                  _imputed()),
    }
    q["monthly_benchmark_long"] = _with(POSTINGS + ["fx_bench_wide"], _monthly_bench())
    q["monthly_benchmark_wide"] = _with(POSTINGS + ["fx_bench_wide"], f"""WITH l AS ({_monthly_bench()})
SELECT month_start,
  max(CASE WHEN source = 'benchmark' THEN cnt END) AS benchmark,
  max(CASE WHEN source = 'full_v1' THEN cnt END) AS full_v1,
  max(CASE WHEN source = 'full_ext' THEN cnt END) AS full_ext
FROM l GROUP BY month_start""")
    q["long_view_by_count"] = f"""WITH c AS ({q["value_counts_two_releases"]})
SELECT field_value, 'Base release' AS version, CAST(cnt_base AS BIGINT) AS value, CAST(-cnt_new AS BIGINT) AS sort_rank FROM c
UNION ALL SELECT field_value, 'New release', CAST(cnt_new AS BIGINT), CAST(-cnt_new AS BIGINT) FROM c"""
    chain = """every AS (SELECT 'r1' AS release, country, state, min_degree FROM fx_postings_v1
UNION ALL SELECT 'r2', country, state, min_degree FROM fx_postings_v2
UNION ALL SELECT 'r10', 'United States', state, min_degree FROM fx_postings_ext)"""
    counts = ", ".join(f"count(*) FILTER (release = '{r}') AS cnt_{r}" for r in ("r1", "r2", "r10"))
    q["release_chain_counts"] = _with(POSTINGS, f"""WITH {chain} SELECT country, state AS field_value, {counts}
FROM every WHERE state IS NOT NULL AND lower(state) NOT LIKE '%unclassified%' GROUP BY country, state""")
    q["release_chain_incremental"] = _with(POSTINGS, f"""WITH {chain}, l AS (SELECT release, country, 'state' AS field, state AS field_value FROM every
UNION ALL SELECT release, country, 'min_degree', min_degree FROM every)
SELECT field, country, field_value, {counts}, CAST(1 AS BIGINT) AS releases_read
FROM l WHERE field_value IS NOT NULL AND lower(field_value) NOT LIKE '%unclassified%' GROUP BY field, country, field_value""")
    q["ordered_distribution"] = f"""WITH d AS (SELECT field_value, nullif(ext_count, 0) AS ext_count, nullif(v1_count, 0) AS v1_count
FROM ({_with(POSTINGS, _dist3(_F_EMPLOYER, exclude=True, extra=_X_EMPLOYER))}))
SELECT *, row_number() OVER (ORDER BY ext_count DESC NULLS LAST, v1_count DESC NULLS LAST, field_value NULLS LAST) AS position FROM d"""
    q["ordered_totals"] = f"""SELECT *, row_number() OVER (ORDER BY source, yr) AS position FROM ({q["totals_yearly"]})"""
    q["label_shares"] = _with(POSTINGS, f"""WITH l AS (SELECT 'v1' AS side, naics2_name AS spelling FROM fx_postings_v1 WHERE country = {US} AND year(post_date) = {YC}
UNION ALL SELECT 'v2', naics2_name FROM fx_postings_v2 WHERE country = {US} AND year(post_date) = {YC}
UNION ALL SELECT 'ext', upper(left(naics2_name, 1)) || lower(substr(naics2_name, 2)) FROM fx_postings_ext WHERE year(posted) = {YC}),
s AS (SELECT side, lower(trim(spelling)) AS key, spelling, count(*) AS n FROM l WHERE spelling IS NOT NULL GROUP BY ALL),
best AS (SELECT side, key, spelling FROM s QUALIFY row_number() OVER (PARTITION BY side, key ORDER BY n DESC, spelling) = 1),
t AS (SELECT side, key, CAST(sum(n) AS DOUBLE) AS n, sum(n) / sum(sum(n)) OVER (PARTITION BY side) AS frac FROM s GROUP BY side, key)
SELECT k.key, coalesce(v1.spelling, v2.spelling, ext.spelling) AS label,
  v1.spelling AS v1_label, coalesce(t1.n, 0.0) AS v1_n, coalesce(t1.frac, 0.0) AS v1_frac,
  v2.spelling AS v2_label, coalesce(t2.n, 0.0) AS v2_n, coalesce(t2.frac, 0.0) AS v2_frac,
  ext.spelling AS ext_label, coalesce(te.n, 0.0) AS ext_n, coalesce(te.frac, 0.0) AS ext_frac
FROM (SELECT DISTINCT key FROM s) k
LEFT JOIN best v1 ON v1.side = 'v1' AND v1.key = k.key LEFT JOIN t t1 ON t1.side = 'v1' AND t1.key = k.key
LEFT JOIN best v2 ON v2.side = 'v2' AND v2.key = k.key LEFT JOIN t t2 ON t2.side = 'v2' AND t2.key = k.key
LEFT JOIN best ext ON ext.side = 'ext' AND ext.key = k.key LEFT JOIN t te ON te.side = 'ext' AND te.key = k.key""")
    for job, artifacts in _PUBLISHED.items():
        q[job] = "\nUNION ALL\n".join(
            f"SELECT '{name}' AS artifact, 'ok' AS status, (SELECT count(*) FROM ({q[key]})) AS rows"
            for name, key in artifacts.items())
    restart = [(1, "total_counts_yearly", "ok", "totals_yearly"), (1, "kpi", "ok", "postings_kpi_matrix"), (1, "kpi_percent", "ok", "postings_kpi_matrix"),
               (1, "comp_soc2", "failed", None), (1, "comp_soc2_top", "skipped", None),
               (2, "total_counts_yearly", "kept", "totals_yearly"), (2, "kpi", "kept", "postings_kpi_matrix"), (2, "kpi_percent", "kept", "postings_kpi_matrix"),
               (2, "comp_soc2", "ok", "distribution_lookup_join"), (2, "comp_soc2_top", "ok", "distribution_lookup_join")]
    rows = {None: "CAST(NULL AS BIGINT)", "comp_soc2_top": "least(2, (SELECT count(*) FROM (%s)))"}
    q["publish_restart"] = "\nUNION ALL\n".join(
        f"SELECT {run} AS run, '{name}' AS artifact, '{status}' AS status, "
        + (rows[None] if key is None else rows[name] % q[key] if name in rows else f"(SELECT count(*) FROM ({q[key]}))").replace("\n", " ") + " AS rows"
        for run, name, status, key in restart)
    return q


# Published artifacts of each job and the query whose rows they hold.
_PUBLISHED = {
    "publish_manifest": {
        "comp": "profile_matrix_long", "kpi": "profile_matrix_kpi",
        "roles_benchmark": "occupation_share_benchmark",
        "employers_industry_benchmark": "industry_share_stints"},
    "publish_postings": {
        "total_counts_yearly": "totals_yearly", "total_counts_monthly": "totals_monthly_spine",
        "onet_changes": "code_changes_top", "onet_change_summary": "code_agreement",
        "salary_stats": "salary_stats", "salary_distribution": "salary_buckets",
        "salary_by_soc2": "salary_median_by_group", "salary_coverage": "salary_coverage",
        "state_comparison": "state_share_benchmark", "kpi": "postings_kpi_matrix",
        "comp": "postings_field_matrix", "comp_top_employer": "distribution_top_anchor"},
    "publish_overlap": {
        "total_counts_yearly": "overlap_totals_yearly", "total_counts_monthly": "overlap_totals_monthly",
        "kpi": "overlap_kpi_matrix", "comp": "overlap_field_matrix",
        "monthly_openings": "monthly_benchmark_long", "openings_by_month": "wide_month_unpivot",
        "employment": "coded_benchmark_load", "group_vs_employment": "group_share_vs_employment",
        "industry_sectors": "sector_share_benchmark"},
    "publish_export": {
        "monthly_counts": "monthly_benchmark_wide", "salary_stats": "salary_stats_with_vendor",
        "salary_distribution": "salary_buckets", "salary_by_group": "salary_median_by_group",
        "salary_coverage": "salary_coverage", "group_vs_employment": "group_share_vs_employment",
        "industry_sectors": "sector_share_benchmark", "industry_coverage": "field_coverage_by_source"},
}


def _monthly_bench() -> str:
    return f"""SELECT 'benchmark' AS source, month AS month_start, posting_count AS cnt FROM ({_wide_unpivot()})
WHERE month >= DATE '{Y0}-01-01'
UNION ALL
SELECT 'full_v1', CAST(date_trunc('month', v1.post_date) AS DATE), count(DISTINCT v1.job_id)
FROM fx_postings_v1 v1 WHERE v1.country = {US} AND year(v1.post_date) >= {Y0} GROUP BY 1, 2
UNION ALL
SELECT 'full_ext', CAST(date_trunc('month', ext.posted) AS DATE), count(DISTINCT ext.id)
FROM fx_postings_ext ext WHERE year(ext.posted) >= {Y0} GROUP BY 1, 2"""
