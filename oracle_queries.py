"""The registered queries as plain SQL over the same Parquet tables, for the correctness check."""

from __future__ import annotations

# Input tables derived from the order tables, then the star schema built from them.
STAR = r"""
WITH raw_arrivals AS (
  SELECT CAST(CASE WHEN l_linestatus = 'F' THEN 1.0
                   WHEN l_returnflag = 'R' THEN 1.9
                   WHEN l_returnflag = 'A' THEN 2.0 END AS DOUBLE) AS i94mode,
         CAST(CASE WHEN c_acctbal < 0 THEN 999 ELSE c_nationkey % 5 END AS DOUBLE) AS i94res,
         CASE WHEN l_returnflag = 'R' THEN 'S-' ELSE 'Supplier#' END
           || ((l_suppkey + l_linenumber) % 12) AS i94port,
         CASE WHEN l_tax <> 0 OR l_discount <> 0
              THEN CAST(date_diff('day', DATE '1960-01-01',
                                  CAST(date_trunc('month', o_orderdate) AS DATE))
                        + (day(o_orderdate) - 1) // 9 * 9 AS DOUBLE)
         END AS arrdate,
         CAST(year(o_orderdate) AS DOUBLE) AS i94yr,
         CAST(month(o_orderdate) AS DOUBLE) AS i94mon,
         CAST(CASE WHEN l_quantity <> 50 THEN floor(l_quantity / 2) * 4 - 4 END AS DOUBLE)
           AS i94bir,
         CASE WHEN o_orderstatus = 'P' THEN o_orderstatus ELSE o_orderpriority END AS visatype
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
), raw_ports AS (
  SELECT 'Supplier#' || (s_suppkey % 10) AS "Code",
         ' Town  ' || (s_suppkey % 10 % 8)
           || CASE WHEN s_nationkey < 5 THEN '. ' ELSE '  (' || s_nationkey || ')' END AS "City",
         'S' || substr('ABCDE', CAST(s_suppkey % 10 % 8 % 5 + 1 AS INTEGER), 1) || '* ' AS "State"
  FROM supplier
), raw_visas AS (
  SELECT o_orderpriority AS "Visa Type",
         'Séjour' || chr(160) || o_orderstatus || ' – ' || o_orderpriority AS "Purpose"
  FROM orders
), raw_countries AS (
  SELECT CASE WHEN c_acctbal < 0 THEN 'x' || c_nationkey
              WHEN c_mktsegment = 'BUILDING' THEN c_nationkey || '.5'
              WHEN c_mktsegment = 'MACHINERY'
              THEN ' ' || chr(9) || (c_nationkey + 40) || chr(160) || ' '
              ELSE CAST(c_nationkey AS VARCHAR) END AS "Country_code",
         'Land ' || (c_nationkey % 3) AS "Country"
  FROM customer
), raw_demographics AS (
  SELECT 'TOWN ' || c_nationkey AS "City",
         'State ' || (c_nationkey % 5) AS "State",
         '0S' || substr('ABCDE', CAST(c_nationkey % 5 + 1 AS INTEGER), 1) || '.' AS "State Code",
         min(c_acctbal) AS "Median Age",
         CAST(count(*) FILTER (c_acctbal < 5000) AS INTEGER) AS "Male Population",
         CAST(count(*) FILTER (c_acctbal >= 5000) AS INTEGER) AS "Female Population",
         CAST(count(*) AS INTEGER) AS "Total Population",
         CAST(count(*) FILTER (c_acctbal < 0) AS INTEGER) AS "Number of Veterans",
         max(c_acctbal) AS "Average Household Size"
  FROM customer
  GROUP BY c_nationkey, c_mktsegment
), country_list AS (
  SELECT n_nationkey AS code,
         CASE n_nationkey % 5 WHEN 1 THEN 'INVALID: ' WHEN 2 THEN 'Collapsed '
                              WHEN 3 THEN 'No Country Code ' ELSE '' END || n_name AS label
  FROM nation
), air AS (
  SELECT i94res, i94port, arrdate, i94yr, i94mon, i94bir, visatype
  FROM raw_arrivals WHERE i94mode = 1
), air_distinct AS (
  SELECT DISTINCT * FROM air
), typed AS (
  SELECT 1 AS one_of_distinct, * FROM air_distinct UNION ALL SELECT 0, * FROM air
), typed_both AS (
  SELECT one_of_distinct,
         CAST(trunc(i94res) AS INTEGER) AS country_of_residence_cd,
         regexp_replace(i94port, '[^A-Z0-9]', '', 'g') AS port_of_entry,
         CAST(trunc(arrdate) AS INTEGER) AS arrdate,
         CAST(trunc(i94bir) AS INTEGER) AS i94bir,
         regexp_replace(visatype, '[^A-Z0-9]', '', 'g') AS visatype,
         CAST(trunc(i94yr) AS INTEGER) AS arrival_date_year,
         CAST(trunc(i94mon) AS INTEGER) AS arrival_date_month,
         CAST(DATE '1960-01-01' + CAST(trunc(arrdate) AS INTEGER) AS VARCHAR) AS arrival_date,
         CASE WHEN i94bir IS NULL OR trunc(i94bir) = 0 THEN 'NA'
              WHEN trunc(i94bir) < 1 THEN 'infant'
              WHEN trunc(i94bir) < 13 THEN 'children'
              WHEN trunc(i94bir) <= 18 THEN 'teens'
              WHEN trunc(i94bir) < 65 THEN 'adult'
              ELSE 'elderly' END AS age_group
  FROM typed
), clean AS (
  SELECT * EXCLUDE (one_of_distinct) FROM typed_both WHERE one_of_distinct = 1
), clean_all AS (
  SELECT * EXCLUDE (one_of_distinct) FROM typed_both WHERE one_of_distinct = 0
), ports_clean AS (
  SELECT regexp_replace("Code", '[^A-Z0-9]', '', 'g') AS "Code",
         trim(regexp_replace(regexp_replace("City", '[^A-Z,a-z ()0-9]', '', 'g'),
                             '  ', ' ', 'g')) AS "City",
         trim(regexp_replace(regexp_replace("State", '[^A-Za-z 0-9]', '', 'g'),
                             '  ', ' ', 'g')) AS "State"
  FROM raw_ports
), ports AS (
  SELECT * FROM ports_clean
  QUALIFY row_number() OVER (PARTITION BY "Code"
                             ORDER BY "City" NULLS FIRST, "State" NULLS FIRST) = 1
), visas AS (
  SELECT * FROM (
    SELECT regexp_replace("Visa Type", '[^A-Z0-9]', '', 'g') AS "Visa_Type",
           regexp_replace("Purpose", '[^\x00-\x7F]', '', 'g') AS "Visa_Purpose"
    FROM raw_visas)
  QUALIFY row_number() OVER (PARTITION BY "Visa_Type" ORDER BY "Visa_Purpose" NULLS FIRST) = 1
), countries AS (
  SELECT * FROM (
    SELECT CAST(trunc(TRY_CAST(trim("Country_code", ' ' || chr(9) || chr(160)) AS DOUBLE))
                AS INTEGER) AS "Country_code", "Country"
    FROM raw_countries)
  QUALIFY row_number() OVER (PARTITION BY "Country_code" ORDER BY "Country" NULLS FIRST) = 1
), cities_renamed AS (
  SELECT "City", "State", "State Code" AS "State_Code", "Median Age" AS "Median_Age",
         "Male Population" AS "Male_Population", "Female Population" AS "Female_Population",
         "Total Population" AS "Total_Population",
         "Number of Veterans" AS "Number_of_Veterans",
         "Average Household Size" AS "Average_Household_Size"
  FROM raw_demographics
), cities AS (
  SELECT * REPLACE (regexp_replace("State_Code", '[^A-Z]', '', 'g') AS "State_Code")
  FROM cities_renamed
  QUALIFY row_number() OVER (
    PARTITION BY "City", "State"
    ORDER BY regexp_replace("State_Code", '[^A-Z]', '', 'g') NULLS FIRST,
             "Median_Age" NULLS FIRST, "Male_Population" NULLS FIRST,
             "Female_Population" NULLS FIRST, "Total_Population" NULLS FIRST,
             "Number_of_Veterans" NULLS FIRST, "Average_Household_Size" NULLS FIRST) = 1
), dates AS (
  SELECT arrival_date, arrival_date_year, arrival_date_month,
         CAST(day(CAST(arrival_date AS DATE)) AS INTEGER) AS arrival_date_day,
         strftime(CAST(arrival_date AS DATE), '%a') AS weekday
  FROM (SELECT DISTINCT arrival_date, arrival_date_year, arrival_date_month FROM clean)
  QUALIFY row_number() OVER (
    PARTITION BY arrival_date
    ORDER BY arrival_date_year NULLS FIRST, arrival_date_month NULLS FIRST) = 1
), fact AS (
  SELECT country_of_residence_cd, port_of_entry, visatype, arrival_date, arrival_date_year,
         arrival_date_month, age_group, "City", "State", count(*) AS "count"
  FROM clean LEFT JOIN ports ON port_of_entry = "Code"
  GROUP BY ALL
), head_count AS (
  SELECT country_of_residence_cd, port_of_entry, visatype, arrival_date, arrival_date_year,
         arrival_date_month, age_group, "City", "State", count(*) AS "count"
  FROM clean_all LEFT JOIN ports ON port_of_entry = "Code"
  GROUP BY ALL
), by_weekday AS (
  SELECT d.arrival_date_year, weekday, CAST(sum("count") AS BIGINT) AS sum_count
  FROM fact f LEFT JOIN dates d ON f.arrival_date = d.arrival_date
  GROUP BY ALL
), by_visa AS (
  SELECT arrival_date_year, "Visa_Type", "Visa_Purpose",
         CAST(sum("count") AS BIGINT) AS sum_count
  FROM fact LEFT JOIN visas ON visatype = "Visa_Type"
  GROUP BY ALL
), by_country AS (
  SELECT arrival_date_year, "Country", CAST(sum("count") AS BIGINT) AS sum_count
  FROM fact LEFT JOIN countries ON country_of_residence_cd = "Country_code"
  GROUP BY ALL
), by_city AS (
  SELECT arrival_date_year, "City", "State", CAST(sum("count") AS BIGINT) AS sum_count
  FROM fact GROUP BY ALL
), counts AS (
  SELECT 'cities_demographics' AS table_name, 9 AS n_columns, count(*) AS n_rows FROM cities
  UNION ALL SELECT 'country_codes', 2, count(*) FROM countries
  UNION ALL SELECT 'US_Visas', 2, count(*) FROM visas
  UNION ALL SELECT 'arrival_dates', 5, count(*) FROM dates
  UNION ALL SELECT 'immigration_fact', 10, count(*) FROM fact
), null_keys AS (
  SELECT 'cities_demographics' AS table_name, 'City' AS column_name,
         count(*) FILTER ("City" IS NULL) AS bad_rows FROM cities
  UNION ALL SELECT 'cities_demographics', 'State', count(*) FILTER ("State" IS NULL) FROM cities
  UNION ALL SELECT 'country_codes', 'Country_code', count(*) FILTER ("Country_code" IS NULL)
            FROM countries
  UNION ALL SELECT 'US_Visas', 'Visa_Type', count(*) FILTER ("Visa_Type" IS NULL) FROM visas
  UNION ALL SELECT 'arrival_dates', 'arrival_date', count(*) FILTER (arrival_date IS NULL)
            FROM dates
), repeated_keys AS (
  SELECT 'cities_demographics' AS table_name, 'City, State' AS column_name,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT "City", "State" FROM cities))
           AS bad_rows FROM cities
  UNION ALL SELECT 'country_codes', 'Country_code',
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT "Country_code" FROM countries))
         FROM countries
  UNION ALL SELECT 'US_Visas', 'Visa_Type',
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT "Visa_Type" FROM visas)) FROM visas
  UNION ALL SELECT 'arrival_dates', 'arrival_date',
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT arrival_date FROM dates)) FROM dates
)
"""


def _star(select: str) -> str:
    return STAR + select


def _corrected(select: str) -> str:
    """The same after February's records of unknown age were taken out."""
    air = "FROM raw_arrivals WHERE i94mode = 1\n"
    kept = air.rstrip() + " AND NOT (i94mon = 2 AND i94bir IS NULL)\n"
    return STAR.replace(air, kept) + select


def _text(pattern: str) -> str:
    cleaned = f"regexp_replace(text, '{pattern}', '', 'g')"
    return f"SELECT doc_id, {cleaned} AS cleaned FROM documents"


_FIRST_ARRIVAL = """
SELECT * FROM raw_arrivals
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY
  i94mode NULLS FIRST, i94res NULLS FIRST, i94port NULLS FIRST, arrdate NULLS FIRST,
  i94yr NULLS FIRST, i94mon NULLS FIRST, i94bir NULLS FIRST, visatype NULLS FIRST) = 1
"""

_STATES = """
  ('AL', 'ALABAMA'), ('AK', 'ALASKA'), ('AZ', 'ARIZONA'), ('AR', 'ARKANSAS'),
  ('CA', 'CALIFORNIA'), ('CO', 'COLORADO'), ('CT', 'CONNECTICUT'), ('DE', 'DELAWARE'),
  ('DC', 'DIST. OF COLUMBIA'), ('FL', 'FLORIDA'), ('GA', 'GEORGIA'), ('GU', 'GUAM'),
  ('HI', 'HAWAII'), ('ID', 'IDAHO'), ('IL', 'ILLINOIS'), ('IN', 'INDIANA'), ('IA', 'IOWA'),
  ('KS', 'KANSAS'), ('KY', 'KENTUCKY'), ('LA', 'LOUISIANA'), ('ME', 'MAINE'),
  ('MD', 'MARYLAND'), ('MA', 'MASSACHUSETTS'), ('MI', 'MICHIGAN'), ('MN', 'MINNESOTA'),
  ('MS', 'MISSISSIPPI'), ('MO', 'MISSOURI'), ('MT', 'MONTANA'), ('NC', 'N. CAROLINA'),
  ('ND', 'N. DAKOTA'), ('NE', 'NEBRASKA'), ('NV', 'NEVADA'), ('NH', 'NEW HAMPSHIRE'),
  ('NJ', 'NEW JERSEY'), ('NM', 'NEW MEXICO'), ('NY', 'NEW YORK'), ('OH', 'OHIO'),
  ('OK', 'OKLAHOMA'), ('OR', 'OREGON'), ('PA', 'PENNSYLVANIA'), ('PR', 'PUERTO RICO'),
  ('RI', 'RHODE ISLAND'), ('SC', 'S. CAROLINA'), ('SD', 'S. DAKOTA'), ('TN', 'TENNESSEE'),
  ('TX', 'TEXAS'), ('UT', 'UTAH'), ('VT', 'VERMONT'), ('VI', 'VIRGIN ISLANDS'),
  ('VA', 'VIRGINIA'), ('WV', 'W. VIRGINIA'), ('WA', 'WASHINGTON'), ('WI', 'WISCONSON'),
  ('WY', 'WYOMING'), ('99', 'All Other Codes')
"""

ORACLE = {
    "clean_code": _text("[^A-Z0-9]"),
    "clean_state_code": _text("[^A-Z]"),
    "clean_city_text": _text("[^A-Z,a-z ()0-9]"),
    "clean_state_text": _text("[^A-Za-z 0-9]"),
    "ascii_only": _text(r"[^\x00-\x7F]"),
    "collapse_spaces": """
        SELECT doc_id,
               trim(regexp_replace(spaced, '  ', ' ', 'g')) AS once,
               trim(regexp_replace(spaced, ' {2,}', ' ', 'g')) AS fully
        FROM (SELECT doc_id, translate(text, '.,', '  ') AS spaced FROM documents)
    """,
    "sas_date": """
        SELECT o_orderkey, arrival_date,
               CAST(day(CAST(arrival_date AS DATE)) AS INTEGER) AS arrival_date_day,
               strftime(CAST(arrival_date AS DATE), '%a') AS weekday
        FROM (SELECT o_orderkey,
                     CASE WHEN o_orderstatus <> 'P'
                          THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS arrival_date
              FROM orders)
    """,
    "age_group": """
        SELECT l_orderkey, age, band AS age_group,
               CASE WHEN age = 0 THEN 'infant' ELSE band END AS age_group_zero_is_infant
        FROM (SELECT *, CASE WHEN age IS NULL OR age = 0 THEN 'NA'
                             WHEN age < 1 THEN 'infant' WHEN age < 13 THEN 'children'
                             WHEN age <= 18 THEN 'teens' WHEN age < 65 THEN 'adult'
                             ELSE 'elderly' END AS band
              FROM (SELECT l_orderkey,
                           CASE WHEN l_quantity < 50
                                THEN CAST(l_quantity * 2 - 4 AS INTEGER) END AS age
                    FROM lineitem))
    """,
    "project_arrivals": _star(
        "SELECT i94res, i94port, arrdate, i94yr, i94mon, i94bir, visatype FROM raw_arrivals"
    ),
    "rename_columns": _star("SELECT * FROM cities_renamed"),
    "filter_mode": _star("SELECT * FROM raw_arrivals WHERE i94mode = 1"),
    "typed_arrivals": _star("SELECT * FROM clean"),
    "distinct_rows": _star("SELECT DISTINCT * FROM raw_arrivals"),
    "distinct_projected": _star("SELECT * FROM air_distinct"),
    "dedupe_by_key": _star(_FIRST_ARRIVAL.format(keys="i94port")),
    "dedupe_by_two_keys": _star(_FIRST_ARRIVAL.format(keys="i94port, visatype")),
    "arrivals_month_union": _star(
        "SELECT *, CAST(i94mon AS INTEGER) AS file_month FROM raw_arrivals"
    ),
    "dim_visas": _star("SELECT * FROM visas"),
    "dim_countries": _star("SELECT * FROM countries"),
    "dim_cities": _star("SELECT * FROM cities"),
    "dim_ports": _star("SELECT * FROM ports"),
    "dim_dates": _star("SELECT * FROM dates"),
    "join_port": _star(
        'SELECT clean.*, "City", "State" FROM clean LEFT JOIN ports ON port_of_entry = "Code"'
    ),
    "fact_arrivals": _star("SELECT * FROM fact"),
    "fact_head_count": _star("SELECT * FROM head_count"),
    "stats_weekday": _star("SELECT * FROM by_weekday"),
    "stats_visa": _star("SELECT * FROM by_visa"),
    "stats_country": _star("SELECT * FROM by_country"),
    "stats_city": _star("SELECT * FROM by_city"),
    "dq_row_counts": _star("SELECT *, n_rows > 0 AS passed FROM counts"),
    "dq_null_keys": _star("""
        SELECT table_name, 'not_null' AS check_name, column_name, bad_rows = 0 AS passed, bad_rows
        FROM null_keys
    """),
    "dq_report": _star("""
        SELECT table_name, 'not_empty' AS check_name, CAST(NULL AS VARCHAR) AS column_name,
               n_rows > 0 AS passed, CAST(0 AS BIGINT) AS bad_rows FROM counts
        UNION ALL
        SELECT table_name, 'not_null', column_name, bad_rows = 0, bad_rows FROM null_keys
        UNION ALL
        SELECT table_name, 'unique', column_name, bad_rows = 0, bad_rows FROM repeated_keys
    """),
    "csv_roundtrip": _star("SELECT * FROM raw_arrivals"),
    "csv_semicolon_roundtrip": _star("SELECT * FROM raw_demographics"),
    "csv_inferred": _star("SELECT * FROM raw_demographics"),
    "csv_careless_numbers": _star("""
        SELECT "City", "State", "State Code", "Median Age", "Male Population",
               "Female Population" * 1000 AS "Female Population",
               CASE WHEN "Total Population" % 7 <> 0 THEN "Total Population" END
                 AS "Total Population",
               nullif("Number of Veterans", 0) AS "Number of Veterans",
               CASE WHEN "Male Population" % 5 <> 0
                    THEN CAST("Male Population" * 10 AS DOUBLE) END AS "Average Household Size"
        FROM raw_demographics
    """),
    "dq_bad_numbers": _star("""
        SELECT 'demographics' AS table_name, 'bad_number' AS check_name, column_name,
               bad_rows = 0 AS passed, bad_rows
        FROM (
          SELECT unnest(['Median Age', 'Male Population', 'Female Population',
                         'Total Population', 'Number of Veterans', 'Average Household Size'])
                   AS column_name,
                 unnest([0, 0, 0, count(*) FILTER ("Total Population" % 7 = 0), 0,
                         count(*) FILTER ("Male Population" % 5 = 0)]) AS bad_rows
          FROM raw_demographics)
    """),
    "dq_failures": _star("""
        , codes AS (
          SELECT CAST(trunc(TRY_CAST(trim("Country_code", ' ' || chr(9) || chr(160)) AS DOUBLE))
                      AS INTEGER) AS code
          FROM raw_countries
        )
        SELECT table_name, check_name, column_name, false AS passed, bad_rows FROM (
          SELECT 'countries' AS table_name, 'not_null' AS check_name, 'code' AS column_name,
                 count(*) FILTER (code IS NULL) AS bad_rows FROM codes
          UNION ALL
          SELECT 'countries', 'unique', 'code',
                 count(*) - (SELECT count(*) FROM (SELECT DISTINCT code FROM codes)) FROM codes
          UNION ALL
          SELECT 'visas', 'unique', 'Visa Type', count(*) - count(DISTINCT "Visa Type")
          FROM raw_visas
          UNION ALL SELECT 'ports', 'not_empty', NULL, 0)
        WHERE bad_rows > 0 OR check_name = 'not_empty'
    """),
    "fact_two_month_files": _star("""
        , landed AS (
          SELECT *, i94mon AS file_month FROM raw_arrivals
          UNION ALL SELECT *, i94mon + 1 FROM raw_arrivals WHERE i94mon % 2 = 1
        ), twice AS (
          SELECT DISTINCT i94res, i94port, arrdate, i94yr, i94mon, i94bir, visatype, file_month
          FROM landed WHERE i94mode = 1
        ), copies AS (
          SELECT CAST(i94res AS INTEGER) AS country_of_residence_cd,
                 regexp_replace(i94port, '[^A-Z0-9]', '', 'g') AS port_of_entry,
                 regexp_replace(visatype, '[^A-Z0-9]', '', 'g') AS visatype,
                 CAST(DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS VARCHAR) AS arrival_date,
                 CAST(i94yr AS INTEGER) AS arrival_date_year,
                 CAST(i94mon AS INTEGER) AS arrival_date_month,
                 CASE WHEN i94bir IS NULL OR i94bir = 0 THEN 'NA' WHEN i94bir < 1 THEN 'infant'
                      WHEN i94bir < 13 THEN 'children' WHEN i94bir <= 18 THEN 'teens'
                      WHEN i94bir < 65 THEN 'adult' ELSE 'elderly' END AS age_group
          FROM twice
        )
        SELECT copies.*, "City", "State", count(*) AS "count"
        FROM copies LEFT JOIN ports ON port_of_entry = "Code"
        GROUP BY ALL
    """),
    "load_year_fact": _star("SELECT * FROM fact"),
    "load_year_weekday": _star("SELECT * FROM by_weekday"),
    "load_year_visa": _star("SELECT * FROM by_visa"),
    "load_year_country": _star("SELECT * FROM by_country"),
    "load_year_city": _star("SELECT * FROM by_city"),
    "reload_month_fact": _corrected("SELECT * FROM fact"),
    "reload_month_dates": _corrected("SELECT * FROM dates"),
    "reload_month_weekday": _corrected("SELECT * FROM by_weekday"),
    "reload_month_visa": _corrected("SELECT * FROM by_visa"),
    "reload_month_country": _corrected("SELECT * FROM by_country"),
    "reload_month_city": _corrected("SELECT * FROM by_city"),
    "failed_load_fact": _star("SELECT * FROM fact"),
    "sink_overwrite_readback": _star("SELECT * FROM raw_arrivals"),
    "sink_append_readback": _star("SELECT * FROM raw_arrivals"),
    "sink_partitioned_readback": _star("SELECT * FROM fact"),
    "top_visas": _star("""
        SELECT "Visa_Type", "Visa_Purpose", CAST(sum(sum_count) AS BIGINT) AS sum_count
        FROM by_visa GROUP BY ALL
        ORDER BY sum_count DESC, "Visa_Type" NULLS FIRST, "Visa_Purpose" NULLS FIRST LIMIT 3
    """),
    "top_ports": _star("""
        SELECT port_of_entry, "City", "State", CAST(sum("count") AS BIGINT) AS sum_count
        FROM fact GROUP BY ALL
        ORDER BY sum_count DESC, port_of_entry NULLS FIRST, "City" NULLS FIRST,
                 "State" NULLS FIRST LIMIT 10
    """),
    "top_countries": _star("""
        SELECT "Country", CAST(sum(sum_count) AS BIGINT) AS sum_count
        FROM by_country GROUP BY ALL
        ORDER BY sum_count DESC, "Country" NULLS FIRST LIMIT 3
    """),
    "weekday_trend": _star("""
        SELECT arrival_date_year,
               CAST(list_position(['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'], weekday)
                    AS INTEGER) AS weekday_number,
               weekday, sum_count
        FROM by_weekday
    """),
    "monthly_inflow": _star("""
        SELECT arrival_date_year, arrival_date_month, CAST(sum("count") AS BIGINT) AS sum_count
        FROM fact GROUP BY ALL
    """),
    "busiest_days": _star("""
        SELECT arrival_date, CAST(sum("count") AS BIGINT) AS sum_count
        FROM fact GROUP BY ALL
        ORDER BY sum_count DESC, arrival_date NULLS FIRST LIMIT 10
    """),
    "city_inflow_demographics": _star("""
        SELECT f."City", f."State", f.sum_count, "Median_Age", "Male_Population",
               "Female_Population", "Total_Population", "Number_of_Veterans",
               "Average_Household_Size"
        FROM (SELECT "City", "State", CAST(sum("count") AS BIGINT) AS sum_count
              FROM fact GROUP BY ALL) f
        LEFT JOIN cities c ON upper(f."City") = upper(c."City") AND f."State" = c."State_Code"
    """),
    "decode_country": _star("""
        SELECT c_custkey, res AS code, label AS country
        FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 999 ELSE c_nationkey END AS res
              FROM customer)
        LEFT JOIN country_list ON res = code
    """),
    "decode_port": """
        SELECT l_orderkey, l_suppkey + l_linenumber AS port_code, s_name AS port
        FROM lineitem LEFT JOIN supplier ON l_suppkey + l_linenumber = s_suppkey
    """,
    "decode_mode": """
        SELECT l_orderkey, code,
               CASE code WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land'
                         WHEN 9 THEN 'Not reported' END AS label
        FROM (SELECT l_orderkey,
                     CASE WHEN l_linenumber > 3 THEN l_linenumber + 2 ELSE l_linenumber END
                       AS code
              FROM lineitem)
    """,
    "decode_state_default": f"""
        SELECT l_orderkey, state_code, coalesce(label, 'All Other Codes') AS state
        FROM (SELECT l_orderkey,
                     chr(CAST(65 + l_partkey % 26 AS INTEGER))
                       || chr(CAST(65 + l_suppkey % 26 AS INTEGER)) AS state_code
              FROM lineitem)
        LEFT JOIN (VALUES {_STATES}) AS states(code, label) ON state_code = code
    """,
    "decode_visa_category": """
        SELECT l_orderkey, l_linenumber AS code,
               CASE l_linenumber WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure'
                                 WHEN 3 THEN 'Student' END AS label
        FROM lineitem
    """,
    "split_port_label": r"""
        SELECT p_partkey, label,
               CASE WHEN contains(label, ',')
                    THEN trim(regexp_extract(label, '^(.*),([^,]*)$', 1))
                    ELSE trim(label) END AS "City",
               CASE WHEN contains(label, ',')
                    THEN trim(regexp_extract(label, '^(.*),([^,]*)$', 2)) END AS "State"
        FROM (SELECT p_partkey,
                     CASE WHEN p_size > 35 THEN upper(p_name) || '  '
                          WHEN p_size > 15 THEN upper(p_name) || ', ' || p_type || '   '
                          ELSE upper(p_name) || ', ' || p_brand || ', ' || p_type END AS label
              FROM part)
    """,
    "classify_code": _star("""
        SELECT c_custkey, label,
               CASE WHEN label IS NULL THEN NULL
                    WHEN label LIKE 'INVALID%' THEN 'invalid'
                    WHEN label LIKE 'Collapsed%' THEN 'collapsed'
                    WHEN label LIKE 'No Country Code%' OR label LIKE 'No PORT Code%'
                    THEN 'no_code' ELSE 'valid' END AS code_class
        FROM customer LEFT JOIN country_list
          ON CASE WHEN c_acctbal < 0 THEN 999 ELSE c_nationkey END = code
    """),
}
