
from __future__ import annotations

import logging
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from landfall import functions as fn  # noqa: E402
from landfall import operators as op  # noqa: E402
from landfall import sources as io  # noqa: E402
from landfall.plans import answers, dims, stats  # noqa: E402
from landfall.plans import fact as facts  # noqa: E402
from landfall.plans.yearly_load import (  # noqa: E402
    Inputs,
    Lake,
    load_year,
    read_lake,
    read_summaries,
)
from landfall.schemas import FACT, RAW_ARRIVALS, RAW_DEMOGRAPHICS  # noqa: E402
from landfall.sources import sample_tables as sample  # noqa: E402
from landfall.sources.files import MONTH_FILE, MONTHS  # noqa: E402
from oracle_queries import ORACLE  # noqa: E402

try:  # the text operators are an optional part of the library
    import corpus_pipeline
    from landfall.llm import queries as llm
except ImportError as error:  # or one of the libraries that only they need is missing
    logging.getLogger("landfall").warning("without text operators: %s", error)
    LLM_QUERIES, LLM_ORACLE = {}, {}
else:
    LLM_QUERIES = {**llm.QUERIES, "pipeline": corpus_pipeline.run}
    LLM_ORACLE = dict(llm.ORACLE)

Query = Callable[[SparkSession, str], DataFrame]

LANDED_FILE = "file=" + MONTH_FILE

UNIQUE_RULES = tuple(
    op.TableRule(rule.table, rule.keys, unique=bool(rule.keys)) for rule in op.DEFAULT_RULES
)


def _clean(spark: SparkSession, folder: str, dedupe: bool = True) -> DataFrame:
    return facts.clean_arrivals(sample.raw_arrivals(spark, folder), dedupe)


def _ports(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dim_ports(sample.raw_ports(spark, folder))


def _fact(spark: SparkSession, folder: str, dedupe: bool = True) -> DataFrame:
    return facts.fact_arrivals(_clean(spark, folder, dedupe), _ports(spark, folder))


def _visas(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dim_visas(sample.raw_visas(spark, folder))


def _countries(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dim_countries(sample.raw_countries(spark, folder))


def _cities(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dim_cities(sample.raw_demographics(spark, folder))


def _dates(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dim_dates(_clean(spark, folder, dedupe=False))


def _lake(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    fact = _fact(spark, folder)
    return {
        "cities_demographics": _cities(spark, folder),
        "country_codes": _countries(spark, folder),
        "US_Visas": _visas(spark, folder),
        "arrival_dates": dims.dim_dates(fact),
        "immigration_fact": fact,
    }


# Cleaning


def _document_text(clean) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        documents = sample.table(spark, folder, "documents")
        return documents.select("doc_id", clean("text").alias("cleaned"))

    return query


def collapse_spaces(spark: SparkSession, folder: str) -> DataFrame:
    spaced = F.translate("text", ".,", "  ")
    return sample.table(spark, folder, "documents").select(
        "doc_id",
        fn.collapse_spaces(spaced).alias("once"),
        fn.collapse_spaces(spaced, collapse_all=True).alias("fully"),
    )


def sas_date(spark: SparkSession, folder: str) -> DataFrame:
    days = F.date_diff(F.to_date("o_orderdate"), F.lit("1960-01-01").cast("date"))
    orders = sample.table(spark, folder, "orders")
    known = F.when(F.col("o_orderstatus") != "P", days.cast("double"))
    dated = orders.select("o_orderkey", fn.day_number_to_date(known).alias("arrival_date"))
    return dated.withColumns(
        {
            "arrival_date_day": fn.day_of_month("arrival_date"),
            "weekday": fn.weekday_name("arrival_date"),
        }
    )


def age_group(spark: SparkSession, folder: str) -> DataFrame:
    age = F.when(F.col("l_quantity") < 50, (F.col("l_quantity") * 2 - 4).cast("int"))
    aged = sample.table(spark, folder, "lineitem").select("l_orderkey", age.alias("age"))
    return aged.withColumns(
        {
            "age_group": fn.age_group("age"),
            "age_group_zero_is_infant": fn.age_group("age", zero_is_infant=True),
        }
    )


# Shape


def project_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    return facts.project_arrivals(sample.raw_arrivals(spark, folder))


def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    return op.rename_columns(sample.raw_demographics(spark, folder), dims.CITY_COLUMNS)


def filter_mode(spark: SparkSession, folder: str) -> DataFrame:
    return facts.air_arrivals(sample.raw_arrivals(spark, folder))


def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return op.distinct_of(sample.raw_arrivals(spark, folder))


def distinct_projected(spark: SparkSession, folder: str) -> DataFrame:
    air = facts.air_arrivals(sample.raw_arrivals(spark, folder))
    return op.distinct_of(air, facts.ARRIVAL_COLUMNS)


def dedupe_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return op.first_per_key(sample.raw_arrivals(spark, folder), ["i94port"])


def dedupe_by_two_keys(spark: SparkSession, folder: str) -> DataFrame:
    return op.first_per_key(sample.raw_arrivals(spark, folder), ["i94port", "visatype"])


def arrivals_month_union(spark: SparkSession, folder: str) -> DataFrame:
    """Land the arrivals in twelve month folders, then read them as one scan."""
    landing = _landed(spark, sample.raw_arrivals(spark, folder))
    return io.read_arrivals(spark, landing, 2016, name=LANDED_FILE)


def _landed(spark: SparkSession, arrivals: DataFrame) -> str:
    """Arrivals in twelve month folders of one year, by the month of the record."""
    landing = io.scratch_folder(spark, "landing")
    months = F.array(*[F.lit(month) for month in MONTHS])
    month = F.element_at(months, F.col("i94mon").cast("int"))
    named = arrivals.withColumn("file", F.concat(F.lit("i94_"), month, F.lit("16_sub")))
    io.write_partitioned(named, landing, ["file"], mode="overwrite")
    return landing


def fact_two_month_files(spark: SparkSession, folder: str) -> DataFrame:
    """The fact of files that repeat rows: each arrival of odd months also stands in the file of
    the month after, where it counts again."""
    landing = io.scratch_folder(spark, "landing")
    arrivals = sample.raw_arrivals(spark, folder)
    again = arrivals.where(F.col("i94mon") % 2 == 1)
    months = F.array(*[F.lit(month) for month in MONTHS])
    files = [
        rows.withColumn("file", F.concat(F.lit("i94_"), F.element_at(months, n), F.lit("16_sub")))
        for rows, n in (
            (arrivals, F.col("i94mon").cast("int")),
            (again, F.col("i94mon").cast("int") + 1),
        )
    ]
    io.write_partitioned(files[0].unionByName(files[1]), landing, ["file"], mode="overwrite")
    clean = facts.clean_arrivals(io.read_arrivals(spark, landing, 2016, name=LANDED_FILE))
    return facts.fact_arrivals(clean, _ports(spark, folder))


# Star schema


def join_port(spark: SparkSession, folder: str) -> DataFrame:
    return facts.join_port(_clean(spark, folder), _ports(spark, folder))


def fact_head_count(spark: SparkSession, folder: str) -> DataFrame:
    return _fact(spark, folder, dedupe=False)


def stats_weekday(spark: SparkSession, folder: str) -> DataFrame:
    fact = _fact(spark, folder)
    return stats.stats_weekday(fact, dims.dim_dates(fact))


def stats_visa(spark: SparkSession, folder: str) -> DataFrame:
    return stats.stats_visa(_fact(spark, folder), _visas(spark, folder))


def stats_country(spark: SparkSession, folder: str) -> DataFrame:
    return stats.stats_country(_fact(spark, folder), _countries(spark, folder))


def stats_city(spark: SparkSession, folder: str) -> DataFrame:
    return stats.stats_city(_fact(spark, folder))


# Quality


def dq_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return op.row_count_report(_lake(spark, folder), op.DEFAULT_RULES)


def dq_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    return op.null_key_report(_lake(spark, folder), op.DEFAULT_RULES)


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    return op.quality_report(_lake(spark, folder), UNIQUE_RULES)


# Input and output


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = io.scratch_folder(spark, "csv")
    io.write_csv(sample.raw_arrivals(spark, folder), path)
    return io.read_csv(spark, path, RAW_ARRIVALS)


def csv_semicolon_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = io.scratch_folder(spark, "csv")
    io.write_csv(sample.raw_demographics(spark, folder), path, sep=";")
    return io.read_csv(spark, path, RAW_DEMOGRAPHICS, sep=";")


def sink_overwrite_readback(spark: SparkSession, folder: str) -> DataFrame:
    """The second write replaces the first, so each arrival is read once."""
    path = io.scratch_folder(spark, "overwrite")
    arrivals = sample.raw_arrivals(spark, folder)
    io.overwrite(facts.air_arrivals(arrivals), path)
    io.overwrite(arrivals, path)
    return io.read_table(spark, path, RAW_ARRIVALS)


def sink_append_readback(spark: SparkSession, folder: str) -> DataFrame:
    """Arrivals by air, then all others, give all arrivals."""
    path = io.scratch_folder(spark, "append")
    arrivals = sample.raw_arrivals(spark, folder)
    io.overwrite(facts.air_arrivals(arrivals), path)
    io.append(arrivals.where(~F.equal_null("i94mode", F.lit(1.0))), path)
    return io.read_table(spark, path, RAW_ARRIVALS)


def sink_partitioned_readback(spark: SparkSession, folder: str) -> DataFrame:
    """The head counts are replaced partition by partition with the de-duplicated counts."""
    path = io.scratch_folder(spark, "partitioned")
    keys = ["arrival_date_year", "arrival_date_month"]
    io.write_partitioned(_fact(spark, folder, dedupe=False), path, keys)
    io.write_partitioned(_fact(spark, folder), path, keys)
    return io.read_table(spark, path, FACT)


def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = io.scratch_folder(spark, "csv")
    io.write_csv(sample.raw_demographics(spark, folder), path, sep=";")
    return io.read_csv(spark, path, sep=";")


def _careless_csv(spark: SparkSession, folder: str) -> str:
    path = io.scratch_folder(spark, "csv")
    io.write_csv(sample.raw_demographics_text(spark, folder), path, sep=";")
    return path


def csv_careless_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Padded, decimal and grouped figures read as numbers."""
    return io.read_csv(spark, _careless_csv(spark, folder), RAW_DEMOGRAPHICS, sep=";")


def dq_bad_numbers(spark: SparkSession, folder: str) -> DataFrame:
    text = io.read_csv_text(spark, _careless_csv(spark, folder), RAW_DEMOGRAPHICS, sep=";")
    bad = io.bad_numbers(text, RAW_DEMOGRAPHICS)
    return op.bad_number_report("demographics", text, bad)


# The yearly load


# Keys and numbers of the sample are not checked: it has codes that are no numbers and arrivals
# without date.
ANY_KEYS = [op.TableRule(rule.table) for rule in op.DEFAULT_RULES]


def _loaded(spark: SparkSession, folder: str) -> tuple[Inputs, Lake]:
    """The sample tables as landing files, loaded into a new lake."""
    files = {
        "ports": (sample.raw_ports, ","),
        "visas": (sample.raw_visas, ","),
        "countries": (sample.raw_countries, ","),
        "cities": (sample.raw_demographics, ";"),
    }
    paths = []
    for name, (rows, sep) in files.items():
        paths.append(io.scratch_folder(spark, name))
        io.write_csv(rows(spark, folder), paths[-1], sep=sep)
    landing = _landed(spark, sample.raw_arrivals(spark, folder))
    lake = Lake(io.scratch_folder(spark, "lake"), io.scratch_folder(spark, "summaries"))
    source = Inputs(landing, *paths, month_file=LANDED_FILE)
    load_year(spark, 2016, source, lake, ANY_KEYS, check_numbers=False)
    return source, lake


def _corrected(spark: SparkSession, folder: str) -> tuple[Inputs, Lake]:
    """The loaded lake, and February's file landed anew without records of unknown age."""
    source, lake = _loaded(spark, folder)
    february = io.month_paths(source.arrivals, 2016, name=LANDED_FILE)[1]
    corrected = io.scratch_folder(spark, "corrected")
    # by a folder beside it, as a table that is read cannot be overwritten
    io.overwrite(io.read_table(spark, february, RAW_ARRIVALS).where("i94bir IS NOT NULL"), corrected)
    io.overwrite(io.read_table(spark, corrected, RAW_ARRIVALS), february)
    return source, lake


def _reload(name: str) -> Query:
    """A table or summary after the corrected month was loaded."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        source, lake = _corrected(spark, folder)
        load_year(spark, 2016, source, lake, ANY_KEYS, check_numbers=False)
        return {**read_lake(spark, lake), **read_summaries(spark, lake)}[name]

    return query


def failed_load_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact after a load of the corrected month that the checks stopped: as it was."""
    source, lake = _corrected(spark, folder)
    try:
        load_year(spark, 2016, source, lake, check_numbers=False)
    except op.DataQualityError:
        return read_lake(spark, lake)["immigration_fact"]
    raise AssertionError("the sample has arrivals without date")


def load_year_fact(spark: SparkSession, folder: str) -> DataFrame:
    return read_lake(spark, _loaded(spark, folder)[1])["immigration_fact"]


def _load_summary(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return read_summaries(spark, _loaded(spark, folder)[1])[name]

    return query


def dq_failures(spark: SparkSession, folder: str) -> DataFrame:
    """The failing lines that stop a run over raw tables: repeated and null keys, no rows."""
    countries = sample.raw_countries(spark, folder)
    tables = {
        "countries": countries.withColumn("code", fn.text_to_int("Country_code")),
        "visas": sample.raw_visas(spark, folder),
        "ports": sample.raw_ports(spark, folder).where("Code is null"),
    }
    rules = [
        op.TableRule("countries", ("code",), unique=True),
        op.TableRule("visas", ("Visa Type",), unique=True),
        op.TableRule("ports", ("Code",)),
    ]
    try:
        op.enforce(tables, rules)
    except op.DataQualityError as error:
        return spark.createDataFrame(
            error.failures,
            "table_name string, check_name string, column_name string, passed boolean, "
            "bad_rows long",
        )
    raise AssertionError("the raw tables have faults")


# Answers


def top_visas(spark: SparkSession, folder: str) -> DataFrame:
    return answers.top_visas(_fact(spark, folder), _visas(spark, folder), k=3)


def top_ports(spark: SparkSession, folder: str) -> DataFrame:
    return answers.top_ports(_fact(spark, folder))


def top_countries(spark: SparkSession, folder: str) -> DataFrame:
    return answers.top_countries(_fact(spark, folder), _countries(spark, folder), k=3)


def weekday_trend(spark: SparkSession, folder: str) -> DataFrame:
    fact = _fact(spark, folder)
    return answers.weekday_trend(fact, dims.dim_dates(fact))


def monthly_inflow(spark: SparkSession, folder: str) -> DataFrame:
    return answers.monthly_inflow(_fact(spark, folder))


def busiest_days(spark: SparkSession, folder: str) -> DataFrame:
    return answers.busiest_days(_fact(spark, folder))


def city_inflow_demographics(spark: SparkSession, folder: str) -> DataFrame:
    return answers.city_inflow_demographics(_fact(spark, folder), _cities(spark, folder))


# Decoding


def _customers_with_country(spark: SparkSession, folder: str, out: str) -> DataFrame:
    code = F.when(F.col("c_acctbal") < 0, 999).otherwise(F.col("c_nationkey"))
    customers = sample.table(spark, folder, "customer")
    coded = customers.select("c_custkey", code.alias("code"))
    return op.decode(coded, sample.country_codes(spark, folder), "code", out)


def decode_country(spark: SparkSession, folder: str) -> DataFrame:
    return _customers_with_country(spark, folder, "country")


def decode_port(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("l_suppkey") + F.col("l_linenumber")
    lines = sample.table(spark, folder, "lineitem").select("l_orderkey", code.alias("port_code"))
    return op.decode(lines, sample.port_codes(spark, folder), "port_code", "port")


def decode_mode(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("l_linenumber")
    code = F.when(number > 3, number + 2).otherwise(number)
    lines = sample.table(spark, folder, "lineitem").select("l_orderkey", code.alias("code"))
    return lines.withColumn("label", fn.decode_mode("code"))


def decode_state_default(spark: SparkSession, folder: str) -> DataFrame:
    letters = [F.char(F.lit(65) + F.col(c) % 26) for c in ("l_partkey", "l_suppkey")]
    lines = sample.table(spark, folder, "lineitem").select(
        "l_orderkey", F.concat(*letters).alias("state_code")
    )
    return op.decode(
        lines, op.state_labels(spark), "state_code", "state", default=op.OTHER_STATE
    )


def decode_visa_category(spark: SparkSession, folder: str) -> DataFrame:
    lines = sample.table(spark, folder, "lineitem")
    coded = lines.select("l_orderkey", F.col("l_linenumber").alias("code"))
    return coded.withColumn("label", fn.decode_visa_category("code"))


def split_port_label(spark: SparkSession, folder: str) -> DataFrame:
    name = F.upper("p_name")
    label = (
        F.when(F.col("p_size") > 35, F.concat(name, F.lit("  ")))
        .when(F.col("p_size") > 15, F.concat(name, F.lit(", "), "p_type", F.lit("   ")))
        .otherwise(F.concat(name, F.lit(", "), "p_brand", F.lit(", "), "p_type"))
    )
    labels = sample.table(spark, folder, "part").select("p_partkey", label.alias("label"))
    return op.split_port_label(labels, "label")


def classify_code(spark: SparkSession, folder: str) -> DataFrame:
    labelled = _customers_with_country(spark, folder, "label").drop("code")
    return op.with_code_class(labelled, "label")


def entry(spark: SparkSession) -> DataFrame:
    """Counted arrivals at the smallest scale."""
    return _fact(spark, "/root/testdata/sf0.001")


def core_queries() -> dict[str, Query]:
    return {
        "clean_code": _document_text(fn.clean_code),
        "clean_state_code": _document_text(fn.clean_state_code),
        "clean_city_text": _document_text(fn.clean_city_text),
        "clean_state_text": _document_text(fn.clean_state_text),
        "collapse_spaces": collapse_spaces,
        "ascii_only": _document_text(fn.ascii_only),
        "sas_date": sas_date,
        "age_group": age_group,
        "project_arrivals": project_arrivals,
        "rename_columns": rename_columns,
        "filter_mode": filter_mode,
        "typed_arrivals": _clean,
        "distinct_rows": distinct_rows,
        "distinct_projected": distinct_projected,
        "dedupe_by_key": dedupe_by_key,
        "dedupe_by_two_keys": dedupe_by_two_keys,
        "arrivals_month_union": arrivals_month_union,
        "dim_visas": _visas,
        "dim_countries": _countries,
        "dim_cities": _cities,
        "dim_ports": _ports,
        "dim_dates": _dates,
        "join_port": join_port,
        "fact_arrivals": _fact,
        "fact_head_count": fact_head_count,
        "stats_weekday": stats_weekday,
        "stats_visa": stats_visa,
        "stats_country": stats_country,
        "stats_city": stats_city,
        "dq_row_counts": dq_row_counts,
        "dq_null_keys": dq_null_keys,
        "dq_report": dq_report,
        "csv_roundtrip": csv_roundtrip,
        "csv_semicolon_roundtrip": csv_semicolon_roundtrip,
        "csv_inferred": csv_inferred,
        "csv_careless_numbers": csv_careless_numbers,
        "dq_bad_numbers": dq_bad_numbers,
        "dq_failures": dq_failures,
        "fact_two_month_files": fact_two_month_files,
        "load_year_fact": load_year_fact,
        "load_year_weekday": _load_summary("weekday"),
        "load_year_visa": _load_summary("visa"),
        "load_year_country": _load_summary("country"),
        "load_year_city": _load_summary("city"),
        "reload_month_fact": _reload("immigration_fact"),
        "reload_month_dates": _reload("arrival_dates"),
        "reload_month_weekday": _reload("weekday"),
        "reload_month_visa": _reload("visa"),
        "reload_month_country": _reload("country"),
        "reload_month_city": _reload("city"),
        "failed_load_fact": failed_load_fact,
        "sink_overwrite_readback": sink_overwrite_readback,
        "sink_append_readback": sink_append_readback,
        "sink_partitioned_readback": sink_partitioned_readback,
        "top_visas": top_visas,
        "top_ports": top_ports,
        "top_countries": top_countries,
        "weekday_trend": weekday_trend,
        "monthly_inflow": monthly_inflow,
        "busiest_days": busiest_days,
        "city_inflow_demographics": city_inflow_demographics,
        "decode_country": decode_country,
        "decode_port": decode_port,
        "decode_mode": decode_mode,
        "decode_state_default": decode_state_default,
        "decode_visa_category": decode_visa_category,
        "split_port_label": split_port_label,
        "classify_code": classify_code,
    }


def core_oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


def queries() -> dict[str, Query]:
    return {**core_queries(), **LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**core_oracle_sql(), **LLM_ORACLE}
