"""From raw scholarship records to trusted, structured and relational tables.

Each step takes and returns DataFrames; nothing passes through the driver, so a
flow is one plan per written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe import fixed_values as fv
from edupipe.functions import arrays, links, records, sections, text, values
from edupipe.operators import dedupe, filters, quality, relational
from edupipe.schemas import STRUCTURED_SCHOLARSHIP
from edupipe.session import materialise
from edupipe.sources import readers, writers


def trusted(raw: DataFrame, updated: Column | None = None) -> DataFrame:
    """Raw records (nine text fields) to the trusted columns.

    The row filters are plain predicates on the scanned columns and reach the scan.
    """
    required = ["Name", "Country of Origin", "Status", "Fields of Study"]
    rows = filters.keep_allowed(filters.drop_placeholders(raw, required), "Status", fv.VALID_STATUSES)
    overview, procedure = F.col("Overview"), F.col("Application Procedure")
    requirements, instructions = F.col("Application Requirements"), F.col("Application Instructions")
    level = text.clean_text(F.col("Status"))
    return rows.select(
        text.clean_text(text.strip_suffix(F.col("Name"), fv.SOURCE_SUFFIX_PATTERN)).alias("scholarship_name"),
        text.clean_text(sections.description(overview)).alias("description"),
        F.lit(fv.PROGRAM_COUNTRY).alias("program_country"),
        text.clean_text(F.col("Country of Origin")).alias("origin_country"),
        text.clean_text(sections.funding_info(overview)).alias("funding_info"),
        level.alias("program_level"),
        values.required_level(level).alias("required_level"),
        text.clean_text(sections.deadline(procedure, overview)).alias("deadline"),
        F.lit(fv.PROGRAM_INTAKE).alias("intake"),
        text.clean_text(sections.requirements(requirements, overview)).alias("exams"),
        text.clean_text(F.col("Fields of Study")).alias("fields_of_study"),
        text.clean_text(sections.duration(overview)).alias("duration"),
        text.clean_text(sections.documents(procedure, overview)).alias("documents"),
        links.extract_websites([F.col("Contact Information"), overview, procedure, requirements]).alias("website"),
        values.placeholder_default(instructions).alias("instructions"),
        values.iso_text(F.current_timestamp() if updated is None else updated).alias("last_updated_utc"),
    )


def grouped(trusted_rows: DataFrame) -> DataFrame:
    """One row per scholarship with its sorted origin countries."""
    return dedupe.collapse_to_list(
        trusted_rows, fv.GROUP_KEYS, "origin_country", "origin_countries", ["last_updated_utc"], ["last_updated_utc"]
    )


def project_texts(blocks: DataFrame, position: str) -> DataFrame:
    """The distinct text blocks of every project page, joined in order."""
    distinct = blocks.select("project", "main_link", position, "text").distinct()
    return dedupe.collect_snippets(distinct, ["project", "main_link"], position, "text")


def prompts(grouped_rows: DataFrame, template: str, sections_of: Sequence[tuple[str, str]]) -> DataFrame:
    """The text that is sent out for extraction, one per row."""
    payload = text.labelled_sections([(label, F.col(c)) for label, c in sections_of])
    return grouped_rows.withColumn("prompt", text.fill_template(template, payload))


def _parsed_answers(answers: DataFrame, wanted: T.StructType) -> DataFrame:
    """Answers with the JSON object found in their text; those without one are left out."""
    found = answers.withColumn("json", records.embedded_json(F.col("answer"))).where("json is not null")
    return found.withColumn("object", records.parse_object(F.col("json"), wanted))


def structured_from_pages(answers: DataFrame, updated: Column) -> DataFrame:
    """Answers (project, main_link, answer text) to structured scholarships.

    The JSON inside the answer is read leniently; name and website fall back to
    the project and its page.  Answers without JSON are left out.
    """
    wanted = T.StructType([f for f in STRUCTURED_SCHOLARSHIP.fields if f.name != "scholarship_id"])
    found = _parsed_answers(answers, wanted)
    coerced = found.select("project", "main_link", "object", *records.coerced_fields(F.col("object"), wanted))

    def given_or(name: str, fallback: Column) -> Column:
        return F.coalesce(F.nullif(F.col("object")[name], F.lit("")), fallback)

    filled = coerced.withColumns(
        {
            "scholarship_name": given_or("scholarship_name", F.col("project")),
            "website": given_or("website", F.col("main_link")),
            "last_updated_utc": given_or("last_updated_utc", F.date_format(updated, fv.DATE_TIME_FORMAT)),
        }
    )
    return filled.withColumn(
        "scholarship_id",
        records.scholarship_id(
            F.col("scholarship_name"), F.col("program_country"), F.col("program_level"), F.col("fields_of_study_code")
        ),
    ).select(*STRUCTURED_SCHOLARSHIP.names)


EXTRACTED = [
    "funding_category", "deadline", "scholarship_coverage", "language_certificates", "fields_of_study_code",
    "study_duration", "gpa", "list_of_universities", "status", "other_information",
]


def structured_from_trusted(answers: DataFrame) -> DataFrame:
    """Grouped trusted rows with an ``answer`` to structured scholarships.

    Descriptive columns come from the row, the others from the JSON in the answer.
    """
    wanted = T.StructType([STRUCTURED_SCHOLARSHIP[c] for c in EXTRACTED])
    found = _parsed_answers(answers, wanted)
    own_id = records.deterministic_id(
        [records.id_text(F.col(c)) for c in ("scholarship_name", "program_country", "program_level", "fields_of_study")]
    )
    return found.select(
        own_id.alias("scholarship_id"),
        "scholarship_name",
        "description",
        F.array("program_country").alias("program_country"),
        F.col("origin_countries").alias("origin_country"),
        *["program_level", "required_level", "intake", "documents", "website", "last_updated_utc"],
        *records.coerced_fields(F.col("object"), wanted, default=""),
    ).select(*STRUCTURED_SCHOLARSHIP.names)


def standardised(structured: DataFrame) -> DataFrame:
    """Canonical levels, lower-case country lists, joined document lists, closed status."""
    filled = arrays.fill_from_longest(structured, "origin_country")
    return filled.withColumns(
        {
            "scholarship_name": F.lower("scholarship_name"),
            "program_country": arrays.lower_array(F.col("program_country")),
            "program_level": values.canonical_level(F.col("program_level")),
            "required_level": values.canonical_level(F.col("required_level")),
            "documents": records.json_array_to_text(F.col("documents")),
            "status": values.status_after_update(F.col("status"), F.col("deadline"), F.col("last_updated_utc")),
        }
    )


def relational_tables(standard: DataFrame, countries: DataFrame) -> dict[str, DataFrame]:
    """The filter and info tables, the three bridges, and the rows kept back.

    countries(country_id, name).  A row whose enumerated columns are null or not
    allowed goes to ``rejected`` and into no other table.
    """
    maps = ("scholarship_coverage", "language_certificates", "other_information")
    typed = standard.withColumns(
        {
            **{c: F.lower(c) for c in ("funding_category", "program_level", "required_level", "intake", "status")},
            "last_updated_utc": values.parse_timestamp(F.col("last_updated_utc")),
            "deadline": values.parse_date(F.col("deadline")),
            **{c: records.map_to_json(F.col(c)) for c in maps},
        }
    )
    rows, rejected = quality.split_accepted(typed, fv.ALLOWED)
    filter_table, info_table = relational.split_columns(rows, relational.FILTER_COLUMNS, relational.INFO_COLUMNS)

    def country_bridge(column: str) -> DataFrame:
        return relational.bridge_to_dimension(rows, "scholarship_id", column, countries, "country_id", "name")

    return {
        "scholarship_filter": filter_table,
        "scholarship_info": info_table,
        "program_country": country_bridge("program_country"),
        "origin_country": country_bridge("origin_country"),
        "scholarship_field_of_study": relational.bridge_values(rows, "scholarship_id", "fields_of_study_code", "field_code"),
        "rejected": rejected,
    }


def load_relational(structured: DataFrame, countries: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Standardise once, write every relational table under ``folder`` and return them as written.

    The standard rows feed six outputs, so they are written to the shared folder first.
    """
    tables = relational_tables(materialise(standardised(structured), "standard"), countries)
    for name, table in tables.items():
        writers.write_parquet(table, f"{folder}/{name}")
    return {name: readers.read_parquet(structured.sparkSession, f"{folder}/{name}") for name in tables}


def violations(tables: dict[str, DataFrame], countries: DataFrame) -> dict[str, DataFrame]:
    """The declared constraints of the relational tables, each as its violating rows."""
    fields = list(fv.FIELDS_OF_STUDY)
    found = {
        "filter_key": quality.duplicate_keys(tables["scholarship_filter"], ["scholarship_id"]),
        "info_key": quality.duplicate_keys(tables["scholarship_info"], ["scholarship_id"]),
        "info_parent": quality.orphans(
            tables["scholarship_info"], "scholarship_id", tables["scholarship_filter"], "scholarship_id"
        ),
        "info_field_codes": quality.array_outside(tables["scholarship_info"], "fields_of_study_code", fields),
        "field_code": quality.outside_accepted(tables["scholarship_field_of_study"], "field_code", fields),
    }
    found["country_name"] = quality.duplicate_keys(countries, ["name"])
    dimensions = {"program_country": "country_id", "origin_country": "country_id", "scholarship_field_of_study": "field_code"}
    for bridge, value in dimensions.items():
        found[f"{bridge}_parent"] = quality.orphans(tables[bridge], "scholarship_id", tables["scholarship_filter"], "scholarship_id")
        found[f"{bridge}_pair"] = quality.duplicate_keys(tables[bridge], ["scholarship_id", value])
        if value == "country_id":
            found[f"{bridge}_dimension"] = quality.orphans(tables[bridge], value, countries, value)
    return found


def embedding_input(standard: DataFrame) -> DataFrame:
    """The text to embed, with the metadata kept next to the vector."""
    lists = ("program_country", "origin_country", "fields_of_study_code")
    fields = [text.list_text(F.col(c)) if c in lists else F.col(c) for c in fv.EMBEDDING_FIELDS]
    return standard.select(
        "scholarship_id",
        text.compose_text(fields).alias("embedding_text"),
        F.col("scholarship_name").alias("name"),
        "program_country", "program_level", "fields_of_study_code", "funding_category", "status",
    )
