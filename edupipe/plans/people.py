"""From raw profiles to standard profiles, facets, and a person graph."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.functions import arrays
from edupipe.functions.text import lower_trim
from edupipe.functions.values import email_or_null, enum_or_null, first_number, int_in_range_or_null, lenient_int, reference_value_or_null
from edupipe.operators import graph, nested, relational, vectors

# array -> (field that stays unique, greater-is-better fields)
UNIQUE_FIELDS = {
    "skills": ("name", ()),
    "courses": ("course_name", ()),
    "honors": ("honor", ()),
    "languages": ("language", ()),
    "educations": ("institution_name", ("graduation_year",)),
    "licenses": ("license_name", ("issued_year",)),
    "experiences": ("company_name", ()),
}

# facet -> (array, output name -> element field)
FACETS: Mapping[str, tuple[str, Mapping[str, str]]] = {
    "languages": ("languages", {"language": "language", "level": "level"}),
    "skills": ("skills", {"skill": "name"}),
    "education": (
        "educations",
        {"degree": "degree", "institution": "institution_name", "graduation_year": "graduation_year", "program_name": "major"},
    ),
    "certificates": (
        "licenses", {"certification_name": "license_name", "associated_with": "institute_name", "date": "issued_year"},
    ),
    "honors": ("honors", {"honor_name": "honor"}),
}

# edge type -> (facet, item column, properties)
EDGES = {
    "SPEAKS": ("languages", "language", ("level",)),
    "HAS_SKILL": ("skills", "skill", ()),
    "HAS_DEGREE": ("education", "program_name", ("degree", "institution", "graduation_year")),
    "HAS_CERTIFICATION": ("certificates", "certification_name", ("associated_with", "date")),
    "HAS_HONOR": ("honors", "honor_name", ()),
    "WORKED_AT": ("experiences", "company_name", ("role", "duration")),
}


def _rebuild(array: str, fields: Callable[[Column], Mapping[str, Column]]) -> Column:
    return F.transform(array, lambda x: F.struct(*[c.alias(name) for name, c in fields(x).items()]))


def standardise(profiles: DataFrame, countries: DataFrame, country_column: str) -> DataFrame:
    """Clean and validate every field, and keep one element per name in every array.

    All arrays are treated inside their row; only the country list is joined.
    """
    def designation(d: Column) -> Column:
        return F.struct(lower_trim(d["designation"]).alias("role"), first_number(d["duration"]).alias("duration"))

    clean = profiles.withColumns(
        {
            "name": lower_trim(F.col("name")),
            "email": email_or_null(F.col("email")),
            "age": int_in_range_or_null(F.col("age"), *fv.AGE_RANGE),
            "experiences": _rebuild("experiences", lambda x: {
                "company_name": lower_trim(x["company_name"]),
                "designations": F.transform(x["designations"], designation),
            }),
            "educations": _rebuild("educations", lambda x: {
                "institution_name": lower_trim(x["college"]),
                "degree": enum_or_null(x["degree"], fv.DEGREES),
                "graduation_year": lenient_int(x["graduation_year"]).try_cast("int"),
                "major": lower_trim(x["major"]),
            }),
            "licenses": _rebuild("licenses", lambda x: {
                "license_name": lower_trim(x["name"]),
                "institute_name": lower_trim(x["institute"]),
                "issued_year": lenient_int(x["issued_date"]).try_cast("int"),
            }),
            "languages": _rebuild("languages", lambda x: {
                "language": lower_trim(x["name"]),
                "level": enum_or_null(x["level"], fv.LANGUAGE_LEVELS),
            }),
            "skills": _rebuild("skills", lambda x: {"name": lower_trim(x["name"])}),
            "courses": _rebuild("courses", lambda x: {
                "course_name": lower_trim(x["course_name"]), "association_name": lower_trim(x["associated_with"]),
            }),
            "honors": _rebuild("honors", lambda x: {"honor": lower_trim(x["honor_name"])}),
        }
    )
    clean = reference_value_or_null(clean, "country", countries, country_column, fv.COUNTRY_PATTERN)
    clean = arrays.dedupe_in_array(clean, "skills", "name")
    clean = arrays.dedupe_in_array(clean, "courses", "course_name")
    clean = arrays.dedupe_in_array(clean, "honors", "honor")
    clean = arrays.keep_highest_in_array(clean, "languages", "language", "level", fv.LANGUAGE_RANK)
    clean = arrays.keep_latest_in_array(clean, "educations", "institution_name", "graduation_year")
    clean = arrays.keep_latest_in_array(clean, "licenses", "license_name", "issued_year")
    return arrays.keep_longest_in_array(clean, "experiences", "company_name", "designations", "duration")


def one_per_person(standard: DataFrame, null_key: str = "drop") -> DataFrame:
    """One profile per email.

    Profiles without a valid email are left out (``drop``), or become one profile (``collapse``), which
    gathers their distinct names in one row.  Scalars come from the least (name, url) row that has them.
    """
    if null_key not in ("collapse", "drop"):
        raise ValueError(null_key)
    rows = standard if null_key == "collapse" else standard.where("email is not null")
    scalars = [c for c in ("url", "name", "age", "country") if c in rows.columns]
    order = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("name", "url") if c in rows.columns]
    return nested.merge_same_key(rows, "email", UNIQUE_FIELDS, scalars, order)


def facets(standard: DataFrame) -> dict[str, DataFrame]:
    """The facet tables, each keyed by email; people without an element have no row."""
    tables = {name: nested.facet(standard, "email", array, fields) for name, (array, fields) in FACETS.items()}
    tables["experiences"] = nested.facet_two_level(
        standard, "email", "experiences", "designations", {"company_name": "company_name"},
        {"role": "role", "duration": "duration"},
    )
    return tables


def edges(facet_tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Edge tables of the facets; repeated elements keep their greatest property values."""
    out = {}
    for kind, (facet, item, properties) in EDGES.items():
        rows = facet_tables[facet].select("email", F.trim(F.col(item)).alias("item"), *properties)
        order = [F.col(p) for p in properties]
        out[kind] = graph.upsert_edges(rows, kind, "email", "item", properties, order)
    return out


# --- basic records of users and alumni ----------------------------------------


def _person(records: DataFrame, extra: Mapping[str, Column]) -> DataFrame:
    return records.select(
        F.trim("Email").alias("email"),
        F.trim("Name").alias("name"),
        lenient_int(F.col("Age")).try_cast("int").alias("age"),
        F.trim("Gender").alias("gender"),
        *[c.alias(name) for name, c in extra.items()],
    ).where("email is not null")


def basic_people(users: DataFrame, alumni: DataFrame) -> DataFrame:
    """One person per email; alumni records overwrite the fields both have."""
    of_users = _person(users, {"plan": F.trim("Plan")})
    of_alumni = _person(alumni, {"status": F.trim("Status")})
    by = [F.col(c) for c in ("name", "age", "gender")]
    return relational.merge_records([of_users, of_alumni], "email", [by, by])


def basic_edges(users: DataFrame, alumni: DataFrame) -> dict[str, DataFrame]:
    """Where people live, and which scholarship alumni had in which year."""
    lives = [r.select(F.trim("Email").alias("email"), F.trim("Country").alias("item")) for r in (users, alumni)]
    held = alumni.select(
        F.trim("Email").alias("email"),
        F.trim("Associeted_Scholarship").alias("item"),
        lenient_int(F.col("Year_Scholarship")).try_cast("int").alias("year_recipient"),
    )
    return {
        "LIVES_IN": graph.upsert_edges(lives[0].unionByName(lives[1]), "LIVES_IN", "email", "item"),
        "HAS_SCHOLARSHIP": graph.upsert_edges(
            held, "HAS_SCHOLARSHIP", "email", "item", ["year_recipient"], [F.col("year_recipient")]
        ),
    }


def embedding_index(people: DataFrame, edges: DataFrame, embeddings: DataFrame) -> DataFrame:
    """(email, embedding, status, scholarship_id): what similar-people searches read.

    embeddings(node, embedding) come from walks; people without one are left out.
    """
    marked = graph.person_status(people.select("email"), "email", edges, "src", "dst")
    return marked.join(
        embeddings.where("node like 'person:%'").select(F.expr("substring(node, 8)").alias("email"), "embedding"), "email"
    )


def similar_people(index: DataFrame, email: str, k: int = fv.TOP_PEOPLE) -> DataFrame:
    """The nearest users who are not alumni."""
    return vectors.top_k(index, "email", "embedding", email, k, F.col("status") == "user")


def similar_alumni(index: DataFrame, email: str, scholarship: str, k: int = fv.TOP_PEOPLE) -> DataFrame:
    """The nearest alumni of a scholarship."""
    wanted = (F.col("status") == "alumni") & (F.col("scholarship_id") == scholarship)
    return vectors.top_k(index, "email", "embedding", email, k, wanted)
