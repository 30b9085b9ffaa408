"""Declared schemas of the data sets."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_TEXTS = T.ArrayType(T.StringType())
_PAIRS = T.MapType(T.StringType(), T.StringType())

RAW_SCHOLARSHIP = _strings(
    "Country of Origin", "Name", "Status", "Fields of Study", "Overview",
    "Application Requirements", "Application Procedure", "Application Instructions",
    "Contact Information",
)

STRUCTURED_SCHOLARSHIP = T.StructType(
    [
        T.StructField("scholarship_id", T.StringType()),
        T.StructField("scholarship_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("program_country", _TEXTS),
        T.StructField("origin_country", _TEXTS),
        T.StructField("program_level", T.StringType()),
        T.StructField("required_level", T.StringType()),
        T.StructField("intake", T.StringType()),
        T.StructField("documents", T.StringType()),
        T.StructField("website", T.StringType()),
        T.StructField("last_updated_utc", T.StringType()),
        T.StructField("funding_category", T.StringType()),
        T.StructField("deadline", T.StringType()),
        T.StructField("scholarship_coverage", _PAIRS),
        T.StructField("language_certificates", _PAIRS),
        T.StructField("fields_of_study_code", _TEXTS),
        T.StructField("study_duration", T.StringType()),
        T.StructField("gpa", T.StringType()),
        T.StructField("list_of_universities", _TEXTS),
        T.StructField("status", T.StringType()),
        T.StructField("other_information", _PAIRS),
    ]
)

PAGE_BLOCK = _strings("project", "main_link", "subpage", "tag", "text")

RAW_PROFILE = T.StructType(
    [
        *_strings("url", "name", "email", "age", "country").fields,
        T.StructField(
            "experiences",
            T.ArrayType(
                _strings("company_name").add("designations", T.ArrayType(_strings("designation", "duration")))
            ),
        ),
        T.StructField("educations", T.ArrayType(_strings("college", "degree", "graduation_year", "major"))),
        T.StructField("licenses", T.ArrayType(_strings("name", "institute", "issued_date"))),
        T.StructField("skills", T.ArrayType(_strings("name"))),
        T.StructField("languages", T.ArrayType(_strings("name", "level"))),
        T.StructField("courses", T.ArrayType(_strings("course_name", "associated_with"))),
        T.StructField("honors", T.ArrayType(_strings("honor_name"))),
    ]
)

BASIC_USER = _strings("Age", "Country", "Email", "Gender", "Name", "Plan")
BASIC_ALUMNI = _strings(
    "Age", "Associeted_Scholarship", "Country", "Email", "Gender", "Name", "Status", "Year_Scholarship"
)

CLICK_EVENT = T.StructType(
    [
        *_strings("Timestamp", "User_ID", "Session_ID", "Page").fields,
        T.StructField("Duration", T.DoubleType()),
        *_strings("Location", "Clicked_Element", "Clicked_Parameter").fields,
    ]
)

CLICK_HISTORY = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("page", T.StringType()),
        T.StructField("clicked_element", T.StringType()),
        T.StructField("clicked_parameter", T.StringType()),
        T.StructField("duration", T.FloatType()),
        T.StructField("location", T.StringType()),
    ]
)

RECOMMENDATION = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("recommended_id", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("clicked", T.BooleanType()),
    ]
)
