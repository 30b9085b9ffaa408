"""The test tables in the shapes the operators expect (operators know no table names)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def piece_structs(pieces: Column, *fields: str) -> Column:
    """The pieces of a text (words, lines) as structs of the wanted fields."""
    def element(piece: Column) -> Column:
        n = F.length(piece)
        level = F.when(n > 6, "advanced").when(n > 3, "intermediate").otherwise("beginner")
        duration = F.when(n % 4 != 0, F.concat((n + 0.5).cast("string"), F.lit(" years")))
        made = {
            "word": piece,
            "lower": F.lower(piece),
            "name": F.lower(F.right(piece, F.lit(1))),
            "level": level,
            "year": F.when(n % 5 != 0, n + 2000),
            "designations": F.array(F.struct(piece.alias("designation"), duration.alias("duration"))),
        }
        return F.struct(*[made[field.split("=")[-1]].alias(field.split("=")[0]) for field in fields])

    return F.transform(pieces, element)


def profiles(documents: DataFrame) -> DataFrame:
    """One raw profile per document: skills are its words, the other arrays its lines."""
    words, lines = F.split("text", " "), F.split("text", "\n")
    lang = F.col("lang")
    domain = F.when(lang == "en", "@gmail.com").otherwise("@mail.example")
    return documents.select(
        "doc_id",
        F.concat(F.lit(" "), F.upper("source")).alias("name"),
        F.concat("source", F.lit("."), F.col("doc_id").cast("string"), domain).alias("email"),
        (F.col("n_chars") % 130).cast("string").alias("age"),
        F.when(lang == "de", "Germany").when(lang == "fr", "FRANCE ").when(lang == "es", "Sp4in").otherwise("Atlantis").alias("country"),
        piece_structs(lines, "company_name=name", "designations").alias("experiences"),
        piece_structs(lines, "college=name", "degree=level", "graduation_year=year", "major=word").alias("educations"),
        piece_structs(lines, "name", "institute=word", "issued_date=year").alias("licenses"),
        piece_structs(words, "name=word").alias("skills"),
        piece_structs(lines, "name", "level").alias("languages"),
        piece_structs(lines, "course_name=word", "associated_with=name").alias("courses"),
        piece_structs(lines, "honor_name=name").alias("honors"),
    )


def people_edges(customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> dict[str, DataFrame]:
    """Rows behind the edge types: where customers live, what and from whom they bought."""
    bought = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return {
        "LIVES_IN": customer.select(F.col("c_custkey").alias("person"), F.col("c_nationkey").alias("item")),
        "HAS_SKILL": bought.select(F.col("o_custkey").alias("person"), F.col("l_partkey").alias("item")),
        "WORKED_AT": bought.select(F.col("o_custkey").alias("person"), F.col("l_suppkey").alias("item")),
    }


def clicks(events: DataFrame) -> DataFrame:
    """Site events as click records with their topic; a purchase is a save click."""
    kind = F.col("event_type")
    topic = (
        F.when(kind == "view", "search_events").when(kind == "signup", "filter_events")
        .when(kind == "error", "faq_events").otherwise("details_events")
    )
    element = (
        F.when(kind == "purchase", '"Save" button').when(kind == "click", "Scholarship Details link")
        .when(kind == "error", "FAQ link").otherwise("Search button")
    )
    item = F.concat(F.lit("Scholarship ID: "), F.get_json_object("props", "$.k"))
    parameter = F.when(topic == "details_events", item).otherwise(F.concat(F.lit("Search Input: "), "props"))
    return events.select(
        topic.alias("topic"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp"),
        F.col("user_id").cast("string").alias("User_ID"),
        F.col("event_id").cast("string").alias("Session_ID"),
        F.concat(F.lit("/"), kind).alias("Page"),
        F.col("value").alias("Duration"),
        F.lit("0.0, 0.0").alias("Location"),
        element.alias("Clicked_Element"),
        parameter.alias("Clicked_Parameter"),
    )


def recommendations(events: DataFrame) -> DataFrame:
    """Events as stored recommendations: user, source item, recommended item, score, time."""
    return events.select(
        "user_id",
        F.get_json_object("props", "$.k").cast("int").alias("source_id"),
        F.col("event_id").alias("recommended_id"),
        F.col("value").alias("score"),
        F.col("ts").alias("timestamp"),
        (F.col("event_type") == "signup").alias("clicked"),
    )
