"""Sections and web addresses in free text.

Document and page texts get headings and addresses put around them, the same way
in the query and in the SQL.
"""

from pyspark.sql import functions as F

from edupipe.catalog.registry import query
from edupipe.functions import links, sections
from edupipe.plans import scholarships

_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def _joined(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


_OVERVIEW_SQL = """'About' || chr(10) || 'Programme Description' || chr(10) || ' ' || text || chr(10) || 'Duration' || chr(10)
    || n_chars || ' months' || chr(10) || 'Scholarship Value' || chr(10) || source || ' EUR ' || chr(10) || chr(10)
    || 'APPLICATION PAPERS' || chr(10) || 'CV ' || lang || chr(10) || 'Application Deadline' || chr(10) || '31/12/2025'"""


def _section_sql(headings, stops):
    return _STRIP.format(f"regexp_extract(o, '(?is){headings}\\n(.*?)\\n(?:{stops})\\n', 1)")


@query(
    "extract_section",
    f"""SELECT doc_id,
          {_section_sql('(?:programme description|program description)', 'target group|academic requirements|duration|number of|scholarship value|application papers|application deadline')} AS description,
          {_section_sql(chr(92) + 'nduration', 'scholarship value|number of scholarships|application papers|application deadline')} AS duration,
          {_section_sql(chr(92) + 'n(?:scholarship' + chr(92) + 's+value|value)', 'selection|further information|to allow you|please note|application papers')} AS funding_info,
          {_section_sql(chr(92) + 'napplication papers', 'application deadline|number of|duration|scholarship value')} AS documents,
          'not specified' AS exams
        FROM (SELECT doc_id, {_OVERVIEW_SQL} AS o FROM documents)""",
)
def extract_section(t):
    overview = _joined(
        "About\nProgramme Description\n ", F.col("text"), "\nDuration\n", F.col("n_chars").cast("string"),
        " months\nScholarship Value\n", F.col("source"), " EUR \n\nAPPLICATION PAPERS\nCV ", F.col("lang"),
        "\nApplication Deadline\n31/12/2025",
    )
    o, none = F.col("o"), F.lit(None).cast("string")
    return t.documents.select("doc_id", overview.alias("o")).select(
        "doc_id",
        sections.description(o).alias("description"),
        sections.duration(o).alias("duration"),
        sections.funding_info(o).alias("funding_info"),
        sections.documents(none, o).alias("documents"),
        sections.requirements(F.lit("N/A"), o).alias("exams"),
    )


@query(
    "extract_section_fallback",
    """SELECT doc_id,
         CASE WHEN lang = 'en' THEN '1 May of ' || source WHEN lang IN ('fr', 'es') THEN n_chars || ' days' ELSE 'not specified' END AS deadline,
         CASE WHEN lang = 'en' THEN 'CV and ' || source ELSE 'not specified' END AS documents,
         CASE WHEN lang IN ('fr', 'es') THEN 'full' ELSE 'not specified' END AS funding_info,
         CASE WHEN lang IN ('fr', 'es') THEN 'as above' WHEN lang = 'en' THEN 'B2' ELSE 'not specified' END AS exams
       FROM documents""",
)
def extract_section_fallback(t):
    lang = F.col("lang")
    procedure = (
        F.when(lang == "en", _joined(
            "Steps\nApplication deadline: 1 May of ", F.col("source"), "\nApplication documents:\nCV and ", F.col("source"),
            "\nPlease note\nnothing",
        ))
        .when(lang == "fr", "Steps only")
        .when(lang == "es", "Application deadline:\n\nApplication location\nhere")
    )
    tail = _joined(
        "\nAcademic Requirements\nas above\nApplication Deadline\n", F.col("n_chars").cast("string"),
        " days\nDuration\n2 years\nValue\nfull\nSelection\n",
    )
    overview = F.when(lang.isin("fr", "es"), F.concat("text", tail)).otherwise(F.col("text"))
    requirements = F.when(lang == "en", " B2 ").when(lang == "fr", "N/A")
    p, o = F.col("p"), F.col("o")
    return t.documents.select("doc_id", procedure.alias("p"), overview.alias("o"), requirements.alias("r")).select(
        "doc_id",
        sections.deadline(p, o).alias("deadline"),
        sections.documents(p, o).alias("documents"),
        sections.funding_info(o).alias("funding_info"),
        sections.requirements(F.col("r"), o).alias("exams"),
    )


@query(
    "extract_urls",
    """SELECT page_id, CASE page_id % 4
         WHEN 0 THEN 'https://www.daad.de/en/' || page_id
         WHEN 1 THEN 'https://tu-berlin.de/' || page_id || '/en; https://www.uni-bonn.de/en/' || page_id || '.html'
         WHEN 2 THEN 'https://www.bafög.de' ELSE 'not specified' END AS website FROM pages""",
)
def extract_urls(t):
    kind, number = F.col("page_id") % 4, F.col("page_id").cast("string")
    contact = (
        F.when(kind == 0, _joined("See https://www.daad.de/en/", number, ", or (www.daad.de/en/", number, "/)."))
        .when(kind == 1, _joined(
            "http://uni-bonn.de/page", number, " https://tu-berlin.de/", number, "/en) www.uni-bonn.de/en/", number, ".html;",
        ))
        .when(kind == 2, "Ask for BAföG")
    )
    return t.pages.select(
        "page_id", links.extract_websites([contact, F.col("html"), F.col("url"), F.lit("")]).alias("website")
    )


_CLEAN = r"regexp_replace(regexp_replace(lower({}), '^\s+|\s+$', '', 'g'), '\s{{2,}}', ' ', 'g')"
_LEVEL = "CASE lang WHEN 'en' THEN 'Master' WHEN 'de' THEN 'Bachelor' WHEN 'fr' THEN 'PhD' ELSE 'Faculty' END"


@query(
    "trusted_records",
    f"""SELECT doc_id || ' ' || lower(source) AS scholarship_name, {_CLEAN.format("text")} AS description, 'germany' AS program_country,
          CASE WHEN doc_id % 3 = 0 THEN 'france' ELSE 'spain' END AS origin_country, lower(source) || ' eur' AS funding_info,
          lower({_LEVEL}) AS program_level,
          CASE lang WHEN 'en' THEN 'bachelor' WHEN 'de' THEN 'high school diploma' WHEN 'fr' THEN 'master' ELSE '-' END AS required_level,
          CASE WHEN lang = 'en' THEN '1 may' ELSE '31/12/2025' END AS deadline, 'fall' AS intake,
          CASE WHEN lang = 'de' THEN 'abitur' ELSE 'not specified' END AS exams, 'maths ' || lang AS fields_of_study,
          n_chars || ' months' AS duration, 'cv ' || lang AS documents, 'not specified' AS website,
          CASE WHEN lang = 'fr' THEN 'Write' ELSE 'not specified' END AS instructions
        FROM documents WHERE doc_id % 7 <> 0""",
)
def trusted_records(t):
    """The whole projection, on texts without links; every seventh record lacks a field that it must have."""
    overview = _joined(
        "About\nProgramme Description\n ", F.col("text"), "\nDuration\n", F.col("n_chars").cast("string"),
        " months\nScholarship Value\n", F.col("source"), " EUR \n\nAPPLICATION PAPERS\nCV ", F.col("lang"),
        "\nApplication Deadline\n31/12/2025\n",
    )
    lang = F.col("lang")
    raw = t.documents.select(
        F.concat(F.col("doc_id").cast("string"), F.lit(" "), "source").alias("Name"),
        F.when(F.col("doc_id") % 3 == 0, " France ").otherwise("Spain").alias("Country of Origin"),
        F.when(F.col("doc_id") % 7 == 0, "N/A").when(lang == "en", "Master").when(lang == "de", "Bachelor").when(lang == "fr", "PhD").otherwise("Faculty").alias("Status"),
        F.concat(F.lit("Maths  "), lang).alias("Fields of Study"),
        overview.alias("Overview"),
        F.when(lang == "de", "Abitur ").otherwise("N/A").alias("Application Requirements"),
        F.when(lang == "en", "Application Deadline: 1 May\n").alias("Application Procedure"),
        F.when(lang == "fr", "Write").otherwise("N/A").alias("Application Instructions"),
        F.lit(None).cast("string").alias("Contact Information"),
    )
    found = scholarships.trusted(raw).drop("last_updated_utc")
    return found.withColumn("required_level", F.coalesce("required_level", F.lit("-")))
