"""Array columns.  The arrays are made inside each row (words, lines, names), so
nothing has to be gathered from other rows."""

from functools import reduce

from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.catalog.registry import query
from edupipe.functions import arrays, values
from edupipe.operators import nested
from edupipe.plans import people, shapes
from edupipe.plans.people import standardise
from edupipe.session import materialise


def _words(t, *fields):
    """doc_id and its words as structs."""
    return t.documents.select("doc_id", shapes.piece_structs(F.split("text", " "), *fields).alias("words"))


def _listed(df, *fields):
    """The surviving elements as one text."""
    shown = F.transform("words", lambda w: F.concat_ws(":", *[w[f].cast("string") for f in fields]))
    return df.select("doc_id", F.coalesce(F.array_join(shown, " "), F.lit("-")).alias("kept"))


_PIECES_SQL = """SELECT doc_id, pos, word, coalesce(right(lower(word), 1), '') AS name, length(word) AS n,
    CASE WHEN length(word) > 6 THEN 'advanced' WHEN length(word) > 3 THEN 'intermediate' ELSE 'beginner' END AS level
  FROM (SELECT doc_id, unnest(string_split(text, {0})) AS word, generate_subscripts(string_split(text, {0}), 1) AS pos FROM documents)"""
_WORDS_SQL = _PIECES_SQL.format("' '")
_LINES_SQL = _PIECES_SQL.format("chr(10)")


def _best_sql(key, order, shown):
    return f"""SELECT doc_id, string_agg({shown}, ' ' ORDER BY pos) AS kept FROM (
        SELECT * FROM ({_WORDS_SQL}) QUALIFY row_number() OVER (PARTITION BY doc_id, {key} ORDER BY {order}pos) = 1)
      GROUP BY doc_id"""


@query("nested_dedupe", _best_sql("lower(word)", "", "word"))
def nested_dedupe(t):
    return _listed(arrays.dedupe_in_array(_words(t, "word", "lower"), "words", "lower"), "word")


@query("nested_keep_highest", _best_sql("name", "CASE level WHEN 'advanced' THEN 3 WHEN 'intermediate' THEN 2 ELSE 1 END DESC, ", "name || ':' || level || ':' || word"))
def nested_keep_highest(t):
    kept = arrays.keep_highest_in_array(_words(t, "name", "level", "word"), "words", "name", "level", fv.LANGUAGE_RANK)
    return _listed(kept, "name", "level", "word")


@query("nested_keep_latest", _best_sql("name", "CASE WHEN n % 5 = 0 THEN NULL ELSE 2000 + n END DESC NULLS LAST, ", "name || ':' || word"))
def nested_keep_latest(t):
    return _listed(arrays.keep_latest_in_array(_words(t, "name", "year", "word"), "words", "name", "year"), "name", "word")


@query("nested_keep_longest", _best_sql("name", "CASE WHEN n % 4 = 0 THEN NULL ELSE n + 0.5 END DESC NULLS LAST, ", "name || ':' || word"))
def nested_keep_longest(t):
    kept = arrays.keep_longest_in_array(_words(t, "name", "word", "designations"), "words", "name", "designations", "duration")
    return _listed(kept, "name", "word")


@query(
    "nested_transform",
    r"""SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l: length(l) || '=' ||
          array_to_string(list_transform(string_split(l, ' '), lambda w: lower(trim(w)) || '/' ||
            coalesce(CAST(TRY_CAST(trunc(TRY_CAST(nullif(regexp_extract(w, '([0-9]+(?:\.[0-9]+)?)', 1), '') AS DOUBLE)) AS BIGINT) AS VARCHAR), '')), ',')), '|') AS rebuilt
        FROM documents""",
)
def nested_transform(t):
    def word(w):
        number = values.lenient_int(values.first_number(w, type_name="double"))
        return F.struct(F.lower(F.trim(w)).alias("role"), number.alias("duration"))

    def line(x):
        return F.struct(F.length(x).alias("company"), F.transform(F.split(x, " "), word).alias("designations"))

    rebuilt = t.documents.select("doc_id", F.transform(F.split("text", "\n"), line).alias("experiences"))
    shown = F.transform(
        "experiences",
        lambda e: F.concat(
            e["company"].cast("string"),
            F.lit("="),
            F.array_join(
                F.transform(
                    e["designations"],
                    lambda d: F.concat(d["role"], F.lit("/"), F.coalesce(d["duration"].cast("string"), F.lit(""))),
                ),
                ",",
            ),
        ),
    )
    return rebuilt.select("doc_id", F.array_join(shown, "|").alias("rebuilt"))


@query(
    "explode_keep_empty",
    """SELECT d.doc_id, coalesce(w.word, '-') AS word FROM documents d LEFT JOIN (
         SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) w ON w.doc_id = d.doc_id AND contains(w.word, '@')""",
)
def explode_keep_empty(t):
    with_at = F.filter(F.split("text", " "), lambda w: F.contains(w, F.lit("@")))
    rows = nested.explode_keep_empty(t.documents.select("doc_id", with_at.alias("words")), "words", "word")
    return rows.select("doc_id", F.coalesce("word", F.lit("-")).alias("word"))


@query("facet_rows", f"SELECT doc_id, name AS skill, level FROM ({_WORDS_SQL})")
def facet_rows(t):
    return nested.facet(_words(t, "name", "level"), "doc_id", "words", {"skill": "name", "level": "level"})


@query(
    "facet_two_level",
    """SELECT doc_id, length(line) AS company_name, lower(trim(w)) AS role
       FROM (SELECT doc_id, line, unnest(string_split(line, ' ')) AS w
             FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents))""",
)
def facet_two_level(t):
    def line(x):
        roles = F.transform(F.split(x, " "), lambda w: F.struct(F.lower(F.trim(w)).alias("role")))
        return F.struct(F.length(x).alias("company"), roles.alias("designations"))

    nested_lines = t.documents.select("doc_id", F.transform(F.split("text", "\n"), line).alias("experiences"))
    return nested.facet_two_level(
        nested_lines, "doc_id", "experiences", "designations", {"company_name": "company"}, {"role": "role"}
    )


@query(
    "lower_array",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN '' ELSE lower(replace(p_name, ' ', '|') || '|' || p_type) END AS names FROM part""",
)
def lower_array(t):
    names = F.concat(F.split(F.initcap("p_name"), " "), F.array(F.concat(F.lit(" "), "p_type", F.lit("\n"))))
    given = F.when(F.col("p_size") <= 40, names)
    return t.part.select("p_partkey", F.array_join(arrays.lower_array(given), "|").alias("names"))


@query(
    "fill_from_longest",
    """WITH given AS (
         SELECT p_partkey, CASE WHEN p_size > 40 THEN NULL WHEN p_size > 30 THEN []
                ELSE list_concat(string_split(p_name, ' '), CASE WHEN p_size > 20 THEN [p_type, ''] ELSE [] END) END AS names FROM part),
       longest AS (SELECT names FROM given WHERE names IS NOT NULL ORDER BY len(names) DESC, array_to_string(names, ',') DESC LIMIT 1),
       filled AS (SELECT p_partkey, CASE WHEN len(names) > 0 THEN names ELSE (SELECT names FROM longest) END AS names FROM given)
       SELECT p_partkey, array_to_string(list_sort(list_distinct(list_transform(list_filter(names, lambda x: x <> ''), lambda x: lower(trim(x))))), '|') AS names
       FROM filled""",
)
def fill_from_longest(t):
    size = F.col("p_size")
    words = F.split("p_name", " ")
    none = F.array().cast("array<string>")
    given = (
        F.when(size > 40, F.lit(None).cast("array<string>")).when(size > 30, none)
        .when(size > 20, F.concat(words, F.array("p_type", F.lit("")))).otherwise(words)
    )
    filled = arrays.fill_from_longest(t.part.select("p_partkey", given.alias("names")), "names")
    return filled.select("p_partkey", F.array_join("names", "|").alias("names"))


@query(
    "argmax_array",
    """SELECT len(words) AS n_words, array_to_string(words, ',') AS words
       FROM (SELECT string_split(text, ' ') AS words FROM documents) ORDER BY 1 DESC, 2 DESC LIMIT 1""",
)
def argmax_array(t):
    longest = arrays.longest_array(t.documents.select(F.split("text", " ").alias("words")), "words")
    return longest.select(F.size("words").alias("n_words"), F.array_join("words", ",").alias("words"))


@query(
    "standardise_profile",
    f"""SELECT d.doc_id, lower(trim(d.source)) AS name,
          CASE WHEN d.lang = 'en' THEN d.source || '.' || d.doc_id || '@gmail.com' ELSE '-' END AS email,
          CASE WHEN d.n_chars % 130 BETWEEN 18 AND 100 THEN CAST(d.n_chars % 130 AS INT) ELSE -1 END AS age,
          CASE d.lang WHEN 'de' THEN 'germany' WHEN 'fr' THEN 'france' ELSE '-' END AS country,
          k.n_skills, s.n_languages, s.n_educations, s.n_experiences, s.n_courses, l.best AS languages, e.latest AS educations
        FROM documents d
        JOIN (SELECT doc_id, count(DISTINCT lower(trim(word))) AS n_skills FROM ({_WORDS_SQL}) GROUP BY doc_id) k ON k.doc_id = d.doc_id
        JOIN (SELECT doc_id, count(DISTINCT trim(name)) AS n_languages, count(DISTINCT trim(name)) AS n_educations,
                     count(DISTINCT trim(name)) AS n_experiences, count(DISTINCT lower(trim(word))) AS n_courses
              FROM ({_LINES_SQL}) GROUP BY doc_id) s ON s.doc_id = d.doc_id
        JOIN (SELECT doc_id, string_agg(trim(name) || ':' || level, ' ' ORDER BY pos) AS best FROM (
                SELECT * FROM ({_LINES_SQL}) QUALIFY row_number() OVER (PARTITION BY doc_id, trim(name)
                  ORDER BY CASE level WHEN 'advanced' THEN 3 WHEN 'intermediate' THEN 2 ELSE 1 END DESC, pos) = 1)
              GROUP BY doc_id) l ON l.doc_id = d.doc_id
        JOIN (SELECT doc_id, string_agg(trim(name) || ':' || coalesce(CAST(year AS VARCHAR), '-'), ' ' ORDER BY pos) AS latest FROM (
                SELECT * FROM (SELECT *, CASE WHEN n % 5 <> 0 THEN 2000 + n END AS year FROM ({_LINES_SQL}))
                QUALIFY row_number() OVER (PARTITION BY doc_id, trim(name) ORDER BY year DESC NULLS LAST, pos) = 1)
              GROUP BY doc_id) e ON e.doc_id = d.doc_id""",
)
def standardise_profile(t):
    profiles = shapes.profiles(t.documents)
    countries = t.spark.createDataFrame([("Germany",), ("France",), ("Spain",)], "name string")
    clean = standardise(profiles, countries, "name")
    return clean.select(
        "doc_id",
        "name",
        F.coalesce("email", F.lit("-")).alias("email"),
        F.coalesce("age", F.lit(-1)).alias("age"),
        F.coalesce("country", F.lit("-")).alias("country"),
        *[F.size(a).cast("long").alias(f"n_{a}") for a in ("skills", "languages", "educations", "experiences", "courses")],
        F.array_join(F.transform("languages", lambda x: F.concat_ws(":", x["language"], x["level"])), " ").alias("languages"),
        F.array_join(
            F.transform(
                "educations",
                lambda x: F.concat_ws(":", x["institution_name"], F.coalesce(x["graduation_year"].cast("string"), F.lit("-"))),
            ),
            " ",
        ).alias("educations"),
    )


_VALID = "SELECT doc_id, lower(source) AS source, lower(source) || '.' || doc_id || '@gmail.com' AS email FROM documents WHERE lang = 'en'"
_YEAR = "CASE WHEN n % 5 <> 0 THEN 2000 + n END"
_RANK = "CASE level WHEN 'advanced' THEN 3 WHEN 'intermediate' THEN 2 ELSE 1 END"


def _countries(t):
    return t.spark.createDataFrame([("Germany",), ("France",), ("Spain",)], "name string")


@query(
    "facet_edges",
    f"""WITH v AS ({_VALID}), l AS (SELECT * FROM ({_LINES_SQL}) JOIN v USING (doc_id)), w AS (SELECT * FROM ({_WORDS_SQL}) JOIN v USING (doc_id))
        SELECT 'SPEAKS' AS type, email AS src, trim(name) AS dst, level AS detail FROM l
          QUALIFY row_number() OVER (PARTITION BY email, trim(name) ORDER BY {_RANK} DESC, pos) = 1
        UNION ALL SELECT DISTINCT 'HAS_SKILL', email, lower(trim(word)), '-' FROM w
        UNION ALL SELECT DISTINCT 'HAS_DEGREE', email, lower(trim(word)), '-' FROM (
          SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY email, trim(name) ORDER BY {_YEAR} DESC NULLS LAST, pos) = 1)
        UNION ALL SELECT DISTINCT 'HAS_CERTIFICATION', email, trim(name), '-' FROM l
        UNION ALL SELECT DISTINCT 'HAS_HONOR', email, trim(name), '-' FROM l
        UNION ALL SELECT DISTINCT 'WORKED_AT', email, trim(name), '-' FROM l""",
)
def facet_edges(t):
    """All six facets of the standard profiles, as typed edges."""
    clean = materialise(people.standardise(shapes.profiles(t.documents), _countries(t), "name"), "standard")  # feeds six facets
    found = people.edges(people.facets(clean))
    rows = [e.select("type", "src", "dst", F.col("level").alias("detail") if kind == "SPEAKS" else F.lit("-").alias("detail")) for kind, e in found.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def _list_sql(shown, rows):
    return f"(SELECT source, string_agg({shown}, '|' ORDER BY {shown}) AS shown FROM ({rows}) GROUP BY source)"


@query(
    "merged_profiles",
    f"""WITH v AS ({_VALID}), l AS (SELECT source, trim(name) AS name, lower(trim(word)) AS word, {_YEAR} AS year FROM ({_LINES_SQL}) JOIN v USING (doc_id)),
          w AS (SELECT source, lower(trim(word)) AS word FROM ({_WORDS_SQL}) JOIN v USING (doc_id)),
          names AS {_list_sql("name", "SELECT DISTINCT source, name FROM l")},
          dated AS {_list_sql("name || ':' || coalesce(CAST(year AS VARCHAR), '-')", "SELECT source, name, max(year) AS year FROM l GROUP BY source, name")},
          courses AS {_list_sql("word", "SELECT DISTINCT source, word FROM l")},
          skills AS {_list_sql("word", "SELECT DISTINCT source, word FROM w")}
        SELECT names.source || '@gmail.com' AS email, md5(skills.shown) AS skills, md5(courses.shown) AS courses, names.shown AS honors, names.shown AS languages,
               names.shown AS experiences, dated.shown AS educations, dated.shown AS licenses
        FROM names JOIN dated USING (source) JOIN courses USING (source) JOIN skills USING (source)""",
)
def merged_profiles(t):
    """Profiles that share an address (the source of their document) become one; all seven arrays are compared."""
    raw = shapes.profiles(t.documents)
    domain = F.element_at(F.split("email", "@"), -1)
    raw = raw.withColumn("email", F.concat(F.split("email", r"\.")[0], F.lit("@"), domain))
    merged = people.one_per_person(materialise(people.standardise(raw, _countries(t), "name"), "standard"))

    def names(array, field, year=None):
        shown = F.transform(array, lambda x: x[field] if year is None else F.concat_ws(":", x[field], F.coalesce(x[year].cast("string"), F.lit("-"))))
        return F.array_join(F.array_sort(shown), "|")

    return merged.select(
        "email", F.md5(names("skills", "name")).alias("skills"), F.md5(names("courses", "course_name")).alias("courses"),
        names("honors", "honor").alias("honors"), names("languages", "language").alias("languages"),
        names("experiences", "company_name").alias("experiences"),
        names("educations", "institution_name", "graduation_year").alias("educations"),
        names("licenses", "license_name", "issued_year").alias("licenses"),
    )
