"""Filters, projections and scalar functions on the test tables."""

from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.catalog.registry import query
from edupipe.functions import records, text, values
from edupipe.operators import filters


@query(
    "filter_placeholders",
    """SELECT c_custkey, c_name, c_mktsegment FROM (
         SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'N/A' ELSE c_name END AS c_name,
                CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE nullif(c_mktsegment, 'HOUSEHOLD') END AS c_mktsegment
         FROM customer)
       WHERE c_name NOT IN ('N/A', 'Unknown', '') AND c_mktsegment NOT IN ('N/A', 'Unknown', '')""",
)
def filter_placeholders(t):
    segment = F.col("c_mktsegment")
    raw = t.customer.select(
        "c_custkey",
        F.when(segment == "MACHINERY", "N/A").otherwise(F.col("c_name")).alias("c_name"),
        F.when(segment == "BUILDING", "").otherwise(F.nullif(segment, F.lit("HOUSEHOLD"))).alias("c_mktsegment"),
    )
    return filters.drop_placeholders(raw, ["c_name", "c_mktsegment"])


@query(
    "filter_allowed_values",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-low')",
)
def filter_allowed_values(t):
    return filters.keep_allowed(
        t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["1-URGENT", "2-HIGH", "5-low"]
    )


@query(
    "normalise_string_columns",
    """SELECT p_partkey, lower(trim(p_name)) AS p_name, lower(trim(p_brand)) AS p_brand,
              lower(trim(p_type)) AS p_type, p_size, p_retailprice FROM part""",
)
def normalise_string_columns(t):
    return filters.normalise_strings(t.part)


@query(
    "drop_incomplete_rows",
    """SELECT event_id, user_id, event_type, value FROM (
         SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, nullif(value, 0.0) AS value FROM events)
       WHERE event_type IS NOT NULL AND value IS NOT NULL""",
)
def drop_incomplete_rows(t):
    holes = t.events.select(
        "event_id",
        "user_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.nullif("value", F.lit(0.0)).alias("value"),
    )
    return filters.drop_incomplete(holes)


@query(
    "project_trusted",
    r"""SELECT doc_id, regexp_replace(trim(lower(text)), '\s{2,}', ' ', 'g') AS description,
               'germany' AS program_country, 'fall' AS intake,
               CASE lang WHEN 'en' THEN 'master' WHEN 'de' THEN 'bachelor' WHEN 'fr' THEN 'phd' ELSE 'faculty' END AS program_level,
               CASE lang WHEN 'en' THEN 'bachelor' WHEN 'de' THEN 'high school diploma' WHEN 'fr' THEN 'master' ELSE '-' END AS required_level
        FROM documents""",
)
def project_trusted(t):
    level = values.map_value(F.col("lang"), {"en": "Master", "de": "Bachelor", "fr": "PhD"})
    trusted = t.documents.select(
        "doc_id",
        text.clean_text(F.col("text")).alias("description"),
        F.lit(fv.PROGRAM_COUNTRY).alias("program_country"),
        F.lit(fv.PROGRAM_INTAKE).alias("intake"),
        text.clean_text(F.coalesce(level, F.lit("Faculty"))).alias("program_level"),
    )
    return trusted.withColumn("required_level", F.coalesce(values.required_level(F.col("program_level")), F.lit("-")))


@query(
    "filter_recent",
    "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 1 HOUR",
)
def filter_recent(t):
    as_of = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return filters.recent(t.events, "ts", as_of, "1 hour").select("event_id", "event_type")


@query(
    "retention_keep_rows",
    "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-29 00:00:00' - INTERVAL 1 DAY",
)
def retention_keep_rows(t):
    as_of = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    return filters.within_retention(t.events, "ts", as_of, "1 day").select("event_id", "user_id")


@query(
    "retention_expired_days",
    """SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS folder FROM events
       WHERE date_diff('day', CAST(ts AS DATE), DATE '2024-01-20') > 7""",
)
def retention_expired_days(t):
    folders = t.events.select(
        F.when(F.col("event_type") == "error", F.lit("archive")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("folder")
    )
    return filters.expired_folders(folders, "folder", F.lit("2024-01-20").cast("date"), 7)


@query("filter_links", "SELECT page_id, url FROM pages WHERE NOT contains(url, '#')")
def filter_links(t):
    return filters.drop_containing(t.pages.select("page_id", "url"), "url", "#")


@query(
    "filter_listed_links",
    """SELECT page_id, url FROM pages WHERE url IN (
         SELECT p.url FROM pages p JOIN labels l ON l.doc_id = p.page_id WHERE l.quality = 1)""",
)
def filter_listed_links(t):
    good = t.labels.where("quality = 1")
    wanted = t.pages.join(good, F.col("page_id") == F.col("doc_id"), "left_semi")
    return filters.keep_listed(t.pages.select("page_id", "url"), "url", wanted, "url").select("page_id", "url")


@query(
    "split_by_hash",
    """SELECT c_custkey, CASE WHEN CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 10 < 9
                              THEN 'user' ELSE 'alumni' END AS part FROM customer""",
)
def split_by_hash(t):
    return filters.split_by_hash(t.customer.select("c_custkey"), "c_custkey", 10, 9, ("user", "alumni"))


# --- text ---------------------------------------------------------------------


@query(
    "clean_text",
    r"SELECT doc_id, regexp_replace(trim(lower(text)), '\s{2,}', ' ', 'g') AS cleaned FROM documents",
)
def clean_text(t):
    return t.documents.select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(
    "strip_suffix",
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ' • other' ELSE c_name END AS name FROM customer",
)
def strip_suffix(t):
    mark = F.when(F.col("c_mktsegment") == "BUILDING", " • other").otherwise("  • DAAD")
    return t.customer.select(
        "c_custkey", text.strip_suffix(F.concat("c_name", mark), fv.SOURCE_SUFFIX_PATTERN).alias("name")
    )


@query(
    "extract_item_id",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN '-'
                             ELSE json_extract_string(props, '$.k') END AS item_id FROM events""",
)
def extract_item_id(t):
    k = F.get_json_object("props", "$.k")
    parameter = F.when(F.col("event_type") == "error", "FAQ Page").otherwise(F.concat(F.lit("Scholarship ID: "), k, F.lit(" ")))
    return t.events.select(
        "event_id", F.coalesce(text.after_label(parameter, fv.ITEM_LABEL), F.lit("-")).alias("item_id")
    )


@query(
    "compose_text",
    """SELECT p_partkey, lower(concat_ws(' ', p_name, nullif(CASE WHEN p_size > 25 THEN p_brand ELSE '' END, ''),
                         '[''' || p_type || ''', ''' || p_brand || ''']', CAST(p_size AS VARCHAR))) AS embedding_text FROM part""",
)
def compose_text(t):
    brand = F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("")
    fields = [F.col("p_name"), brand, text.list_text(F.array("p_type", "p_brand")), F.col("p_size")]
    return t.part.select("p_partkey", text.compose_text(fields).alias("embedding_text"))


@query(
    "composite_key",
    """SELECT event_id, 'recommendations:' || user_id || ':' || json_extract_string(props, '$.k') AS cache_key,
              CAST(user_id AS VARCHAR) AS key_user, json_extract_string(props, '$.k') AS key_item FROM events""",
)
def composite_key(t):
    key = text.composite_key(fv.CACHE_PREFIX, F.col("user_id"), F.get_json_object("props", "$.k"))
    return t.events.select("event_id", key.alias("cache_key")).select(
        "event_id",
        "cache_key",
        text.key_part(F.col("cache_key"), 1).alias("key_user"),
        text.key_part(F.col("cache_key"), 2).alias("key_item"),
    )


@query(
    "assemble_text",
    r"""SELECT doc_id, 'Read this:' || chr(10) || 'NAME:' || chr(10) || source || chr(10) || chr(10) || 'DESCRIPTION:' || chr(10)
               || text || chr(10) || chr(10) || 'LEVEL:' || chr(10) || coalesce(nullif(lang, 'fr'), '') || chr(10) || 'End.' AS prompt
        FROM documents""",
)
def assemble_text(t):
    payload = text.labelled_sections(
        [("NAME", F.col("source")), ("DESCRIPTION", F.col("text")), ("LEVEL", F.nullif("lang", F.lit("fr")))]
    )
    return t.documents.select(
        "doc_id", text.fill_template("Read this:\n{payload}\nEnd.", payload).alias("prompt")
    )


# --- values -------------------------------------------------------------------

_PRIORITY_LEVELS = {
    "1-URGENT": "Master's", "2-HIGH": " Ph.D", "3-MEDIUM": "postdoctoral fellow", "4-NOT SPECIFIED": "other", "5-LOW": "Bachelor",
}
_PRIORITY_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'master' WHEN '2-HIGH' THEN 'phd'
    WHEN '3-MEDIUM' THEN 'postdoctoral researchers' WHEN '5-LOW' THEN 'bachelor' ELSE '-' END"""


def _level(c="o_orderpriority"):
    return values.map_value(F.col(c), _PRIORITY_LEVELS)


@query("canonical_category", f"SELECT o_orderkey, {_PRIORITY_SQL} AS program_level FROM orders")
def canonical_category(t):
    return t.orders.select("o_orderkey", F.coalesce(values.canonical_level(_level()), F.lit("-")).alias("program_level"))


@query(
    "level_ladder",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'bachelor' WHEN '2-HIGH' THEN 'master'
              WHEN '3-MEDIUM' THEN 'phd' WHEN '5-LOW' THEN 'high school diploma' ELSE '-' END AS required_level FROM orders""",
)
def level_ladder(t):
    required = values.required_level(values.canonical_level(_level()))
    return t.orders.select("o_orderkey", F.coalesce(required, F.lit("-")).alias("required_level"))


@query(
    "enum_or_null",
    """SELECT p_partkey, CASE WHEN lower(trim(p_type)) IN ('economy', 'promo', 'large') THEN lower(trim(p_type)) ELSE '-' END AS kind
       FROM part""",
)
def enum_or_null(t):
    kind = values.enum_or_null(F.concat(F.lit(" "), "p_type"), ["economy", "promo", "large"])
    return t.part.select("p_partkey", F.coalesce(kind, F.lit("-")).alias("kind"))


_ADDRESS = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9.-]+\.[a-z]+"
_MAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@mail[1-5]\.example\.(com|org|net|edu)$"


@query(
    "validate_email",
    rf"""SELECT doc_id, address,
                CASE WHEN regexp_matches(address, '{_MAIL_PATTERN}') THEN lower(trim(address)) ELSE '-' END AS email,
                CASE WHEN regexp_matches(address, '{fv.EMAIL_PATTERN}') THEN lower(trim(address)) ELSE '-' END AS default_email
         FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_ADDRESS}')) AS address FROM documents)""",
)
def validate_email(t):
    found = t.documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_ADDRESS), 0)).alias("address"))
    return found.select(
        "doc_id",
        "address",
        F.coalesce(values.email_or_null(F.col("address"), _MAIL_PATTERN), F.lit("-")).alias("email"),
        F.coalesce(values.email_or_null(F.col("address")), F.lit("-")).alias("default_email"),
    )


@query(
    "range_or_null",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
              CASE WHEN l_quantity BETWEEN 18 AND 40 THEN CAST(l_quantity AS INT) ELSE -1 END AS age FROM lineitem""",
)
def range_or_null(t):
    whole = F.col("l_quantity").cast("string")
    age = values.int_in_range_or_null(F.when(F.col("l_quantity") > 45, "old").otherwise(whole), 18, 40)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return t.lineitem.select(*keys, F.coalesce(age, F.lit(-1)).alias("age"))


@query(
    "validate_reference_value",
    r"""SELECT c_custkey, CASE WHEN c_nationkey % 5 <> 0 AND c_nationkey < 20 THEN lower('NATION ' || chr(65 + c_nationkey)) ELSE '-' END AS country
        FROM customer""",
)
def validate_reference_value(t):
    spelled = lambda key: F.concat(F.lit("NATION "), F.char(F.lit(65) + F.col(key)))
    known = t.nation.where("n_nationkey < 20").select(F.lower(spelled("n_nationkey")).alias("country"))
    given = t.customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") % 5 == 0, F.concat(F.lit("#"), spelled("c_nationkey"))).otherwise(spelled("c_nationkey")).alias("given"),
    )
    valid = values.reference_value_or_null(given, "given", known, "country", fv.COUNTRY_PATTERN)
    return valid.select("c_custkey", F.coalesce("given", F.lit("-")).alias("country"))


@query(
    "extract_number",
    r"""SELECT p_partkey, coalesce(TRY_CAST(nullif(regexp_extract(p_brand || CASE WHEN p_size > 25 THEN '.5 years' ELSE '' END,
               '([0-9]+(?:\.[0-9]+)?)', 1), '') AS DOUBLE), -1) AS number FROM part""",
)
def extract_number(t):
    label = F.concat("p_brand", F.when(F.col("p_size") > 25, ".5 years").otherwise(""))
    number = values.first_number(label).cast("double")
    return t.part.select("p_partkey", F.coalesce(number, F.lit(-1.0)).alias("number"))


@query(
    "placeholder_default",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'not specified' ELSE c_mktsegment END AS instructions
       FROM customer""",
)
def placeholder_default(t):
    segment = F.col("c_mktsegment")
    raw = (
        F.when(segment == "BUILDING", F.lit(" N/A ")).when(segment == "MACHINERY", F.lit("UNKNOWN"))
        .when(segment != "HOUSEHOLD", segment)
    )
    return t.customer.select("c_custkey", values.placeholder_default(raw).alias("instructions"))


def _deadline_text():
    """Order dates as text; some orders have none, some an impossible day."""
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "4-NOT SPECIFIED", fv.NOT_SPECIFIED).when(priority == "5-LOW", "31/02/2025")
        .otherwise(F.date_format("o_orderdate", fv.DATE_FORMAT))
    )


_DEADLINE_SQL = """CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN NULL ELSE CAST(o_orderdate AS DATE) END"""


@query(
    "parse_dates",
    f"""SELECT o_orderkey, coalesce(strftime({_DEADLINE_SQL}, '%Y-%m-%d'), '-') AS deadline,
               strftime(o_orderdate + INTERVAL 90 MINUTE, '%Y-%m-%dT%H:%M:00.000Z') AS updated FROM orders""",
)
def parse_dates(t):
    updated = F.date_format(F.col("o_orderdate") + F.expr("interval 90 minutes"), fv.DATE_TIME_FORMAT)
    day = F.date_format(values.parse_date(_deadline_text()), "yyyy-MM-dd")
    return t.orders.select(
        "o_orderkey",
        F.coalesce(day, F.lit("-")).alias("deadline"),
        values.iso_text(values.parse_timestamp(updated)).alias("updated"),
    )


@query(
    "status_from_deadline",
    f"""SELECT o_orderkey, CASE WHEN {_DEADLINE_SQL} < DATE '1998-06-01' THEN 'closed' ELSE 'open' END AS status FROM orders""",
)
def status_from_deadline(t):
    status = values.status_after_update(F.lit("open"), _deadline_text(), F.lit("01/06/1998 10:30"))
    return t.orders.select("o_orderkey", status.alias("status"))


@query(
    "status_as_of",
    f"""SELECT o_orderkey, CASE WHEN {_DEADLINE_SQL} > DATE '1998-06-01' THEN 'open' ELSE 'closed' END AS status FROM orders""",
)
def status_as_of(t):
    as_of = F.lit("1998-06-01").cast("date")
    return t.orders.select("o_orderkey", values.status_as_of(_deadline_text(), as_of).alias("status"))


@query(
    "lenient_int",
    """SELECT doc_id, CASE lang WHEN 'de' THEN -1 ELSE n_chars END AS n FROM documents""",
)
def lenient_int(t):
    given = (
        F.when(F.col("lang") == "de", "unknown").when(F.col("lang") == "fr", F.concat(F.col("n_chars").cast("string"), F.lit(".9")))
        .otherwise(F.col("n_chars").cast("string"))
    )
    return t.documents.select("doc_id", F.coalesce(values.lenient_int(given), F.lit(-1)).cast("long").alias("n"))


@query(
    "classify_coverage",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
              CASE WHEN l_returnflag <> 'A' AND l_quantity > 10 THEN 'fully funded' ELSE 'partially funded' END AS funding_category
       FROM lineitem""",
)
def classify_coverage(t):
    tuition = F.when(F.col("l_returnflag") == "A", fv.NOT_SPECIFIED).otherwise("covered (amount not specified)")
    allowance = F.concat(F.col("l_quantity").cast("string"), F.lit("/month"))
    coverage = F.when(
        F.col("l_quantity") > 10, F.create_map(F.lit("tuition"), tuition, F.lit("monthly_allowance"), allowance)
    ).otherwise(F.create_map(F.lit("tuition"), tuition))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return t.lineitem.select(*keys, values.funding_category(coverage).alias("funding_category"))


_FIELD_ROWS = ", ".join(f"('{code}', '{name}')" for code, name in fv.FIELDS_OF_STUDY.items())


@query(
    "code_lookup",
    f"""SELECT p_partkey, f.code, f.category FROM part
        JOIN (VALUES {_FIELD_ROWS}) f(code, category) ON f.code = lpad(CAST(p_size % 11 AS VARCHAR), 2, '0')""",
)
def code_lookup(t):
    code = F.lpad((F.col("p_size") % 11).cast("string"), 2, "0")
    return t.part.select("p_partkey", code.alias("code"), values.field_of_study(code).alias("category"))


# --- JSON and ids -------------------------------------------------------------


@query(
    "deterministic_id",
    """SELECT p_partkey, substr(sha256(lower(trim(p_name)) || '|' || lower(least(p_type, p_brand) || ',' || greatest(p_type, p_brand))
              || '|' || lower(trim(p_brand)) || '|'), 1, 16) AS scholarship_id FROM part""",
)
def deterministic_id(t):
    name = F.concat(F.lit(" "), F.upper("p_name"), F.lit(" "))
    none = F.lit(None).cast("array<string>")
    return t.part.select(
        "p_partkey",
        records.scholarship_id(name, F.array("p_type", "p_brand"), F.col("p_brand"), none).alias("scholarship_id"),
    )


@query(
    "json_array_to_text",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ', ' || c_mktsegment
              WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_name END AS documents FROM customer""",
)
def json_array_to_text(t):
    segment = F.col("c_mktsegment")
    given = (
        F.when(segment == "BUILDING", F.to_json(F.array("c_name", segment))).when(segment == "MACHINERY", F.lit(' ["cut off'))
        .otherwise(F.col("c_name"))
    )
    return t.customer.select("c_custkey", records.json_array_to_text(given).alias("documents"))


@query(
    "map_to_json",
    """SELECT s_suppkey, s_name AS name, CAST(s_nationkey AS VARCHAR) AS country, CAST(s_nationkey AS VARCHAR) AS direct FROM supplier""",
)
def map_to_json(t):
    pairs = F.create_map(F.lit("name"), F.lit(0), F.lit("country"), F.col("s_nationkey"))
    as_text = records.values_as_text(pairs)
    named = F.map_concat(F.map_filter(as_text, lambda k, _: k != "name"), F.create_map(F.lit("name"), F.col("s_name")))
    return t.supplier.select("s_suppkey", records.map_to_json(named).alias("j"), as_text.alias("m")).select(
        "s_suppkey",
        F.get_json_object("j", "$.name").alias("name"),
        F.get_json_object("j", "$.country").alias("country"),
        F.element_at("m", "country").alias("direct"),
    )


@query(
    "parse_embedded_json",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS name FROM events""",
)
def parse_embedded_json(t):
    answer = F.concat(F.lit("Here is the result:\n"), "props", F.lit("\nEnd of result."))
    found = t.events.select("event_id", "event_type", records.embedded_json(answer).alias("j"))
    return found.select(
        "event_id",
        F.get_json_object("j", "$.k").alias("k"),
        records.field_or(F.col("j"), "name", F.col("event_type")).alias("name"),
    )


