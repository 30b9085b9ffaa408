import datetime
import hashlib

from helpers import each, one, plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe import fixed_values as fv
from edupipe.functions import arrays, links, records, text, values


def test_clean_text(spark):
    given = [None, "", "   ", "\tA\t", "A  B", "A\n\n\nB", "A\nB", " X Y "]
    assert each(spark, text.clean_text, given) == [None, "", "", "\ta\t", "a b", "a b", "a\nb", "x y"]


def test_strip_all_takes_every_kind_of_blank(spark):
    assert each(spark, text.strip_all, [" \n a b \t", None, " "]) == ["a b", None, ""]


def test_strip_suffix(spark):
    given = ["Grant • DAAD", "Grant  •  DAAD", "Grant • DAAD more", None]
    got = each(spark, lambda c: text.strip_suffix(c, fv.SOURCE_SUFFIX_PATTERN), given)
    assert got == ["Grant", "Grant", "Grant • DAAD more", None]


def test_after_label(spark):
    given = ["Scholarship ID: AB12 ", "x Scholarship ID:  a Scholarship ID: b", "FAQ Page", "", None, "Scholarship ID:"]
    assert each(spark, lambda c: text.after_label(c, fv.ITEM_LABEL), given) == ["AB12", "a", None, None, None, ""]


def test_compose_text_skips_empty_fields_but_not_empty_lists(spark):
    df = spark.createDataFrame([("Name", "", None, ["A", "B"], None)], "a string, b string, c string, l array<string>, n array<string>")
    fields = [F.col("a"), F.col("b"), F.col("c"), text.list_text(F.col("l")), text.list_text(F.col("n"))]
    assert df.select(text.compose_text(fields)).first()[0] == "name ['a', 'b'] []"


def test_composite_key(spark):
    key = text.composite_key("recommendations", F.col("u"), F.col("s"))
    assert one(spark, key, u="7", s="ab") == "recommendations:7:ab"
    assert one(spark, text.key_part(F.col("k"), 2), k="recommendations:7:ab") == "ab"


def test_fill_template(spark):
    filled = text.fill_template("a {payload} b", F.col("p"))
    assert one(spark, filled, p="$1 \\x") == "a $1 \\x b"


def test_levels(spark):
    given = ["Master's", " masters ", "PhD", "Ph.D", "phd's", "postdoctoral x", "Faculty staff", "mastery", "other", None]
    assert each(spark, values.canonical_level, given) == [
        "master", "master", "phd", "phd", "phd", "postdoctoral researchers", "faculty", None, None, None,
    ]


def test_required_level_has_no_rung_for_faculty(spark):
    given = ["bachelor", "master", "phd", "postdoctoral researchers", "faculty", None]
    assert each(spark, values.required_level, given) == ["high school diploma", "bachelor", "master", "phd", None, None]


def test_email(spark):
    given = ["Ann.B@GMAIL.com", "Ann.B@gmail.com", "a@example.edu", "a@other.com", "a@gmail.com\n", "", None]
    got = each(spark, values.email_or_null, given)
    assert got[:4] == [None, "ann.b@gmail.com", "a@example.edu", None] and got[5:] == [None, None]


def test_age(spark):
    given = ["17", "18", "100", "101", "x", "", None, "18.9"]
    assert each(spark, lambda c: values.int_in_range_or_null(c, 18, 100), given) == [None, 18, 100, None, None, None, None, 18]


def test_lenient_int(spark):
    assert each(spark, values.lenient_int, ["2.0", "2.9", "-2.9", "7", "x", "", None, "1e20"]) == [2, 2, -2, 7, None, None, None, None]
    large = ["9007199254740993", " -9223372036854775808", "9223372036854775808", "+3000000000.7"]
    assert each(spark, values.lenient_int, large) == [9007199254740993, -9223372036854775808, None, 3000000000]


def test_first_number(spark):
    assert each(spark, values.first_number, ["3 years", "2.5y", "none", "", None]) == [3.0, 2.5, None, None, None]
    assert each(spark, lambda c: values.first_number(c, fv.DIGITS_PATTERN), ["...", "1.2.3", "4"]) == [None, None, 4.0]


def test_placeholder_default(spark):
    given = [" N/A ", "NA", "Unknown", "", "  ", None, "Apply online"]
    assert each(spark, values.placeholder_default, given) == ["not specified"] * 6 + ["Apply online"]


def test_dates(spark):
    given = ["31/12/2025", "not specified", "31/02/2025", None]
    assert each(spark, values.parse_date, given) == [datetime.date(2025, 12, 31), None, None, None]
    assert each(spark, values.parse_timestamp, ["01/02/2025 10:30", "x"]) == [datetime.datetime(2025, 2, 1, 10, 30), None]


def test_status_stays_open_on_the_day_of_the_update(spark):
    def status(deadline, updated):
        c = values.status_after_update(F.lit("open"), F.col("d"), F.col("u"))
        return one(spark, c, schema="d string, u string", d=deadline, u=updated)

    assert status("02/01/2025", "02/01/2025 23:59") == "open"
    assert status("01/01/2025", "02/01/2025 00:00") == "closed"
    assert status("not specified", "02/01/2025 00:00") == "open"
    assert status("01/01/2025", None) == "open"


def test_status_as_of(spark):
    as_of = F.lit("2025-01-01").cast("date")
    given = ["02/01/2025", "01/01/2025", "not specified", None]
    assert each(spark, lambda c: values.status_as_of(c, as_of), given) == ["open", "closed", "closed", "closed"]


def test_funding_category(spark):
    given = [
        {"tuition": "460/year", "monthly_allowance": "covered (amount not specified)"},
        {"tuition": "460/year", "monthly_allowance": "Not specified"},
        {"tuition": "", "monthly_allowance": "1"},
        {"travel_allowance": "1"},
        {},
    ]
    got = each(spark, values.funding_category, given, "map<string,string>")
    assert got == ["fully funded"] + ["partially funded"] * 4


def test_reference_value(spark):
    df = spark.createDataFrame([(" Germany", 1), ("Sp4in", 2), ("Atlantis", 3), (None, 4)], "c string, i int")
    known = spark.createDataFrame([("germany",), ("Spain",), ("Germany",)], "name string")
    got = values.reference_value_or_null(df, "c", known, "name", fv.COUNTRY_PATTERN).orderBy("i").collect()
    assert [r["c"] for r in got] == ["germany", None, None, None]


def test_rows_of_a_common_reference_value_stay_in_their_tasks(spark):
    df = spark.range(1000, numPartitions=4).withColumn("c", F.lit("Germany"))
    known = spark.createDataFrame([("Germany",), ("Spain",)], "name string")
    checked = values.reference_value_or_null(df, "c", known, "name", fv.COUNTRY_PATTERN)
    assert "SortMergeJoin" not in plan_of(checked)
    assert checked.groupBy(F.spark_partition_id()).count().count() == 4 and checked.where("c = 'germany'").count() == 1000


# --- links --------------------------------------------------------------------


def _websites(spark, *texts):
    columns = [F.lit(t).cast("string") for t in texts]
    return spark.range(1).select(links.extract_websites(columns)).first()[0]


def test_websites(spark):
    assert _websites(spark, "see https://www.daad.de/en/study).", None) == "https://www.daad.de/en/study"
    assert _websites(spark, "www.daad.de/en/", "www.daad.de/en") == "https://www.daad.de/en"
    assert _websites(spark, "https://evil.com/en/") == "not specified"
    assert _websites(spark, "https://www.daad.de/about") == "not specified"
    assert _websites(spark, "b http://tu-ulm.de/en a https://daad.de/en") == "http://tu-ulm.de/en; https://daad.de/en"
    assert _websites(spark, "", None) == "not specified"
    assert _websites(spark, "ask for BAföG") == "https://www.bafög.de"
    assert _websites(spark, "WWW.DAAD.DE/en/x.pdf,") == "https://WWW.DAAD.DE/en/x.pdf"


def test_with_main_link(spark):
    df = spark.createDataFrame(
        [("http://a/", ["http://a", "http://b", "http://b"]), ("http://a", ["http://b"]), ("http://a", [])],
        "m string, l array<string>",
    )
    got = [r[0] for r in df.select(links.with_main_link(F.col("l"), F.col("m"))).collect()]
    assert got == [["http://a", "http://b"], ["http://a", "http://b"], ["http://a"]]


# --- arrays -------------------------------------------------------------------


def test_lower_array(spark):
    assert each(spark, arrays.lower_array, [[" A\n", "b"], [], None], "array<string>") == [["a", "b"], [], []]


def test_fill_from_longest(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["B", "a ", "", "b"]), (4, ["z"])], "i int, a array<string>")
    got = {r["i"]: r["a"] for r in arrays.fill_from_longest(df, "a").collect()}
    assert got == {1: ["a", "b"], 2: ["a", "b"], 3: ["a", "b"], 4: ["z"]}


_ELEMENTS = "i int, a array<struct<k:string,n:int,t:string>>"


def _kept(df):
    return {r["i"]: None if r["a"] is None else [tuple(x) for x in r["a"]] for r in df.collect()}


def test_keep_best_in_array(spark):
    df = spark.createDataFrame(
        [
            (1, None), (2, []), (3, [("a", 1, "x")]),
            (4, [("b", 1, "p"), ("a", 5, "q"), ("b", 7, "r"), ("a", None, "s"), ("b", 7, "t")]),
            (5, [(None, 1, "p"), ("a", None, "q"), (None, 2, "r"), ("a", None, "s")]),
        ],
        _ELEMENTS,
    )
    latest = _kept(arrays.keep_latest_in_array(df, "a", "k", "n"))
    assert latest == {
        1: None, 2: None, 3: [("a", 1, "x")], 4: [("a", 5, "q"), ("b", 7, "r")], 5: [("a", None, "q"), (None, 2, "r")],
    }
    first = _kept(arrays.dedupe_in_array(df, "a", "k"))
    assert first[4] == [("b", 1, "p"), ("a", 5, "q")] and first[5] == [(None, 1, "p"), ("a", None, "q")]


def test_keep_highest_in_array(spark):
    df = spark.createDataFrame([(1, [("pt", 0, "beginner"), ("pt", 0, "advanced"), ("es", 0, None), ("es", 0, "odd")])], _ELEMENTS)
    got = _kept(arrays.keep_highest_in_array(df, "a", "k", "t", fv.LANGUAGE_RANK))
    assert got == {1: [("pt", 0, "advanced"), ("es", 0, None)]}


def test_keep_longest_in_array_uses_the_first_designation(spark):
    df = spark.createDataFrame(
        [(1, [("g", [(1.5,)]), ("g", [(2.0,), (0.1,)]), ("h", None), ("h", []), ("h", [(None,)])])],
        "i int, a array<struct<c:string,d:array<struct<duration:float>>>>",
    )
    kept = arrays.keep_longest_in_array(df, "a", "c", "d", "duration").first()["a"]
    assert [(x["c"], x["d"] and [y["duration"] for y in x["d"]]) for x in kept] == [("g", [2.0, pytest_approx(0.1)]), ("h", None)]


def pytest_approx(x):
    import pytest

    return pytest.approx(x)


# --- records ------------------------------------------------------------------


def test_json_array_to_text(spark):
    given = ['["CV", "Letter"]', ' ["CV"', "CV; Letter", None]
    assert each(spark, records.json_array_to_text, given) == ["CV, Letter", "", "CV; Letter", None]


def test_embedded_json(spark):
    given = ['say {"a": 1} end', '{"a": 1} and {"b": 2}', 'x\n{"a":\n 1}\n', "none", "", None]
    assert each(spark, records.embedded_json, given) == ['{"a": 1}', '{"a": 1} and {"b": 2}', '{"a":\n 1}', None, None, None]


def test_coerce_to_schema(spark):
    schema = T.StructType(
        [
            T.StructField("s", T.StringType()), T.StructField("a", T.ArrayType(T.StringType())),
            T.StructField("m", T.MapType(T.StringType(), T.StringType())), T.StructField("n", T.IntegerType()),
        ]
    )
    given = [
        '{"s": "x", "a": ["p", 1], "m": {"k": 2}, "n": 3}', '{"s": "", "a": "p", "m": [1], "n": "x"}',
        '{"s": ["p"], "a": null, "m": null}', "{}", "broken",
    ]
    df = spark.createDataFrame(list(enumerate(given)), "i int, j string")
    parsed = df.select("i", records.parse_object(F.col("j"), schema).alias("o"))
    rows = parsed.select("i", *records.coerced_fields(F.col("o"), schema)).orderBy("i").collect()
    empty = ("not specified", [], {}, None)
    assert [tuple(r)[1:] for r in rows] == [("x", ["p", "1"], {"k": "2"}, 3), empty, ('["p"]', [], {}, None), empty, empty]


def test_scholarship_id_is_the_hash_of_its_parts(spark):
    df = spark.createDataFrame([(" Name", ["b", "A"], "PhD ", None)], "n string, c array<string>, l string, f array<string>")
    got = df.select(records.scholarship_id(*[F.col(c) for c in "nclf"])).first()[0]
    assert got == hashlib.sha256(b"name|a,b|phd|").hexdigest()[:16]


def test_map_values_as_text(spark):
    df = spark.createDataFrame([({"a": 1},)], "m map<string,int>")
    assert df.select(records.map_to_json(records.values_as_text(F.col("m")))).first()[0] == '{"a":"1"}'
