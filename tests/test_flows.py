import datetime
import json

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from edupipe import schemas
from edupipe.operators import graph
from edupipe.plans import clickstream, people, scholarships
from edupipe.session import fresh_path
from edupipe.sources import readers
from edupipe.streaming import clicks

RAW = [
    ("Peru", "Grant • DAAD", "Master", "Law", "x\nProgramme Description\nGood  one\nDuration\n2 years\nApplication papers\nCV\nApplication deadline\n1 May\nduration\ny",
     "N/A", "Steps\nDeadline: 3 June", "N/A", "see www.daad.de/en/."),
    ("Chile", "Grant • DAAD", "Master", "Law", "x\nProgramme Description\nGood  one\nDuration\n2 years\nApplication papers\nCV\nApplication deadline\n1 May\nduration\ny",
     "N/A", "Steps\nDeadline: 3 June", None, "see www.daad.de/en/."),
    ("Peru", "N/A", "Master", "Law", None, None, None, None, None),
    ("Peru", "Other", "master", "Law", None, None, None, None, None),
    ("Peru", "Chair", "Faculty", "Law", None, None, None, "Call us", None),
]


def _trusted(spark):
    raw = spark.createDataFrame(RAW, schemas.RAW_SCHOLARSHIP)
    return scholarships.trusted(raw, F.lit("2025-01-02 03:04:05").cast("timestamp"))


def test_trusted(spark):
    rows = {(r["scholarship_name"], r["origin_country"]): r.asDict() for r in _trusted(spark).collect()}
    assert set(rows) == {("grant", "peru"), ("grant", "chile"), ("chair", "peru")}
    assert rows["grant", "peru"] == {
        "scholarship_name": "grant", "description": "good one", "program_country": "germany", "origin_country": "peru",
        "funding_info": "not specified", "program_level": "master", "required_level": "bachelor", "deadline": "3 june",
        "intake": "fall", "exams": "not specified", "fields_of_study": "law", "duration": "2 years", "documents": "cv",
        "website": "https://www.daad.de/en", "instructions": "not specified", "last_updated_utc": "2025-01-02T03:04:05.000Z",
    }
    chair = rows["chair", "peru"]
    assert (chair["description"], chair["required_level"], chair["deadline"], chair["website"], chair["instructions"]) == (
        None, None, "not specified", "not specified", "Call us",
    )


def test_grouped_and_structured_from_trusted(spark):
    rows = scholarships.grouped(_trusted(spark))
    grant = rows.where("scholarship_name = 'grant'")
    assert grant.first()["origin_countries"] == ["chile", "peru"]
    assert scholarships.prompts(grant, "Do {payload}!", [("NAME", "scholarship_name")]).first()["prompt"] == "Do NAME:\ngrant!"
    answer = json.dumps({"funding_category": "fully funded", "deadline": "03/06/2025", "fields_of_study_code": ["04"],
                         "scholarship_coverage": {"tuition": 5}, "status": "open"})
    made = scholarships.structured_from_trusted(grant.withColumn("answer", F.lit(f"Sure:\n{answer}\n"))).first()
    assert made["program_country"] == ["germany"] and made["origin_country"] == ["chile", "peru"]
    assert made["scholarship_coverage"] == {"tuition": "5"} and made["gpa"] == "" and made["fields_of_study_code"] == ["04"]
    assert len(made["scholarship_id"]) == 16
    assert scholarships.structured_from_trusted(grant.withColumn("answer", F.lit("sorry"))).count() == 0


def _structured(spark):
    answers = [
        ("P1", "http://p1", 'x {"scholarship_name": "", "program_country": ["Germany", " France "], "program_level": "Master\'s", '
                            '"required_level": "bachelor", "intake": "Fall", "funding_category": "Fully funded", "status": "open", '
                            '"deadline": "01/01/2025", "last_updated_utc": "02/01/2025 10:00", "fields_of_study_code": ["04", "04"], '
                            '"documents": ["CV", "Letter"], "origin_country": ["Peru", "Chile"], "other_information": {"a": "b"}} y'),
        ("P2", "http://p2", '{"scholarship_name": "Two", "program_level": "odd", "status": "open", "origin_country": []}'),
        ("P3", "http://p3", "no json"),
    ]
    df = spark.createDataFrame(answers, "project string, main_link string, answer string")
    return scholarships.structured_from_pages(df, F.lit("2025-03-04 05:06:00").cast("timestamp"))


def test_pages_to_relational(spark):
    structured = _structured(spark)
    rows = {r["website"]: r for r in structured.collect()}
    assert rows["http://p1"]["scholarship_name"] == "P1" and rows["http://p2"]["last_updated_utc"] == "04/03/2025 05:06"
    assert rows["http://p2"]["gpa"] == "not specified" and rows["http://p2"]["program_country"] == []
    standard = scholarships.standardised(structured)
    std = {r["scholarship_name"]: r for r in standard.collect()}
    assert std["p1"]["status"] == "closed" and std["p1"]["documents"] == "CV, Letter" and std["p1"]["program_country"] == ["germany", "france"]
    assert std["two"]["origin_country"] == ["chile", "peru"] and std["two"]["program_level"] is None
    countries = spark.createDataFrame([(1, "Germany"), (2, "France"), (3, "Peru")], "country_id int, name string")
    tables = scholarships.relational_tables(standard, countries)
    key = std["p1"]["scholarship_id"]
    assert tuples(tables["scholarship_filter"]) == [(key, "fully funded", "master", "bachelor", "fall", "closed")]
    info = tables["scholarship_info"].first()
    assert info["deadline"] == datetime.date(2025, 1, 1) and json.loads(info["other_information"]) == {"a": "b"}
    assert tuples(tables["program_country"]) == [(key, 1), (key, 2)] and tuples(tables["origin_country"]) == [(key, 3)]
    assert tuples(tables["scholarship_field_of_study"]) == [(key, "04")]
    rejected = tables["rejected"].first()
    assert rejected["failing"] == ["program_level", "required_level"]
    assert all(v.count() == 0 for v in scholarships.violations(tables, countries).values())
    text = scholarships.embedding_input(standard.where("scholarship_name = 'p1'")).first()["embedding_text"]
    assert text.startswith("p1 not specified ['germany', 'france'] ['chile', 'peru'] master bachelor ['04', '04']")


def test_project_texts(spark):
    blocks = spark.createDataFrame([("p", "m", 1, "b"), ("p", "m", 0, "a"), ("p", "m", 1, "b")], "project string, main_link string, n long, text string")
    assert scholarships.project_texts(blocks, "n").select("payload").first()[0] == "a\nb"


PROFILES = [
    {"url": "u1", "name": " Ann ", "email": "ann@gmail.com", "age": "30", "country": "Germany",
     "skills": [{"name": "Python"}, {"name": "python "}], "languages": [{"name": "En", "level": "Beginner"}, {"name": "en", "level": "Advanced"}],
     "educations": [{"college": "U", "degree": "Master", "graduation_year": "2020", "major": "Law"}, {"college": "u", "degree": "odd", "graduation_year": "2022", "major": "Art"}],
     "licenses": [{"name": "L", "institute": "I", "issued_date": "2021"}], "courses": [], "honors": None,
     "experiences": [{"company_name": "C", "designations": [{"designation": "Dev", "duration": "1.5 years"}]},
                     {"company_name": "c", "designations": [{"designation": "Lead", "duration": "3 years"}, {"designation": "Dev", "duration": None}]}]},
    {"url": "u2", "name": "Bob", "email": "bob@nowhere", "age": "17", "country": "Atlantis", "skills": [{"name": "Go"}]},
    {"url": "u3", "name": "Cid", "email": None, "age": "40", "country": None, "skills": [{"name": "go"}, {"name": "Rust"}]},
]


def _standard(spark):
    raw = spark.createDataFrame([json.dumps(p) for p in PROFILES], "string").select(F.from_json("value", schemas.RAW_PROFILE).alias("p")).select("p.*")
    countries = spark.createDataFrame([("Germany",)], "name string")
    return people.standardise(raw, countries, "name")


def test_standard_profiles(spark):
    ann = _standard(spark).where("name = 'ann'").first()
    assert (ann["email"], ann["age"], ann["country"]) == ("ann@gmail.com", 30, "germany")
    assert [tuple(x) for x in ann["skills"]] == [("python",)]
    assert [tuple(x) for x in ann["languages"]] == [("en", "advanced")]
    assert [tuple(x) for x in ann["educations"]] == [("u", None, 2022, "art")]
    assert ann["courses"] is None and ann["honors"] is None
    assert [(x["company_name"], [tuple(d) for d in x["designations"]]) for x in ann["experiences"]] == [("c", [("lead", 3.0), ("dev", None)])]


def test_profiles_without_a_valid_email(spark):
    standard = _standard(spark)
    merged = {r["email"]: r for r in people.one_per_person(standard, "collapse").collect()}
    assert set(merged) == {"ann@gmail.com", None}
    assert merged[None]["name"] == "bob" and merged[None]["age"] == 40
    assert [x["name"] for x in merged[None]["skills"]] == ["go", "rust"]
    assert people.one_per_person(standard, "drop").count() == 1
    with pytest.raises(ValueError):
        people.one_per_person(standard, "x")


def test_facets_and_edges(spark):
    facets = people.facets(people.one_per_person(_standard(spark), "drop"))
    assert tuples(facets["skills"]) == [("ann@gmail.com", "python")]
    assert tuples(facets["experiences"]) == sorted([("ann@gmail.com", "c", "lead", 3.0), ("ann@gmail.com", "c", "dev", None)], key=repr)
    assert facets["honors"].count() == 0
    edges = people.edges(facets)
    assert tuples(edges["HAS_DEGREE"]) == [("ann@gmail.com", "HAS_DEGREE", "art", None, "u", 2022)]
    assert tuples(edges["WORKED_AT"], "src", "dst") == [("ann@gmail.com", "c")]
    union = graph.union_edges(list(edges.values()))
    assert union.groupBy("type").count().count() == 5


def test_basic_people_to_similar_people(spark):
    users = spark.createDataFrame([("30", "Peru", " a@x ", "F", "Ann", "free"), ("x", "Peru", "b@x", "M", "Bob", "paid"), ("1", "Peru", None, "M", "No", "paid")], schemas.BASIC_USER)
    alumni = spark.createDataFrame([("31.0", "Grant", "Chile", "a@x", None, "Anna", "Alumni", "2020")], schemas.BASIC_ALUMNI)
    assert tuples(people.basic_people(users, alumni), "email", "name", "age", "gender", "plan", "status") == sorted(
        [("a@x", "Anna", 31, None, "free", "Alumni"), ("b@x", "Bob", None, "M", "paid", None)], key=repr
    )
    edges = people.basic_edges(users, alumni)
    assert tuples(edges["LIVES_IN"], "src", "dst") == [("a@x", "Chile"), ("a@x", "Peru"), ("b@x", "Peru")]
    assert tuples(edges["HAS_SCHOLARSHIP"]) == [("a@x", "HAS_SCHOLARSHIP", "Grant", 2020)]
    vectors = spark.createDataFrame([("person:a@x", [1.0, 0.0]), ("person:b@x", [0.9, 0.1]), ("LIVES_IN:Peru", [1.0, 1.0])], "node string, embedding array<double>")
    index = people.embedding_index(people.basic_people(users, alumni), edges["HAS_SCHOLARSHIP"], vectors)
    assert tuples(index, "email", "status", "scholarship_id") == sorted([("a@x", "alumni", "Grant"), ("b@x", "user", None)], key=repr)
    assert tuples(people.similar_people(index, "a@x"), "email") == [("b@x",)]
    assert tuples(people.similar_alumni(index, "b@x", "Grant"), "email") == [("a@x",)]
    assert people.similar_alumni(index, "b@x", "Other").count() == 0


def test_load_relational_writes_every_table(spark):
    countries = spark.createDataFrame([(1, "Germany")], "country_id int, name string")
    tables = scholarships.load_relational(_structured(spark), countries, fresh_path(spark, "tables"))
    assert {name: t.count() for name, t in tables.items()} == {
        "scholarship_filter": 1, "scholarship_info": 1, "program_country": 1, "origin_country": 0,
        "scholarship_field_of_study": 1, "rejected": 1,
    }


def test_clean_pending_days(spark):
    source, out = fresh_path(spark, "source"), fresh_path(spark, "out")
    header = "id,user_id,timestamp,page,clicked_element,clicked_parameter,duration,location"

    def day(name, *lines):
        spark.createDataFrame([(x,) for x in (header, *lines)], "value string").coalesce(1).write.text(f"{source}/{name}")
        # Spark names its files .txt; the history holds .csv files.
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.listStatus(path(f"{source}/{name}")):
            file = status.getPath().toString()
            if file.endswith(".txt"):
                fs.rename(path(file), path(file.replace(".txt", ".csv")))

    day("2024-01-01", "1,7,2024-01-01 10:00:00, /FAQ ,El,Pa,0.5,Here", "2,7,2024-01-01 10:00:00,/faq,,,0.5,here")
    assert clickstream.clean_pending(spark, source, out) == 1
    day("2024-01-02", "3,8,2024-01-02 10:00:00,/faq,el,pa,0.5,here")
    assert clickstream.clean_pending(spark, source, out) == 1
    assert clickstream.clean_pending(spark, source, out) == 0
    rows = spark.read.parquet(out)
    assert tuples(rows, "id", "page", "clicked_element") == [(1, "/faq", "el"), (3, "/faq", "el")]


def test_archive_and_expiry(spark):
    path = fresh_path(spark, "history")
    rows = spark.sql("SELECT 1 id, 'faq' topic, CAST('2024-01-01 10:30:00' AS timestamp) ts UNION ALL SELECT 2, 'faq', CAST('2024-01-01 08:00:00' AS timestamp)")
    clickstream.archive_recent(rows, path, "topic", "ts", F.lit("2024-01-01 11:00:00").cast("timestamp"))
    assert tuples(readers.read_parquet(spark, path), "id") == [(1,)]
    assert tuples(clickstream.expired_history(spark, path, F.lit("2024-01-20").cast("date"))) == [("2024-01-01",)]


def test_archive_stream(spark):
    source, out = fresh_path(spark, "source"), fresh_path(spark, "out")
    spark.sql("SELECT 'faq_events' topic, CAST('2024-01-01 23:59:00' AS timestamp) timestamp UNION ALL SELECT 'faq_events', CAST('2023-01-02' AS timestamp)").write.parquet(source)
    stream = spark.readStream.schema("topic string, timestamp timestamp").parquet(source)
    clickstream.archive_stream(stream, f"{out}/rows", f"{out}/checkpoint")
    assert tuples(spark.read.parquet(f"{out}/rows").select(F.col("dt").cast("string"))) == [("2023-01-02",), ("2024-01-01",)]


def test_decode_and_save_clicks(spark):
    event = {"Timestamp": "2025-04-05 18:05:16 ", "User_ID": "7", "Page": "/details", "Duration": 0.5, "Clicked_Element": '"Save" button', "Clicked_Parameter": "Scholarship ID: AB "}
    rows = [("details_events", json.dumps(event)), ("faq_events", json.dumps(event)), ("details_events", json.dumps({**event, "Clicked_Parameter": "none"})),
            ("details_events", json.dumps({**event, "Clicked_Element": "Link"})), ("details_events", "broken")]
    messages = spark.createDataFrame([(t, b"7", v.encode()) for t, v in rows], "topic string, key binary, value binary")
    events = clicks.decode(messages)
    assert events.count() == 5
    saves = clicks.save_clicks(events).collect()
    assert [(r["user_id"], r["item_id"], r["timestamp"]) for r in saves] == [("7", "AB", datetime.datetime(2025, 4, 5, 18, 5, 16))]
    assert {r[0] for r in clicks.route(events).select("table_name").collect()} == {"details_table", "faq_table"}


def test_stream_into_tables(spark):
    source, out = fresh_path(spark, "source"), fresh_path(spark, "out")
    rows = [(t, str(i)) for i, t in enumerate(["faq_events", "details_events", "faq_events", "other"])]
    spark.createDataFrame(rows, "topic string, id string").write.parquet(source)
    stream = spark.readStream.schema("topic string, id string").parquet(source)

    def save(batch, table, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/{table}/{batch_id}")

    clicks.write_tables(stream, f"{out}/checkpoint", save)
    assert tuples(spark.read.parquet(f"{out}/faq_table/0"), "id") == [("0",), ("2",)]
    assert tuples(spark.read.parquet(f"{out}/details_table/0"), "id") == [("1",)]
    assert spark.read.parquet(f"{out}/search_table/0").count() == 0


def test_only_answered_saves_start_the_time_to_live(spark):
    saves = spark.sql("""SELECT u user_id, i item_id, CAST(t AS timestamp) timestamp, n FROM VALUES
        ('u', 'a', '2024-01-01 00:00:00', 1), ('u', 'a', '2024-01-01 00:59:59', 2), ('u', 'a', '2024-01-01 01:00:00', 3),
        ('u', 'b', '2024-01-01 00:00:00', 4), ('w', 'a', '2024-01-01 00:30:00', 5) v(u, i, t, n)""")
    neighbours = spark.createDataFrame([("a", [("x", 0.9), ("y", 0.8)]), ("b", [])], "item_id string, neighbours array<struct<recommended_id:string,score:double>>")
    got = clickstream.fresh_recommendations(saves, neighbours, "n")
    rows = tuples(got.select("user_id", "source_id", "recommended_id", F.hour("timestamp"), F.minute("timestamp"), "clicked"))
    assert rows == sorted(
        (u, "a", r, h, m, False) for u, h, m in [("u", 0, 0), ("u", 1, 0), ("w", 0, 30)] for r in ("x", "y")
    )
