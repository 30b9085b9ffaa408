from pyspark.sql import functions as F

from edupipe.functions import sections


def _run(spark, build, *texts):
    return spark.range(1).select(build(*[F.lit(t).cast("string") for t in texts])).first()[0]


def test_description(spark):
    run = lambda t: _run(spark, sections.description, t)
    assert run("x\nProgramme Description\n a\nb \n\nTARGET GROUP\nc") == "a\nb"
    assert run("programme description\na\nb") == "not specified"
    assert run("program description\n\nduration\nx") == ""
    assert run("Objective\nwhy\nSelection\nx") == "why"
    assert run("objective\no\nvalue\nx\nprogram description\nd\nduration\ny") == "d"
    assert run("program description\na\nduration of\nb\nduration\nc") == "a\nduration of\nb"
    assert run(None) is None
    assert run("") == "not specified"


def test_heading_without_a_stop_lets_a_later_heading_count(spark):
    assert _run(spark, sections.duration, "a\nduration\nx\nduration of the funding\n2 years\nvalue\ny") == "2 years"


def test_funding(spark):
    run = lambda t: _run(spark, sections.funding_info, t)
    assert run("a\nScholarship  Value\n100\nselection\nb") == "100"
    assert run("a\nvalue\n100\nplease note\nb") == "100"
    assert run("value\n100\nselection\nb") == "not specified"
    assert run("a\nWhat can be funded?\nall\nduration\nb") == "all"
    assert run(None) is None


def test_deadline(spark):
    run = lambda p, o: _run(spark, sections.deadline, p, o)
    assert run("Application deadline: 1 May\nApplication documents:\nCV", None) == "1 May"
    assert run("deadline\n1 May", None) == "1 May"
    assert run("Application deadline:\n\nPlease note\nx", "application deadline\n2 May\nduration\ny") == "2 May"
    assert run("nothing", "Deadline: 3 May\nline two") == "3 May\nline two"
    assert run(None, None) == "not specified"
    assert run("deadline of note", None) == "not specified"


def test_requirements(spark):
    run = lambda r, o: _run(spark, sections.requirements, r, o)
    assert run(" B2 ", "x") == "B2"
    assert run("N/A", "a\nacademic requirements\ngood\nduration\nb") == "good"
    assert run("  ", None) == "not specified"
    assert run(None, "a\nacademic requirements\n\nduration\nb") == ""


def test_documents(spark):
    run = lambda p, o: _run(spark, sections.documents, p, o)
    papers = "a\napplication papers\nCV\nduration\nb"
    assert run("x\nApplication documents:\nLetter\nPlease note:\ny", papers) == "Letter"
    assert run("x\nRequired documents\nPass", papers) == "Pass"
    assert run("x\ndocuments:\n\napplication deadline\ny", papers) == "CV"
    assert run("N/A", papers) == "CV"
    assert run(None, None) == "not specified"


def test_long_text_does_not_exhaust_the_stack(spark):
    body = "\n".join(f"line {i}" for i in range(200_000))
    assert _run(spark, sections.description, f"program description\n{body}\nduration\nx") == body
