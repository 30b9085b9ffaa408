import types

import pyarrow as pa
from helpers import tuples
from pyspark.sql import functions as F

from edupipe.operators import web


def test_blocks_repeat_nested_text_and_skip_scripts():
    html = "<body><div>a <p>b<br>c &amp; d</p><script>var x='<p>no</p>'</script><!-- no --></div><ul><li> x </li><li></li></ul><span>no</span></body>"
    assert web.blocks_of(html) == [("div", "abc & d"), ("p", "bc & d"), ("ul", "x"), ("li", "x")]


def test_unclosed_blocks_stay_open():
    assert web.blocks_of("<div><p>one<p>two</div><h1>t</h1>") == [("div", "onetwo"), ("p", "onetwo"), ("p", "two"), ("h1", "t")]
    assert web.blocks_of("<p>one") == [("p", "one")]
    assert web.blocks_of("</p><p>a</b></p>") == [("p", "a")]
    assert web.blocks_of("") == []


def test_links_of_a_menu():
    html = '<nav id="top"><a href="/no">x</a></nav><nav class="Main-Menu"><ul><li><a href="/a">a</a><a href="http://other/b#c">b</a><a>c</a></ul></nav><a href="/no">x</a>'
    assert web.links_of("http://h/p", html) == ["http://h/a", "http://other/b#c"]


def test_menu_list_serves_when_no_nav_does():
    html = '<nav><a href="/no">x</a></nav><ul id="sidemenu"><li><a href="q">a</a></ul>'
    assert web.links_of("http://h/p/", html) == ["http://h/p/q"]


def test_links_of_the_same_host_without_a_menu():
    html = '<a href="/a">1</a><a href="/a">2</a><a href="http://other/b">3</a><a href="#x">4</a><a href="http://h/p">5</a><a href="http://[bad">6</a>'
    assert web.links_of("http://h/p", html) == ["http://h/a"]


def test_link_rows(spark):
    df = spark.createDataFrame([(1, "m", ["u", "u/#x", "v"]), (2, "m", []), (3, "m", ["/#y"]), (4, "m", None)], "i int, m string, l array<string>")
    assert tuples(web.link_rows(df, "i", "m", "l")) == sorted([(1, "m", "u", 2), (1, "m", "v", 2), (2, "m", None, 0), (4, "m", None, 0)], key=repr)


def test_anchors(spark):
    df = spark.createDataFrame([(1, '<a class="c" href="/x"> T </a><a href="">no</a><a href="/y"> </a><A HREF="/z">Z</A>')], "i int, h string")
    assert tuples(web.anchors(df, "i", "h")) == [(1, "T", "/x"), (1, "Z", "/z")]


def test_catalogue_items_by_class_with_the_title_inside_the_link(spark):
    item = "ecl-content-item-block__item contextual-region ecl-u-mb-l ecl-col-12"
    link = "ecl-link ecl-link--standalone ecl-link--icon"
    page = (
        f'<div class="{item}"><a href="/other">no</a><a class="{link}" href="/x?a=1&amp;b=2"><span class="ecl-link__label">Title &amp; more</span><svg/></a></div>'
        f'<div class="{item}"><a class="{link}"><span class="ecl-link__label">no link</span></a></div>'
        f'<div class="{item}"><a class="{link}" href="/y">no title</a></div><a class="{link}" href="/z"><span class="ecl-link__label">outside</span></a>'
    )
    df = spark.createDataFrame([(1, page), (2, None), (3, "<p>")], "i int, h string")
    assert tuples(web.catalogue_items(df, "i", "h")) == [(1, "Title & more", "/x?a=1&b=2")]
    labelled = spark.createDataFrame([(1, '<a href="/q"><span class="label">Title</span></a>')], "i int, h string")
    assert tuples(web.catalogue_items(labelled, "i", "h", None, ("span", "label"), ("a", ""))) == [(1, "Title", "/q")]
    assert tuples(web.anchors(labelled, "i", "h")) == [(1, "Title", "/q")]


def test_page_blocks_keep_order_and_pages(spark):
    df = spark.createDataFrame([(1, "u", "<p>b</p><p>a</p>"), (2, "v", None), (3, "w", "text")], "i int, u string, h string")
    rows = web.page_blocks(df, "i", "u", "u", "h").orderBy("position").select("project", "position", "text").collect()
    assert [tuple(r) for r in rows] == [("1", 0, "b"), ("1", 1, "a")]
    links = web.page_links(df.withColumn("h", F.lit('<a href="/q">q</a>')), "i", "u", "h")
    assert links.count() == 3


def test_blocks_are_given_out_as_they_come(spark, monkeypatch):
    """A task does not hold the blocks of all pages of a batch, whose nested ones repeat their text."""
    class Batches:
        made = spark.sparkContext.accumulator(0)

        @classmethod
        def from_arrays(cls, arrays, names):
            cls.made.add(1)
            return pa.RecordBatch.from_arrays(arrays, names)

    monkeypatch.setattr(web, "pa", types.SimpleNamespace(RecordBatch=Batches, array=pa.array, int32=pa.int32, int64=pa.int64, string=pa.string))
    monkeypatch.setattr(web, "BATCH_CHARS", 100)
    html = F.concat(F.lit("<div><div><p>text"), "id", F.lit("</p></div></div><ul><li>x</li></ul>"))
    pages = spark.range(0, 200, 1, 1).select("id", F.lit("u").alias("u"), html.alias("h"))
    rows = web.page_blocks(pages, "id", "u", "u", "h").collect()
    expected = [(str(i), k, tag, text) for i in range(200) for k, (tag, text) in enumerate(
        [("div", f"text{i}"), ("div", f"text{i}"), ("p", f"text{i}"), ("ul", "x"), ("li", "x")])]
    assert [(r["project"], r["position"], r["tag"], r["text"]) for r in rows] == expected
    assert Batches.made.value > 20


def test_blocks_from_sql(spark):
    web.register_page_blocks(spark)
    spark.createDataFrame([(1, "<h1>a</h1><p>b</p>"), (2, None)], "i int, h string").createOrReplaceTempView("fetched")
    got = spark.sql("SELECT i, position, tag, text FROM fetched, LATERAL page_blocks(h)")
    assert tuples(got) == [(1, 0, "h1", "a"), (1, 1, "p", "b")]
