"""Headings and entities against the standard library's decoder."""

import html
import random

from prodlink.sources import html as H


def test_entities(spark):
    rng = random.Random(1)
    names = list(html.entities.html5)
    texts = [f"a &{n}{rng.choice(['', ';', ' ', 'x', '&'])} b" for n in rng.sample(names, 600)]
    texts += ["&amp;lt;", "&&amp", "&", "", "none", "&#233;&#xE9;&#233 &#xe9x", "&#128;&#159;&#129;", "&#55296;&#1114112;&#99999999999999999999;",
              "&notin;&notit;&not", "&#;&#x;&;"]
    texts = [t for t in texts if "&#129;" not in t] + ["&#130;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [(r.t, r.x) for r in df.select("t", H.unescape_entities(df.t).alias("x")).collect()]
    assert got == [(t, html.unescape(t)) for t in texts]


def test_headings_where_markup_counts(spark):
    pages = {"<h1>A</h1><p>x</p><H1 id=1>B <i>c</i></H1 >": "AB c", "<!-- <h1>no</h1> --><h1>yes</h1>": "yes",
             "<script>'<h1>no</h1>'</script><h1>yes</h1>": "yes", "<textarea><h1>no</h1></textarea>": "", "<h1>open": "open",
             "<!-- never closed <h1>no</h1>": "", "<h10>no</h10><h1\n>a<!-- b -->c</h1>": "ac", "": "", "no heading": ""}
    df = spark.createDataFrame(list(pages.items()), "html string, want string")
    for r in df.select("html", "want", H.heading_text(df.html).alias("got")).collect():
        assert r.got == r.want, r.html


def test_null_page(spark):
    df = spark.createDataFrame([(None,)], "html string")
    assert df.select(H.heading_text(df.html).alias("x")).first().x is None
