"""Scalar helpers against the Python/pandas behaviour they reproduce."""

import html
import math
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.functions import coerce as C
from strata.functions import text as T


def col_values(spark, values, expr, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_round_half_even_matches_numpy(spark):
    rng = np.random.default_rng(7)
    vals = [float(v) for v in np.concatenate([rng.integers(0, 10**7, 3000) / 1000.0, rng.random(2000) * 1e4,
                                [2.675, 0.125, 0.375, 1.005, 2.5, 3.5, -2.675]])]
    got = col_values(spark, vals, lambda c: C.round_half_even(c, 2), "x double")
    assert got == list(np.round(np.array(vals), 2))


def test_round_to_long_half_even(spark):
    assert col_values(spark, [0.5, 1.5, 2.5, -0.5, 2.4999], C.round_to_long, "x double") == [0, 2, 2, 0, 2]


@pytest.mark.parametrize("raw,expected", [("2.7", 2), ("n/a", 0), (" 5 ", 5), ("NaN", 0), (None, 0),
                                          ("1e3", 1000), ("-3.9", -3), ("", 0)])
def test_quantity_coercion(spark, raw, expected):
    assert col_values(spark, [raw], C.to_long_or_zero) == [expected]
    p = pd.to_numeric(pd.Series([raw], dtype=object), errors="coerce").fillna(0).astype(int)[0]
    assert p == expected


@pytest.mark.parametrize("raw,expected", [("29.99", 29.99), ("bad", 0.0), ("NaN", 0.0), (None, 0.0)])
def test_price_coercion(spark, raw, expected):
    assert col_values(spark, [raw], C.to_double_or_zero) == [expected]


def test_dates_per_row(spark):
    vals = ["2024-01-15", "2024-01-15T10:30:00.000Z", "2024-01-15T10:30:00+02:00", "garbage", None]
    got = col_values(spark, vals, C.to_timestamp_or_null)
    assert got[0] == pd.Timestamp("2024-01-15").to_pydatetime()
    assert got[1] == pd.Timestamp("2024-01-15 10:30").to_pydatetime()
    assert got[2] == pd.Timestamp("2024-01-15 08:30").to_pydatetime()  # offset normalised to UTC
    assert got[3] is None and got[4] is None


STRINGS = ["  Electronics ", "\tfurniture\n", " home ", "usb-c", "men's wear", "3d printer",
           "ÉCOLE élève", "hello   world", "", "x y", "o'neil-smith", "ABC def", "a1b2 c3"]


def test_strip_matches_python(spark):
    assert col_values(spark, STRINGS, T.strip) == [s.strip() for s in STRINGS]


def test_title_matches_python(spark):
    assert col_values(spark, STRINGS, T.title_case) == [s.title() for s in STRINGS]


def test_upper_lower_strip(spark):
    assert col_values(spark, STRINGS, T.upper_strip) == [s.upper().strip() for s in STRINGS]
    assert col_values(spark, STRINGS, T.lower_strip) == [s.lower().strip() for s in STRINGS]


def test_word_count_matches_split(spark):
    vals = STRINGS + ["a b", "line1\nline2\r\nline3", None]
    assert col_values(spark, vals, T.word_count) == [len(v.split()) if v else 0 for v in vals]


class _TextNodes(HTMLParser):
    """Text nodes of a document, the way an HTML tree's get_text sees them:
    script/style content, comments and declarations are not text; CDATA is."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.skip:
            self.skip -= 1

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self.parts.append(data[len("CDATA["):])


def reference_text(doc):
    if not doc or not isinstance(doc, str):
        return ""
    p = _TextNodes()
    p.feed(doc)
    p.close()
    # adjacent data events of one node are one string in a tree; join them first
    return " ".join(s.strip() for s in p.parts if s.strip())


HTML_CASES = [
    "<p>a</p>b", "<b>a</b>b", "<p>Tom &amp; Jerry &copy; 2024 &middot; &quot;x&quot;</p>",
    "<script>var t='</p>';</script>hi<!-- note --> there", "<style>p{margin:0}</style><p> x </p>",
    "<!DOCTYPE html><html><head><title>T</title></head><body><h1>H</h1></body></html>",
    "<ul><li>one</li><li>two</li></ul>", "<p>caf&#233; &#x41;</p>", "plain text", "", None,
    "<p>line one\nline two</p>", "<p>&nbsp;x&nbsp;</p>", "<table><tr><td>1</td><td>2</td></tr></table>",
]


def test_html_to_text_cases(spark):
    got = col_values(spark, HTML_CASES, T.html_to_text)
    assert got == [reference_text(h) for h in HTML_CASES]


def test_html_cdata_keeps_tag_like_text(spark):
    doc = "<ac:plain-text-body><![CDATA[if a < b: print('<b>x</b>')]]></ac:plain-text-body>"
    assert col_values(spark, [doc], T.html_to_text) == ["if a < b: print('<b>x</b>')"]


def test_html_entities_one_pass(spark):
    # '&amp;lt;' is the text '&lt;', not '<'
    assert col_values(spark, ["<p>&amp;lt; &bogus; a&b</p>"], T.html_to_text) == ["&lt; &bogus; a&b"]
    assert html.unescape("&amp;lt;") == "&lt;"


def test_html_to_text_on_all_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html")
    got = {r[0]: r[1] for r in pages.select("page_id", T.html_to_text("html")).collect()}
    ref = {r[0]: reference_text(r[1]) for r in pages.collect()}
    bad = [k for k in ref if ref[k] != got[k]]
    assert not bad, f"{len(bad)} pages differ, e.g. {bad[:3]}"


def test_nan_guard():
    assert math.isnan(float("nan"))


def test_html_corner_cases(spark):
    from strata.functions import text as T
    cases = {'<a title="x>y">z</a>': "z", "a<script> var q=1;": "a", "&#00000065;&#x000041;": "AA", "a\u0002b": "ab",
             "<p class='a>b'>q</p> 1 < 2": "q 1 < 2", '<a title="x>z': "z", "<style>p{}": ""}
    df = spark.createDataFrame(list(cases.items()), "h string, want string")
    assert [tuple(r) for r in df.select("want", T.html_to_text("h")).collect() if r[0] != r[1]] == []


class _References(HTMLParser):
    """Character references as the parser's own patterns find them."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.out = ""

    def handle_data(self, data):
        self.out += data

    def handle_charref(self, name):
        n = int(name[1:], 16) if name[0] in "xX" else int(name)
        self.out += html.unescape(f"&#{n};")

    def handle_entityref(self, name):
        known = T.ENTITY_CODEPOINTS.get(name)
        self.out += "&" + name if known is None else chr(known)


def test_references_without_semicolon(spark):
    docs = ["&copy 2020 &amp x", "&copy2020 y", "a &lt b &gt c", "&#65 &#65a &#x41 &#x41g &#128; &#x99; &#150 &#129;",
            "&eacute, &eacute.txt &amp-x &ndash-", "&alpha<b>x</b>&beta!</p>", "&copy&reg&amp;lt;", "&#0; &#55296; &#1114112;",
            "x &bogus y &nosuch, z", "&#00000000169 t &#xA9\n"]
    want = []
    for doc in docs:
        p = _References()
        p.feed(doc.replace("<b>", "").replace("</b>", "").replace("</p>", "") + " .")
        p.close()
        want.append(p.out)
    assert col_values(spark, [d.replace("<b>", "").replace("</b>", "").replace("</p>", "") + " ." for d in docs], T.unescape) == want
    assert col_values(spark, ["<p>&alpha<b>x</b>&beta</p>"], T.html_to_text) == ["α x β"]


def test_references_equal_their_oracle(spark):
    import duckdb

    from strata import oracle as O
    docs = ["&copy 2020 &amp x", "&copy2020", "&#65 &#65a &#x41 &#x41g &#128; &#x99; &#129;", "&eacute.txt &amp-x", "&copy&reg&amp;lt;",
            "&#0; &#x0; &#12345678; &#x1234567; &#; &#x; &; &", "&#00000000169 &#x000000A9;", "no reference"]
    got = col_values(spark, docs, T.unescape)
    assert got == [duckdb.execute(f"select {O.unescape('x')} from (select ?::varchar as x) t", [d]).fetchone()[0] for d in docs]


def test_positions_follow_the_order_over_many_partitions(spark):
    from strata.operators.window import positions
    spark_conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("t")).repartition(7)
        got = {r["k"]: r["position"] for r in positions(df.orderBy(F.col("t").desc(), "k")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", spark_conf)
    want = sorted(((i % 3, i * 7919 % 5003) for i in range(5000)), key=lambda x: (-x[0], x[1]))
    assert got == {k: n for n, (_, k) in enumerate(want, 1)}
    assert positions(df.where("false").orderBy("k")).count() == 0
