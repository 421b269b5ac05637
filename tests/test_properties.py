"""Property tests: the text rules against Python's own string methods on
generated strings (one Spark job per batch of examples)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions import text as T

# Latin letters with case, digits, punctuation, and every white-space
# character Python knows. Letters whose upper case is longer (e.g. U+00DF) or
# that have a separate title case (e.g. U+01C6) are outside the set: there
# Python's title() and Spark's upper() differ by design.
ALPHABET = st.sampled_from(list("abcXYZéÉñÑøØ019-'_.,;!&<> ") + ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f",
                                                                  "\x85", "\xa0", " ", "　"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=1, max_size=40)

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def run(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn("x")).collect()]


@SETTINGS
@given(TEXTS)
def test_strip(spark, values):
    assert run(spark, values, T.strip) == [v.strip() for v in values]


@SETTINGS
@given(TEXTS)
def test_title(spark, values):
    assert run(spark, values, T.title_case) == [v.title() for v in values]


@SETTINGS
@given(TEXTS)
def test_word_count_and_words(spark, values):
    assert run(spark, values, T.word_count) == [len(v.split()) for v in values]
    assert run(spark, values, T.words) == [v.split() for v in values]


@SETTINGS
@given(TEXTS)
def test_html_of_plain_text_is_stripped_text(spark, values):
    plain = [v.replace("<", " ").replace("&", " ") for v in values]
    assert run(spark, plain, T.html_to_text) == [v.strip() for v in plain]


ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5), st.integers(-3, 3)),
                min_size=1, max_size=30)


@SETTINGS
@given(ROWS)
def test_keep_last_matches_pandas(spark, rows):
    """D1 against pandas ``drop_duplicates(keep="last")`` after sorting by
    the explicit order (null keys form one group)."""
    import pandas as pd

    from strata.operators.dedup import keep_last
    seq = [(k, s, v, i) for i, (k, s, v) in enumerate(rows)]
    df = spark.createDataFrame(seq, "k string, s int, v int, i int")
    got = sorted((r["k"] or "", r["i"]) for r in keep_last(df, ["k"], ["s", "i"]).collect())
    pdf = pd.DataFrame(seq, columns=["k", "s", "v", "i"]).sort_values(["s", "i"])
    want = sorted((k or "", i) for k, i in pdf.drop_duplicates(subset=["k"], keep="last")[["k", "i"]].itertuples(
        index=False, name=None))
    assert got == want


@SETTINGS
@given(ROWS)
def test_keep_last_idempotent(spark, rows):
    from strata.operators.dedup import keep_last
    df = spark.createDataFrame([(k, s, v, i) for i, (k, s, v) in enumerate(rows)], "k string, s int, v int, i int")
    once = keep_last(df, ["k"], ["s", "i"])
    twice = keep_last(once, ["k"], ["s", "i"])
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)


FRAGMENTS = st.sampled_from([
    "<p>", "</p>", "<b>", "</b>", "<br/>", "<div class=\"x\">", "</div>", "<li>", "</li>",
    "word", "two words", " ", "\n", "\t", "\xa0", "&amp;", "&copy;", "&quot;", "&#233;", "&#x41;", "&lt;b&gt;",
    "<!-- note -->", "<script>var a='</p>';</script>", "<style>p{margin:0}</style>", "<![CDATA[x < y]]>",
    "café", "a&b", "x < 1",
])


@SETTINGS
@given(st.lists(FRAGMENTS, max_size=20).map("".join))
def test_html_fragments_match_reference_parser(spark, doc):
    from test_functions import reference_text
    assert run(spark, [doc], T.html_to_text) == [reference_text(doc)]
