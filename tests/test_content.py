"""Wiki content: API flattening, silver cleaning, gold tables incl. absent inputs."""

import json

from pyspark.sql import functions as F

from strata.plans import content as P
from strata.sources import wiki

SPACES = {"results": [{"id": "1", "key": " etldemo ", "name": " ETL Demo\t", "type": "Global",
                       "description": {"plain": {"value": "<p>Demo &amp; docs</p>"}}},
                      {"id": "2", "key": "plat", "name": "Platform", "type": "global"}], "size": 2}
PAGES = {"space_key": "ETLDEMO", "results": [
    {"id": "10", "title": " Arch ", "status": "Current", "body": {"storage": {"value": "<h1>Arch</h1><p>one two</p>"}},
     "version": {"number": 1, "when": "2024-01-15T10:00:00.000Z", "by": {"displayName": "alice"}},
     "history": {"createdDate": "2024-01-15T09:00:00.000Z", "createdBy": {"displayName": "alice"}}},
    {"id": "10", "title": "Arch v2", "status": "current", "body": {"storage": {"value": "<p>one two three</p>"}},
     "version": {"number": 2, "when": "2024-01-16T10:00:00.000Z", "by": {"displayName": "bob"}},
     "history": {"createdDate": "2024-01-15T09:00:00.000Z", "createdBy": {"displayName": "alice"}}},
    {"id": "11", "title": "Empty", "status": "current"}]}
COMMENTS = [{"page_id": 10, "results": [
    {"id": "100", "body": {"storage": {"value": "<p>nice</p>"}},
     "version": {"when": "2024-01-17T08:00:00.000Z", "by": {"displayName": " carol "}}},
    {"id": "101", "body": {"storage": {"value": "<p>agreed, ship it</p>"}},
     "version": {"when": "2024-01-17T09:00:00.000Z", "by": {"displayName": "alice"}}}]},
            {"page_id": 99, "results": [{"id": "102", "body": {"storage": {"value": "orphan"}},
                                         "version": {"when": "2024-01-18T09:00:00.000Z", "by": {"displayName": "dan"}}}]}]


def land(tmp, name, records):
    path = f"{tmp}/{name}.jsonl"
    with open(path, "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")
    return path


def bronze(spark, scratch):
    s = wiki.flatten_spaces(wiki.read_responses(spark, land(scratch, "s", [SPACES]), wiki.SPACES_RESPONSE))
    p = wiki.flatten_pages(wiki.read_responses(spark, land(scratch, "p", [PAGES]), wiki.PAGES_RESPONSE))
    c = wiki.flatten_comments(wiki.read_responses(spark, land(scratch, "c", COMMENTS), wiki.COMMENTS_RESPONSE))
    return s, p, c


def test_flatten_defaults(spark, scratch):
    s, p, c = bronze(spark, scratch)
    sp = {r["space_id"]: r for r in s.collect()}
    assert sp["2"]["description"] == ""                     # absent description -> ''
    pg = [r for r in p.collect() if r["page_id"] == "11"][0]
    assert pg["body_html"] == "" and pg["created_by"] == "" and pg["version_number"] is None
    assert pg["space_key"] == "ETLDEMO"                      # from the request
    assert {r["page_id"] for r in c.collect()} == {"10", "99"}  # page id as text
    only = wiki.flatten_pages(wiki.read_responses(spark, land(scratch, "p2", [PAGES]), wiki.PAGES_RESPONSE), "PLAT")
    assert only.count() == 0


def test_silver_and_gold(spark, scratch):
    s, p, c = bronze(spark, scratch)
    spaces = {r["space_id"]: r for r in P.clean_spaces(s).collect()}
    assert (spaces["1"]["space_key"], spaces["1"]["space_name"], spaces["1"]["space_type"],
            spaces["1"]["description"]) == ("ETLDEMO", "ETL Demo", "global", "Demo & docs")
    pages = P.clean_pages(p)
    got = {r["page_id"]: r for r in pages.collect()}
    assert got["10"]["version_number"] == 2 and got["10"]["body_text"] == "one two three"
    assert got["10"]["word_count"] == 3 and got["10"]["content_length"] == len("one two three")
    assert got["11"]["body_text"] == "" and got["11"]["word_count"] == 0
    comments = P.clean_comments(c)
    assert {r["author"] for r in comments.collect()} == {"carol", "alice", "dan"}   # stripped (T13)
    md = {r["page_id"]: r["comment_count"] for r in P.most_discussed(pages, comments).collect()}
    assert md == {"10": 2, "11": 0}                         # orphan comment dropped, zero filled
    aa = {r["author"]: tuple(r)[1:] for r in P.author_activity(pages, comments).collect()}
    assert aa["alice"] == (1, 3, 1, 3, 2) and aa["dan"] == (0, 0, 1, 1, 1) and aa["carol"] == (0, 0, 1, 1, 1)
    assert aa[""] == (1, 0, 0, 0, 1)                       # a missing name is the group '' (T2)
    tl = [(str(r["day"]), r["pages_created"], r["comments_created"], r["total_activity"], r["cumulative_pages"])
          for r in P.content_timeline(pages, comments).collect()]
    # page 11 has no creation date: it is left out of the days
    assert tl == [("2024-01-15", 1, 0, 1, 1), ("2024-01-17", 0, 2, 2, 1), ("2024-01-18", 0, 1, 1, 1)]


def test_absent_inputs(spark, scratch):
    s, p, c = bronze(spark, scratch)
    pages, comments = P.clean_pages(p), P.clean_comments(c)
    only_pages = P.build_gold(pages, None)
    assert set(only_pages) == {"wiki_content_by_space", "wiki_author_activity",
                               "wiki_most_discussed", "wiki_content_timeline"}
    assert {r["comment_count"] for r in only_pages["wiki_most_discussed"].collect()} == {0}
    assert {r["comments_made"] for r in only_pages["wiki_author_activity"].collect()} == {0}
    only_comments = P.build_gold(None, comments)
    assert set(only_comments) == {"wiki_content_timeline"}
    assert {r["cumulative_pages"] for r in only_comments["wiki_content_timeline"].collect()} == {0}
    assert P.build_gold(None, None) == {}


def test_content_by_space_rounding(spark):
    rows = [("1", "A", 1, 10, None), ("2", "A", 2, 11, None), ("3", "B", 3, 5, None)]
    df = spark.createDataFrame(rows, "page_id string, space_key string, x int, word_count long, last_updated_date timestamp") \
        .withColumn("content_length", F.col("word_count") * 2)
    got = {r["space_key"]: (r["page_count"], r["avg_word_count"]) for r in P.content_by_space(df).collect()}
    assert got == {"A": (2, 10), "B": (1, 5)}   # mean 10.5 rounds half to even


def test_comment_page_keys(spark):
    """Comments with no page id or an unknown one count for no page."""
    pages = spark.createDataFrame([("1", "t", "S", 3)], "page_id string, title string, space_key string, word_count long")
    comments = spark.createDataFrame([("c1", "1"), ("c2", None), ("c3", "None"), ("c4", "2")],
                                     "comment_id string, page_id string")
    assert [(r["page_id"], r["comment_count"]) for r in P.most_discussed(pages, comments).collect()] == [("1", 1)]


def test_keep_last_without_lineage(spark):
    from strata.operators.dedup import keep_last
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 5, "z")], "key string, n int, s string")
    got = sorted(tuple(r) for r in keep_last(df, ["key"], []).collect())
    assert got == [("j", 5, "z"), ("k", 2, "b")]


def test_author_totals_equal_input_totals(spark):
    """E1 property: the outer join loses no page and no comment."""
    from strata.sources import testdata as TD
    pages = P.clean_pages(TD.raw_pages(spark, "/root/testdata/sf0.001"))
    comments = P.clean_comments(TD.raw_comments(spark, "/root/testdata/sf0.001"))
    aa = P.author_activity(pages, comments).agg(F.sum("pages_created"), F.sum("comments_made"),
                                                 F.sum("pages_total_words")).first()
    assert aa[0] == pages.count() and aa[1] == comments.count()
    assert aa[2] == pages.agg(F.sum("word_count")).first()[0]
