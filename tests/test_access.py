"""Row visibility: the reference's three scenarios (FIXTURES §3) and the many-user form."""

from pyspark.sql import functions as F

from strata.operators import access

# --- fixed values: the sample space -> groups map and documents of the scenario check
SPACE_GROUPS = {"ETLDEMO": ["team-data-engineering", "all"], "PLAT": ["team-platform", "all"],
                "FIN": ["team-finance"], "HR": ["team-hr"]}
DOCS = [("page-001", "ETL Pipeline Architecture", "ETLDEMO"), ("page-002", "Platform Infrastructure Overview", "PLAT"),
        ("page-003", "Q3 Finance Review", "FIN"), ("page-004", "HR Onboarding Handbook", "HR"),
        ("page-005", "Cross-Team Data Standards", "ETLDEMO")]
SCENARIOS = {"alice": ["team-data-engineering"], "carol": ["team-finance"], "eve": ["all"], "nobody": []}
EXPECTED = {"alice": {"page-001", "page-002", "page-005"}, "carol": {"page-001", "page-002", "page-003", "page-005"},
            "eve": {"page-001", "page-002", "page-005"}, "nobody": {"page-001", "page-002", "page-005"}}


def docs(spark):
    df = spark.createDataFrame(DOCS, "id string, title string, space_key string")
    return access.label_groups(df, access.group_map_frame(spark, SPACE_GROUPS))


def test_labels(spark):
    got = {r["id"]: r["allowed_groups"] for r in docs(spark).collect()}
    assert got["page-003"] == ["team-finance"] and got["page-001"] == ["team-data-engineering", "all"]
    lower = spark.createDataFrame([("x", "t", "plat"), ("y", "t", "OTHER")], "id string, title string, space_key string")
    got = {r["id"]: r["allowed_groups"] for r in access.label_groups(lower, access.group_map_frame(spark, SPACE_GROUPS)).collect()}
    assert got == {"x": ["team-platform", "all"], "y": ["all"]}


def test_scenarios(spark):
    d = docs(spark)
    for user, groups in SCENARIOS.items():
        ids = {r["id"] for r in access.match_all_search(d, groups).collect()}
        assert ids == EXPECTED[user], user


def test_many_users_and_diff(spark):
    d = docs(spark)
    users = access.users_frame(spark, SCENARIOS)
    pairs = access.visibility_pairs(d, users)
    got = {}
    for r in pairs.collect():
        got.setdefault(r["user"], set()).add(r["id"])
    assert got == EXPECTED
    assert pairs.count() == sum(len(v) for v in EXPECTED.values())   # each pair once
    expected = spark.createDataFrame([(u, i) for u, ids in EXPECTED.items() for i in ids], "user string, id string")
    diff = {r["user"]: (r["missing"], r["unexpected"], r["passed"]) for r in access.visibility_diff(expected, pairs).collect()}
    assert all(v == (0, 0, True) for v in diff.values())
    wrong = pairs.filter(~((F.col("user") == "carol") & (F.col("id") == "page-003")))
    diff = {r["user"]: (r["missing"], r["passed"]) for r in access.visibility_diff(expected, wrong).collect()}
    assert diff["carol"] == (1, False) and diff["alice"] == (0, True)


def test_groups_text_round_trip(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "g array<string>")
    out = df.select(access.groups_to_text("g").alias("t")).select("t", access.text_to_groups("t").alias("g")).collect()
    assert [(r["t"], r["g"]) for r in out] == [("a,b", ["a", "b"]), ("", [])]
    assert access.effective_groups(None) == ["all"] and access.effective_groups(["b", "a"]) == ["a", "b", "all"]


def test_classes_say_the_same_as_pairs(spark):
    d = docs(spark).unionByName(spark.createDataFrame(
        [("n", "t", "X", None), ("e", "t", "X", []), ("r", "t", "X", ["a,b", "all", "all"]), ("s", "t", "X", ["all", "a,b"]),
         ("t", "t", "X", ["a", "b"])], "id string, title string, space_key string, allowed_groups array<string>"))
    users = access.users_frame(spark, {**SCENARIOS, "dan": ["a,b"], "fay": ["b"]})
    classes = access.visibility_classes(d, users)
    members = (classes.join(access.document_classes(d), "doc_class").join(access.user_classes(users), "user_class"))
    want = sorted(map(tuple, access.visibility_pairs(d, users).collect()))
    assert sorted(map(tuple, members.select("user", "id").collect())) == want
    assert sum(r["n_pairs"] for r in classes.collect()) == len(want)
    assert classes.select("user_class", "doc_class").distinct().count() == classes.count()


def test_bucket_diff(spark):
    want = spark.range(20000).select((F.col("id") % 7).cast("string").alias("user"), F.col("id").cast("string").alias("id"))
    odd = spark.createDataFrame([(None, "x"), ("x", None), ("0", "0"), ("0", "0")], "user string, id string")
    want = want.unionByName(odd)
    # one row gone, one new, one copy fewer, and a null that moved to the other column
    got = (want.where("id is null or id <> '4242'").where("not (user is null)").dropDuplicates()
           .unionByName(spark.createDataFrame([("3", "new"), ("x", None)], "user string, id string")))
    key = lambda df: sorted((str(r["user"]), r["expected"], r["actual"], r["missing"], r["unexpected"], r["passed"]) for r in df.collect())
    assert key(access.visibility_diff_buckets(want, got, buckets=64)) == key(access.visibility_diff(want, got))
    same = access.visibility_diff_buckets(want, want.repartition(5), buckets=64)
    assert all(r["passed"] for r in same.collect())
    assert access.differing_buckets(want, want.repartition(3, "id"), ["user", "id"], 64).count() == 0
    # a single different row: one bucket of all is compared
    one = want.where("id is null or id <> '4242'")
    assert access.differing_buckets(want, one, ["user", "id"], 4096).count() == 1
    assert [r["user"] for r in access.visibility_diff_buckets(want, one).collect() if not r["passed"]] == [str(4242 % 7)]
    swapped = access.differing_buckets(odd.limit(1), odd.where("id is null"), ["user", "id"], 8)
    assert swapped.count() >= 1
    none = want.limit(0)
    assert access.visibility_diff_buckets(none, none).count() == 0
    assert all(r["missing"] == r["expected"] for r in access.visibility_diff_buckets(want, none).collect())
