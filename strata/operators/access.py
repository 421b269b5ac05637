"""Group-based row visibility."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.common import as_col

PUBLIC_GROUP = "all"


def group_map_frame(spark: SparkSession, mapping: Mapping[str, Sequence[str]],
                    key: str = "space_key") -> DataFrame:
    """A space -> groups mapping given as a dict, as a two-column frame."""
    return spark.createDataFrame([(k, list(v)) for k, v in mapping.items()],
                                 f"{key} string, allowed_groups array<string>")


def label_groups(df: DataFrame, group_map: DataFrame, key: str = "space_key",
                 default: Sequence[str] = (PUBLIC_GROUP,)) -> DataFrame:
    """Add ``allowed_groups`` = groups of ``upper(key)`` in ``group_map``
    (columns ``space_key``, ``allowed_groups``), or ``default`` when unmapped.

    The map is joined by key (left join, so no row is lost); Spark broadcasts
    it if its measured bytes are below the session's threshold.
    """
    gm = group_map.select(F.col(group_map.columns[0]).alias("__gkey"),
                          F.col("allowed_groups").alias("__groups"))
    out = (df.withColumn("__gkey", F.upper(F.col(key)))
           .join(gm, "__gkey", "left")
           .withColumn("allowed_groups",
                       F.coalesce(F.col("__groups"), F.array(*[F.lit(g) for g in default])))
           .drop("__gkey", "__groups"))
    return out


def groups_to_text(c) -> Column:
    """``["a", "b"]`` -> ``"a,b"`` (CSV form)."""
    return F.array_join(as_col(c), ",")


def text_to_groups(c) -> Column:
    """``"a,b"`` -> ``["a", "b"]``; empty text -> no groups."""
    c = as_col(c)
    return F.when((c.isNull()) | (c == ""), F.array().cast("array<string>")).otherwise(F.split(c, ","))


def effective_groups(groups: Iterable[str] | None) -> list[str]:
    """The caller's groups plus ``all``; no groups means ``all`` only."""
    out = sorted({g for g in (groups or []) if g})
    return out if PUBLIC_GROUP in out else out + [PUBLIC_GROUP]


def effective_groups_col(c) -> Column:
    """I2 on a column of group arrays."""
    return F.array_union(F.coalesce(as_col(c), F.array().cast("array<string>")), F.array(F.lit(PUBLIC_GROUP)))


def visible_to(df: DataFrame, groups: Iterable[str] | None, col: str = "allowed_groups") -> DataFrame:
    """Rows whose groups overlap the caller's effective groups. The groups
    enter the plan as literals, so no quoting or injection issue arises."""
    eff = F.array(*[F.lit(g) for g in effective_groups(groups)])
    return df.filter(F.arrays_overlap(F.col(col), eff))


def match_all_search(df: DataFrame, groups: Iterable[str] | None,
                     select: Sequence[str] = ("id", "title", "space_key", "allowed_groups"),
                     top: int = 50, key: str = "id") -> DataFrame:
    """M3: ``search("*")`` with the visibility filter: visible rows, chosen
    columns, first ``top`` by ``key`` (the result-size cap of the search API)."""
    return visible_to(df, groups).select(*select).orderBy(key).limit(top)


def users_frame(spark: SparkSession, users: Mapping[str, Sequence[str]]) -> DataFrame:
    """Callers as rows ``(user, groups)``."""
    return spark.createDataFrame([(u, list(g)) for u, g in users.items()], "user string, groups array<string>")


def visibility_pairs(docs: DataFrame, users: DataFrame, doc_key: str = "id") -> DataFrame:
    """Every (user, document) pair where the document is visible to the
    user, for many users at once.

    Both sides are exploded to one row per group and equi-joined on the group.
    A pair that shares several groups would appear once per shared group; only
    the row whose group is the smallest shared group is kept, so each visible
    pair is produced exactly once without a ``distinct`` shuffle. Spark
    broadcasts the user side if its measured bytes are below the session's
    threshold; otherwise both sides shuffle on the group and AQE splits hot
    groups such as ``all``.
    """
    u = (users.withColumn("__ugroups", effective_groups_col("groups"))
         .select("user", "__ugroups", F.explode("__ugroups").alias("__g")))
    d = (docs.select(doc_key, "allowed_groups")
         .withColumn("__dgroups", F.array_distinct("allowed_groups"))
         .select(doc_key, "__dgroups", F.explode("__dgroups").alias("__g")))
    pairs = d.join(u, "__g")
    first_shared = F.array_min(F.array_intersect("__dgroups", "__ugroups"))
    return pairs.filter(F.col("__g") == first_shared).select("user", doc_key)


def visibility_diff(expected: DataFrame, actual: DataFrame, keys: Sequence[str] = ("user", "id"),
                    by: str = "user") -> DataFrame:
    """Per ``by`` value: expected, actual, missing and unexpected counts and
    whether they match (multiset difference both ways)."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    tagged = (expected.select(*keys, one.alias("__e"), none.alias("__a"))
              .unionByName(actual.select(*keys, none.alias("__e"), one.alias("__a"))))
    counts = tagged.groupBy(*keys).agg(F.sum("__e").alias("__e"), F.sum("__a").alias("__a"))
    out = counts.groupBy(by).agg(
        F.sum("__e").alias("expected"), F.sum("__a").alias("actual"),
        F.sum(F.greatest(F.col("__e") - F.col("__a"), none)).alias("missing"),
        F.sum(F.greatest(F.col("__a") - F.col("__e"), none)).alias("unexpected"))
    return out.withColumn("passed", (F.col("missing") == 0) & (F.col("unexpected") == 0))


def _class_of(groups) -> Column:
    """A group set as text: the JSON of its sorted distinct groups. Equal sets
    have equal texts, whatever characters the names hold."""
    return F.to_json(F.array_sort(F.array_distinct(groups)))


def document_classes(docs: DataFrame, doc_key: str = "id") -> DataFrame:
    """Membership: (``doc_key``, doc_class), one row per document row."""
    return docs.select(doc_key, _class_of(F.col("allowed_groups")).alias("doc_class"))


def user_classes(users: DataFrame) -> DataFrame:
    """Membership: (user, user_class), the class being the effective groups."""
    return users.select("user", _class_of(effective_groups_col("groups")).alias("user_class"))


def visibility_classes(docs: DataFrame, users: DataFrame) -> DataFrame:
    """C6 by classes: (user_class, doc_class, n_users, n_docs, n_pairs) of all
    pairs of classes in which the users see the documents.

    Documents with the same group set are seen by the same users, so the sets
    are counted first (partial aggregation: a class of a third of all documents
    sends one row per task) and only classes are joined on their groups. With
    the two memberships this says the same as :func:`visibility_pairs`, without
    a row per (user, document). Documents without groups (null or empty) are
    seen by nobody and appear in no pair.
    """
    d = (docs.select(_class_of(F.col("allowed_groups")).alias("doc_class"))
         .groupBy("doc_class").agg(F.count(F.lit(1)).alias("n_docs"))
         .withColumn("allowed_groups", F.from_json("doc_class", "array<string>")))
    u = user_classes(users).groupBy("user_class").agg(F.count(F.lit(1)).alias("n_users"))
    seen = visibility_pairs(d, u.select(F.col("user_class").alias("user"),
                                        F.from_json("user_class", "array<string>").alias("groups")), "doc_class")
    return (seen.withColumnRenamed("user", "user_class").join(d.drop("allowed_groups"), "doc_class").join(u, "user_class")
            .select("user_class", "doc_class", "n_users", "n_docs", (F.col("n_users") * F.col("n_docs")).alias("n_pairs")))


def differing_buckets(expected: DataFrame, actual: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Buckets (of the hash of the keys) whose row counts or checksums differ.

    A checksum is the exact sum of two 64-bit hashes per row, so the order of
    the rows does not matter and repeated rows count. Null flags are hashed
    too, since Spark's hash skips nulls.
    """
    row = [*[F.col(k) for k in keys], *[F.col(k).isNull() for k in keys]]

    def sums(df: DataFrame, n: str, a: str, b: str) -> DataFrame:
        return (df.select(_bucket(keys, buckets).alias("__bucket"), F.xxhash64(*row).cast("decimal(38,0)").alias("__h"),
                          F.xxhash64(F.lit(1), *row).cast("decimal(38,0)").alias("__i"))
                .groupBy("__bucket").agg(F.count(F.lit(1)).alias(n), F.sum("__h").alias(a), F.sum("__i").alias(b)))

    both = sums(expected, "n1", "a1", "b1").join(sums(actual, "n2", "a2", "b2"), "__bucket", "full_outer")
    same = F.expr("n1 <=> n2 and a1 <=> a2 and b1 <=> b2")
    return both.where(~same).select("__bucket")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def visibility_diff_buckets(expected: DataFrame, actual: DataFrame, keys: Sequence[str] = ("user", "id"),
                            by: str = "user", buckets: int = 4096) -> DataFrame:
    """I1 on large results: the columns of :func:`visibility_diff`.

    Both sides are first summed to one checksum row per bucket; only rows of
    buckets that differ are shuffled and compared, so two results that agree
    but for a few rows cost two scans and a few buckets. The differing buckets
    are broadcast (at most ``buckets`` numbers). Both frames are read twice:
    pass stored ones. Equal checksums of different rows (two 64-bit sums that
    both agree by chance) are the only way to miss a difference.
    """
    differ = F.broadcast(differing_buckets(expected, actual, keys, buckets))

    def suspects(df: DataFrame) -> DataFrame:
        return df.select(*keys, _bucket(keys, buckets).alias("__bucket")).join(differ, "__bucket", "left_semi").drop("__bucket")

    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    n = (expected.select(by, one.alias("expected"), none.alias("actual"))
         .unionByName(actual.select(by, none.alias("expected"), one.alias("actual")))
         .groupBy(by).agg(F.sum("expected").alias("expected"), F.sum("actual").alias("actual")))
    wrong = (visibility_diff(suspects(expected), suspects(actual), keys, by)
             .select(F.col(by).alias("__by"), "missing", "unexpected"))
    out = (n.join(wrong, F.col(by).eqNullSafe(F.col("__by")), "left").drop("__by")
           .withColumns({c: F.coalesce(c, none) for c in ("missing", "unexpected")}))
    return out.withColumn("passed", (F.col("missing") == 0) & (F.col("unexpected") == 0))


def secured_documents(pages: DataFrame, group_map: DataFrame) -> DataFrame:
    """Searchable documents from silver pages, labelled with their groups."""
    docs = pages.select(F.col("page_id").alias("id"), "title", "space_key", "body_text",
                        F.col("created_by").alias("author"), "word_count")
    return label_groups(docs, group_map)
