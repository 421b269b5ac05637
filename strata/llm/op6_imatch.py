"""I-Match document fingerprints with randomised lexicons (built-in
expressions only).

Terms are lower-cased words. The lexicon holds the terms whose document
frequency over different texts (copies count once) lies in a band (``RAREST``
to ``MOST_COMMON`` of them, two at least), that is, a band of inverse document
frequency. A text with fewer lexicon terms than one in ``FEW`` of its distinct
terms (many near copies push theirs out of the band), or with none in any
sub-lexicon, takes all its distinct terms as lexicon. Each of
``LEXICONS`` random sub-lexicons keeps a term with probability 1/4, 1/8, ...
(``LEVELS`` densities in turn), so that texts of any length meet some
sub-lexicons in a few terms. A fingerprint is one hash per sub-lexicon over
the document's distinct terms in it; the hash (XOR of 64-bit term hashes) does
not depend on order, which is what sorting the terms would be for. No term: no
hash ("-"); a text whose terms are in no sub-lexicon at all has the hash over
all of them in the first place, so that only texts without terms have no hash.

The likeness of two fingerprints is the share of equal hashes among the
sub-lexicons in which at least one of the two has a hash; 1 if there is none.

The edited text takes the last quarter of its characters from the next
document's beginning (by id, null first, then by row; after the last, the
first). Ids are cut into ranges at quantiles, each range also gets the first
row of the next range, and the next row is found within the range.

Null texts count as empty: no terms, empty edited text. Rows that share an id
are separate rows. A single document is its own next. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import read, stored

LEXICONS, LEVELS, DENSEST = 24, 8, 2
RAREST, MOST_COMMON = 0.0005, 0.02
FEW = 8

_SPACE = r"[\x20\x09-\x0D]+"
_NO_TERM = 0                # term hash of a marker that every document has


def terms(text):
    """Distinct 64-bit hashes of a text's terms, and the marker."""
    words = F.filter(F.split(F.lower(text), _SPACE), lambda w: w != "")
    return F.array_append(F.transform(F.array_distinct(words), lambda w: F.xxhash64(w)), F.lit(_NO_TERM).cast("bigint"))


def lexicon(docs: DataFrame) -> DataFrame:
    """(term): the band's terms."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).distinct()
    counts = stored(texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").count(), "terms")
    total = counts.where(F.col("term") == _NO_TERM).agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    return stored(counts.where((F.col("term") != _NO_TERM) & (F.col("count") >= max(2, RAREST * total))
                               & (F.col("count") <= max(2, MOST_COMMON * total))).select("term"), "lexicon")


def hashes(rows: DataFrame, keys: list[str], texts: list[str], words: DataFrame) -> DataFrame:
    """keys and, per text column t and sub-lexicon i, the hash t_i (0: none)."""
    # proven bound: each term of the band is in at least RAREST of all texts, so the lexicon holds at most
    # (mean distinct terms of a text) / RAREST numbers, whatever the number of texts
    words = F.broadcast(words.withColumn("band", F.lit(1)))
    none = F.lit(0).cast("bigint")
    sides = F.array(*[F.struct(F.lit(j).alias("side"), terms(F.col(t)).alias("terms")) for j, t in enumerate(texts)])
    exploded = (rows.select(*keys, F.explode(sides).alias("s")).select(*keys, "s.side", F.explode("s.terms").alias("term"))
                .join(words, "term", "left"))
    # lexicon i takes a term in 2 ** (level + DENSEST): one hash decides for LEVELS lexicons, by bits of their own
    groups = range(-(-LEXICONS // LEVELS))
    exploded = exploded.withColumns({f"hash_{g}": F.xxhash64("term", F.lit(g)) for g in groups})

    def takes(i):
        level = i % LEVELS
        first = sum(v + DENSEST for v in range(level))
        return F.col(f"hash_{i // LEVELS}").bitwiseAND(F.lit(((1 << (level + DENSEST)) - 1) << first)) == 0
    mask = F.when(F.col("term") == _NO_TERM, 0).otherwise(sum((
        F.when(takes(i), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(LEXICONS)), F.lit(0)))
    part = [F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, F.col("term")).otherwise(none) for i in range(LEXICONS)]
    found = exploded.withColumn("mask", mask).groupBy(*keys, "side").agg(
        F.count("band").alias("n_band"), F.count_if(F.col("term") != _NO_TERM).alias("n_terms"), F.bit_xor("term").alias("every"),
        *[F.bit_xor(F.when(F.col("band").isNotNull(), part[i]).otherwise(none)).alias(f"band_{i}") for i in range(LEXICONS)],
        *[F.bit_xor(part[i]).alias(f"all_{i}") for i in range(LEXICONS)])

    def empty(prefix):
        return F.greatest(*[(F.col(f"{prefix}_{i}") != 0) for i in range(LEXICONS)]) == F.lit(False)
    whole = found.withColumn("few", (F.col("n_band") * FEW < F.col("n_terms")) | empty("band")).withColumn("bare", empty("all"))
    own = whole.select(*keys, "side", *[
        F.when(~F.col("few"), F.col(f"band_{i}")).when(F.col("bare"), F.col("every") if i == 0 else none).otherwise(F.col(f"all_{i}")).alias(f"h_{i}")
        for i in range(LEXICONS)])
    return own.groupBy(*keys).agg(*[F.bit_xor(F.when(F.col("side") == j, F.col(f"h_{i}")).otherwise(none)).alias(f"{t}_{i}")
                                    for j, t in enumerate(texts) for i in range(LEXICONS)])


def written(prefix: str):
    return F.concat_ws(".", *[F.when(F.col(f"{prefix}_{i}") == 0, F.lit("-")).otherwise(F.lower(F.hex(f"{prefix}_{i}"))) for i in range(LEXICONS)])


def likeness(a: str, b: str):
    """Share of equal hashes of two fingerprints given as columns a_i, b_i."""
    some = sum((F.when((F.col(f"{a}_{i}") != 0) | (F.col(f"{b}_{i}") != 0), 1).otherwise(0) for i in range(LEXICONS)), F.lit(0))
    same = sum((F.when((F.col(f"{a}_{i}") != 0) & (F.col(f"{a}_{i}") == F.col(f"{b}_{i}")), 1).otherwise(0) for i in range(LEXICONS)), F.lit(0))
    return F.when(some == 0, F.lit(1.0)).otherwise(same / some)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs`` (doc_id, text)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    return hashes(rows, ["row", "doc_id"], ["text"], lexicon(docs)).select("doc_id", written("text").alias("fingerprint"))


def with_next(rows: DataFrame) -> DataFrame:
    """``rows`` (row, doc_id, text) with next_row, next_id and next_text. ``row``
    must be the same at every evaluation: rows are placed in two of them."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], F.lit(10_000))).first()[0] or []
    cuts = sorted(set(cuts))
    bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("doc_id"))) if cuts else F.lit(0)
    placed = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(bucket).cast("int"))
    # the first row of each range, handed to the range before it (the first range's to the last)
    order = F.struct(F.col("doc_id").isNotNull().alias("n"), "doc_id", "row")
    firsts = placed.groupBy("bucket").agg(F.min(F.struct(*[order.alias("o"), F.col("text").alias("text")])).alias("f"))
    ranges = Window.orderBy("bucket")                       # over one row per range
    everything = Window.partitionBy()
    ghosts = (firsts.withColumn("to", F.coalesce(F.lag("bucket").over(ranges), F.max("bucket").over(everything)))
              .select("f.o.row", "f.o.doc_id", "f.text", F.col("to").alias("bucket"), F.lit(True).alias("ghost")))
    inside = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").asc_nulls_first(), "row")
    return (placed.withColumn("ghost", F.lit(False)).select("row", "doc_id", "text", "bucket", "ghost").union(ghosts)
            .withColumns({"next_row": F.lead("row").over(inside), "next_id": F.lead("doc_id").over(inside),
                          "next_text": F.lead("text").over(inside)})
            .where("not ghost").drop("ghost", "bucket"))


def numbered_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row) of a table read from files: ``row`` hashes the row's
    file and place in it, so it does not depend on how the files are split
    (with the id it tells rows apart; alone it need not)."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row"))


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = (with_next(numbered_rows(docs)).withColumn("n_chars", n.cast("bigint"))
              .withColumn("edited", F.concat(F.expr("left(text, length(text) - cast(length(text) div 4 as int))"), F.left("next_text", cut))))
    keys = ["row", "doc_id", "n_chars", "next_row", "next_id", "edited_sha256"]
    keyed = edited.withColumn("edited_sha256", F.sha2("edited", 256)).select(*keys, "text", "edited")
    own = stored(hashes(keyed, keys, ["text", "edited"], lexicon(docs.select("doc_id", "text"))), "imatch")
    after = own.select(F.col("row").alias("after_row"), F.col("doc_id").alias("after_id"),
                       *[F.col(f"text_{i}").alias(f"next_{i}") for i in range(LEXICONS)])
    met = own.join(after, (F.col("next_row") == F.col("after_row")) & F.col("next_id").eqNullSafe(F.col("after_id")), "left")
    return met.select(
        "doc_id", "n_chars", "edited_sha256", written("text").alias("fingerprint"), written("edited").alias("edited_fingerprint"),
        likeness("text", "edited").alias("near_edited"), likeness("text", "next").alias("near_next"))
