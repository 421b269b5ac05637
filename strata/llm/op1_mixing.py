"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's words form a line: its documents in a shuffled order (hash of
the id), repeated as often as needed, cut into blocks of equally many words.
The mix is a sequence of slots. Slot i takes the van der Corput point of i and
maps it through the sources' cumulative numbers of blocks to a source; the
j-th slot of a source gets block j of its line. So every stretch of the mix
holds the sources in nearly the target proportions. Every source gets exactly
the blocks of its target (rounded to words, one word at least; the last block
is cut there); its slots after those stay empty.

Targets: weights 1, 2, 3, repeating over the sources by code point (null
last), share the total size; no target exceeds ``MOST`` times its source's
size, the excess goes to the others by weight. A source's line ends after
MOST rounds, so no document is taken more often.

Positions come from two-level sums over range-partitioned rows (source, hash,
row), so a source with a third of all rows is spread over many tasks.

A null or empty text has size 0 and is never taken. Rows that share an id are
separate rows. With no words at all every target is 0. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import before, column_like, ordered, read, stored

WEIGHTS = (1, 2, 3)
MOST = 3                    # rounds of a source
SLOTS_PER_SOURCE = 1 << 14
CELL_BITS = 12              # 2^12 equal parts of [0, 1) in which slots meet sources
CHUNK = 1 << 12             # slots that are ranked together


def word_count(col: str = "text"):
    return F.coalesce(F.regexp_count(col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target, cap, words: the target in whole words) of ``sized`` (source, size): one row per source."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()               # over one row per source
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((place - 1) % len(WEIGHTS) + 1).cast("int")).cast("bigint"))
    # the level to which all sources are filled: those whose cap lies below it stay at their cap
    order = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (weighed.withColumn("total", F.sum("source_size").over(everything))
             .withColumn("cap", F.col("source_size") * MOST)
             .withColumn("rest", F.col("total") - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
             .withColumn("open", F.sum("weight").over(later))
             .withColumn("capped", F.expr("cast(rest as decimal(38,0)) * weight > cast(cap as decimal(38,0)) * open")))
    # the first source that is not capped gives the level; later ones would give the same or less
    first = F.max(F.expr("if(capped, null, rest / open)")).over(everything)
    return (level.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double"))
                             .otherwise(F.col("weight") * F.coalesce(first, F.lit(0.0))))
            .withColumn("words", F.expr("if(target > 0, least(cap, greatest(1L, cast(round(target) as bigint))), 0L)"))
            .select("source", "source_size", "target", "cap", "words"))


def schedule(goal: DataFrame, total: int, sources: int) -> tuple[DataFrame, int]:
    """((slot, source, block), words per block) of a mix of ``total`` words."""
    spark = goal.sparkSession
    slots = max(1, min(total, SLOTS_PER_SOURCE * max(sources, 1)))
    size = -(-total // slots) if total else 1
    # at least as many points as blocks, so that every source meets as many points as it has blocks
    bits = max(1, (-(-total // size) + sources - 1).bit_length())
    shift = max(0, bits - CELL_BITS)
    # van der Corput: the bits of the slot number mirrored at the point, here in units of 1 / 2^bits
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), bits, "0")), 2, 10).cast("bigint")
    points = spark.range(1 << bits if total else 0).withColumnRenamed("id", "slot").withColumn("point", point).withColumn("cell", F.expr(f"shiftright(point, {shift})"))
    upto = F.sum("blocks").over(Window.orderBy(F.col("source").asc_nulls_last()))
    low, high = (F.expr(f"cast({n} as decimal(18,0)) * cast({1 << bits} as decimal(18,0)) div cast(all as decimal(18,0))") for n in ("(upto - blocks)", "upto"))
    spans = (goal.where("words > 0").withColumn("blocks", F.expr(f"(words + {size - 1}L) div {size}L"))
             .withColumn("upto", upto).withColumn("all", F.sum("blocks").over(Window.partitionBy()))
             .withColumn("low", low).withColumn("high", high)
             .select("source", "blocks", "low", "high", F.explode(F.expr(f"sequence(shiftright(low, {shift}), shiftright(high - 1, {shift}))")).alias("cell")))
    placed = (points.join(spans, "cell").where("low <= point and point < high")
              .select("slot", "source", "blocks", F.floor(F.col("slot") / CHUNK).cast("int").alias("run")))
    inside = F.row_number().over(Window.partitionBy("source", "run").orderBy("slot"))
    earlier = before(placed, F.lit(1), ["source"])
    ranks = (placed.withColumn("inside", inside).alias("p").join(earlier.alias("e"), F.expr("p.run = e.run and p.source <=> e.source"))
             .select("p.slot", "p.source", "p.blocks", (F.col("e.before") + F.col("p.inside") - 1).alias("block")))
    return ranks.where("block < blocks").drop("blocks"), size


def mix(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of ``docs`` (doc_id, text, source): its segments (slot, row,
    doc_id, round, first_word, n_words), the rows (row, doc_id, source, size),
    and the sources' targets."""
    return mix_rows(docs.select("doc_id", "source", word_count().alias("size"), F.monotonically_increasing_id().alias("row")))


def mix_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``mix`` of rows (doc_id, source, size, row) numbered by the caller."""
    by = ["source", "shuffle", "row"]
    runs = ordered(rows.withColumn("shuffle", F.xxhash64("doc_id")), by, "mix-rows")
    goal = stored(targets(runs), "mix-targets")
    total, sources = goal.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.count("*")).first()
    slots, size = schedule(goal, total, sources)
    window = Window.partitionBy("source", "run").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    placed = (runs.where("size > 0").withColumn("inside", F.coalesce(F.sum("size").over(window), F.lit(0))).alias("r")
              .join(before(runs, "size", ["source"]).alias("e"), F.expr("r.run = e.run and r.source <=> e.source"))
              .select("r.row", "r.doc_id", "r.source", "r.size", (F.col("inside") + F.col("before")).alias("at")))
    # a document covers words [at, at + size) of every round of its source's line
    lines = (placed.alias("r").join(goal.alias("g"), F.expr("r.source <=> g.source"))
             .select("r.*", "g.source_size", "g.words")
             .withColumn("round", F.explode(F.expr(f"sequence(0L, {MOST - 1}L)")))
             .withColumn("low", F.expr("round * source_size + at")).withColumn("high", F.expr("low + size"))
             .where("low < words").withColumn("high", F.least("high", "words"))
             .withColumn("block", F.explode(F.expr(f"sequence(low div {size}L, (high - 1) div {size}L)"))))
    segments = (lines.alias("d").join(slots.alias("s"), F.expr("d.block = s.block and d.source <=> s.source"))
                .select("s.slot", "d.row", "d.doc_id", "d.round",
                        F.expr(f"greatest(0L, d.block * {size}L - d.low)").alias("first_word"),
                        F.expr(f"least(d.high, (d.block + 1) * {size}L) - greatest(d.low, d.block * {size}L)").alias("n_words")))
    return segments, runs.drop("run", "shuffle"), goal


def taken(docs: DataFrame) -> DataFrame:
    """(row, doc_id, size, source, source_size, target, taken) of every row."""
    return taken_of(mix(docs))


def taken_of(parts: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """``taken`` of a mix."""
    segments, rows, goal = parts
    words = segments.groupBy("row").agg(F.sum("n_words").alias("taken"))
    return (rows.join(words, "row", "left").alias("r").join(goal.alias("g"), F.expr("r.source <=> g.source"))
            .select("r.row", "r.doc_id", "r.size", "r.source", "g.source_size", "g.target",
                    F.coalesce("r.taken", F.lit(0)).cast("bigint").alias("taken")))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of the mix: a row appears once for every round in which at
    least half of its words are taken (rows without words never); columns as
    they are."""
    # row numbers hold only within one read (they follow the splits), so the rows are written with theirs
    row, doc = column_like(docs.columns, "row"), column_like(docs.columns, "doc")
    whole = stored(docs.select(F.monotonically_increasing_id().alias(row), F.struct(*docs.columns).alias(doc)), "mix-docs")
    sized = whole.select(f"{doc}.doc_id", f"{doc}.source", word_count(f"{doc}.text").alias("size"), F.col(row).alias("row"))
    copies = (taken_of(mix_rows(sized)).select(F.col("row").alias(row), F.floor(F.try_divide("taken", "size") + 0.5).cast("int").alias("copies"))
              .where("copies > 0"))
    return (whole.join(copies, row).withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
            .select(f"{doc}.*"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
