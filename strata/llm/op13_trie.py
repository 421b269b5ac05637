"""Prefix trie of conversations, screened with a count-min sketch.

Every prefix of a conversation has a digest. All digests are counted in a
count-min sketch of fixed size, which never counts too little: where it says
one, the prefix belongs to one conversation, and so do all longer ones. Those
tails are nodes of one member and are emitted where they stand; only prefixes
that may be shared are shuffled and grouped exactly, as digests. Texts are
shuffled once, to number the turns.

A turn's digest is its md5 (role and text, framed); a prefix's digest is the
exclusive or of 2 x 64-bit hashes of (turn digest, position), so it can be
carried on across the runs of a conversation that is longer than a task takes.

What a shared node sums over its subtree is dealt to conversations: a node's
saving and its leaf belong to its smallest member, so the sums over a subtree are
sums over the node's members, and no ancestors are joined.

Turns stand in the order of ``turn`` (null first), then role and text. Null role
or text counts as empty; rows with a null conversation take no part. Repeated
rows are turns of their own. Extra columns are ignored. An empty table has no
nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import mix, ordered, read, stored

# The sketch: rows of counters, counters of a row (a power of two), and the
# slices in which partial sketches are added up. Its size (3 MB) is fixed: with
# many more prefixes than counters it proves less, and more is shuffled.
SKETCH_ROWS = 3
SKETCH_WIDTH = 1 << 20
SLICES = 48

# Nodes that hold more than this share of all shared prefixes are joined by
# broadcast (so at most 4,000 rows), others by their digest.
HOT_SHARE = 4_000

_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def hashed_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv, pos, digest, bytes): the turns numbered from 1 within their
    conversation. Runs of a range partitioning are numbered apart, so that a
    conversation of any length is split among tasks."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.select("conv", "turn", "role", "text",
                       F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest"),
                       F.octet_length("text").cast("bigint").alias("bytes"))
    by = ["conv", "turn", "role", "text"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the row's place in its run: the low bits of the id, whose high bits are the run
    runs = stored(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
                  .withColumn("id", F.monotonically_increasing_id()).drop("role", "text"), "op13-turns")
    runs = runs.withColumns({"run": F.shiftright("id", 33), "at": F.col("id").bitwiseAND((1 << 33) - 1)})
    runs = runs.withColumn("own", F.col("at") - F.min("at").over(Window.partitionBy("run", "conv")) + 1)
    totals = runs.groupBy("conv", "run").agg(F.count(F.lit(1)).alias("n"))
    past = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (totals.select("conv", "run", F.sum("n").over(past).alias("before"))
               .filter(F.col("before").isNotNull()))             # a row per run at most
    return (runs.join(F.broadcast(earlier), ["conv", "run"], "left")
            .select("conv", (F.col("own") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "bytes"))


def rebuilt(turns: DataFrame, group: int = 5, modulus: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the start of their group's first one: of
    conversation c the first h = crc32(decimal c) % ``modulus`` turns are those of
    c - c % ``group`` (as many as it has), then c's own turns after its first h.

    Returns ((conv, size), (conv, pos, digest, bytes)); conversations without
    turns are in the first table only.
    """
    own = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    heads = own.select("conv", F.col("own").cast("bigint").alias("own"), (F.col("conv") - F.col("conv") % group).alias("base"),
                       (F.crc32(F.col("conv").cast("string").cast("binary")) % modulus).alias("h"))
    bases = own.select(F.col("conv").alias("base"), F.col("own").alias("base_size"))
    convs = stored(heads.join(bases, "base", "left").select(
        "conv", "own", "base", "h", F.least("h", F.coalesce("base_size", F.lit(0))).cast("bigint").alias("taken"))
        .withColumn("size", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "op13-convs")
    start = (turns.filter((F.col("pos") < modulus) & (F.col("conv") % group == 0))
             .withColumnRenamed("conv", "base")
             .join(convs.select("conv", "base", "taken"), "base").filter(F.col("pos") <= F.col("taken"))
             .select("conv", F.col("pos").cast("bigint").alias("pos"), "digest", "bytes"))
    rest = (turns.join(convs.select("conv", "h", "taken"), "conv").filter(F.col("pos") > F.col("h"))
            .select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "bytes"))
    return convs.select("conv", "size"), start.unionByName(rest)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, run, a, b, pa, pb, bytes): the digest (a, b) of every
    prefix of one turn or more and that of its parent."""
    turns = ordered(turns, ["conv", "pos"], "op13-rebuilt").withColumns({
        "ha": F.xxhash64("digest", "pos", F.lit("a")), "hb": F.xxhash64("digest", "pos", F.lit("b"))})
    window = Window.partitionBy("run", "conv").orderBy("pos")
    inside = turns.withColumns({"xa": F.bit_xor("ha").over(window), "xb": F.bit_xor("hb").over(window)})
    totals = turns.groupBy("conv", "run").agg(F.bit_xor("ha").alias("ta"), F.bit_xor("hb").alias("tb"))
    past = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (totals.select("conv", "run", F.bit_xor("ta").over(past).alias("ea"), F.bit_xor("tb").over(past).alias("eb"))
               .filter(F.col("ea").isNotNull()))                  # a row per run at most
    none = F.lit(0).cast("bigint")
    full = inside.join(F.broadcast(earlier), ["conv", "run"], "left").withColumns({
        "a": F.col("xa").bitwiseXOR(F.coalesce("ea", none)), "b": F.col("xb").bitwiseXOR(F.coalesce("eb", none))})
    return full.select("conv", F.col("pos").alias("depth"), "run", "a", "b",
                       F.col("a").bitwiseXOR(F.col("ha")).alias("pa"), F.col("b").bitwiseXOR(F.col("hb")).alias("pb"), "bytes")


def _cells(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Counter of each digest in each row of the sketch."""
    cells = np.empty((SKETCH_ROWS, len(a)), dtype=np.int64)
    for r in range(SKETCH_ROWS):
        cells[r] = (mix(a + b * _SEEDS[r]) & np.uint64(width - 1)).astype(np.int64) + r * width
    return cells


def _digests(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("a", "b"))


def sketch(rows: DataFrame, width: int = SKETCH_WIDTH) -> np.ndarray:
    """Count-min sketch of the digests (a, b): 0, 1 or 2 (two or more) per
    counter. Tasks sketch their rows; slices are added up apart; what reaches
    the driver is one sketch, 3 MB."""
    size = SKETCH_ROWS * width // SLICES

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH_ROWS * width, dtype=np.uint8)
        for batch in batches:
            cells, n = np.unique(_cells(*_digests(batch), width).ravel(), return_counts=True)
            counts[cells] = np.minimum(counts[cells] + np.minimum(n, 2), 2).astype(np.uint8)
        full = [k for k in range(SLICES) if counts[k * size:(k + 1) * size].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([counts[k * size:(k + 1) * size].tobytes() for k in full], pa.binary())],
            ["slice", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                have = sums.setdefault(k, np.zeros(size, dtype=np.uint8))
                np.minimum(have + np.frombuffer(raw.as_buffer(), dtype=np.uint8), 2, out=have)
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()),
                                          pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["slice", "counts"])
    schema = "slice int, counts binary"
    slices = rows.select("a", "b").mapInArrow(partial, schema).repartition(SLICES, "slice").mapInArrow(added, schema)
    out = np.zeros(SKETCH_ROWS * width, dtype=np.uint8)
    for k, raw in slices.collect():
        out[k * size:(k + 1) * size] = np.frombuffer(raw, dtype=np.uint8)
    return out


def screened(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """``rows`` with ``one``: the sketch proves that one conversation has this prefix."""
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            one = (table[_cells(*_digests(batch), len(table) // SKETCH_ROWS)] < 2).any(axis=0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(one)], [*batch.schema.names, "one"])
    return rows.mapInArrow(fn, T.StructType([*rows.schema.fields, T.StructField("one", T.BooleanType())]))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(a, b, depth, ends_sha256) of (a, b, depth, conv): sha256 of the decimal
    ids in order, comma-joined. Ranges of the order are joined into pieces of
    text in parallel; one pass over the pieces of a node hashes them."""
    key = ["a", "b", "depth"]
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = (ends.repartitionByRange(parts, *key, "conv").sortWithinPartitions(*key, "conv")
                .select(*key, "conv", F.spark_partition_id().alias("run")))

    def groups(cols: list[np.ndarray]) -> list[tuple[int, int]]:
        new = np.zeros(len(cols[0]), dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cut = [0, *np.flatnonzero(new).tolist(), len(new)]
        return list(zip(cut, cut[1:]))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for seq, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in key]
            convs = batch.column("conv").to_pylist()
            spans = groups(cols)
            at = np.array([s for s, _ in spans])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c[at]) for c in cols), batch.column("run").take(pa.array(at)),
                 pa.array(np.full(len(at), seq, dtype=np.int64)),
                 pa.array([",".join(map(str, convs[s:e])) for s, e in spans], pa.string())], [*key, "run", "seq", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            out = []
            for a, b, depth, ids in zip(*(batch.column(c).to_pylist() for c in (*key, "ids"))):
                if (a, b, depth) == now:
                    sha.update(b",")
                else:
                    if now is not None:
                        out.append((*now, sha.hexdigest()))
                    now, sha = (a, b, depth), hashlib.sha256()
                sha.update(ids.encode())
            yield _batch(out)
        if now is not None:
            yield _batch([(*now, sha.hexdigest())])

    def _batch(out: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                          [*key, "ends_sha256"])
    shape = "a bigint, b bigint, depth bigint"
    return (in_order.mapInArrow(pieces, f"{shape}, run int, seq bigint, ids string")
            .repartition(parts, *key).sortWithinPartitions(*key, "run", "seq")
            .mapInArrow(hashed, f"{shape}, ends_sha256 string"))


def with_parent(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` (pa, pb, depth...) with ``parent_conv_id`` from the shared
    ``nodes``. Nodes of many members meet their children by broadcast: with
    more than one in HOT_SHARE of all memberships, there are at most HOT_SHARE."""
    total = nodes.agg(F.sum("n_convs").alias("n")).first()["n"] or 0
    look = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"),
                        F.col("conv_id").alias("parent"), "n_convs")
    hot = look.filter(F.col("n_convs") * HOT_SHARE > total).drop("n_convs").withColumnRenamed("parent", "hot_parent")
    rest = look.filter(F.col("n_convs") * HOT_SHARE <= total).drop("n_convs")
    key = ["pa", "pb", "depth"]
    met = stored(rows.join(F.broadcast(hot), key, "left"), "op13-parents")
    found = met.filter(F.col("hot_parent").isNotNull()).withColumn("parent_conv_id", F.col("hot_parent"))
    others = met.filter(F.col("hot_parent").isNull()).join(rest, key, "left").withColumn("parent_conv_id", F.col("parent"))
    return found.drop("hot_parent").unionByName(others.drop("hot_parent", "parent"))


def trie(convs: DataFrame, turns: DataFrame, width: int = SKETCH_WIDTH) -> DataFrame:
    """All nodes of the prefix trie of (conv, size) and (conv, pos, digest,
    bytes): conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and the digest (a, b)."""
    rows = stored(prefixes(turns), "op13-prefixes")
    marked = screened(rows, sketch(rows, width))
    # a conversation's tail starts at its first prefix proven to be its own
    window = Window.partitionBy("run", "conv").orderBy("depth")
    marked = stored(marked.withColumn("tail", F.coalesce(F.max("one").over(window), F.lit(False))), "op13-marked")
    began = marked.filter("one").groupBy("conv").agg(F.min("depth").alias("start"))
    convs = stored(convs.join(began, "conv", "left"), "op13-sizes")
    # runs that a conversation entered with its tail begun
    late = (marked.groupBy("conv", "run").agg(F.max("tail").alias("any"))
            .withColumn("past", F.max("any").over(Window.partitionBy("conv").orderBy("run")
                                                  .rowsBetween(Window.unboundedPreceding, -1)))
            .filter("past").select("conv", "run", F.lit(True).alias("late")))      # a row per run at most
    marked = (marked.join(F.broadcast(late), ["conv", "run"], "left")
              .withColumn("tail", F.col("tail") | F.coalesce("late", F.lit(False))).drop("late"))
    sized = marked.join(convs, "conv")
    none = F.lit(0).cast("bigint")

    # prefixes that may be shared, and the root as prefix of depth 0
    shared = sized.filter(~F.col("tail")).select("conv", "depth", "a", "b", "pa", "pb", "bytes", "size", "start")
    root = convs.select("conv", none.alias("depth"), none.alias("a"), none.alias("b"), none.alias("pa"), none.alias("pb"),
                        none.alias("bytes"), "size", "start")
    shared = stored(root.unionByName(shared), "op13-shared")
    key = ["a", "b", "depth"]
    nodes = stored(shared.groupBy(*key).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("size").alias("longest"),
        F.first("bytes").alias("bytes"), F.first("pa").alias("pa"), F.first("pb").alias("pb")), "op13-nodes")

    # what a node adds to its ancestors goes to its smallest member
    one = F.lit(1).cast("bigint")
    given = nodes.select(F.col("conv_id").alias("conv"), "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
                         (F.col("longest") == F.col("depth")).cast("bigint").alias("leaf"), none.alias("child"))
    child = nodes.filter("depth > 0").select(F.col("conv_id").alias("conv"), (F.col("depth") - 1).alias("depth"),
                                             none.alias("saved"), none.alias("leaf"), one.alias("child"))
    dealt = given.unionByName(child).groupBy("conv", "depth").agg(*[F.sum(c).alias(c) for c in ("saved", "leaf", "child")])
    dealt = shared.select("conv", *key, "start").join(dealt, ["conv", "depth"], "left")
    below = Window.partitionBy("conv").orderBy(F.col("depth").desc())
    whole = Window.partitionBy("conv")
    own_tail = F.col("start").isNotNull().cast("bigint")
    summed = (dealt.withColumns({
        "saved": F.sum(F.coalesce("saved", none)).over(below),
        "leaf": F.sum(F.coalesce("leaf", none)).over(whole) + own_tail,
        "child": F.coalesce("child", none) + F.col("start").eqNullSafe(F.col("depth") + 1).cast("bigint")})
        .groupBy(*key).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"),
                           F.sum("child").alias("n_children")))
    ends = ends_digest(shared.filter(F.col("size") == F.col("depth")).select(*key, "conv"))
    full = (nodes.join(summed, key).join(ends, key, "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "a", "b"]

    # tails: nodes of one member
    tails = sized.filter("tail").select(
        F.col("conv").alias("conv_id"), "depth", one.alias("n_convs"),
        (F.col("depth") < F.col("size")).cast("bigint").alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens"),
        F.when(F.col("depth") == F.col("size"), F.sha2(F.col("conv").cast("string").cast("binary"), 256))
        .otherwise(F.lit(EMPTY_SHA256)).alias("ends_sha256"), "a", "b", "pa", "pb", "start")
    first = tails.filter(F.col("depth") == F.col("start")).drop("start")
    inner = tails.filter(F.col("depth") > F.col("start")).withColumn("parent_conv_id", F.col("conv_id"))
    wanting = full.drop("longest", "bytes").select(*first.columns).unionByName(first)
    return with_parent(wanting, nodes).select(*columns).unionByName(inner.select(*columns))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(hashed_turns(read(spark, sf_dir, "conversations")), "op13-numbered")
    convs, rows = rebuilt(turns)
    return trie(convs, rows).drop("a", "b")
