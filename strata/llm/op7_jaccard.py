"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct word shingles (64-bit hashes). Each
shingle flips one bit of the document's sketch, so the Hamming distance of two
sketches never exceeds the symmetric difference of their sets. A sketch is cut
into pieces of ``2^16`` bits; a piece is known by the XOR of the codes of its
set bits. Within a band of set sizes a similarity of p % allows at most D
differing shingles, so with D + 1 + S pieces at least 1 + S pieces agree
(pigeonhole): sketches are joined on equal pieces, and the pairs are verified
on the whole sets. S, the slack, is a quarter of D, at least ``SLACK``. Empty
pieces are left out unless a sketch has more than S of them, which keeps the
argument intact; what they leave of S is the sketch's room (none if it has
more empty ones): without its most frequent pieces, as many as its room, a
sketch still shares a piece with every sketch of a link.

Documents with equal sets form one class, represented by its smallest id
before anything else happens. A piece shared by many classes never yields all
pairs: postings are range-partitioned by (piece, node), so one piece may span
tasks, and every task links a piece's nodes to the first one it holds (the
firsts of one piece are linked among themselves). Links found this way give
components; only nodes that share a piece, not counting each one's most
frequent pieces in its room, and still lie in different components are then
compared across: their sketches meet in blocks, and the
pairs whose Hamming distance does not rule a link out are verified. So no
link between components is lost, and no piece yields rows for all its pairs.

Null and empty texts have an empty set and link with nothing. A null id takes
part in nothing and gets a null component. Rows that share an id and a text are one
document; one id with different texts stands for several. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import column_like, map_batches, mix, numbered, ordered, read, stored, word_hashes
from strata.llm.graph import joined

SLACK = 2                   # least slack of a band
BAND_RATIO = 1.5
BLOCK = 1_000_000           # bytes of text in work at a time
FILTER_BITS = 1 << 23       # size of the bit set that thins out the second read
GROUP = 256                 # members of a hub that are verified in one group

_U = np.uint64
_EMPTY = np.empty(0, dtype=np.uint64)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; the whole sequence is
    one shingle if there are fewer words."""
    if not text:
        return _EMPTY
    h = word_hashes(text.encode().lower())
    if not len(h):
        return _EMPTY
    k = min(words, len(h))
    x = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        x = mix(x * _U(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i])
    return np.unique(x)


def bands(percent: int, most: int) -> list[tuple[int, int, int]]:
    """(smallest size, pieces, slack) of the bands up to size ``most``."""
    out, low = [], 1
    while low <= most:
        high = max(low + 1, int(low * BAND_RATIO))
        apart = 2 * (high - 1) * (100 - percent) // (100 + percent)
        slack = max(SLACK, apart // 4)
        out.append((low, apart + 1 + slack, slack))
        low = high
    return out


def cut(own: np.ndarray, percent: int, table: list[tuple[int, int, int]]):
    """(band, its slack, value of each piece, 0 if empty) for the band of the
    set's size, and for the next band if a similar set can lie there."""
    n = len(own)
    if not n:
        return
    lows = [low for low, _, _ in table]
    band = int(np.searchsorted(lows, n, side="right")) - 1
    for i in (band, band + 1):
        if i > band and (i >= len(table) or 100 * n < percent * lows[i]):
            break
        _, count, slack = table[i]
        x = mix(own + _U(0xA0761D6478BD642F * (i + 1) % (1 << 64)))
        piece = ((x >> _U(32)) * _U(count)) >> _U(32)
        code = mix((piece << _U(16)) | (x & _U(0xFFFF)))
        value = np.zeros(count, dtype=np.uint64)
        np.bitwise_xor.at(value, piece.astype(np.int64), code)
        yield i, slack, value


def sketch_keys(own: np.ndarray, percent: int, table: list[tuple[int, int, int]]) -> np.ndarray:
    """Keys of the sketch's pieces; the last bit is that of the band."""
    out = [np.empty(0, dtype=np.uint64)]
    for i, slack, value in cut(own, percent, table):
        filled = np.flatnonzero(value) if (value == 0).sum() <= slack else np.arange(len(value))
        key = mix(value[filled] ^ mix(filled.astype(np.uint64) + _U(i << 40) + _U(1 << 60)))
        out.append((key & ~_U(1)) | _U(i & 1))
    return np.concatenate(out).view(np.int64)


def rooms(own: np.ndarray, percent: int, table: list[tuple[int, int, int]]) -> tuple[int, int]:
    """Room of the sketch in its even and in its odd band."""
    out = [0, 0]
    for i, slack, value in cut(own, percent, table):
        out[i & 1] = max(0, slack - int((value == 0).sum()))
    return tuple(out)


def class_of(own: np.ndarray) -> tuple[int | None, int | None]:
    if not len(own):
        return None, None
    return int(np.bitwise_xor.reduce(mix(own ^ _U(0x51ED27)))) - (1 << 63), int(mix(own + _U(len(own))).sum(dtype=np.uint64)) - (1 << 63)


def classes(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, c1, c2): set size and class of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        def fn(batch):
            sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
            c = [class_of(s) for s in sets]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([a for a, _ in c], pa.int64()), pa.array([b for _, b in c], pa.int64())], ["doc_id", "n", "c1", "c2"])
        return fn
    return map_batches(docs.select("doc_id", "text"), make, f"doc_id {kind}, n bigint, c1 bigint, c2 bigint", BLOCK)


def postings(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(key, node): the pieces of one representative of each class."""
    table = bands(percent, 1 << 40)

    def make():
        def fn(batch):
            sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
            c = [class_of(s) for s in sets]
            keys = [sketch_keys(s, percent, table) for s in sets]
            at = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([a for a, _ in c], pa.int64()), pa.array([b for _, b in c], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(keys)))], ["doc_id", "c1", "c2", "keys"])
        return fn
    rows = map_batches(docs.select("doc_id", "text").where("doc_id is not null"), make,
                       "doc_id bigint, c1 bigint, c2 bigint, keys array<bigint>", BLOCK)
    return (rows.where("c1 is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys"))
            .select(F.explode("keys").alias("key"), "node"))


def _shared(batches):
    """Of rows sorted by (key, node): (key, node, hub, edge) for keys with two
    nodes or more in this task, hub being the first node; the first and last
    key of the task are always kept (``edge``), as they may go on next door."""
    held_key = held_hub = None          # the last key so far, and its hub
    waiting = None                      # its single row, not yet given out
    first_key = None

    def out(key, node, hub, edge):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(hub), pa.array(edge)],
                                          ["key", "node", "hub", "edge"])
    for batch in batches:
        key = batch.column("key").to_numpy(zero_copy_only=False)
        node = batch.column("node").to_numpy(zero_copy_only=False)
        if not len(key):
            continue
        if waiting is not None:
            key, node = np.concatenate([[held_key], key]), np.concatenate([[waiting], node])
            waiting = None
            goes_on = False
        else:
            goes_on = held_key is not None and key[0] == held_key
        if first_key is None:
            first_key = key[0]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        hub = np.repeat(node[start], size)
        if goes_on:
            hub[:size[0]] = held_hub
        many = np.repeat(size > 1, size)
        if goes_on:
            many[:size[0]] = True
        edge = key == first_key
        keep = many | edge
        held_key, held_hub = key[-1], hub[-1]
        if not keep[-1]:
            waiting = node[-1]
        if keep.any():
            yield out(key[keep], node[keep], hub[keep], edge[keep])
    if held_key is not None:
        # the task's last key: its hub again, as an edge
        yield out(np.array([held_key]), np.array([held_hub if waiting is None else waiting]),
                  np.array([held_hub if waiting is None else waiting]), np.array([True]))


def shared_pieces(posts: DataFrame) -> DataFrame:
    parts = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (posts.repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node")
            .mapInArrow(_shared, "key bigint, node bigint, hub bigint, edge boolean"))


def _bits_of(nodes: DataFrame) -> bytes:
    """A bit set of fixed size with the hashes of ``nodes`` (at most
    FILTER_BITS / 64 rows of two numbers reach the driver)."""
    h = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS))
    rows = (nodes.select(F.floor(h / 64).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(node), {FILTER_BITS}) % 64 as int))").alias("b"))
            .groupBy("w").agg(F.expr("bit_or(b)").alias("b"))).toPandas()
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    bits[rows["w"].to_numpy(dtype=np.int64)] = rows["b"].to_numpy(dtype=np.int64)
    return bits.tobytes()


def _of_nodes(docs: DataFrame, nodes: DataFrame, words: int, make_row, fields: dict[str, pa.DataType], schema: str) -> DataFrame:
    """One row of ``make_row(set)`` for each of the given nodes. The bit set
    spares most other documents the work; the join is what decides."""
    bits = docs.sparkSession.sparkContext.broadcast(_bits_of(nodes))
    h = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(FILTER_BITS))

    def make():
        own = np.frombuffer(bits.value, dtype=np.uint64)

        def fn(batch):
            at = batch.column("h").to_numpy(zero_copy_only=False)
            hit = (own[at // 64] >> (at % 64).astype(np.uint64)) & _U(1) == 1
            batch = batch.filter(pa.array(hit))
            rows = [make_row(shingles(t, words)) for t in batch.column("text").to_pylist()]
            cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(fields.values())]
            return pa.RecordBatch.from_arrays([batch.column("node"), *cols], ["node", *fields])
        return fn
    found = map_batches(docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("node"), "text", h.alias("h")),
                        make, schema, BLOCK)
    return found.join(nodes, "node", "left_semi").groupBy("node").agg(*[F.min(f).alias(f) for f in fields])


def sets_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, own binary): the sets of the given nodes."""
    return _of_nodes(docs, nodes, words, lambda own: (own.tobytes(),), {"own": pa.binary()}, "node bigint, own binary")


def sketch(own: np.ndarray) -> tuple[int, bytes]:
    """Set size and parity sketch of about one bit per shingle, a power of
    two; a wide one folds to a narrow one by XOR of its halves."""
    width = max(512, 1 << (len(own) - 1).bit_length())
    at = (mix(own ^ _U(0x2545F4914F6CDD1D)) & _U(width - 1)).astype(np.int64)
    return len(own), np.packbits(np.bincount(at, minlength=width).astype(np.uint8) & 1, bitorder="little").tobytes()


def sketches_of(docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, n, sketch, room_even, room_odd) of the given nodes."""
    table = bands(percent, 1 << 40)
    return _of_nodes(docs, nodes, words, lambda own: (*sketch(own), *rooms(own, percent, table)),
                     {"n": pa.int64(), "sketch": pa.binary(), "room_even": pa.int64(), "room_odd": pa.int64()},
                     "node bigint, n bigint, sketch binary, room_even bigint, room_odd bigint")


def near_pairs(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, member, ...) whose sketches do not rule a link out."""
    columns = pairs.columns

    def run(batches):
        for batch in batches:
            keep = []
            for n, a, n2, b in zip(*(batch.column(c).to_pylist() for c in ("n", "sketch", "n2", "sketch2"))):
                width = min(len(a), len(b)) // 8
                x = np.bitwise_xor.reduce(np.frombuffer(a, dtype=np.uint64).reshape(-1, width), axis=0)
                x ^= np.bitwise_xor.reduce(np.frombuffer(b, dtype=np.uint64).reshape(-1, width), axis=0)
                keep.append(int(np.bitwise_count(x).sum(dtype=np.int64)) * (100 + percent) <= (n + n2) * (100 - percent))
            yield batch.filter(pa.array(keep, pa.bool_())).select(columns)
    other = own.select(F.col("node").alias("hub"), F.col("n").alias("n2"), F.col("sketch").alias("sketch2"))
    sized = pairs.join(own.select(F.col("node").alias("member"), "n", "sketch"), "member").join(other, "hub")
    return (sized.where(f"100 * least(n, n2) >= {percent} * greatest(n, n2)")
            .select(*pairs.columns, "n", "sketch", "n2", "sketch2").mapInArrow(run, pairs.schema))


def _verify(batches):
    hub, first = None, _EMPTY
    for batch in batches:
        ids, salts, members = (batch.column(c).to_pylist() for c in ("hub", "salt", "member"))
        out = []
        for i, (h, s, m) in enumerate(zip(ids, salts, members)):
            own = np.frombuffer(batch.column("own")[i].as_py(), dtype=np.uint64)
            if m is None:
                hub, first = (h, s), own
            elif hub == (h, s):
                both = len(np.intersect1d(first, own, assume_unique=True))
                out.append((h, m, both, len(first) + len(own) - both))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["hub", "member", "both", "either"])


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(hub, member, both, either): sizes of intersection and union. A hub's
    members are dealt into groups of about GROUP, each with a copy of the
    hub's set, so no hub has to fit in one task."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = pairs.groupBy("hub").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    members = (pairs.join(groups, "hub").select("hub", F.expr("pmod(xxhash64(member), groups)").alias("salt"), "member")
               .join(sets.withColumnRenamed("node", "member"), "member").select("hub", "salt", "member", "own"))
    hubs = (groups.join(sets.withColumnRenamed("node", "hub"), "hub")
            .select("hub", F.explode(F.expr("sequence(0L, groups - 1)")).alias("salt"), F.lit(None).cast("bigint").alias("member"), "own"))
    return (hubs.union(members).repartition(parts, "hub", "salt").sortWithinPartitions("hub", "salt", F.asc_nulls_first("member"))
            .mapInArrow(_verify, "hub bigint, member bigint, both bigint, either bigint"))


def _near(percent: int, rows: list[tuple], to: list[tuple] | None) -> list[tuple[int, int]]:
    """Pairs of nodes of different components, between ``rows`` and ``to`` (or
    within ``rows``), whose sketches are as near as those of a link can be."""
    other = rows if to is None else to
    width = min(len(r[3]) for r in [*rows, *other])

    def columns(some):
        bits = np.stack([np.bitwise_xor.reduce(np.frombuffer(r[3], dtype=np.uint64).reshape(-1, width // 8), axis=0) for r in some])
        return *(np.array([r[i] for r in some], dtype=np.int64) for i in range(3)), bits
    node, part, n, bits = columns(rows)
    node2, part2, n2, bits2 = columns(other)
    out = []
    for i in range(len(rows)):
        here = np.flatnonzero((part2 != part[i]) & (100 * np.minimum(n2, n[i]) >= percent * np.maximum(n2, n[i])))
        if to is None:
            here = here[here > i]
        if len(here):
            far = np.bitwise_count(bits2[here] ^ bits[i]).sum(axis=1, dtype=np.int64)
            here = here[far * (100 + percent) <= (n2[here] + n[i]) * (100 - percent)]
            out += [(min(node[i], m), max(node[i], m)) for m in node2[here]]
    return out


def close_across(apart: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """(hub, member): nodes that share a key, lie in different components, and
    whose sketches do not rule a link out. A key's nodes are dealt into blocks
    of about GROUP * 4, and each pair of blocks is compared in one task: no
    pair becomes a row unless its sketches are near."""
    parts = int(apart.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = apart.groupBy("key").agg(F.ceil(F.count("*") / (GROUP * 4)).alias("blocks"))
    block = F.expr("pmod(xxhash64(node), blocks)")
    rows = (apart.join(sizes, "key").withColumn("block", block)
            .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
            .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "component")
            .join(own.select("node", "n", "sketch"), "node"))

    def run(batches):
        held_key, held = None, []

        def compare():
            if len(held) < 2:
                return []
            if held_key[1] == held_key[2]:
                return _near(percent, [h[1:] for h in held], None)
            sides = [[h[1:] for h in held if (h[0] == held_key[1]) == one] for one in (True, False)]
            return _near(percent, *sides) if all(sides) else []
        for batch in batches:
            out = []
            for key, low, high, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "low", "high", "block", "node", "component", "n", "sketch"))):
                if (key, low, high) != held_key:
                    out += compare()
                    held_key, held = (key, low, high), []
                held.append(tuple(row))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["hub", "member"])
        if out := compare():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["hub", "member"])
    return (rows.repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high")
            .select("key", "low", "high", "block", "node", "component", "n", "sketch").mapInArrow(run, "hub bigint, member bigint"))


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (hub, member, ...) whose nodes lie in different components."""
    side = found.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    other = found.select(F.col("node").alias("member"), F.col("component").alias("member_component"))
    return (pairs.join(side, "hub", "left").join(other, "member", "left")
            .where("coalesce(hub_component, hub) <> coalesce(member_component, member)").select(*pairs.columns))


def links(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) of the classes that are linked with another one.

    Pairs of nodes and hubs whose sketches rule a link out go first. Then every
    node meets the hub with which it shares most pieces (what has been joined by
    then needs no further look), then all other hubs in other components, then
    all other nodes in other components."""
    shared = stored(shared_pieces(postings(docs, words, percent)), "pieces")
    ends = shared.where("edge").groupBy("key").agg(F.min("hub").alias("first"))
    across = (shared.where("edge").select("key", "hub").distinct().join(ends, "key").where("hub <> first")
              .select(F.col("first").alias("hub"), F.col("hub").alias("member")))
    pairs = stored(shared.where("hub <> node").select("hub", F.col("node").alias("member")).union(across)
                   .groupBy("hub", "member").agg(F.count("*").alias("pieces")), "pairs")

    def ends_of(some: DataFrame) -> DataFrame:
        return some.select(F.col("hub").alias("node")).union(some.select("member")).distinct()
    own = stored(sketches_of(docs, ends_of(pairs), words, percent), "sketches")
    pairs = stored(near_pairs(pairs, own, percent), "pairs")
    sets = stored(sets_of(docs, ends_of(pairs), words), "sets")
    is_link = f"100 * both >= {percent} * either"
    known = found = None

    def verified(some: DataFrame):
        """Verify pairs; all that is known then, and the components."""
        now = stored(verify(some, sets), "verified")
        both = now if known is None else known.union(now)
        new = now.where(is_link).select(F.col("hub").alias("a"), F.col("member").alias("b"))
        if found is not None and new.isEmpty():
            return both, found
        return both, stored(joined(found, new), "components")

    best = F.max(F.struct("pieces", (-F.col("hub")).alias("low")))
    first = pairs.groupBy("member").agg(best.alias("best")).select((-F.col("best.low")).alias("hub"), "member")
    known, found = verified(first)
    rest = stored(_across(pairs.select("hub", "member").join(known.select("hub", "member"), ["hub", "member"], "left_anti"), found), "pairs")
    if not rest.isEmpty():
        known, found = verified(rest)

    # nodes that share a piece and lie in different components; a piece of two
    # nodes is done with, one of them being the hub
    part = shared.groupBy("key", "node").agg(F.max("edge").alias("edge")).join(found, "node", "left").select(
        "key", "node", "edge", F.coalesce("component", "node").alias("component"))
    # and of a node's other pieces the most frequent ones in its room are left out
    split = (part.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("n"), F.max("edge").alias("edge"))
             .where("a < b and (n > 2 or edge)").select("key", F.col("n").alias("often")))
    odd = F.pmod(F.col("key"), F.lit(2)).alias("odd")
    place = F.row_number().over(Window.partitionBy("node", "odd").orderBy(F.desc("often"), "key"))
    apart = stored(part.join(split, "key").join(own.select("node", "room_even", "room_odd"), "node")
                   .select("key", "node", "component", odd, "often", F.expr("if(pmod(key, 2) = 1, room_odd, room_even)").alias("room"))
                   .withColumn("place", place).where("place > room").select("key", "node", "component"), "apart")
    more = (close_across(apart, own, percent).distinct()
            .join(known.select(F.least("hub", "member").alias("hub"), F.greatest("hub", "member").alias("member")),
                  ["hub", "member"], "left_anti"))
    more = stored(more, "pairs")
    if more.isEmpty():
        return found
    sets = stored(sets_of(docs, ends_of(more), words), "sets")
    return verified(more)[1]


def _one_text_per_id(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with column ``node``: the id, or, where one id has different
    texts, a number of its own (above all ids) per text; and (node, doc_id) of
    these, or None where there are none."""
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    twice = stored(docs.where("doc_id is not null").select("doc_id", h.alias("h")).groupBy("doc_id")
                   .agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("doc_id"), "ids")
    if twice.isEmpty():
        return docs.withColumn("node", F.col("doc_id")), None
    most = docs.agg(F.max("doc_id")).first()[0]
    texts = docs.join(twice, "doc_id", "left_semi").select("doc_id", h.alias("h")).distinct()
    extra = stored(numbered(ordered(texts, ["doc_id", "h"], "ids"), ["doc_id", "h"])
                   .select("doc_id", "h", (F.col("rank") + most + 1).alias("extra")), "ids")
    apart = (docs.withColumn("h", h).join(extra, ["doc_id", "h"], "left")
             .withColumn("node", F.coalesce("extra", "doc_id")).drop("h", "extra"))
    return apart, extra.select(F.col("extra").alias("node"), "doc_id")


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) of (doc_id, text), one text per id."""
    rows = stored(classes(docs, words), "classes")
    found = links(docs, words, percent)
    nodes = (rows.where("c1 is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("node"))
             .join(found, "node", "left").select("c1", "c2", F.coalesce("component", "node").alias("component_id")))
    full = (rows.where("c1 is not null").join(nodes, ["c1", "c2"])
            .select("doc_id", F.col("n").alias("n_shingles"), F.expr("if(doc_id is null, null, component_id)").alias("component_id")))
    none = rows.where("c1 is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.union(none)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id,
    text). Rows of one id with different texts are documents of their own."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    docs, extra = _one_text_per_id(docs)
    found = _grouped(docs.select(F.col("node").alias("doc_id"), "text"), words, percent)
    if extra is None:
        return found
    named = stored(found.withColumnRenamed("doc_id", "node").join(extra, "node", "left")
                   .withColumn("doc_id", F.coalesce("doc_id", "node")), "named")
    least = named.groupBy("component_id").agg(F.min("doc_id").alias("least"))
    return (named.join(least, "component_id", "left")
            .select("doc_id", "n_shingles", F.col("least").alias("component_id")))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when of each group of near duplicates
    one is kept, the smallest id (where one id has different texts, they count
    as documents of their own and come after all others); of repeated rows one.
    Rows with a null id stay."""
    own = docs.select("*", F.col("doc_id").cast("bigint").alias(column_like(docs.columns, "doc_key")))
    key = own.columns[-1]
    small, extra = _one_text_per_id(own.select(F.col(key).alias("doc_id"), "text"))
    groups = _grouped(small.select(F.col("node").alias("doc_id"), "text"), words, percent)
    stay = groups.where("doc_id = component_id").select(F.col("doc_id").alias("node")).distinct()
    if extra is None:
        kept = own.join(stay.withColumnRenamed("node", key), key, "left_semi").dropDuplicates([key])
        return kept.select(*docs.columns).union(docs.where("doc_id is null"))
    # the few ids with several texts are told apart by the hash of the text
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = small.where("doc_id is not null").select(F.col("doc_id").alias(key), h.alias("text_hash"), "node")
    keep = stored(texts.join(stay, "node", "left_semi").select(key, "text_hash").distinct(), "kept")
    mark = column_like(own.columns, "text_hash")
    kept = (own.withColumn(mark, h).join(keep.withColumnRenamed("text_hash", mark), [key, mark], "left_semi")
            .dropDuplicates([key, mark]))
    return kept.select(*docs.columns).union(docs.where("doc_id is null"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), words=3, percent=90)
