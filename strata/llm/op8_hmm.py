"""Hidden Markov language model.

Tokens are lower-cased words and one end per text. The model emits a symbol
per token: one of the ``SYMBOLS`` most frequent words, the end, or one of
``CLASSES`` classes of the other words (by their last two bytes); within a
class a word has probability (c + 1) / (sum of c + 1 over the class, plus 1 for
the unseen words). ``STATES`` latent states emit symbols and follow each other.

Training (Baum-Welch): each task runs scaled forward-backward over its texts
and gives out expected counts; Spark adds them up by symbol; the driver holds
only the model (a bounded table of SYMBOLS + CLASSES + 1 rows). Each of the
``ROUNDS`` rounds runs over all texts of the training fold, which are stored
once as symbols. Expected counts are added as whole millionths, so reruns agree.

Word counts come from all training texts. Words among the ``HEAD`` most
frequent are looked up in a bounded table that every task holds; the other
tokens are joined with the full table of counts by a shuffle. Scoring is the
scaled forward recursion over whole texts: the exact log10 likelihood.

Null and empty texts are one end token. A null id is in the training fold.
Repeated rows are scored (and counted) once each. Without training texts all
counts are 0 and the model is uniform over symbols. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import hashed_words, in_fold, map_batches, read, stored

STATES = 8
SYMBOLS = 1 << 15
CLASSES = 1 << 10
HEAD = 1 << 19
ROUNDS = 8
PRIOR = 20.0                # pseudo-tokens of the unigram in each state's emissions
BLOCK = 6_000_000           # bytes of text in work at a time
ROUND_TOKENS = 2_000_000    # tokens that a round sorts by length at a time
LANE_TOKENS = 600_000       # tokens that go through the recursions at a time
HASHED = 1 << 18            # bytes of text whose words are hashed at a time
HELD = 1_000_000            # distinct words a counting task holds before giving them out
END = 1 << 62               # the end token; words have their class in the low bits

_LOW = np.uint64(CLASSES - 1)


def all_tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts, one text after the other, and how many each has:
    the words' 64-bit keys (their class in the low bits), then the end. Texts are
    hashed together, about :data:`HASHED` bytes at a time, with a blank between
    them."""
    keys, lengths, held, size = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)], [], 0
    for i, text in enumerate(texts, 1):
        held.append(text.encode() if text else b"")
        size += len(held[-1])
        if size < HASHED and i < len(texts):
            continue
        border = np.cumsum([len(raw) + 1 for raw in held])
        raw = b" ".join(held).lower()
        h, start, end = hashed_words(raw)
        buf = np.frombuffer(raw, dtype=np.uint8)
        kind = buf[end - 1].astype(np.uint64) * np.uint64(31) + buf[np.maximum(end - 2, start)].astype(np.uint64) * np.uint64(7)
        ends = np.searchsorted(start, border) + np.arange(len(held))      # places of the end tokens
        block = np.full(len(h) + len(held), END, dtype=np.int64)
        word = np.ones(len(block), dtype=bool)
        word[ends] = False
        block[word] = ((h & ~_LOW) | (kind & _LOW)).view(np.int64)
        keys.append(block)
        lengths.append(np.diff(ends, prepend=-1))
        held, size = [], 0
    return np.concatenate(keys), np.concatenate(lengths)


def tokens(text: str | None) -> np.ndarray:
    """The words' 64-bit keys (their class in the low bits), then the end."""
    return all_tokens([text])[0]


def count_words(docs: DataFrame) -> DataFrame:
    """(key, c) of all tokens of ``docs``."""
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            keys = np.concatenate([k for k, _ in held])
            order = np.argsort(keys, kind="stable")
            keys, c = keys[order], np.concatenate([c for _, c in held])[order]
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return keys[start], np.add.reduceat(c, start)

        def out(pair):
            for a in range(0, len(pair[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[a:a + 100_000]) for x in pair], ["key", "c"])
        for batch in batches:
            texts = batch.column("text")
            for a in range(0, batch.num_rows, 200):
                keys = all_tokens(texts.slice(a, 200).to_pylist())[0]
                held.append(np.unique(keys, return_counts=True))
                if sum(len(k) for k, _ in held) > HELD:
                    held = [merged()]
                    if len(held[0][0]) > HELD // 2:
                        yield from out(held.pop())
        if held:
            yield from out(merged())
    return docs.select("text").mapInArrow(run, "key bigint, c bigint").groupBy("key").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """Everything a task needs; the size is bounded by the constants above."""
    head_key: np.ndarray        # sorted keys of the most frequent words
    head_count: np.ndarray
    head_symbol: np.ndarray     # symbol of each
    class_total: np.ndarray     # sum of c + 1 over a class's words that are no symbol, plus 1
    unigram: np.ndarray         # (symbols,)
    n: int
    v: int
    start: np.ndarray           # (states,)
    follow: np.ndarray          # (states, states)
    emit: np.ndarray            # (symbols, states)
    first: np.ndarray | None = None     # place in the head by high bits of a key, built where it is used

    def places(self, keys: np.ndarray) -> np.ndarray:
        """First place in the sorted head of a key not below each (the last
        place at most). Keys are hashes, so their high bits lead to it within a
        step or two; the table of them is built once per task."""
        if self.first is None:
            edges = np.arange(-(1 << 19), 1 << 19, dtype=np.int64) << 44
            self.first = np.searchsorted(self.head_key, edges).astype(np.int32)
        last = len(self.head_key) - 1
        at = np.minimum(self.first[(keys >> 44) + (1 << 19)], last)
        behind = np.flatnonzero((self.head_key[at] < keys) & (at < last))
        while len(behind):
            at[behind] += 1
            now = at[behind]
            behind = behind[(self.head_key[now] < keys[behind]) & (now < last)]
        return at

    def look_up(self, keys: np.ndarray):
        """(symbol, count or -1 if not in the head) of tokens."""
        if not len(self.head_key):
            return np.where(keys == END, SYMBOLS + CLASSES, SYMBOLS + (keys & (CLASSES - 1))), np.full(len(keys), -1)
        at = self.places(keys)
        known = self.head_key[at] == keys
        symbol = np.where(known, self.head_symbol[at], SYMBOLS + (keys & (CLASSES - 1)))
        symbol[keys == END] = SYMBOLS + CLASSES
        return symbol, np.where(known, self.head_count[at], -1)


def start_model(counts: DataFrame) -> Model:
    """Head, classes and unigram from the word counts; random soft states."""
    size = F.floor(F.log2("c") * 8).cast("int")
    sizes = counts.groupBy(size.alias("size")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()
    n, v = sum(r["c"] for r in sizes), sum(r["n"] for r in sizes)
    least, room = 1 << 30, HEAD
    for r in sorted(sizes, key=lambda r: -r["size"]):
        if r["n"] > room:
            break
        room -= r["n"]
        least = r["size"]
    head = counts.where(size >= least).toPandas()           # at most HEAD rows of two numbers
    order = np.lexsort((head["key"], -head["c"]))
    key, c = head["key"].to_numpy()[order], head["c"].to_numpy()[order]
    is_end = key == END
    symbol = np.where(np.cumsum(~is_end) <= SYMBOLS, np.cumsum(~is_end) - 1, -1)
    symbol[is_end] = -1
    own_class = key & (CLASSES - 1)
    by_class = counts.where(F.col("key") != END).groupBy(F.expr(f"key & {CLASSES - 1}L").alias("k")).agg(F.sum(F.col("c") + 1).alias("c")).collect()
    total = np.ones(CLASSES)
    for r in by_class:
        total[r["k"]] += r["c"]
    named = symbol >= 0
    np.subtract.at(total, own_class[named], c[named] + 1)
    unigram = np.zeros(SYMBOLS + CLASSES + 1)
    unigram[symbol[named]] = c[named] + 1
    unigram[SYMBOLS:-1] = total
    end = c[is_end].sum() if is_end.any() else counts.where(F.col("key") == END).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    unigram[-1] = end + 1
    unigram /= unigram.sum()
    symbol = np.where(named, symbol, SYMBOLS + own_class)
    by_key = np.argsort(key)
    rng = np.random.default_rng(11)
    emit = unigram[:, None] * rng.uniform(0.5, 1.5, (len(unigram), STATES))
    follow = np.full((STATES, STATES), 0.1 / (STATES - 1))
    np.fill_diagonal(follow, 0.9)
    return Model(key[by_key], c[by_key], symbol[by_key].astype(np.int32), total, unigram, n, v,
                 np.full(STATES, 1 / STATES), follow, emit / emit.sum(axis=0))


def lanes(sequences: list[np.ndarray], most: int = LANE_TOKENS):
    """Groups of sequences of similar length, about ``most`` tokens each: (which
    sequences, longest first; active lanes per step; tokens step by step)."""
    lengths = np.array([len(x) for x in sequences], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable").tolist()
    group, size = [], 0
    for i in [*order, None]:
        if group and (i is None or size + len(sequences[i]) > most):
            length = lengths[group]
            active = np.searchsorted(-length, -np.arange(length[0]), side="left")
            flat = np.concatenate([sequences[j] for j in group])
            step = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
            lane = np.repeat(np.arange(len(group)), length)
            first = np.concatenate([[0], np.cumsum(active)])
            by_step = np.empty(len(flat), dtype=flat.dtype)
            by_step[first[step] + lane] = flat
            yield group, active, first, by_step
            group, size = [], 0
        if i is not None:
            group.append(i)
            size += len(sequences[i])


class Room:
    """Work arrays (one row per state) that are used again for every group of
    lanes, so that their pages are touched once."""

    def __init__(self, arrays: int):
        self.kept = [np.empty(0) for _ in range(arrays)]

    def take(self, number: int, width: int) -> np.ndarray:
        if len(self.kept[number]) < STATES * width:
            self.kept[number] = np.empty(0)
            self.kept[number] = np.empty(STATES * width)
        return self.kept[number][:STATES * width].reshape(STATES, width)


def emissions(table: np.ndarray, symbols: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Emission probabilities of all tokens, one row per state; ``table``: those
    of the model, one row per state."""
    at = symbols.astype(np.intp)
    for own, row in zip(table, out):
        np.take(own, at, out=row, mode="clip")      # all symbols are in range; "clip" writes to ``out`` at once
    return out


def forward(model: Model, active, first, emitted: np.ndarray, keep: bool = True, room: Room | None = None):
    """Scaled forward probabilities of all tokens (None unless ``keep``), and
    the scales; ``emitted`` (tokens, STATES) is best the transpose of
    :func:`emissions`. With ``room`` (its arrays 0 and 1) what comes into each token
    from the token before (or the start) is left in array 0."""
    e, n = emitted.T, len(emitted)
    states, widest = len(model.start), n if keep else int(active[0])
    into, alpha = ((room.take(0, widest), room.take(1, widest)) if room else
                   (np.empty((states, widest)), np.empty((states, widest))))
    scale, follow = np.empty(n), np.ascontiguousarray(model.follow.T)
    a, now = 0, None
    for n in active.tolist():
        b = a + n
        at = slice(a, b) if keep else slice(0, n)
        come = into[:, at]
        if now is None:
            come[:] = model.start[:, None]
        else:
            np.matmul(follow, now[:, :n], out=come)
        now = np.multiply(come, e[:, a:b], out=alpha[:, at])
        now /= np.add.reduce(now, axis=0, out=scale[a:b])
        a = b
    return alpha.T if keep else None, scale


def expected(model: Model, sequences: list[np.ndarray], emit: np.ndarray, start: np.ndarray, follow: np.ndarray,
             room: Room | None = None) -> None:
    """Add the expected counts of the sequences (of symbols).

    Backward, ``b`` becomes the scaled emissions times beta; what comes into a
    token (from the token before, or the start) times that is its posterior.
    """
    room, table = room or Room(3), np.ascontiguousarray(model.emit.T)
    for _, active, first, symbols in lanes(sequences):
        b = emissions(table, symbols, room.take(2, len(symbols)))
        alpha, scale = forward(model, active, first, b.T, room=room)
        alpha, into = alpha.T, room.take(0, len(symbols))
        b /= scale
        sizes, edges = active.tolist(), first.tolist()
        beta = None                               # of the step before; 1 for texts that end there
        for t in range(len(sizes) - 1, -1, -1):
            here = b[:, edges[t]:edges[t + 1]]
            if beta is not None:
                here[:, :beta.shape[1]] *= beta
            if t:
                follow += alpha[:, edges[t - 1]:edges[t - 1] + sizes[t]] @ here.T
                beta = model.follow @ here
        into *= b
        start += into[:, :sizes[0]].sum(axis=1)
        at = symbols.astype(np.intp)
        for k, own in enumerate(into):
            emit[:, k] += np.bincount(at, own, minlength=len(emit))


def symbol_texts(docs: DataFrame, model: Model) -> DataFrame:
    """(symbols): every text as the symbols of its tokens, two bytes each, so that
    the rounds need not look words up again."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value

        def fn(batch):
            keys, length = all_tokens(batch.column("text").to_pylist())
            symbols = own.look_up(keys)[0].astype(np.uint16)
            edges = np.concatenate([[0], np.cumsum(2 * length)]).astype(np.int32)
            rows = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(edges), pa.py_buffer(symbols)])
            return pa.RecordBatch.from_arrays([rows], ["symbols"])
        return fn
    return map_batches(docs.select("text"), make, "symbols binary", BLOCK)


def one_round(texts: DataFrame, model: Model) -> Model:
    """One Baum-Welch round over all of ``texts`` (:func:`symbol_texts`)."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((model.start, model.follow, model.emit))
    fields = [f"e{k}" for k in range(STATES)]
    none = np.zeros(0, dtype=np.int64)

    def run(batches):
        own = Model(none, none, none, none, none, 0, 0, *shared.value)
        emit, start, follow = np.zeros(own.emit.shape), np.zeros(STATES), np.zeros((STATES, STATES))
        held, size, room = [], 0, Room(3)
        for batch in batches:
            for raw in batch.column("symbols").to_pylist():
                held.append(np.frombuffer(raw, dtype=np.uint16))
                size += len(held[-1])
                if size > ROUND_TOKENS:
                    expected(own, held, emit, start, follow, room)
                    held, size = [], 0
        if held:
            expected(own, held, emit, start, follow, room)
        rows = np.concatenate([emit, start[None], follow * own.follow])
        some = np.flatnonzero(rows.any(axis=1))
        whole = np.rint(rows[some] * 1e6).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *[pa.array(whole[:, k]) for k in range(STATES)]],
                                         ["symbol", *fields])
    got = (texts.mapInArrow(run, "symbol bigint, " + ", ".join(f"{f} bigint" for f in fields))
           .groupBy("symbol").agg(*[F.sum(f).alias(f) for f in fields]).toPandas())
    shared.unpersist()
    m = len(model.unigram)
    rows = np.zeros((m + 1 + STATES, STATES))
    rows[got["symbol"].to_numpy(dtype=np.int64)] = got[fields].to_numpy(dtype=np.float64) / 1e6
    emit = rows[:m] + PRIOR * model.unigram[:, None]
    start, follow = rows[m] + 1, rows[m + 1:] + 1
    return Model(**{**model.__dict__, "emit": emit / emit.sum(axis=0), "start": start / start.sum(),
                    "follow": follow / follow.sum(axis=1, keepdims=True)})


def fit(train: DataFrame, counts: DataFrame) -> Model:
    """The model from all texts of ``train`` (doc_id, text), in every round."""
    model = start_model(counts)
    texts = stored(symbol_texts(train, model), "symbols")
    for _ in range(ROUNDS):
        model = one_round(texts, model)
    return model


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "key", "times"]

    def make():
        own = shared.value
        unit = math.log10(own.n + own.v + 1)
        class_log = np.log10(own.class_total)
        room, table = Room(3), np.ascontiguousarray(own.emit.T)

        def fn(batch):
            keys, length = all_tokens(batch.column("text").to_pylist())
            n = len(length)
            if not n:
                return None
            starts = np.cumsum(length) - length           # every text has a token, its end
            symbol, c = own.look_up(keys)
            score = np.zeros(n)
            for group, active, first, symbols in lanes(np.split(symbol, starts[1:])):
                b = emissions(table, symbols, room.take(2, len(symbols)))
                logs = np.log10(forward(own, active, first, b.T, keep=False, room=room)[1])
                lane = np.arange(len(logs)) - np.repeat(first[:-1], active)
                score[group] = np.bincount(lane, logs, minlength=len(group))
            logs = np.log10(np.maximum(c, 0) + 1)
            base = np.add.reduceat(logs, starts) - length * unit
            known = np.add.reduceat((c > 0).astype(np.int64), starts)
            inside = (symbol >= SYMBOLS) & (symbol < SYMBOLS + CLASSES)
            score += np.add.reduceat(np.where(inside, logs - class_log[np.where(inside, symbol - SYMBOLS, 0)], 0.0), starts)
            late = np.flatnonzero(c < 0)
            text = np.repeat(np.arange(n), length)[late]
            order = np.lexsort((keys[late], text))
            late, text = keys[late][order], text[order]
            new = np.flatnonzero(np.concatenate([[True], (late[1:] != late[:-1]) | (text[1:] != text[:-1])])[:len(late)])
            times = np.diff(np.append(new, len(late)))
            row = batch.column("row").to_numpy(zero_copy_only=False)
            at = np.concatenate([np.arange(n), text[new]]).astype(np.int64)
            blank = np.arange(n + len(new)) >= n
            key = np.concatenate([np.zeros(n, dtype=np.int64), late[new]])
            times = np.concatenate([np.zeros(n, dtype=np.int64), times])
            cols = [pa.array(row[at]), batch.column("doc_id").take(pa.array(at)), pa.array(length[at], pa.int64()),
                    pa.array(known[at]), pa.array(base[at]), pa.array(score[at]),
                    pa.array(key, mask=~blank), pa.array(times, mask=~blank)]
            return pa.RecordBatch.from_arrays(cols, fields)
        return fn
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    out = stored(map_batches(rows, make, f"row bigint, doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, "
                                         "score double, key bigint, times bigint", BLOCK), "scored")
    # the tokens outside the head: their counts by a join; sums in whole billionths, so that order does not matter
    late = (out.where("key is not null").select("row", "key", "times").join(counts, "key", "left")
            .groupBy("row").agg(F.sum(F.expr("cast(round(times * log10(coalesce(c, 0) + 1) * 1e9) as bigint)")).alias("logs"),
                                F.sum(F.expr("if(c > 0, times, 0)")).alias("more")))
    return (out.where("key is null").drop("key", "times").join(late, "row", "left")
            .select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                    (F.col("base_score") + F.coalesce(F.col("logs") / 1e9, F.lit(0.0))).alias("base_score"),
                    (F.col("score") + F.coalesce(F.col("logs") / 1e9, F.lit(0.0))).alias("score")))


def op8_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    train = docs.where(~in_fold("doc_id", 7, 2))
    counts = stored(count_words(train), "counts")
    model = fit(train, counts)
    return score(docs, model, counts).select(
        "doc_id", in_fold("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n).cast("bigint").alias("train_tokens"), "base_score", "score")
