"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into overlapping chunks of ``CHUNK`` bytes
every ``STEP`` bytes, to the end of the text. ``FILTERS`` learned filters of
``WIDTH`` bytes run over each chunk, are max-pooled over the chunk and
rectified; the mean of the pooled features over all chunks goes through one
logistic layer: P(label = 1).

Training uses a bounded sample: at most ``SAMPLE`` labelled documents of the
training fold (those with the smallest hash of the id), each with its whole
text, cut into the same chunks as for scoring; a share ``SHORT`` of them gives one
short piece more, so that texts far below a chunk are known too. Inputs of a score
are the text's bytes alone.

Null and empty texts score as one chunk of zero bytes. With no labelled rows
every score is 0.5; with one class only, the smoothed share of label 1.
Several labels for one id: the largest counts. Repeated rows give repeated
results; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import column_like, in_fold, map_batches, read, release

CHUNK, STEP = 256, 192
FILTERS, WIDTH = 16, 4
SAMPLE = 3000
SHORT = 0.25        # share of the sample that also gives one short piece
ROUNDS, BATCH, RATE = 500, 48, 0.02
BLOCK = 1024        # chunks in memory at a time while training
THRESHOLD = 0.7     # predicted 1 from here on; the pipeline drops what lies below


@dataclass
class Model:
    tables: np.ndarray          # (WIDTH, 256, FILTERS): a filter's weight for each byte at each offset
    bias: np.ndarray            # (FILTERS,)
    weight: np.ndarray          # (FILTERS,)
    offset: float

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, FILTERS): rectified maximum of every filter over a chunk."""
        first, second = self.pairs()
        pair = chunks[:, :-1].astype(np.int32) * 256 + chunks[:, 1:]
        act = np.take(first, pair[:, :-2], axis=0, mode="clip")
        act += np.take(second, pair[:, 2:], axis=0, mode="clip")
        return np.maximum(act.max(axis=1) + self.bias, 0)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The four byte tables as two tables of byte pairs."""
        if not hasattr(self, "_pairs"):
            t = self.tables.astype(np.float32)
            self._pairs = tuple((t[i][:, None, :] + t[i + 1][None, :, :]).reshape(65536, FILTERS) for i in (0, 2))
        return self._pairs

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = features.astype(np.float64) @ self.weight + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def chunk_starts(n: int) -> range:
    """Starts of the chunks of n bytes; the last chunk reaches the end."""
    return range(0, max(n - CHUNK, 0) + STEP, STEP) if n > CHUNK else range(1)


def chunks_of(raw: bytes, starts) -> np.ndarray:
    padded = np.frombuffer(raw + bytes(CHUNK + STEP), dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[np.asarray(starts)]


def score_texts(model: Model, texts: list[str], block: int = 768) -> np.ndarray:
    """Scores of whole texts; ``block`` chunks are in memory at a time."""
    total = np.zeros((len(texts), FILTERS))
    count = np.zeros(len(texts))
    held: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    size = 0

    def flush():
        nonlocal size
        if size:
            who = np.concatenate(owner)
            np.add.at(total, who, model.pooled(np.concatenate(held)))
            held.clear(), owner.clear()
            size = 0
    for i, text in enumerate(texts):
        raw = text.encode()
        starts = chunk_starts(len(raw))
        count[i] = len(starts)
        for a in range(0, len(starts), block):
            part = chunks_of(raw, starts[a:a + block]) if len(raw) < 1 << 20 else chunks_of(
                raw[starts[a]:starts[min(a + block, len(starts)) - 1] + CHUNK], range(0, len(starts[a:a + block]) * STEP, STEP))
            held.append(part)
            owner.append(np.full(len(part), i))
            size += len(part)
            if size >= block:
                flush()
    flush()
    return model.probability(total / count[:, None])


def short_pieces(documents: list[bytes], labels: list[int], seed: int = 7) -> tuple[list[bytes], list[int]]:
    """One piece of 11 bytes to a chunk (evenly by logarithm) of a share SHORT of
    the documents, with their labels."""
    rng = np.random.default_rng(seed)
    pieces, marks = [], []
    for raw, label in zip(documents, labels):
        if rng.random() < SHORT:
            n = int(2 ** rng.uniform(3.5, np.log2(CHUNK)))
            start = int(rng.integers(0, max(len(raw) - n, 0) + 1))
            pieces.append(raw[start:start + n])
            marks.append(label)
    return pieces, marks


def strongest(tables: np.ndarray, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunks, FILTERS): where each filter is strongest in a chunk, and how strong."""
    t = tables.astype(np.float32)
    first, second = ((t[i][:, None, :] + t[i + 1][None, :, :]).reshape(65536, FILTERS) for i in (0, 2))
    at, top = [], []
    for a in range(0, len(chunks), BLOCK):
        b = chunks[a:a + BLOCK]
        pair = b[:, :-1].astype(np.int32) * 256 + b[:, 1:]
        act = np.take(first, pair[:, :-2], axis=0)
        act += np.take(second, pair[:, 2:], axis=0)
        at.append(act.argmax(axis=1))
        top.append(np.take_along_axis(act, at[-1][:, None, :], axis=1)[:, 0, :])
    return np.concatenate(at), np.concatenate(top)


def train(documents: list[bytes], labels: list[int], seed: int = 7) -> Model:
    """Fit by Adam on mini-batches of whole documents."""
    rng = np.random.default_rng(seed)
    share = (sum(labels) + 1) / (len(labels) + 2)
    model = Model(rng.normal(0, 0.3, (WIDTH, 256, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.1, FILTERS),
                  float(np.log(share / (1 - share))))
    if not labels or min(labels) == max(labels):
        model.weight[:] = 0
        return model
    parts = [chunks_of(raw, chunk_starts(len(raw))) for raw in documents]
    first = np.cumsum([0] + [len(p) for p in parts])
    x = np.concatenate(parts)
    y = np.asarray(labels, dtype=np.float64)
    params = [model.tables, model.bias, model.weight, np.array([model.offset])]
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    for step in range(1, ROUNDS + 1):
        pick = rng.choice(len(y), min(BATCH, len(y)), replace=False)
        rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in pick])
        who = np.repeat(np.arange(len(pick)), first[pick + 1] - first[pick])
        n = np.bincount(who, minlength=len(pick))[:, None]
        b = x[rows]
        tables, bias, weight, offset = params
        best, top = strongest(tables, b)
        top = top + bias
        feature = np.zeros((len(pick), FILTERS))
        np.add.at(feature, who, np.maximum(top, 0))
        feature /= n
        p = 1 / (1 + np.exp(-np.clip(feature @ weight + offset[0], -50, 50)))
        dz = (p - y[pick]) / len(pick)
        dtop = (dz[:, None] * weight / n)[who] * (top > 0)
        dtables = np.zeros_like(tables)
        at, f = np.arange(len(b))[:, None], np.arange(FILTERS)[None, :]
        for i in range(WIDTH):
            np.add.at(dtables[i], (b[at, best + i], np.broadcast_to(f, best.shape)), dtop)
        grads = [dtables, dtop.sum(axis=0), feature.T @ dz + 1e-4 * weight, np.array([dz.sum()])]
        rate = RATE * (1 - 0.9 * step / ROUNDS)
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            params[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(params[0].astype(np.float32), params[1].astype(np.float32), params[2], float(params[3][0]))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality, text): at most SAMPLE rows. ``labels`` holds doc_id
    and quality of the training fold; of an id with several texts the smallest
    counts."""
    chosen = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # chosen has at most SAMPLE rows of two numbers
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the training fold of ``labels`` (doc_id, quality): ids
    whose crc32 modulo 4 is 2 are never used."""
    fold = labels.select("doc_id", "quality").where(~in_fold("doc_id", 4, 2))

    def learn(batches):
        rows = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: r["doc_id"])
        texts, marks = [r["text"].encode() for r in rows], [int(r["quality"]) for r in rows]
        pieces, more = short_pieces(texts, marks)
        model = train(texts + pieces, marks + more)
        yield pa.RecordBatch.from_arrays(
            [pa.array([pickle.dumps((model.tables, model.bias, model.weight, model.offset))], pa.binary())], ["model"])
        release()
    # one task learns from the sample, so that the driver holds neither its texts nor the work arrays
    made = training_sample(docs, fold).repartition(1).mapInArrow(learn, "model binary").collect()
    return Model(*pickle.loads(made[0]["model"])) if made else train([], [])


def with_score(docs: DataFrame, model: Model, score_col: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the score of every whole text in a column of that name."""
    at = docs.columns.index(text_col)
    names = [*docs.columns, score_col]

    def make():
        def fn(batch):
            texts = ["" if t is None else t for t in batch.column(at).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(score_texts(model, texts))], names)
        return fn
    return map_batches(docs, make, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def keep_quality(docs: DataFrame, labels: DataFrame, least: float = THRESHOLD) -> DataFrame:
    """The rows whose score is at least ``least``; columns as they are."""
    score = column_like(docs.columns, "score")
    return with_score(docs, fit(docs, labels), score).where(F.col(score) >= least).select(*docs.columns)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels"))
    scored = with_score(docs.select("doc_id", "text"), model, "score")
    return scored.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
