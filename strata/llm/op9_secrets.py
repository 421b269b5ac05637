"""Secret scan: fixed patterns plus the token-efficiency test.

The token-efficiency test takes every run of base64-like characters, drops
known digests, numbers and identifiers made of words, and flags those of few
characters per token under a public BPE vocabulary: a vocabulary learned on
language needs many tokens for a random string. Where a whole run passes, its
segments between /, then between _ and -, are tested by themselves.

Spans are ``kind:start:end`` in code points, end exclusive. Kinds: ``assign``,
``access``, ``hex`` (fixed patterns) and ``token`` (the test's own spans,
those inside a span of a fixed pattern left out). Null and empty texts have no
spans; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import map_batches, read, texts_of
from strata.llm.op10_bpe import load_ranks, vocabulary

# The patterns of the base kinds.
ASSIGN = re.compile(r'(password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)',
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "token")
KEYWORDS = (b"passw", b"secret", b"token", b"api")

# The token-efficiency test: runs of at least RUN characters with letters, fewer
# than CHARS_PER_TOKEN characters per token. A piece of an identifier is a word
# if it has at least WORD_CHARS_PER_TOKEN of them.
RUN = 16
CHARS_PER_TOKEN = 2.2
WORD_CHARS_PER_TOKEN = 1.8

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
_DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}        # MD5, SHA-1, SHA-2
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SEPARATORS = (re.compile(r"[^/]+"), re.compile(r"[^/_-]+"))      # of a run's segments, one after the other

_RUN_BYTE = np.zeros(256, dtype=bool)
_RUN_BYTE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=")] = True
_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                            mergeable_ranks=load_ranks(path), special_tokens={})
    return _ENCODERS[path]


def is_known(text: str, count_tokens) -> bool:
    """Digests of the usual lengths, UUIDs, numbers, and identifiers: words and
    short numbers joined by _, -, /, + or capitals, every piece of letters a
    word of three letters or more by its own characters per token."""
    if _UUID.fullmatch(text) or (_DIGEST.fullmatch(text) and len(text) in _DIGEST_LENGTHS):
        return True
    if not any(c.isalpha() for c in text):
        return True
    return all(len(p) <= 4 if p[0].isdigit() else len(p) > 2 and len(p) >= WORD_CHARS_PER_TOKEN * count_tokens(p)
               for p in _PIECE.findall(text))


def random_parts(text: str, count_tokens, level: int = 0) -> list[tuple[int, int]]:
    """Spans of the token-efficiency test in one run: the run itself, or else
    those of its segments."""
    if len(text) < RUN:
        return []
    bare = text.rstrip("=")
    if len(text) < CHARS_PER_TOKEN * count_tokens(text) and not is_known(bare, count_tokens):
        return [(0, len(text))]
    if level == len(_SEPARATORS) or _UUID.fullmatch(bare):
        return []
    return [(m.start() + a, m.start() + b) for m in _SEPARATORS[level].finditer(text)
            for a, b in random_parts(m[0], count_tokens, level + 1)]


def long_runs(raw: bytes) -> list[tuple[int, int]]:
    """Byte spans of the runs of at least RUN candidate characters."""
    if len(raw) < RUN:
        return []
    solid = np.zeros(len(raw) + 2, dtype=np.int8)
    solid[1:-1] = _RUN_BYTE[np.frombuffer(raw, dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(solid))
    start, end = edge[0::2], edge[1::2]
    keep = end - start >= RUN
    return list(zip(start[keep].tolist(), end[keep].tolist()))


def scan(text: str, count_tokens) -> list[tuple[int, int, str]]:
    """All spans (start, kind index, end) of one text, in order."""
    raw = text.encode()
    low = raw.lower()
    spans = []
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    ascii_only = len(raw) == len(text)
    added = []
    at = seen = 0
    for a, b in long_runs(raw):
        own = raw[a:b].decode()
        at, seen = (a if ascii_only else at + len(raw[seen:a].decode())), a
        if "AKIA" in own:
            spans += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(own) if len(m[0]) >= 20]
        if b - a >= 24:
            spans += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(own) if len(m[0]) >= 24]
        for m in _CANDIDATE.finditer(own):
            added += [(at + m.start() + a, 3, at + m.start() + b) for a, b in random_parts(m[0], count_tokens)]
    if added:
        spans += [s for s in added if not any(b[0] <= s[0] and s[2] <= b[2] for b in spans)]
    return sorted(spans)


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, stop>>) of every text."""
    kind = docs.schema[id_col].dataType.simpleString()
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def make():
        own = encoder(path)

        def fn(batch):
            out = [[{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in scan(t, lambda s: len(own.encode_ordinary(s)))]
                   for t in texts_of(batch)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, item)], ["doc_id", "spans"])
        return fn
    return map_batches(docs.selectExpr(f"`{id_col}` as doc_id", f"`{text_col}` as text"), make,
                       f"doc_id {kind}, spans array<struct<kind: string, start: bigint, stop: bigint>>"
                       ).withColumnRenamed("doc_id", id_col)


def redact(docs: DataFrame, path: str, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows with every span replaced by ``mark`` (overlapping spans by
    one); texts without spans, null included, stay as they are."""
    at = docs.columns.index(text_col)

    def make():
        own = encoder(path)

        def clean(text):
            if not text:
                return text
            out, end = [], 0
            for a, _, b in scan(text, lambda s: len(own.encode_ordinary(s))):
                if a >= end:
                    out += [text[end:a], mark]
                end = max(end, b)
            return "".join(out) + text[end:] if out else text

        def fn(batch):
            new = pa.array([clean(t) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            return pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)
        return fn
    return map_batches(docs, make, docs.schema)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read(spark, sf_dir, "documents"), vocabulary()

    def make():
        own = encoder(path)

        def fn(batch):
            cols = [[], [], [], [], []]
            for text in texts_of(batch):
                spans = scan(text, lambda s: len(own.encode_ordinary(s)))
                kinds = [k for _, k, _ in spans]
                for k in range(3):
                    cols[k].append(kinds.count(k))
                cols[3].append(hashlib.sha256(written([s for s in spans if s[1] < 3]).encode()).hexdigest())
                cols[4].append(written(spans))
            types = [pa.int64()] * 3 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, cols, types)],
                                              ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
        return fn
    return map_batches(docs.select("doc_id", "text"), make,
                       "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
