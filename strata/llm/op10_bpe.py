"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pre-tokens are merged with a queue of buckets, one per merge rank: a bucket
holds the positions (in a linked list of parts) whose pair has that
rank, and a two-level bitmap over the ranks gives the next rank by
find-first-set (words of 256 ranks, and one word over the words). Entries whose pair has changed meanwhile are skipped when they
come up. A pre-token of n bytes costs O(n log n) steps at worst, so very long
pre-tokens (no white space for megabytes) are no special case.

Null texts count as empty: no ids, empty decoded bytes. Repeated rows give
repeated results. Extra columns are ignored (``encode`` keeps only the id).
"""

from __future__ import annotations

import base64
import hashlib
from bisect import insort

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import map_batches, read, texts_of

# Entries of each of the two generations of merged pre-tokens that a worker
# keeps (a bound on memory; results do not depend on it).
CACHE_ENTRIES = 400_000

# Bytes of text that are encoded together: their pre-tokens and the lists of the
# merge are all in a worker's memory at once.
BLOCK = 500_000

_BITS = [1 << i for i in range(256)]
_CODECS: dict[str, "Codec"] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder for one vocabulary of byte strings and ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.shared = {i: i for i in self.bytes_of}         # one object per id, however many results hold it
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.byte_pair_rank = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        # rank of every pair of parts whose bytes together are in the vocabulary
        self.pair_rank = {
            ranks[whole[:i]] << 32 | ranks[whole[i:]]: rank
            for whole, rank in ranks.items() for i in range(1, len(whole))
            if whole[:i] in ranks and whole[i:] in ranks}
        self.bitmap_words = (max(ranks.values(), default=0) >> 8) + 1
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def merge(self, tokens: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each of some pre-tokens. All of them stand one after the
        other in the same linked list (no pair crosses a border) and share
        the rank queue; taking the ranks in order over all of them takes them
        in order within each."""
        joined = b"".join(tokens)
        n = len(joined)
        if not n:
            return [() for _ in tokens]
        bits, words, buckets, get = _BITS, [0] * self.bitmap_words, {}, self.pair_rank.get
        raw = np.frombuffer(joined, dtype=np.uint8)
        first_of = np.cumsum([0] + [len(t) for t in tokens])
        first, last = first_of[:-1][np.diff(first_of) > 0], first_of[1:][np.diff(first_of) > 0] - 1
        ranks = np.full(n + 1, -1, dtype=np.int64)
        ranks[:n - 1] = self.byte_pair_rank[raw[:-1], raw[1:]]
        ranks[last] = -1
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[last], before[first] = n, n           # n: a part that joins with nothing
        part = [*self.byte_id[raw].tolist(), -1]    # id of the part that starts here, -1 once merged away
        pair = ranks.tolist()                       # rank of the pair that starts here, -1 for none
        after, before = after.tolist(), before.tolist()
        order = np.argsort(ranks[:n], kind="stable")
        order = order[np.searchsorted(ranks[:n][order], 0):]
        cut = np.flatnonzero(np.diff(ranks[order], prepend=-1)).tolist()
        top = 0
        for a, b in zip(cut, [*cut[1:], len(order)]):
            r = int(ranks[order[a]])
            buckets[r] = order[a:b].tolist()
            words[r >> 8] |= bits[r & 255]
            top |= bits[r >> 8]
        while top:
            w = (top & -top).bit_length() - 1       # find first set, in two levels
            word = words[w]
            low = word & -word
            rank = (w << 8) + low.bit_length() - 1
            bucket = buckets.pop(rank)
            words[w] = word = word ^ low
            if not word:
                top ^= bits[w]
            bucket.sort()                           # leftmost first
            lower = False
            for i, pos in enumerate(bucket):
                if pair[pos] != rank:
                    continue                        # stale
                gone = after[pos]
                part[pos] = rank                    # a rank is the id of the joined bytes
                part[gone] = pair[gone] = -1
                nxt = after[pos] = after[gone]
                before[nxt] = pos
                prev = before[pos]
                r = pair[pos] = get(rank << 32 | part[nxt], -1)
                q = get(part[prev] << 32 | rank, -1)
                if pair[prev] == q:
                    q = -1
                else:
                    pair[prev] = q
                for r, at in ((r, pos), (q, prev)):
                    if r < 0:
                        continue
                    if r in buckets:
                        buckets[r].append(at)
                    elif r == rank:                 # the same bytes, cut elsewhere
                        insort(bucket, at, i + 1)
                    else:
                        buckets[r] = [at]
                        words[r >> 8] |= bits[r & 255]
                        top |= bits[r >> 8]
                        lower |= r < rank
                if lower:                           # a smaller rank came up: it goes first
                    rest = bucket[i + 1:]
                    if rest:
                        buckets[rank] = rest
                        words[w] |= low
                        top |= bits[w]
                    break
        ids = np.array(part[:n])
        kept = np.concatenate([[0], np.cumsum(ids >= 0)])[first_of].tolist()
        ids = [*map(self.shared.__getitem__, ids[ids >= 0].tolist())]
        return [tuple(ids[a:b]) for a, b in zip(kept, kept[1:])]

    def _learn(self, missing: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of pre-tokens that are not in the young cache."""
        old, known = self.old, self.ranks
        found = {t: old[t] for t in missing if t in old}
        rest = [(t, t.encode()) for t in missing if t not in found]
        found.update((t, (known[b],)) for t, b in rest if b in known)
        rest = [(t, b) for t, b in rest if b not in known]
        found.update(zip([t for t, _ in rest], self.merge([b for _, b in rest])))
        return found

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of every text."""
        tokens = [pre_tokens(t) for t in texts]
        missing = set().union(*[set(t).difference(self.young) for t in tokens])
        if len(self.young) + len(missing) > CACHE_ENTRIES:
            found = dict(self.young)
            self.old, self.young = self.young, {}
            found.update(self._learn(list(missing)))
        else:
            self.young.update(self._learn(list(missing)))
            found = self.young
        if found is not self.young:
            self.young = {t: found[t] for t in missing if len(t) <= 64}
        out = []
        for words in tokens:
            ids = []
            for t in words:
                ids += found[t]
            out.append(ids)
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def codec(path: str) -> Codec:
    """The codec of a vocabulary file, built once per Python worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(load_ranks(path))
    return _CODECS[path]


_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Class of every code point: 0 white space, 1 letter, 2 number, 3 other."""
    if not _CLASSES:
        every = np.arange(0x110000, dtype=np.uint32)
        every = every[(every < 0xD800) | (every > 0xDFFF)]
        text = every.tobytes().decode("utf-32-le")
        table = np.full(0x110000, 3, dtype=np.uint8)
        for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (0, r"\p{White_Space}+")):
            for run in regex.finditer(pattern, text):
                table[every[run.start():run.end()]] = kind
        _CLASSES.append(table)
    return _CLASSES[0]


def pre_tokens(text: str) -> list[str]:
    """The matches of the pre-token pattern: contractions, runs of letters,
    numbers or other characters with one blank before, and white space whose
    last character is left to what follows. Found from changes of character
    class over the whole text at once."""
    if not text:
        return []
    point = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    kind = _classes()[point]
    first = np.empty(len(kind), dtype=bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    led = np.flatnonzero(first[1:] & (kind[1:] != 0) & (kind[:-1] == 0)) + 1   # runs after white space
    first[led - 1] = True
    first[led[point[led - 1] == 0x20]] = False
    cut = np.flatnonzero(first).tolist()
    cut.append(len(text))
    tokens = [text[a:b] for a, b in zip(cut, cut[1:])]
    return _contractions(tokens) if "'" in text else tokens


# The contractions of the pre-token pattern.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def _contractions(tokens: list[str]) -> list[str]:
    out, i = [], 0
    while i < len(tokens):
        token = tokens[i]
        if token == "'" and i + 1 < len(tokens):
            both = "'" + tokens[i + 1]
            found = next((c for c in CONTRACTIONS if both.startswith(c)), None)
            if found:
                out.append(found)
                if len(both) > len(found):
                    out.append(both[len(found):])
                i += 2
                continue
        out.append(token)
        i += 1
    return out


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        own = codec(path)

        def fn(batch):
            ids = own.encode_all(texts_of(batch))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        return fn
    return map_batches(docs.selectExpr(f"`{id_col}` as doc_id", f"`{text_col}` as text"), make,
                       f"doc_id {kind}, ids array<int>", BLOCK).withColumnRenamed("doc_id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes binary) of every list of ids (null: empty)."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def make():
        own = codec(path)

        def fn(batch):
            raw = [own.decode(i or []) for i in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])
        return fn
    return map_batches(encoded.selectExpr(f"`{id_col}` as doc_id", f"`{ids_col}` as ids"), make,
                       f"doc_id {kind}, bytes binary", BLOCK).withColumnRenamed("doc_id", id_col)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass; token count and digests of
    the ids and of the decoded bytes."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        own = codec(path)
        name = own.text_of.__getitem__

        def fn(batch):
            n, ids_sha, raw_sha = [], [], []
            for ids in own.encode_all(texts_of(batch)):
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(name, ids)).encode()).hexdigest())
                raw_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(raw_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return fn
    return map_batches(docs.selectExpr(f"`{id_col}` as doc_id", f"`{text_col}` as text"), make,
                       f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                       BLOCK).withColumnRenamed("doc_id", id_col)


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"), vocabulary())
