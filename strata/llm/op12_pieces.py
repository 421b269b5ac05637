"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies with a
score-ordered agenda of adjacent symbol pairs.

The text starts as its characters (blanks written as U+2581, one in front).
The agenda holds every adjacent pair that a piece joins, best score first and
leftmost among equals; the top pair is joined, its new neighbour pairs enter,
and entries whose pair has changed meanwhile are skipped when they come up.
Characters in no piece become their UTF-8 bytes.

No joining can cross two neighbouring characters that stand side by side in no
piece, so the text is cut there and each part has its own agenda; equal
parts are joined once per worker (a cache of bounded size that never changes
results). A part without such a cut may be as long as the text: its agenda
then takes about 110 bytes a character beside the text.

Null texts count as empty: no ids, empty decoded text. Repeated rows give
repeated results. Extra columns are ignored (``encode`` keeps only the id).
Only models with the identity normaliser, byte fallback and without
user-defined or unused pieces are taken (others raise ValueError).
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import map_batches, read, texts_of

# Entries of each of the two generations of joined parts that a worker keeps
# (a bound on memory; results do not depend on it), and their longest part.
CACHE_ENTRIES = 150_000
CACHED_CHARS = 48

# Bytes of text that are encoded together.
BLOCK = 2_000_000

# Fixed values of the model format: piece types, the mark of a blank, the text
# of an unknown piece.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BLANK = "▁"
UNKNOWN_TEXT = " ⁇ "

# Symbols of characters that are no piece (by code point), marks of the space
# beside a short part, of a place joined into another one, and of a pair that
# nothing joins.
CHARACTERS, PAD, GONE, NO_PAIR = 0x200000, 0xFFFFFF, -1, 1 << 62

# Parts of up to so many characters are joined together in arrays of that width.
ROOMS = (0, 1, 8, 16, 48)

_MODELS: dict[str, "PieceModel"] = {}


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value
    while at < len(raw):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(tag & 7)
        n = varint() if n is None else n
        yield tag >> 3, raw[at:at + n]
        at += n


def load_pieces(path: str) -> tuple[list[tuple[str, float, int]], bool]:
    """((piece, score, type) by id, whether a blank is put in front)."""
    with open(path, "rb") as f:
        raw = f.read()
    pieces, trainer, normaliser = [], {}, {}
    for field, value in _fields(raw):
        if field == 1:
            have = dict(_fields(value))
            score = struct.unpack("<f", have[2])[0] if 2 in have else 0.0
            pieces.append((have.get(1, b"").decode(), score, have.get(3, NORMAL)))
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            normaliser = dict(_fields(value))
    if trainer.get(3) != 2 or not trainer.get(35):
        raise ValueError("only merge-type models with byte fallback")
    if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1):
        raise ValueError("only models with the identity normaliser that keep white space")
    if any(kind in (USER_DEFINED, UNUSED) for _, _, kind in pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    return pieces, bool(normaliser.get(3, 1))


class PieceModel:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        pieces, self.in_front = load_pieces(path)
        self.kinds = [kind for _, _, kind in pieces]
        self.name_of = [str(i) for i in range(len(pieces))]
        id_of = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        byte_id = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.raw_of = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL
                       else UNKNOWN_TEXT.encode() if kind == UNKNOWN else p.replace(BLANK, " ").encode()
                       for p, _, kind in pieces]
        self.blank_first = [p.startswith(BLANK) for p, _, _ in pieces]
        # symbols: pieces by id, other characters by code point
        self.symbol = dict(id_of)
        for p in id_of:
            for c in p:
                self.symbol.setdefault(c, CHARACTERS + ord(c))
        self.byte_id = byte_id
        best = {s: i for i, s in enumerate(sorted({pieces[i][1] for i in id_of.values()}, reverse=True))}
        # what joins a pair of symbols: order of its score (0: best; equal scores, equal order) and the piece
        self.join = {self.symbol[p[:k]] << 24 | self.symbol[p[k:]]: best[pieces[i][1]] << 24 | i
                     for p, i in id_of.items() for k in range(1, len(p))
                     if p[:k] in self.symbol and p[k:] in self.symbol}
        self.join_keys = np.array(sorted(self.join), dtype=np.int64)
        self.join_values = np.array([self.join[k] for k in self.join_keys.tolist()], dtype=np.int64)
        chars = {c: s for c, s in self.symbol.items() if len(c) == 1}
        self.symbol_of = np.arange(0x110000, dtype=np.int32) + CHARACTERS
        self.symbol_of[[ord(c) for c in chars]] = list(chars.values())
        # class of every character that stands beside another one in a piece, and the pairs that do
        inner = sorted({c for p in id_of if len(p) > 1 for c in p})
        self.classes = np.zeros(0x110000, dtype=np.int32)
        self.classes[[ord(c) for c in inner]] = np.arange(1, len(inner) + 1)
        self.width = len(inner) + 1
        self.beside = np.zeros(self.width * self.width, dtype=bool)
        pairs = {(a, b) for p in id_of for a, b in zip(p, p[1:])}
        self.beside[[self.classes[ord(a)] * self.width + self.classes[ord(b)] for a, b in pairs]] = True
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def parts(self, text: str) -> list[str]:
        """The text with blanks written out, cut where no piece can join."""
        if not text:
            return []
        text = (BLANK if self.in_front else "") + text.replace(" ", BLANK)
        kind = self.classes[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
        cut = (np.flatnonzero(~self.beside[kind[:-1] * self.width + kind[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cut], [*cut, len(text)])]

    def joined(self, parts: list[str]) -> list[tuple[int, ...]]:
        """Ids of every part: short ones together, others one by one."""
        out: list[tuple[int, ...]] = [()] * len(parts)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        for low, high in zip(ROOMS, ROOMS[1:]):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for some in np.array_split(rows, len(rows) // 20_000 + 1) if len(rows) else ():
                self._short_agendas([parts[k] for k in some.tolist()], some.tolist(), out)
        for k in np.flatnonzero(sizes > ROOMS[-1]).tolist():
            symbol = array("i", self.symbol_of[np.frombuffer(parts[k].encode("utf-32-le"), dtype=np.uint32)].tolist())
            self._agenda(symbol)
            out[k] = self._written([s for s in symbol if s != GONE])
        return out

    def _written(self, symbols: list[int]) -> tuple[int, ...]:
        """Ids of symbols; a character that is no piece becomes its bytes."""
        n_pieces = len(self.kinds)
        if max(symbols) < n_pieces:
            return tuple(symbols)
        return tuple(i for s in symbols for i in
                     ((s,) if s < n_pieces else (self.byte_id[b] for b in chr(s - CHARACTERS).encode())))

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What joins each pair of symbols (NO_PAIR: nothing)."""
        key = left.astype(np.int64) << 24 | right
        at = np.minimum(np.searchsorted(self.join_keys, key), len(self.join_keys) - 1)
        return np.where(self.join_keys[at] == key, self.join_values[at], NO_PAIR)

    def _short_agendas(self, parts: list[str], places: list[int], out: list) -> None:
        """The agendas of many short parts side by side: row by row, the pairs
        in text order. Each round takes every row's top (best score, leftmost
        among equals), joins it and renews the two pairs beside it; a row
        loses one symbol a round and is done when nothing joins any more."""
        size = np.array([len(p) for p in parts])
        width = int(size.max())
        inside = np.arange(width) < size[:, None]
        symbol = np.full((len(parts), width), PAD, dtype=np.int32)
        symbol[inside] = self.symbol_of[np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32)]
        pair = self._pairs(symbol[:, :-1], symbol[:, 1:])
        place = np.array(places)
        while len(place):
            if pair.shape[1]:
                top = (pair >> 24).argmin(1)
                best = np.take_along_axis(pair, top[:, None], 1)[:, 0]
                done = best == NO_PAIR
            else:
                done = np.ones(len(place), dtype=bool)
            if done.any():
                for k, row in zip(place[done].tolist(), symbol[done].tolist()):
                    out[k] = self._written([s for s in row if s != PAD])
                go = ~done
                if not go.any():
                    return
                place, symbol, pair, top, best = place[go], symbol[go], pair[go], top[go], best[go]
            row = np.arange(len(place))
            made = (best & 0xFFFFFF).astype(np.int32)
            symbol[row, top] = made
            col = np.arange(symbol.shape[1] - 1)
            symbol = np.take_along_axis(symbol, col + (col > top[:, None]), 1)
            col = col[:-1]
            pair = np.take_along_axis(pair, col + (col >= top[:, None]), 1)
            if pair.shape[1]:
                on = top < pair.shape[1]
                pair[row[on], top[on]] = self._pairs(made[on], symbol[row[on], top[on] + 1])
                on = top > 0
                pair[row[on], top[on] - 1] = self._pairs(symbol[row[on], top[on] - 1], made[on])

    def _agenda(self, symbol: array) -> None:
        """Many symbols: a heap of (order, position) over a linked list; places
        joined into their left neighbour become GONE."""
        n, join = len(symbol), self.join.get
        after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = join(symbol[i] << 24 | symbol[i + 1])
            if pair is not None:
                agenda.append(pair >> 24 << 40 | i)
        heapify(agenda)
        while agenda:
            top = heappop(agenda)
            i = top & 0xFFFFFFFFFF
            j = after[i]
            if symbol[i] == GONE or j == n:
                continue
            pair = join(symbol[i] << 24 | symbol[j])
            if pair is None or pair >> 24 != top >> 40:
                continue                                 # stale
            made = symbol[i] = pair & 0xFFFFFF
            symbol[j] = GONE
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair = join(made << 24 | symbol[k])
                if pair is not None:
                    heappush(agenda, pair >> 24 << 40 | i)
            h = before[i]
            if h >= 0:
                pair = join(symbol[h] << 24 | made)
                if pair is not None:
                    heappush(agenda, pair >> 24 << 40 | h)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of every text."""
        cut = [self.parts(t) for t in texts]
        missing = set().union(*[set(parts).difference(self.young) for parts in cut])
        found = {p: self.old[p] for p in missing if p in self.old}
        rest = [p for p in missing if p not in found]
        found.update(zip(rest, self.joined(rest)))
        kept = {p: ids for p, ids in found.items() if len(p) <= CACHED_CHARS}
        if len(self.young) + len(kept) > CACHE_ENTRIES:
            found.update(self.young)
            self.old, self.young = self.young, kept
        else:
            self.young.update(kept)
            if len(kept) == len(found):
                found = self.young
            else:
                found.update(self.young)
        out = []
        for parts in cut:
            ids = []
            for p in parts:
                ids += found[p]
            out.append(ids)
        return out

    def decode(self, ids) -> str:
        """The text of some ids; bytes that are no UTF-8 become U+FFFD each."""
        raw = list(map(self.raw_of.__getitem__, ids))
        first = next((k for k, i in enumerate(ids) if self.kinds[i] != CONTROL), None)
        if first is not None and self.in_front and self.blank_first[ids[first]]:
            raw[first] = raw[first][1:]
        try:
            return b"".join(raw).decode()
        except UnicodeDecodeError:
            return self._decode_bytewise(ids, raw)

    def _decode_bytewise(self, ids, raw: list[bytes]) -> str:
        out, run = [], b""
        for i, r in zip([*ids, None], [*raw, b""]):
            if i is not None and self.kinds[i] == BYTE:
                run += r
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    n = 1
                    out.append("�")
                run = run[n:]
            out.append(r.decode())
        return "".join(out)


def model(path: str) -> PieceModel:
    """The model of a file, built once per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _rows(docs: DataFrame, id_col: str, col: str) -> tuple[DataFrame, str]:
    return docs.selectExpr(f"`{id_col}` as doc_id", f"`{col}` as text"), docs.schema[id_col].dataType.simpleString()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text."""
    rows, kind = _rows(docs, id_col, text_col)

    def make():
        own = model(path)

        def fn(batch):
            ids = own.encode_all(texts_of(batch))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        return fn
    return map_batches(rows, make, f"doc_id {kind}, ids array<int>", BLOCK).withColumnRenamed("doc_id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every list of ids (null: empty)."""
    rows, kind = _rows(encoded, id_col, ids_col)

    def make():
        own = model(path)

        def fn(batch):
            texts = [own.decode(i or []) for i in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
        return fn
    return map_batches(rows, make, f"doc_id {kind}, text string", BLOCK).withColumnRenamed("doc_id", id_col)


def disagreements(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, library_ids) of the texts that the sentencepiece library
    encodes otherwise, or decodes otherwise: compared batch by batch."""
    rows, kind = _rows(docs, id_col, text_col)

    def make():
        import sentencepiece
        own, library = model(path), sentencepiece.SentencePieceProcessor(model_file=path)

        def fn(batch):
            texts = texts_of(batch)
            mine, theirs = own.encode_all(texts), library.encode(texts, num_threads=1)
            bad = [k for k, (a, b) in enumerate(zip(mine, theirs)) if a != b or own.decode(a) != library.decode(b)]
            lists = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(bad, pa.int64())), pa.array([mine[k] for k in bad], lists),
                 pa.array([theirs[k] for k in bad], lists)], ["doc_id", "ids", "library_ids"])
        return fn
    return map_batches(rows, make, f"doc_id {kind}, ids array<int>, library_ids array<int>",
                       BLOCK).withColumnRenamed("doc_id", id_col)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass; token count and digests of
    the ids and of the decoded text."""
    rows, kind = _rows(docs, id_col, text_col)

    def make():
        own = model(path)
        name = own.name_of.__getitem__

        def fn(batch):
            n, ids_sha, text_sha = [], [], []
            for ids in own.encode_all(texts_of(batch)):
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return fn
    return map_batches(rows, make, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                       BLOCK).withColumnRenamed("doc_id", id_col)


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"), vocabulary())
