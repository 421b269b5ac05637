"""op11 to op13 against brute force and the sentencepiece library."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from strata.llm import op11_spelling, op12_pieces, op13_trie
from strata.llm.common import read
from test_llm import SCHEMA, edge_rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# ------------------------------------------------------------------ op11

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_scan_finds_exactly_the_pairs():
    rng = random.Random(2)
    for turn in range(800):
        letters = "ab" if turn % 2 else "abcé"
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 8))) for _ in range(rng.randrange(30))})
        for m in range(1, 9):
            want = {(a, b) for a in words for b in words if a < b and max(len(a), len(b)) == m and one_edit(a, b)}
            a, b = [], []
            op11_spelling.scan(words, m, 0, 99, a, b)
            assert sorted(zip(a, b)) == sorted(want)
            framed = [w for w in words if len(w) in (m, m - 1)]
            a, b = [], []
            op11_spelling.search(framed, m, 0, 0, 99, a, b, scan_rows=2)       # cut down to single characters
            assert sorted(zip(a, b)) == sorted(want)


@pytest.mark.parametrize("frame_rows", [3, 5_000])
def test_near_pairs_whatever_the_frames(spark, frame_rows):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(2, 9))) for _ in range(120)} | {"ab", "a" * 30, "a" * 31}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = [tuple(sorted(r)) for r in op11_spelling.near_pairs(df, frame_rows).collect()]
    assert sorted(got) == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))


def brute_spelling(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if v != w and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def test_spelling_groups(spark, docs, nothing):
    rng = random.Random(9)
    # a chain (spelling -> spellings -> spelings), ties, accents, one word in a third of all runs
    extra = (["spelling"] * 130 + ["spellings"] * 26 + ["spelings"] * 5 + ["colour", "color é", "Colours"] * 7
             + ["élèvesÀ"] * 30 + ["élèveÀ"] * 6 + ["aaaaaa"] * 40 + ["aaaaab"] * 40 + ["aaaaac"] * 8 + ["gros" + "x" * 400] * 25
             + ["gros" + "x" * 399] * 5 + ["hotword"] * 300)
    rng.shuffle(extra)
    rows = edge_rows() + [(1000 + i, " ".join(extra[i * 20:i * 20 + 20]), None, None, None, None, None, None) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    words = op11_spelling.counted_words(df, typo_modulus=199)
    got = op11_spelling.grouped(words, op11_spelling.near_pairs(words)).collect()
    assert {tuple(r) for r in got} == brute_spelling(rows) and len(got) == len({r[0] for r in got})
    assert any(r.form and r.root != r.form for r in got)
    none = op11_spelling.counted_words(nothing, typo_modulus=199)
    assert op11_spelling.grouped(none, op11_spelling.near_pairs(none)).count() == 0


# ------------------------------------------------------------------ op12

@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=op12_pieces.vocabulary())


def test_pieces_equal_the_library(library):
    own = op12_pieces.model(op12_pieces.vocabulary())
    rng = random.Random(1)
    alphabet = list("ab e▁é́<0x0A>s/\n\t\r\x00😀中文の벨ﬁİß  ​　﻿�") + [
        "the", " the ", "    ", "ing", " " * 20, "tion"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["", " ", "  a", "▁", "ab" * 30_000, " " * 20_000, "a" * 50_000, "x" * 47, "x" * 48, "x" * 49]
    mine = own.encode_all(texts)
    assert mine == library.encode(texts)
    assert [own.decode(i) for i in mine] == library.decode(mine)
    for _ in range(3000):           # ids that no text gives: control, unknown, stray bytes
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(259)]) for _ in range(rng.randrange(8))]
        assert own.decode(ids) == library.decode(ids)


def test_pieces_cache_does_not_matter(library, monkeypatch):
    own = op12_pieces.PieceModel(op12_pieces.vocabulary())
    monkeypatch.setattr(op12_pieces, "CACHE_ENTRIES", 7)
    texts = [f"word{i % 13} other{i % 7} {'y' * (i % 90)}" for i in range(300)]
    assert [own.encode_all([t])[0] for t in texts] == library.encode(texts)


def test_pieces_query_and_round_trip(spark, docs, nothing, library):
    path = op12_pieces.vocabulary()
    assert op12_pieces.disagreements(docs, path).count() == 0
    assert op12_pieces.disagreements(read(spark, "/root/testdata/sf0.01", "documents"), path).count() == 0
    got = sorted(op12_pieces.digests(docs, path).collect(), key=str)
    want = []
    for r in edge_rows():
        ids = library.encode(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    back = {r.doc_id: r.text for r in op12_pieces.decode(op12_pieces.encode(docs, path), path).collect()}
    assert all(back[r[0]] == (r[1] or "").replace("▁", " ") for r in edge_rows())
    assert op12_pieces.digests(nothing, path).count() == 0 and op12_pieces.decode(
        op12_pieces.encode(nothing, path), path).count() == 0


# ------------------------------------------------------------------ op13

TURNS = "conv_id bigint, turn bigint, role string, text string, conv string, pos bigint, a double"


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r[:4] for r in rows if r[0] is not None),
                                      key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own[c].append((role or "", text or ""))
    convs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += not children[k]
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k)).encode()).hexdigest())
                  for k, m in members.items())


def edge_turns():
    rng = random.Random(4)
    rows = []
    for c in [*range(60), -3, -7, 1003, 2**40]:
        for t in range(rng.choice([1, 2, 3, 8, 10])):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "bot", None]),
                         rng.choice(["hi", "", None, "é" * 5, "same", f"own {c} {t}"]), "x", 7, 0.5))
    for c in range(3000, 3300):                    # one conversation in most of all ids
        rows += [(c, t, "user", f"copied {t}", "x", 7, 0.5) for t in range(9)]
    rows += [(5000, t % 400, "user", f"long {t}", "x", 7, 0.5) for t in range(900)]      # longer than a run, ties
    rows += [rows[3], rows[3], (None, 1, "user", "no id", "x", 7, 0.5)]
    return rows


def nodes_of(spark, rows, width=op13_trie.SKETCH_WIDTH):
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    convs, parts = op13_trie.rebuilt(op13_trie.hashed_turns(turns))
    got = op13_trie.trie(convs, parts, width).drop("a", "b").collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got)


@pytest.mark.parametrize("width", [16, 1 << 20])
def test_trie(spark, width):
    """A sketch that proves next to nothing, and one that proves all tails."""
    assert nodes_of(spark, edge_turns(), width) == brute_trie(edge_turns())


def test_trie_of_few_rows(spark):
    assert nodes_of(spark, []) == []
    for rows in ([(7, None, None, None, None, None, None)], [(5, 1, "a", "b", None, None, None)] * 3,
                 [(None, 1, "a", "b", None, None, None)]):
        assert nodes_of(spark, rows) == brute_trie(rows)


def test_sketch_never_counts_too_little(spark):
    rows = spark.range(0, 500).selectExpr("xxhash64(id % 300, 1) as a", "xxhash64(id % 300, 2) as b").repartition(7)
    marked = op13_trie.screened(rows, op13_trie.sketch(rows, 256))
    twice = rows.groupBy("a", "b").count().filter("count > 1").drop("count")
    assert marked.join(twice, ["a", "b"]).filter("one").count() == 0
