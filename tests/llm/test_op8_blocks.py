"""op8: texts hashed together and work arrays used again give the rows of one text at a time."""

import random

import numpy as np

from strata.llm import op8_hmm


def test_texts_hashed_together(monkeypatch):
    rng = random.Random(5)
    texts = [None, "", "  ", "a", "A b\t", "é Ü x", "a\x00b\x0b c", " lead", "trail "]
    texts += [" ".join(rng.choice(["Ab", "ab", "tail", "é"]) for _ in range(rng.randrange(40))) for _ in range(200)]
    whole = [op8_hmm.tokens(t) for t in texts]
    for size in (1, 50, 1 << 18):
        monkeypatch.setattr(op8_hmm, "HASHED", size)
        keys, lengths = op8_hmm.all_tokens(texts)
        assert lengths.tolist() == [len(x) for x in whole]
        assert keys.tolist() == np.concatenate(whole).tolist()
    assert [len(x) for x in op8_hmm.all_tokens([])] == [0, 0]
    assert (op8_hmm.tokens("A b") == op8_hmm.tokens("a  B")).all()


def test_work_arrays_are_used_again():
    rng = np.random.default_rng(3)
    k, m = op8_hmm.STATES, 6
    emit, follow, start = rng.dirichlet(np.ones(m), k).T, rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(k))
    none = np.array([])
    model = op8_hmm.Model(none, none, none, np.ones(1), np.ones(m), 1, 1, start, follow, emit)
    room = op8_hmm.Room(3)
    for sizes in ((5, 1, 9), (2,), (30, 30, 1)):
        sequences = [rng.integers(0, m, n) for n in sizes]
        got, want = ([np.zeros((m, k)), np.zeros(k), np.zeros((k, k))] for _ in range(2))
        op8_hmm.expected(model, sequences, *got, room)
        for s in sequences:                                  # one after the other, by hand
            a, b = [start * emit[s[0]]], [np.ones(k)]
            for w in s[1:]:
                a.append((a[-1] @ follow) * emit[w])
            for w in s[:0:-1]:
                b.insert(0, follow @ (emit[w] * b[0]))
            total = a[-1].sum()
            for t, w in enumerate(s):
                want[0][w] += a[t] * b[t] / total
                if t:
                    want[2] += np.outer(a[t - 1], emit[w] * b[t]) / total
            want[1] += a[0] * b[0] / total
        assert all(np.allclose(x, y, rtol=1e-9) for x, y in zip(got, want))
        kept = room.kept[0]
        op8_hmm.expected(model, sequences, *want, room)
        assert room.kept[0] is kept
