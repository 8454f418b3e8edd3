"""Batched edit distances against the plain table."""

import random

from folioforge.functions import distance as D


def table(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_distances():
    r = random.Random(5)
    word = lambda n, letters: "".join(r.choice(letters) for _ in range(n))
    a, b = [], []
    for letters in ("ab", "abcdefgh åäö–", "日本語\U0001f600x"):
        for _ in range(220):
            x = word(r.choice([0, 1, 5, 63, 64, 65, 128, 150]), letters)
            y = word(r.choice([0, 1, 5, 63, 64, 65, 128, 150]), letters) if r.random() < 0.6 else x[: r.randint(0, 40)] + word(3, letters) + x[r.randint(0, 60) :]
            a.append(x), b.append(y)
    want = [table(x, y) for x, y in zip(a, b, strict=True)]
    assert D.distances(a, b).tolist() == want
    assert [D.distance(x, y) for x, y in zip(a, b, strict=True)] == want


def test_both_ways_of_a_batch(monkeypatch):
    r = random.Random(6)
    pairs = [tuple("".join(r.choice("abcde ") for _ in range(r.randint(1, 200))) for _ in range(2)) for _ in range(300)]
    pairs = sorted((sorted(p, key=len) for p in pairs), key=lambda p: len(p[1]))
    words = max((len(a) + 63) // 64 for a, _ in pairs)
    assert D._together([tuple(p) for p in pairs], words).tolist() == [D.distance(*p) for p in pairs]


def test_empty():
    assert D.distances([], []).tolist() == [] and D.distances(["", "a"], ["abc", "a"]).tolist() == [3, 0]
