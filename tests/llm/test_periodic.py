"""Periodic runs against trying every period at every place."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from adsettle.llm import periodic as P

SF = "/root/testdata/sf0.001"


def plain_runs(w) -> list[tuple[int, int, int]]:
    """(start, length, period) by the definition."""
    n, least = len(w), {}
    for q in range(1, n // 3 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and w[end] == w[end + q]:
                end += 1
            if end + q - start >= max(24, 3 * q):
                least.setdefault((start, end + q), q)
            start = max(end, start) + 1
    return sorted(((s, e - s, q) for (s, e), q in least.items()), key=lambda r: (r[0], r[2]))


def strings(draw):
    """Words over few letters, with repetitions, repetitions of repetitions and single changes."""
    fib = ["a", "ab"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    yield list(fib[-1])
    yield ["a"] * 500
    yield (["a"] * 22 + ["b"]) * 9
    yield (["a", "b"] * 11 + ["a"]) * 5 + ["a", "b"] * 40
    for _ in range(250):
        letters = "abcdefghijklmnopqrstuvwxyz"[: draw.choice([1, 2, 2, 3, 26])]
        word = [draw.choice(letters) for _ in range(draw.randrange(1, 90))]
        for _ in range(draw.randrange(1, 4)):
            word = word * draw.randrange(1, 8) + [draw.choice(letters) for _ in range(draw.randrange(30))]
            if len(word) > 900:
                word = word[draw.randrange(200) : 900]
            if draw.random() < 0.4 and word:
                word[draw.randrange(len(word))] = "z"
        yield word


def test_all_periods():
    many = list(strings(random.Random(5)))
    words = [[c.encode() for c in w] for w in many]
    for text, alone, together in zip(many, [P.runs_of_texts([w])[0] for w in words], P.runs_of_texts(words)):
        want = plain_runs(text)
        assert list(map(tuple, alone.tolist())) == want
        assert list(map(tuple, together.tolist())) == want


def test_larger_periods():
    """Every period of three dyadic scales, at the shortest length, with a changed word one short of it."""
    draw = random.Random(6)
    for q in range(9, 100):
        word = [draw.randrange(10**9) for _ in range(q)]
        before = [draw.randrange(10**9) for _ in range(7)]
        for length in (3 * q - 1, 3 * q, 3 * q + 1, 7 * q + 3):
            w = np.array(before + (word * 8)[:length] + before[::-1], dtype=np.int64)
            assert list(map(tuple, P.runs_of(w).tolist())) == ([(7, length, q)] if length >= max(24, 3 * q) else [])


def test_selected_positions_are_consistent():
    draw = random.Random(7)
    w = [draw.randrange(3) for _ in range(4000)]
    w = np.array(w + [9] + w, dtype=np.int64)
    hashes = P.joined(w.astype(np.uint64), w.astype(np.uint64))
    for width in (1, 2, 4):
        hashes = P.joined(hashes[:-width], hashes[width:])
    places = set(P.selected(hashes >> P.S1, 8).tolist())
    assert all((i in places) == (i + 4001 in places) for i in range(4000 - 16))
    ordered = sorted(places)
    assert max(b - a for a, b in zip(ordered, ordered[1:])) <= 9 and len(places) < len(w) / 2


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), best[0], best[1], best[2], 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    few = [r for r in docs if len((r.text or "").split()) < 900]
    got = {r.doc_id: tuple(r) for r in P.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs) and len(few) > 0.7 * len(docs)
    for r in few:
        assert got[r.doc_id] == expected(r.doc_id, r.text)


def test_odd_rows(spark, tmp_path, monkeypatch):
    """Null and empty texts, very long ones, repeated rows, missing ids, clashing columns, an empty table."""
    planted = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (None, "é " * 30), (planted, None), (planted, ""), (planted, "un mot ici"),
        (5, "a b " * 20), (5, "a b " * 20), (6, "x\x1cy z " * 9),
    ]
    made = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], "doc_id long, text string, runs int, collapsed string, best int")
    made.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(P, "TOGETHER", 25)
    got = [tuple(r) for r in P.op11_periodic_runs(spark, str(tmp_path)).collect()]
    key = lambda r: repr(r)
    assert sorted(got, key=key) == sorted((expected(*r) for r in rows), key=key)
    made.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert P.op11_periodic_runs(spark, f"{tmp_path}/none").collect() == []
    long = spark.createDataFrame([(1, "w " * 400_000 + "one two " * 100_000)], "doc_id long, text string")
    assert [tuple(x) for x in P.with_runs(long).first().runs] == [(0, 400_000, 1), (400_000, 200_000, 2)]


@pytest.mark.parametrize("period", [3000, 70_000])
def test_long_periods(period):
    draw = random.Random(8)
    word = [b"%d" % draw.randrange(10**6) for _ in range(period)]
    text = [b"start", *(word * 3), b"end"]
    found = P.runs_of_texts([text, text])
    assert [x.tolist() for x in found] == [[[1, 3 * period, period]]] * 2
