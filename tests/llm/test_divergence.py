"""Divergence of sources against the definition, and the index by itself."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from adsettle.llm import divergence as D
from tests.oracle import canonical, connect

SF = "/root/testdata/sf0.001"
COLUMNS = "lang string, source string, text string, value int, rank string"


def plain_audit(rows, least=D.LEAST_DOCS):
    """Of (lang, source, text), by the definition, with Python's own whole numbers."""
    lower = {c: c + 32 for c in range(65, 91)}
    docs = [(a or "", b or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower))) for a, b, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(w for _, _, words in own for w in set(words))
        kept = sorted(w for w, n in held.items() if n >= least)
        counts = {s: Counter(w for _, b, words in own if b == s for w in words if held[w] >= least) for s in {d[1] for d in own}}
        whole = sum(counts.values(), Counter())
        p = lambda c, w: 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, c in counts.items():
            pairs = [(o, sum(f(p(c, w), p(counts[o], w)) for w in kept)) for o in counts if o != s]
            terms = [(w, f(p(c, w), p(whole, w))) for w in kept if c[w] and p(c, w) > p(whole, w)]
            for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def table_of(draw, n):
    words = ["the", "Of", "été", "a_b", "x1y", "日本 語", "z" * 40] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    for _ in range(n):
        text = " ".join(draw.choices(words, weights=range(len(words), 0, -1), k=draw.randrange(40)))
        yield draw.choice(["en", "de", "", None]), draw.choice(["s1", "s2", "é", "S3", None]), draw.choice([text, text, None, ""])


@pytest.mark.parametrize("block, piece, tile", [(300_000, 4096, 512), (50, 7, 2)])
def test_definition(spark, monkeypatch, block, piece, tile):
    """One run or many, pieces of many terms or few, one square of sources or several."""
    for name, value in (("BLOCK", block), ("PIECE", piece), ("TILE", tile)):
        monkeypatch.setattr(D, name, value)
    rows = [*table_of(random.Random(3), 400), ("only", "a", "few"), ("only", "b", None), ("one", "a", "word")]
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], COLUMNS).repartition(5)
    got = sorted(tuple(r) for r in D.audit(docs).collect())
    assert got == plain_audit(rows)
    assert ("only", "a", "pair", "b", 0, 1) in got and not [r for r in got if r[0] == "one"]


def test_more_words_than_a_long_holds(spark):
    """Counts over 9.2 thousand million don't overflow."""
    row = spark.createDataFrame([(2 * 10**10, 4 * 10**10, 3)], "n long, whole long, v long")
    p = row.select(D.share(*[D.F.col(c) for c in row.columns]).alias("p")).first().p
    assert p == 1 + 10**9 * (2 * 10**10 + 2) // (4 * 10**10 + 6)


def test_merge(monkeypatch):
    """Runs in pieces give the same sums as counting at once, in order, in stretches of whole keys."""
    draw = random.Random(4)
    entries = Counter()
    pieces = []
    for _ in range(30):
        run = Counter((b"k%03d\0en" % draw.randrange(300), b"s%d" % draw.randrange(3)) for _ in range(200))
        entries += run
        part = sorted((k, s, n, 1) for (k, s), n in run.items())
        pieces += [D.pa.table(list(map(list, zip(*part[at : at + 16]))), schema=D.ENTRY) for at in range(0, len(part), 16)]
    pieces.sort(key=lambda p: p["key"][0].as_py())
    for stretch in (1, 500, 10**6):
        monkeypatch.setattr(D, "STRETCH", stretch)
        tables = list(D.merged(pieces))
        keys = [sorted(set(t["key"].to_pylist())) for t in tables]
        assert [k for own in keys for k in own] == sorted({k for k, _ in entries}) and (len(tables) > 1) == (stretch < 10**6)
        rows = [r for t in tables for r in D.summed(t, 1).to_pylist()]
        assert {(r["term"].encode() + b"\0en", r["source"].encode()): r["n"] for r in rows} == dict(entries)
        assert sum(r["head"] for r in rows) == len({k for k, _ in entries})
        assert all(r["lang_n"] == sum(n for (k, _), n in entries.items() if k == r["term"].encode() + b"\0en") for r in rows)
    assert list(D.merged([])) == []


def test_pairs():
    import numpy as np

    sizes = np.array([1, 3, 0, 2, 4])
    i, j = D.pairs_within(sizes)
    starts = np.cumsum(sizes) - sizes
    assert list(zip(i, j)) == [(s + a, s + b) for s, n in zip(starts, sizes) for a in range(n) for b in range(a + 1, n)]


def test_terms():
    text = "Ab1cD_é\x00x\tÀB@[`{~\x7f\u0080"
    want = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))
    assert [w.decode() for w in text.encode().translate(D.TERMS).split()] == want


def test_odd_tables(spark):
    docs = spark.createDataFrame([("en", "a", "word " * 300_000, 1, "")] * 12 + [("en", "b", "other", 1, "")], COLUMNS)
    got = sorted(tuple(r) for r in D.audit(docs).collect())
    assert got == plain_audit([(r.lang, r.source, r.text) for r in docs.collect()])
    assert D.audit(docs.limit(0)).collect() == []


def test_sql_of_given_documents(spark):
    result = connect(SF).execute(D.AUDIT_SQL)
    want = canonical([d[0] for d in result.description], result.fetchall())
    out = D.op12_divergence(spark, SF)
    assert canonical(out.columns, [tuple(r) for r in out.collect()]) == want and len(want[1]) > 100
