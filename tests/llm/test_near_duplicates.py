"""Near-duplicate groups against brute force."""

from __future__ import annotations

import random

import pytest
import xxhash

from adsettle.llm import base
from adsettle.llm import near_duplicates as N

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text: str | None) -> int:
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows: list[tuple[int | None, int]]) -> list[int | None]:
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 3:
                parent[root(i)] = root(j)
    ids: dict[int, list] = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc)
    least = {r: min((x for x in own if x is not None), default=None) for r, own in ids.items()}
    return [least[root(i)] for i in range(len(rows))]


def found(df):
    return sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in df.collect()), key=str)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    expected = [(d, f, g) for (d, f), g in zip(rows, plain_groups(rows))]
    assert found(N.near_duplicates(docs)) == sorted(expected, key=str)


@pytest.mark.parametrize("crowd", [256, 3])
def test_links_between_fingerprints(spark, crowd, monkeypatch):
    """Crowded entries or not, groups are those of all pairs."""
    monkeypatch.setattr(N, "CROWD", crowd)
    draw = random.Random(crowd)
    rows = []
    for _ in range(12):
        seed = draw.getrandbits(64)
        for _ in range(12):
            fp = seed
            for _ in range(draw.choice([0, 1, 2, 3, 5, 9])):
                fp ^= 1 << draw.randrange(64)
            rows.append((len(rows) * 7 % 997, fp))
    rows += [(2000, 0), (2001, 0), (2002, 7), (2003, (1 << 64) - 1)]
    signed = [(d, f - (1 << 64) if f >> 63 else f) for d, f in rows]
    groups = N.groups(spark.createDataFrame(signed, "doc_id long, fp long"))
    got = {r.fp & (1 << 64) - 1: r.component_id for r in groups.collect()}
    assert [got[f] for _, f in rows] == plain_groups(rows)


@pytest.mark.parametrize("crowd", [256, 3])
def test_only_counted_tables_are_broadcast(spark, crowd, monkeypatch):
    """What grows with the corpus is merged, however small Spark takes it to be; groups stay the same."""
    monkeypatch.setattr(N, "CROWD", crowd)
    monkeypatch.setattr(base, "FEW_ROWS", -1)
    plans, write = [], N.stage

    def stage(df, name):
        plans.append(plan_of(df))
        return write(df, name)

    monkeypatch.setattr(base, "stage", stage, raising=False)
    monkeypatch.setattr(N, "stage", stage)
    draw = random.Random(5)
    seeds = [draw.getrandbits(63) for _ in range(8)]
    rows = [(i, seeds[i % 8] ^ (1 << draw.randrange(63))) for i in range(100)] + [(None, 5), (3, 5)]
    prints = spark.createDataFrame(rows, "doc_id long, fp long")
    grouped = N.with_groups(prints, N.groups(prints))
    plans.append(plan_of(grouped))
    assert sum(p.count("SortMergeJoin") for p in plans) >= 6
    # but for the fixed table of pairs of bits, and for keys that hold a share of all rows
    joins = [x for p in plans for x in p.splitlines() if "Broadcast" in x and "Join" in x]
    assert all("[first#" in x or "_hot_key#" in x for x in joins)
    got = {(r.doc_id, r.fp): r.component_id for r in grouped.collect()}
    assert [got[r] for r in rows] == plain_groups(rows)


def test_repeated_rows_are_not_broadcast(spark, monkeypatch):
    """As many doc_ids as the corpus has may be repeated, so their table is broadcast only if it is counted as small."""
    docs = spark.createDataFrame([(i % 6, f"text number {i % 6 * 31} of many") for i in range(12)], "doc_id long, text string")
    few = N.one_of_each(docs)
    monkeypatch.setattr(base, "FEW_ROWS", -1)
    many = N.one_of_each(docs)
    assert "BroadcastHashJoin" not in plan_of(many)
    assert sorted(many.collect()) == sorted(few.collect())
    assert len({r.doc_id for r in many.collect()}) == many.count()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_odd_rows(spark):
    """Nulls, empty texts, repeated rows, a clashing column, one very long word run."""
    rows = [
        (1, None, "x"), (2, "", "x"), (None, " \n ", "x"), (4, "one two", "x"), (4, "one two", "x"), (5, "ONE two", "y"),
        (None, "lonely text here", "z"), (7, "word " * 30000, "x"), (8, "word " * 29000, "x"), (9, "é ü", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(3)
    out = found(N.near_duplicates(docs))
    assert sorted(str(x[0]) for x in out if x[2] == 1) == ["1", "2", "None"]
    assert [x for x in out if x[0] in (4, 5)] == [(4, plain_fingerprint("one two"), 4)] * 2 + [
        (5, plain_fingerprint("one two"), 4)
    ]
    assert [x[2] for x in out if x[1] == plain_fingerprint("lonely text here")] == [None]
    kept = N.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "7", "9", "None", "None"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_duplicates(docs).collect() == [] and N.one_of_each(docs).collect() == []
