"""Personal data against plain patterns, and what the trees add."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from adsettle.llm import pii as P

SF = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def valid(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text: str | None) -> list[str]:
    spans = [
        (m.start(), i, f"{kind}:{m.start()}:{m.end()}")
        for i, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m[0])
    ]
    return [x for _, _, x in sorted(spans)]


def base_of(df):
    made, base, every = P.find(df, P.fit(df))
    rows = made.select("i", P.joined(F.col(base)).alias("base"), P.joined(F.col(every)).alias("spans")).collect()
    return {r.i: (r.base, r.spans) for r in rows}


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    for i, (base, spans) in base_of(df).items():
        want = plain(texts[i])
        assert base == ",".join(want), repr(texts[i])
        assert set(want) <= set(spans.split(",")) | {""}


def test_given_documents(spark):
    check(spark, [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])


def test_random_texts(spark):
    draw = random.Random(5)
    parts = ["a", "B7", ".", "..", "@", "-", " ", "  ", "+1", "(", ")", "é", "日本", "1.2.3.4", "256.1.1.1", "\n", "007",
             "4111 1111 1111 1111", "4111111111111111", "378282246310005", "x@y.z", "+1 (743) 555-3824", "12", "_%"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 25))) for _ in range(1500)]
    check(spark, [*texts, None, "", "a@b.c..d@e.f", "a@b.c.", "1.2.3.4.5.6.7.8", "x@a.b@c.d"])


def test_long_runs(spark):
    """Runs that would make a careless pattern slow or exhaust the stack."""
    texts = [
        "a" * 60_000, "1" * 60_000, "1 " * 30_000, "a." * 20_000 + "@b" + ".c" * 20_000, "+1" + " (" * 20_000, "1." * 30_000,
        "x@y.zz " * 700,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").repartition(7)
    made, base, _ = P.find(df, P.Model(0.0, [], {}))
    got = {r.i: r.n for r in made.select("i", F.size(base).alias("n")).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 1, 4: 0, 5: 7500, 6: 700}
    check(spark, [t[: len(t) // 40] for t in texts[1:]])


def test_method_adds_keys(spark):
    """Key-like strings behind telling words are learned; long words and plain numbers are left alone."""
    draw = random.Random(3)
    key = lambda: "".join(draw.choice("0123456789abcdef") for _ in range(40))
    texts = [f'word here token = "{key()}" and more' for _ in range(60)]
    texts += [f"plain words with supercalifragilistic_words and in 1984 there were {i} of them" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    found = base_of(df)
    assert all(found[i][1].startswith("secret:") for i in range(60))
    assert all(found[i][1] == "" for i in range(60, 120))


def test_whole_runs(spark):
    """Keys and handles end where their run ends, however long, and wherever the first digit is."""
    draw = random.Random(4)
    key = lambda n: "".join(draw.choice("0123456789abcdef") for _ in range(n))
    late = "abcdefghij" * 5 + key(20) + "7"
    keys = [*(key(40) for _ in range(60)), *(key(300) for _ in range(30)), *[late] * 30]
    docs = spark.createDataFrame([(i, f"token = {k} end") for i, k in enumerate(keys)], "doc_id long, text string")
    assert {r.text for r in P.redact(docs).collect()} == {"token = [SECRET] end"}
    handles = ["a" * 100 + "@host", "joe@" + "b" * 100, "c" * 60_000 + "@" + "d" * 60_000]
    texts = [*(f"x {h} y" for h in handles), "a@b" * 20_000, "k" * 60_000, "_ab " * 20_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, text string").repartition(6)
    made = frame.select("i", P.matched(F.col("text"), P.HANDLE, "handle")["value"].alias("v")).collect()
    assert {r.i: r.v for r in made if r.i < 3} == {i: [h] for i, h in enumerate(handles)}


def test_planted_keys_without_keywords(spark):
    """Keys are found by what they look like: hexadecimal ones, base64 with its marks, UUIDs and hyphenated ones."""
    draw = random.Random(8)
    pick = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    lower, base64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    kinds = [
        lambda: pick(lower, 40), lambda: "/".join(pick(base64, 14) for _ in range(3)) + "==",
        lambda: "-".join(pick(lower, n) for n in (8, 4, 4, 4, 12)), lambda: f"sk-{pick(base64, 12)}-{pick(base64, 12)}",
    ]
    words = lambda n: " ".join(pick("etaoinshrdlu", draw.randrange(2, 9)) for _ in range(n))
    keyed = [f"{words(9)} {draw.choice(['api_key', 'token', 'secret'])} = {kinds[i % 4]()} {words(5)}" for i in range(400)]
    bare = [f"{words(9)} {kinds[i % 4]()} {words(5)}" for i in range(40)]
    clean = [
        draw.choice([f"{words(4)} {pick('aeinrst', 24)} {words(3)}", f"{words(3)} Jahres-Abschluss-Bericht-20{i % 90 + 10} {words(2)}",
                     f"{words(3)} {pick('123456789', 16)} {words(3)}", f"{words(2)} docs/part/chapter_{i % 9} {words(3)}"])
        for i in range(400)
    ]
    texts = [*keyed, *bare, *clean]
    got = base_of(spark.createDataFrame(list(enumerate(texts)), "i long, text string"))
    found = [any(x.startswith("secret") for x in got[i][1].split(",")) for i in range(len(texts))]
    recall = sum(found[400:440]) / 40
    precision = sum(found[:440]) / max(1, sum(found))
    assert recall >= 0.9 and precision >= 0.95
    whole = [got[i][1].split(":")[1:] for i in range(400, 440) if found[i]]
    assert all(texts[i][int(a) : int(b)] == texts[i].split(" ")[9] for (a, b), i in zip(whole, [i for i in range(400, 440) if found[i]]))


def test_method_adds_numbers_and_handles(spark):
    """National phone numbers, spaced account numbers and bare handles are found among many base spans, formats that
    stand behind personal words elsewhere too; ids, prices and dates aren't."""
    draw = random.Random(6)
    n = lambda k: "".join(draw.choice("123456789") for _ in range(k))
    some = [f"phone: (0{n(3)}) {n(6)} now" for _ in range(60)] + [f"account {n(4)} {n(4)} {n(2)} now" for _ in range(60)]
    some += [f"contact: joe{n(2)}@localhost now" for _ in range(30)] + [f"then (0{n(3)}) {n(6)} rang"]
    none = [f"order id {n(9)} now" for _ in range(60)] + [f"account total $ {n(3)} {n(3)} {n(3)} now" for _ in range(30)]
    none += [f"call 2024-05-{10 + i} now" for i in range(20)] + [f"hotel {n(9)} now" for _ in range(60)]
    base = [f"call +1 (743) 555-{n(4)} or a{i}@b.de" for i in range(300)]
    texts = [*some, *none, *base]
    found = base_of(spark.createDataFrame(list(enumerate(texts)), "i long, text string"))
    kinds = {i: [x.split(":")[0] for x in spans.split(",") if x] for i, (_, spans) in found.items()}
    assert [kinds[i] for i in range(len(some))] == [["number"]] * 120 + [["handle"]] * 30 + [["number"]]
    assert all(not kinds[i] for i in range(len(some), len(some) + len(none)))
    assert all(sorted(kinds[i]) == ["email", "phone"] for i in range(len(some) + len(none), len(texts)))


def test_redact(spark):
    text = "é mail a.b@c.de or call +1 (743) 555-3824, card 4111 1111 1111 1111!"
    rows = [(1, text, len(text), "x"), (2, None, 5, "x"), (3, "", 0, "x"), (4, "clean", 99, "x"), (4, "clean", 99, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, _base string")
    got = sorted(P.redact(docs).collect(), key=lambda r: r.doc_id)
    want = "é mail [EMAIL] or call [PHONE], card [CARD]!"
    assert [tuple(r) for r in got] == [(1, want, len(want), "x"), *rows[1:]]


def test_trees_as_expressions(spark):
    """The expression of a model scores cells as the trees do."""
    draw = np.random.default_rng(2)
    x = draw.integers(0, 6, (400, len(P.FEATURES)))
    x[:, 0] = draw.integers(4, 7, 400)
    positive = (x[:, 1] > 2).astype(float) * 5
    model = P.boost(x, positive, 5 - positive)
    rows = [tuple(map(int, r)) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{f} int" for f in P.FEATURES))
    got = [r.s for r in df.select(model.score(F.struct(*P.FEATURES)).alias("s")).collect()]
    want = model.offset + sum(P.apply(t, x) for t in model.trees)
    assert np.allclose(got, want) and len(model.thresholds) == 3
    assert ((want > 0) == (x[:, 1] > 2)).all()


def test_empty_table_and_digest(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.redact(docs).collect() == []
    empty = spark.createDataFrame([(1, None)], "i long, text string")
    made, base, _ = P.find(empty, P.fit(empty))
    got = made.select(F.sha2(P.joined(F.col(base)), 256).alias("h")).first().h
    assert got == hashlib.sha256(b"").hexdigest()


def test_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    made, _, _ = P.find(docs, P.Model(0.0, [], {}))
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
