"""Personal data: candidate spans, boosted trees and calibrated thresholds, in Spark's own expressions only.

Base rules find e-mail addresses, IP addresses, card and phone numbers; what they find is always taken. Generators of
high recall propose further spans, which may overlap: addresses of any form, digit groups, key-like strings. Trees
boosted on format and context features score these; those that reach their generator's threshold are taken too.

The trees learn from the corpus itself, by two views that have nothing in common. The label is what the words before a
candidate say: a key-like string is a positive example behind words like "token =", a digit group or address behind words
like "phone" or "account", unless words for ids or prices follow these or it is a date; all others are negative. The features
are the candidate's own format and the characters next to it. So the trees tell which formats stand behind such words, and find
these where no word does. What a base rule has takes no part. Features are small integers, so all candidates
of the corpus are counted by feature values in one grouped aggregation, and boosting on these counts is boosting on
every candidate of four fifths of the texts, by a hash of the text. On the other fifth a threshold is set for each generator.
Not every key stands behind such a word, so labels tell some positives only: how many of them, the surest formats show, those
whose candidates have the greatest share of positive labels. The threshold is the least score from which the share of
positive labels is PRECISION of that greatest share. A generator whose greatest share is below LABELLED adds nothing.

Patterns are written so that the matcher neither recurses nor looks back more than a few characters: a text of one very
long run takes linear time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.llm.base import free_name, query, table

PRECISION = 0.95
LABELLED = 0.5
#: Share of a generator's positive labels that the surest formats have to hold.
SUREST = 0.5
TREES = 24
DEPTH = 3
RATE = 0.3

LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# An address begins where its run of characters begins, or where the match before it ended; its last label ends before
# two dots, or before a dot that no label follows.
EMAIL = (
    rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++\.{LABEL}[A-Za-z0-9.-]*?(?=\.\.|\.?(?![A-Za-z0-9.-]))"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# A whole run of digits with single separators; shorter runs than 14 digits are passed over at once.
CARD = r"(?<![0-9])(?<![0-9][ -])(?=[0-9](?:[ -]?[0-9]){13})[0-9][0-9 -]*?(?<=[0-9])(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

# Whole runs, whatever their length. A number ends at the last digit before anything but digits and their separators.
HANDLE = r"(?<![^\s@])[^\s@]++@[^\s@]{3,}+"
NUMBER = r"(?<![0-9.,+])[+(]?(?=[0-9][0-9 ().-]{5})[0-9][0-9 ().-]*?(?<=[0-9])(?![ ().-]*+[0-9])"
SECRET = r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}+={0,2}"

BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

BASE = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
GENERATORS = {"handle": HANDLE, "number": NUMBER, "secret": SECRET}
RANK = {kind: i for i, kind in enumerate([*BASE, *GENERATORS])}

KEYWORD = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|access[_ -]?key|private[_ -]?key|bearer)[\"' ]{0,2}[=: ]{1,3}[\"']?$"
# A word of its own for whom or whose account a number is, and what tells ids, prices and dates from these.
OWNER = (
    r"(?i)(?<![a-z])(?:(?:tele|cell)?phone|tel|call|fax|mobile|card|visa|account|iban|e?mail|contact|ssn|passport)(?![a-z])"
    r"[^\n]{0,12}$"
)
OTHER = r"(?i)(?:(?<![a-z])(?:id|order|invoice|ticket|item|sku|isbn|version|price|cost|total|amount|usd|eur)(?![a-z])|[$€£])[^\n]{0,12}$"
DATE = r"^(?:[0-9]{4}[ .-][0-9]{1,2}[ .-][0-9]{1,2}|[0-9]{1,2}[ .-][0-9]{1,2}[ .-][0-9]{4})(?![0-9])"
CONTEXT = 24


SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string,before:string,after:string>"
#: Spans that are summed up one by one; runs of as many are then joined, as an array grows by copying it.
RUN = 64


def matched(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches as an array of SPAN, with places in code points and a little of the text
    around.

    Matches and the text between them, which the same pattern yields, give the places by running sums."""
    between, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(
        between.alias("between"), values.alias("value"), F.slice(between, 2, F.size(between)).alias("next")
    )
    none = F.array().cast(f"array<{SPAN}>")

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["between"])
        end = start + F.length(x["value"])
        span = F.struct(
            start.alias("start"), F.lit(RANK[kind]).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
            x["value"].alias("value"), F.right(x["between"], F.lit(CONTEXT)).alias("before"),
            F.left(x["next"], F.lit(1)).alias("after"),
        )
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    def summed(pairs: Column) -> Column:
        begun = F.array().cast(f"array<struct<at:int,spans:array<{SPAN}>>>")

        def run(done: Column, i: Column) -> Column:
            at = F.coalesce(F.get(done, F.size(done) - 1)["at"], F.lit(0))
            first = F.struct(at.alias("at"), none.alias("spans"))
            return F.concat(done, F.array(F.aggregate(F.slice(pairs, i * RUN + 1, RUN), first, step)))

        runs = F.sequence(F.lit(0), F.floor(F.size(pairs) / RUN).cast("int"))
        return F.flatten(F.transform(F.aggregate(runs, begun, run), lambda r: r["spans"]))

    # as a lambda's variable, the array is made once and not once per run
    once = F.transform(F.array(F.filter(zipped, lambda x: x["value"].isNotNull())), summed)
    return F.when(F.regexp_like(text, F.lit(pattern)), F.get(once, F.lit(0))).otherwise(none)


def luhn(digits: Column) -> Column:
    """Whether the digits' check sum holds."""
    backwards = F.split(F.reverse(digits), "")

    def weighed(digit: Column, i: Column) -> Column:
        value = digit.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(value > 9, value - 9).otherwise(value)

    total = F.aggregate(F.transform(backwards, weighed), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


RULES: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.regexp_like(v, F.lit(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")),
    "card": lambda v: F.length(digits_of(v)).between(14, 19) & luhn(digits_of(v)),
    "phone": lambda v: F.length(digits_of(v)).between(10, 15),
}

#: What a generator's match has to be as well; others need nothing.
PROPOSED: dict[str, Callable[[Column], Column]] = {
    "secret": lambda v: F.regexp_like(v, F.lit("[0-9]")) | F.regexp_like(v, F.lit("[a-z][A-Z].*[a-z][A-Z]")),
    "number": lambda v: F.length(v) >= 7,
}

#: Features of a candidate, all small integers. Their values multiply to fewer than 200,000.
FEATURES = ["rank", "digits", "size", "marks", "left", "right", "letters", "cut"]
#: One in so many texts, by hash, isn't learned from; thresholds are set there.
HELD_OUT = 5


def char_class(char: Column) -> Column:
    return (
        F.when(char.isin("", " ", "\n", "\t"), 0).when(char.isin('"', "'", "`"), 1)
        .when(char.isin("+", "=", ":", "("), 2).otherwise(3)
    )


def base_like(span: Column) -> Column:
    """Whether a candidate of the handle or number generator is what a base rule takes."""
    value, digits = span["value"], digits_of(span["value"])
    n = F.length(digits)
    phone = F.regexp_like(value, F.lit(r"^\+[0-9]")) & n.between(10, 15)
    card = F.regexp_like(value, F.lit("^[0-9]")) & n.between(14, 19) & luhn(digits)
    handle = F.regexp_like(value, F.lit(rf"{LOCAL}@{LABEL}+\.{LABEL}"))
    return F.when(span["kind"] == "handle", handle).when(span["kind"] == "number", phone | card).otherwise(False)


def described(span: Column) -> Column:
    """A candidate's features, whether a base rule has it, and its weak label."""
    value, size = span["value"], span["end"] - span["start"]
    digits = F.length(digits_of(value))
    marks = F.length(F.regexp_replace(value, "[A-Za-z0-9]", ""))
    letters = (
        F.when(~F.regexp_like(value, F.lit("[A-Za-z]")), 0)
        .when(F.regexp_like(value, F.lit("^[0-9a-f]*$|^[0-9A-F]*$")), 1)
        .when(F.regexp_like(value, F.lit("[a-z]")) & F.regexp_like(value, F.lit("[A-Z]")), 2)
        .otherwise(3)
    )
    keyed = F.regexp_like(span["before"], F.lit(KEYWORD))
    # letters and digits by turns, as in keys; words with a number behind them change once
    turns = F.length(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "0"), "[^0]", ""))
    owned = (
        F.regexp_like(span["before"], F.lit(OWNER)) & ~F.regexp_like(span["before"], F.lit(OTHER))
        & ~F.regexp_like(value, F.lit(DATE))
    )
    base = base_like(span)
    return F.struct(
        span["start"].alias("start"), span["rank"].alias("rank"), span["end"].alias("end"), span["kind"].alias("kind"),
        (F.least(digits, F.lit(21)) / 2).cast("int").alias("digits"),
        (F.least(size, F.lit(55)) / 8).cast("int").alias("size"),
        F.least(marks, F.lit(3)).alias("marks"),
        char_class(F.right(span["before"], F.lit(1))).alias("left"),
        char_class(span["after"]).alias("right"),
        letters.alias("letters"),
        F.least(turns, F.lit(4)).alias("cut"),
        base.alias("base"),
        F.when(span["kind"] == "secret", keyed).otherwise(owned & ~base).alias("positive"),
    )


@dataclass
class Columns:
    base: str
    candidates: str


def with_candidates(docs: DataFrame, text: str = "text") -> tuple[DataFrame, Columns]:
    """``docs`` with base spans in order of start and kind, and all candidates with their features and label."""
    names = Columns(free_name(docs, "_base"), free_name(docs, "_candidates"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    made = docs
    raw = {kind: free_name(docs, f"_raw_{kind}") for kind in RANK}
    made = made.withColumns(
        {raw[k]: matched(body, p, k) for k, p in {**BASE, **GENERATORS}.items()}
    )
    kept = [F.filter(raw[k], (lambda rule: lambda s: rule(s["value"]))(RULES[k])) for k in BASE]
    made = made.withColumn(names.base, F.array_sort(F.concat(*kept)))

    fitting = {k: F.filter(raw[k], (lambda rule: lambda s: rule(s["value"]))(rule)) for k, rule in PROPOSED.items()}
    proposed = F.array_sort(F.concat(*[fitting.get(k, F.col(raw[k])) for k in GENERATORS]))
    made = made.withColumn(names.candidates, F.transform(proposed, described))
    return made.drop(*raw.values()), names


@dataclass
class Node:
    """A split (feature <= cut goes left) or, without feature, a leaf."""

    value: float = 0.0
    feature: int = -1
    cut: int = 0
    left: Node | None = None
    right: Node | None = None


@dataclass
class Model:
    offset: float
    trees: list[Node]
    thresholds: dict[str, float]

    def score(self, candidate: Column) -> Column:
        """Log odds that a candidate is personal data, as an expression."""
        total = F.lit(self.offset)
        for tree in self.trees:
            total = total + as_column(tree, candidate)
        return total

    def accepts(self, candidate: Column) -> Column:
        least = F.lit(float("inf"))
        for kind, threshold in self.thresholds.items():
            least = F.when(candidate["kind"] == kind, F.lit(threshold)).otherwise(least)
        return self.score(candidate) >= least


def as_column(node: Node, candidate: Column) -> Column:
    if node.feature < 0:
        return F.lit(node.value)
    below = candidate[FEATURES[node.feature]] <= F.lit(node.cut)
    return F.when(below, as_column(node.left, candidate)).otherwise(as_column(node.right, candidate))


def grow(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, depth: int, ridge: float = 1.0) -> Node:
    """A tree of second-order splits over cells of equal features."""
    g, h = gradient.sum(), hessian.sum()
    best, choice = 1e-6, None
    if depth:
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                low = x[:, f] <= cut
                gl, hl = gradient[low].sum(), hessian[low].sum()
                gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                if gain > best:
                    best, choice = gain, (f, int(cut), low)
    if choice is None:
        return Node(value=float(RATE * g / (h + ridge)))
    f, cut, low = choice
    return Node(
        feature=f, cut=cut,
        left=grow(x[low], gradient[low], hessian[low], depth - 1, ridge),
        right=grow(x[~low], gradient[~low], hessian[~low], depth - 1, ridge),
    )


def apply(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.value)
    low = x[:, node.feature] <= node.cut
    out = np.empty(len(x))
    out[low], out[~low] = apply(node.left, x[low]), apply(node.right, x[~low])
    return out


def boost(
    x: np.ndarray, positive: np.ndarray, negative: np.ndarray, held_out: tuple[np.ndarray, np.ndarray] | None = None
) -> Model:
    """Trees from counts of positive and negative candidates by cell, and thresholds from such counts of texts held out."""
    if not len(x) or not positive.sum():
        return Model(0.0, [], {})
    held_positive, held_negative = held_out or (positive, negative)
    held = held_positive + held_negative
    n = positive + negative
    offset = float(np.log((positive.sum() + 1) / (negative.sum() + 1)))
    score = np.full(len(x), offset)
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        tree = grow(x, positive - n * p, n * p * (1 - p), DEPTH)
        trees.append(tree)
        score = score + apply(tree, x)
    thresholds = {}
    for kind in GENERATORS:
        own = x[:, 0] == RANK[kind]
        order = np.argsort(-score[own], kind="stable")
        values, hits, all_ = score[own][order], np.cumsum(held_positive[own][order]), np.cumsum(held[own][order])
        if not len(values) or not hits[-1]:
            continue
        last = np.append(values[1:] != values[:-1], True)  # candidates of equal score stand or fall together
        shares = hits / np.maximum(all_, 1)
        surest = shares[last & (hits >= SUREST * hits[-1]) & (hits > 0)].max()
        good = last & (hits > 0) & (shares >= PRECISION * surest) & (surest >= LABELLED)
        if good.any():
            # a margin keeps equal sums that were added in another order on the same side
            thresholds[kind] = float(values[np.flatnonzero(good)[-1]]) - 1e-6
    return Model(offset, trees, thresholds)


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Boosted on every candidate of the corpus that no base rule has, by counts per cell of features."""
    made, names = with_candidates(docs.select(F.col(f"`{text}`").alias("text")))
    held = F.pmod(F.xxhash64("text"), F.lit(HELD_OUT)) == 0
    own = lambda test: F.count_if(test).cast("double")
    cells = (
        made.select(held.alias("held"), F.explode(F.filter(names.candidates, lambda c: ~c["base"])).alias("c"))
        .groupBy(*[F.col(f"c.{f}").alias(f) for f in FEATURES])
        .agg(
            own(F.col("c.positive") & ~F.col("held")).alias("positive"), own(~F.col("c.positive") & ~F.col("held")).alias("negative"),
            own(F.col("c.positive") & F.col("held")).alias("held_positive"), own(~F.col("c.positive") & F.col("held")).alias("held_negative"),
        )
        .orderBy(*FEATURES)
        .collect()  # one row per cell
    )
    x = np.array([[r[f] for f in FEATURES] for r in cells], dtype=np.int64).reshape(-1, len(FEATURES))
    counts = [np.array([r[c] for r in cells]) for c in ("positive", "negative", "held_positive", "held_negative")]
    return boost(x, counts[0], counts[1], (counts[2], counts[3]))


def find(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str, str]:
    """``docs`` with base spans and with all spans, and the names of these columns. Spans are structs of start, rank,
    end and kind, by start and then kind. Of the candidates that no base rule has, those are taken that the model accepts."""
    made, names = with_candidates(docs, text)
    short = lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])
    base = F.transform(names.base, short)
    taken = F.filter(names.candidates, lambda c: ~c["base"] & model.accepts(c))
    every = free_name(made, "_spans")
    made = made.withColumn(every, F.array_sort(F.concat(base, F.transform(taken, short))))
    return made.withColumn(names.base, base).drop(names.candidates), names.base, every


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by the first one's kind in brackets."""

    def step(done: Column, s: Column) -> Column:
        added = F.concat(
            done["text"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")
        )
        fresh = s["start"] >= done["at"]
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"), F.when(fresh, added).otherwise(done["text"]).alias("text")
        )

    begun = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    rest = lambda done: F.concat(done["text"], F.substring(text, done["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, begun, step, rest)).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_chars``, if there is one, counted anew where the text
    changed. A null text stays null; rows and columns stay what they were."""
    columns = docs.columns
    made, _, every = find(docs, fit(docs))
    changed = F.size(every) > 0
    made = made.withColumn("text", redacted(F.col("text"), F.col(every)))
    if "n_chars" in columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        made = made.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return made.select(*[F.col(f"`{c}`") for c in columns])


@query()
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document. Null and empty texts have none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made, base, every = find(docs, fit(docs))
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return made.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(joined(F.col(base)), 256).alias("base_sha256"),
        joined(F.col(every)).alias("spans"),
    )
