"""Quality classifier: hierarchical empirical Bayes over documents, hosts and paths.

A logistic regression on rule statistics and word evidence gives each document the log odds that it is good, the
document's own evidence. Grouped sums of the probabilities give each host and each path of a host its rate of good
documents. A host's rate is shrunk towards the rate of all documents, a path's towards its host's, the more the fewer
documents there are: the strength of either prior is estimated from how the rates of all hosts, and of all paths about
their hosts, spread (method of moments). The path's rate without a document is the prior odds of that document, and evidence
and prior together decide. The cut is set on the posteriors of labelled documents that nothing was fitted on.

What is fitted is bounded: words' weights, the regression and the cut on at most LABELLED documents, those with the smallest
hash of doc_id, half for the words and a quarter each for the regression and the cut. Rates are sums over every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.llm.anomaly import threshold
from adsettle.llm.base import bytes_of, free_name, join_by_frequency, query, table, with_text_columns
from adsettle.llm.textstats import shares, stats
from adsettle.session import stage

LABELLED = 16_000
#: Words with weights, at most: those with the greatest. A word needs LEAST_DOCS documents.
WORDS = 20_000
LEAST_DOCS = 8
#: Share of the labelled good documents that the threshold may reject.
GOOD_LOST = 0.005
#: Bounds of the strength of a prior, in documents.
WEAKEST, STRONGEST = 2.0, 10_000.0

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
EDGES = b".,;:!?\"'()[]#*$%&|"


def words_of(text: bytes) -> set[bytes]:
    return {w.strip(EDGES) for w in text.translate(LOWER).split()}


def features(texts: list[bytes | None], weights: dict[bytes, float]) -> np.ndarray:
    """Rule statistics, and the least, the sum and the mean of the words' weights, negative ones speaking against."""
    counts, words = [], []
    get = weights.get
    for text in texts:
        text = text or b""
        counts.append(stats(text))
        own = [w for w in map(get, words_of(text)) if w is not None]
        words.append((min(own, default=0.0), sum(w for w in own if w < -1), sum(own) / max(1, len(own))))
    rules = shares(counts)
    n = np.log1p(np.array([c.n_words for c in counts], dtype=np.float64)).reshape(-1, 1)
    lines = np.array([c.n_dup_lines / max(1, c.n_words) for c in counts], dtype=np.float64).reshape(-1, 1)
    return np.column_stack([rules, n, np.minimum(n, np.log(50)), lines, np.array(words, dtype=np.float64).reshape(-1, 3)])


@dataclass
class Evidence:
    """A fitted document classifier."""

    words: dict[bytes, float]
    mean: np.ndarray
    scale: np.ndarray
    slope: np.ndarray
    offset: float

    def log_odds(self, texts: list[bytes | None]) -> np.ndarray:
        x = (features(texts, self.words) - self.mean) / self.scale
        return np.clip(x @ self.slope + self.offset, -30, 30)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Slopes and offset by Newton's method."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    penalty = ridge * len(x) * np.eye(len(w)) / 10
    penalty[-1, -1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1.T * (p * (1 - p) + 1e-9)) @ x1 + penalty, x1.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """(doc_id, text, good) of at most ``most`` labelled documents. Good: every quality label of it is 1 and none
    says toxic. Labels without quality or doc_id are left out."""
    chosen = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(((F.min("quality") >= 1) & (F.max(F.coalesce("toxic", F.lit(0))) < 1)).alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def word_weights(rows: DataFrame) -> dict[bytes, float]:
    """Log odds of good against bad per word, by the documents that hold it, shrunk by one document of either."""

    def run(batches):
        for batch in batches:
            words, good = [], []
            for text, flag in zip(bytes_of(batch.column(0)), batch.column(1).to_pylist()):
                own = words_of(text or b"")
                words += own
                good += [int(flag)] * len(own)
            yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.binary()), "good": pa.array(good, pa.int64())})

    sizes = {r.good: r["count"] for r in rows.groupBy("good").count().collect()}
    n_good, n_bad = sizes.get(True, 0), sizes.get(False, 0)
    held = (
        rows.select("text", "good").mapInArrow(run, "word binary, good long")
        .groupBy("word").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
        .filter(F.col("n") >= LEAST_DOCS)
    )
    prior = (n_good + 1) / (n_bad + 1)
    weight = F.log((F.col("good") + F.lit(prior)) / (F.col("n") - F.col("good") + F.lit(1.0)) / F.lit(prior))
    best = held.select("word", weight.alias("weight")).orderBy(F.desc(F.abs("weight")), "word").limit(WORDS)
    return {bytes(r.word): r.weight for r in best.collect()}


@dataclass
class Fitted:
    """A classifier (None if either kind of label is missing), the share of good documents it was fitted on, and the
    labelled documents kept for the cut: (doc_id, good), at most a quarter of LABELLED or so."""

    model: Evidence | None
    base: float
    kept: DataFrame


def fit(docs: DataFrame, labels: DataFrame) -> Fitted:
    rows = stage(labelled_rows(docs, labels), "labelled")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4))
    kept = rows.filter(part == 3).select("doc_id", "good")
    words = word_weights(rows.filter(part < 2))
    names = [f"x{i}" for i in range(11)]

    def made(texts: list[bytes | None]) -> dict[str, pa.Array]:
        x = features(texts, words)
        return {n: pa.array(np.ascontiguousarray(x[:, i])) for i, n in enumerate(names)}

    # without their text, the rows are LABELLED / 4 times a dozen numbers
    table_ = with_text_columns(rows.filter(part == 2), "text", ", ".join(f"{n} double" for n in names), made)
    got = table_.drop("text").orderBy("doc_id").toPandas()
    y = got["good"].to_numpy(dtype=bool)
    if not len(y) or y.all() or not y.any():
        return Fitted(None, 0.5, kept)
    x = got[names].to_numpy(dtype=np.float64)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    slope, offset = logistic((x - mean) / scale, y.astype(np.float64))
    return Fitted(Evidence(words, mean, scale, slope, offset), float(np.clip(y.mean(), 1e-6, 1 - 1e-6)), kept)


def strength(groups: DataFrame, n: str, good: str, mean: Column) -> Column:
    """Strength in documents of the prior that groups' rates were drawn from, by moments: how much the rates spread
    about ``mean`` beyond what their sizes explain. A one-row aggregate, as a column of ``groups.agg``."""
    rate = F.col(good) / F.col(n)
    binomial = mean * (1 - mean)
    # E[n (rate - mean)^2] = binomial * (1 + (n - 1) / (strength + 1))
    excess = F.sum(F.col(n) * F.pow(rate - mean, 2) - binomial)
    weight = F.sum((F.col(n) - 1) * binomial)
    share = excess / weight
    found = F.when(share > 0, 1 / share - 1).otherwise(F.lit(STRONGEST))
    return F.least(F.greatest(F.coalesce(found, F.lit(STRONGEST)), F.lit(WEAKEST)), F.lit(STRONGEST))


def path_rates(scored: DataFrame, host: str, path: str, probability: str) -> DataFrame:
    """host, path, n and rate of every path: its posterior rate of good documents; and what the rate without one of its
    documents is made from, see ``rate_without``. Nulls are a host or path too."""
    paths = scored.groupBy(F.col(host).alias("host"), F.col(path).alias("path")).agg(
        F.count("*").cast("double").alias("n"), F.sum(probability).alias("good")
    )
    paths = stage(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    whole = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_good").alias("good")).first()
    if not whole.n:
        none = [F.lit(0.5).alias(c) for c in ("rate", *PARTS)]
        return paths.select("host", "path", "n", *none)
    base = min(max(whole.good / whole.n, 1e-6), 1 - 1e-6)
    of_hosts = hosts.agg(strength(hosts, "host_n", "host_good", F.lit(base)).alias("s")).first().s
    host_rate = (F.col("host_good") + of_hosts * base) / (F.col("host_n") + of_hosts)
    rated = hosts.select(F.col("host").alias("of_host"), "host_n", "host_good", host_rate.alias("host_rate"))
    joined = paths.join(rated, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host")
    of_paths = joined.agg(strength(joined, "n", "good", F.col("host_rate")).alias("s")).first().s
    rate = (F.col("good") + of_paths * F.col("host_rate")) / (F.col("n") + of_paths)
    whole_ = [F.lit(x).alias(c) for x, c in ((base, "base"), (of_hosts, "of_hosts"), (of_paths, "of_paths"))]
    return joined.select("host", "path", "n", rate.alias("rate"), "good", "host_n", "host_good", *whole_)


#: What a path's rate is made from, besides its number of documents.
PARTS = ("good", "host_n", "host_good", "base", "of_hosts", "of_paths")


def rate_without(parts: Column, probability: Column) -> Column:
    """The rate of a path without one of its documents, which has this probability; ``parts``: n and PARTS."""
    host = (parts["host_good"] - probability + parts["of_hosts"] * parts["base"]) / (parts["host_n"] - 1 + parts["of_hosts"])
    rate = (parts["good"] - probability + parts["of_paths"] * host) / (parts["n"] - 1 + parts["of_paths"])
    return F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))


@dataclass
class Names:
    """Free names for the columns that classification adds."""

    evidence: str
    probability: str
    host: str
    path: str
    rate: str
    good: str
    kept: str

    @staticmethod
    def free(docs: DataFrame) -> Names:
        return Names(*[free_name(docs, f"_quality_{f}") for f in Names.__dataclass_fields__])


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> tuple[DataFrame, Names]:
    """``docs`` with log odds of the text, rate of the path, posterior probability and verdict, and their names.

    A document is kept if its posterior probability is at least the threshold, which is set on the posteriors of labelled
    documents that weren't fitted on and loses at most GOOD_LOST of the good ones among them.
    Null and empty texts are classified like any text without words. Without good and bad labels the evidence is 0 and
    everything is kept. Repeated rows are classified alike, and each counts in its path's rate.
    """
    names = Names.free(docs)
    fitted = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(fitted.model)

    def rows(texts: list[bytes | None]) -> dict[str, pa.Array]:
        own = shared.value
        values = own.log_odds(texts) if own else np.zeros(len(texts))
        return {names.evidence: pa.array(values), names.probability: pa.array(1 / (1 + np.exp(-values)))}

    placed = docs.withColumns({names.host: host, names.path: path})
    scored = with_text_columns(
        placed, "text", f"`{names.evidence}` double, `{names.probability}` double", rows
    )
    scored = stage(scored, "scored")
    rates = path_rates(scored, names.host, names.path, names.probability)
    total = scored.count()
    parts = free_name(docs, "_quality_parts")
    keyed = rates.select(
        F.struct("host", "path").alias("place"), F.col("n").alias("rows"), F.col("rate").alias(names.rate),
        F.struct("n", *PARTS).alias(parts),
    )
    both = join_by_frequency(
        scored, keyed, F.struct(F.col(names.host).alias("host"), F.col(names.path).alias("path")), "place", "rows", total,
        F.col(names.evidence),
    ).drop("rows")
    # The classifier's own base rate leaves the evidence and the path's rate takes its place.
    own = rate_without(F.col(parts), F.col(names.probability))
    prior = F.log(own / (1 - own)) - F.lit(float(np.log(fitted.base / (1 - fitted.base))))
    posterior = F.col(names.evidence) + prior
    told = fitted.kept.withColumnRenamed("doc_id", "_of").withColumnRenamed("good", "_good")
    known = both.join(F.broadcast(told), F.col("doc_id") == F.col("_of")).select(posterior.alias("odds"), "_good")
    # as many rows as labelled documents are kept for it, or as copies of them
    rows_ = known.orderBy("odds").toPandas() if fitted.model else None
    good = rows_["_good"].to_numpy(dtype=bool) if rows_ is not None else np.zeros(0, dtype=bool)
    cut = -threshold(-rows_["odds"].to_numpy(dtype=np.float64), good, GOOD_LOST) if good.any() else float("-inf")
    out = both.withColumn(names.good, 1 / (1 + F.exp(-posterior))).withColumn(
        names.kept, F.lit(fitted.model is None) | (posterior >= F.lit(cut))
    )
    return out.drop(parts), names


def by_source(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Names]:
    """Documents carry no address: their source is the host, and the language within it the path."""
    return classify(docs, labels, F.col("source").cast("string"), F.col("lang").cast("string"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``."""
    found, names = by_source(docs, labels)
    return found.filter(names.kept).select(*[F.col(f"`{c}`") for c in docs.columns])


@query()
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence, path rate, posterior and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found, names = by_source(docs, table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", F.col(names.evidence).alias("evidence"), F.col(names.rate).alias("path_rate"),
        F.col(names.good).alias("probability"), F.col(names.kept).alias("kept"),
    )
