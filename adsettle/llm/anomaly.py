"""Quality rules and an isolation forest on their statistics.

Trees of random splits are grown on rule statistics of labelled documents that pass the base rules, bad ones being a
small share of them. A text that few splits suffice to set apart has a short mean path and a high anomaly score. The
threshold is set on labelled rows.

Each tree's cuts are drawn on SAMPLE rows, as the method has it, and only these rows come to the driver, TREES * SAMPLE at
most. What the trees say comes from every labelled row: all good ones are counted in the leaves they fall into, which makes
the path lengths, and the threshold is found among the scores of all, exactly. Statistics and verdicts cover every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adsettle.llm.base import query, table, with_text_columns
from adsettle.llm.textstats import Stats, shares, stats
from adsettle.session import stage

TREES = 100
SAMPLE = 256
#: Labelled rows that cuts are drawn on, at most.
DRAWN = TREES * SAMPLE
#: Parts in which scores are put in order.
BINS = 1 << 14
#: Share of the labelled good rows that the threshold may reject.
GOOD_LOST = 0.005
#: Bad rows among those the trees grow on, as a share of the good ones, at most. Without any, the splits wouldn't
#: reach beyond good values; were they many, they would no longer be rare.
BAD_SHARE = 0.02
SEED = 7


def mean_path(n):
    """Mean path length of an unsuccessful search among n rows, by which scores are scaled."""
    n = np.asarray(n, dtype=np.float64)
    big = np.maximum(n, 2)
    return np.where(
        n > 2, 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big, np.where(n == 2, 1.0, 0.0)
    )


@dataclass
class Forest:
    """Trees as complete binary heaps: ``feature`` is -1 at leaves, whose path length is in ``length``."""

    feature: np.ndarray
    cut: np.ndarray
    length: np.ndarray
    scale: float

    @staticmethod
    def grow(rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Forest:
        """Trees over the rows of a feature matrix. Columns without spread in a node are not split."""
        draw = np.random.default_rng(seed)
        used = min(sample, len(rows))
        depth = max(1, int(np.ceil(np.log2(max(used, 2)))))
        size = 2 ** (depth + 1) - 1
        feature = np.full((trees, size), -1, dtype=np.int32)
        cut = np.zeros((trees, size))
        length = np.zeros((trees, size))
        for t in range(trees):
            open_nodes = [(0, 0, rows[draw.choice(len(rows), used, replace=False)])]
            while open_nodes:
                node, level, own = open_nodes.pop()
                low, high = own.min(axis=0), own.max(axis=0)
                spread = np.flatnonzero(high > low)
                if level == depth or not len(spread):
                    length[t, node] = level + mean_path(len(own))
                    continue
                f = int(draw.choice(spread))
                at = draw.uniform(low[f], high[f])
                left = own[:, f] <= at
                feature[t, node], cut[t, node] = f, at
                open_nodes += [
                    (2 * node + 1, level + 1, own[left]),
                    (2 * node + 2, level + 1, own[~left]),
                ]
        return Forest(feature, cut, length, float(mean_path(used)) or 1.0)

    def leaves(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """Of each tree, the leaf that each row of a feature matrix falls into."""
        each = np.arange(len(rows))
        for feature, cut in zip(self.feature, self.cut):
            node = np.zeros(len(rows), dtype=np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = rows[each, np.maximum(f, 0)] > cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            yield node

    def counts(self, rows: np.ndarray) -> np.ndarray:
        """How many rows of a feature matrix fall into each leaf, by tree and node."""
        return np.array([np.bincount(node, minlength=self.length.shape[1]) for node in self.leaves(rows)])

    def weighed(self, counts: np.ndarray, used: int) -> Forest:
        """The same cuts with path lengths by the rows counted in each leaf, on the scale of ``used`` rows."""
        level = np.floor(np.log2(np.arange(self.length.shape[1]) + 1))
        share = np.rint(counts * (used / counts.sum(axis=1, keepdims=True)))
        return Forest(self.feature, self.cut, level + mean_path(share), float(mean_path(used)) or 1.0)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly from 0 to 1 of each row of a feature matrix."""
        total = np.zeros(len(rows))
        for length, node in zip(self.length, self.leaves(rows)):
            total += length[node]
        return 2.0 ** (-total / len(self.feature) / self.scale)


@dataclass
class Verdict:
    """A fitted forest and the greatest score that is kept."""

    forest: Forest | None
    most: float


def threshold(scores: np.ndarray, good: np.ndarray, lost: float = GOOD_LOST) -> float:
    """The cut with the greatest share of bad rows above it, less that of good rows, among those that lose at most
    ``lost`` of the good rows."""
    if not good.any():
        return float("inf")
    least = np.quantile(scores[good], 1 - lost, method="higher")
    if good.all():
        return float(least)
    cuts = np.unique(scores[scores >= least])
    caught = 1 - np.searchsorted(np.sort(scores[~good]), cuts, side="right") / (~good).sum()
    wrong = 1 - np.searchsorted(np.sort(scores[good]), cuts, side="right") / good.sum()
    return float(cuts[np.argmax(caught - wrong)])


def table_threshold(scores: DataFrame, lost: float = GOOD_LOST) -> float:
    """``threshold`` of the rows (anomaly_score, good) of a table, exactly.

    Scores are counted within bins, from the rows of the bins below on, so that no task sorts them all.
    """
    each = scores.groupBy("anomaly_score").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    each = stage(each.withColumn("bin", F.floor(F.col("anomaly_score") * BINS)), "scores")
    bins = each.groupBy("bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("bin").collect()
    goods, bads = sum(b["good"] for b in bins), sum(b["bad"] for b in bins)
    if not goods:
        return float("inf")
    below, rows = [0, 0], []
    for b in bins:
        rows.append((b["bin"], *below))
        below = [below[0] + b["good"], below[1] + b["bad"]]
    before = scores.sparkSession.createDataFrame(rows, "bin long, good_before long, bad_before long")
    up_to = Window.partitionBy("bin").orderBy("anomaly_score").rowsBetween(Window.unboundedPreceding, 0)
    so_far = each.join(F.broadcast(before), "bin").select(
        "anomaly_score",
        (F.col("good_before") + F.sum("good").over(up_to)).alias("good"),
        (F.col("bad_before") + F.sum("bad").over(up_to)).alias("bad"),
    )
    cuts = so_far.filter(F.col("good") >= int(np.ceil((goods - 1) * (1 - lost))) + 1)
    if not bads:
        return cuts.agg(F.min("anomaly_score")).first()[0]
    gain = (1 - F.col("bad") / bads) - (1 - F.col("good") / goods)
    return cuts.agg(F.min_by("anomaly_score", F.struct(-gain, "anomaly_score"))).first()[0]


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every row's whole text. Null and empty texts count 0 everywhere."""

    def rows(texts: list[bytes | None]) -> dict[str, pa.Array]:
        counts = np.array([stats(t or b"") for t in texts], dtype=np.int64).reshape(-1, len(Stats._fields))
        return {f: pa.array(counts[:, i]) for i, f in enumerate(Stats._fields)}

    added = ", ".join(f"{f} long" for f in Stats._fields)
    return with_text_columns(docs.select("doc_id", "text"), "text", added, rows).drop("text")


def labelled_rows(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of every labelled document: good if every quality label of it is 1. Null labels and ids are left
    out."""
    return (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.min("quality") >= 1).alias("good"))
    )


def drawn(rows: DataFrame, most: int) -> np.ndarray:
    """Features of the ``most`` rows with the smallest hash."""
    names = list(Stats._fields)
    # only the first parts of the hashes' range are put in order, so that tasks don't all send as many as are drawn
    part, first = F.shiftright(F.xxhash64("doc_id"), 52), 0
    counts = sorted(map(tuple, rows.groupBy(part.alias("part")).count().collect()))
    for last, n in counts:
        first += n
        if first >= most:
            rows = rows.filter(part <= last)
            break
    found = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select(*names).toPandas()
    return shares(found.to_numpy())


def leaf_counts(rows: DataFrame, forest: Forest) -> np.ndarray:
    """How many of all rows fall into each leaf, by tree and node: a small table for each task, added up."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        total = np.zeros(shared.value.length.shape, dtype=np.int64)
        for batch in batches:
            total += shared.value.counts(features_of(batch))
        tree, node = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"tree": tree, "node": node, "n": total[tree, node]})

    found = rows.select(*Stats._fields).mapInArrow(run, "tree long, node long, n long")
    out = np.zeros(forest.length.shape)
    for row in found.groupBy("tree", "node").agg(F.sum("n").alias("n")).collect():
        out[row["tree"], row["node"]] = row["n"]
    return out


def fit(counted: DataFrame, labels: DataFrame) -> Verdict:
    """Forest and threshold from all labelled rows of ``rule_statistics`` that pass the base rules. Without good ones there
    is no forest, and nothing is an anomaly."""
    rows = stage(
        counted.join(labelled_rows(labels), "doc_id")
        .groupBy("doc_id", "good")
        .agg(*[F.max(f).alias(f) for f in Stats._fields])  # a repeated doc_id counts once
        .filter("NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"),
        "labelled-statistics",
    )
    number = rows.agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).first()
    if not number["good"]:
        return Verdict(None, float("inf"))
    some = min(number["bad"], int(BAD_SHARE * number["good"]))
    # of more rows than are drawn, good and bad ones by their shares
    good = min(number["good"], round(DRAWN * number["good"] / (number["good"] + some)))
    matrix = drawn(rows.filter("good"), good)
    if some:
        matrix = np.vstack([matrix, drawn(rows.filter("NOT good"), min(some, max(1, DRAWN - good)))])
    forest = Forest.grow(matrix)
    forest = forest.weighed(leaf_counts(rows.filter("good"), forest), min(SAMPLE, len(matrix)))
    return Verdict(forest, table_threshold(scored(rows, forest)))


def features_of(batch: pa.RecordBatch) -> np.ndarray:
    return shares(np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in Stats._fields]))


def scored(rows: DataFrame, forest: Forest | None) -> DataFrame:
    """``rows`` of statistics with their anomaly_score, 0 without a forest."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)
    names = rows.columns

    def run(batches):
        for batch in batches:
            score = np.zeros(batch.num_rows) if shared.value is None else shared.value.score(features_of(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*names, "anomaly_score"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, anomaly_score double")


def judge(counted: DataFrame, verdict: Verdict) -> DataFrame:
    """``rule_statistics`` with anomaly_score, base_failed and kept.

    base_failed: under 50 words, or over half the words in repeated windows. kept: neither that nor an anomaly.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        scored(counted, verdict.forest)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly_score") <= F.lit(verdict.most)))
    )


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rule statistics and verdict of every row.

    Statistics are made once and staged, as fitting and judging both read them; they hold no text. Null and empty
    texts have no words and fail the base rules. Repeated rows and rows without doc_id get results of their own.
    Columns other than doc_id and text are not looked at.
    """
    counted = stage(rule_statistics(docs), "rule-statistics")
    return judge(counted, fit(counted, labels))


@query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and isolation forest over all documents."""
    rows = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "anomaly_score",
    )
