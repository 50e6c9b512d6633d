"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of consecutive words with smallest period q and a length of at least EXPONENT periods and LEAST
words that no neighbouring word extends. All runs of a text are found, exactly, in n log^2 n steps:

* Small periods, below 12, are sought one by one: those are the stretches in which every word equals the one q before.
* Larger ones are sought at dyadic scales t = 8, 16, ... A scale serves the periods q with 1.5 t <= q < 3 t. Of each
  position, the hash of the t words from there is taken. A position i is selected if the least hash among i to i + t
  is at i or at i + t. That depends on the 2 t words from i alone, so equal contexts are selected or left out alike.
* Highly periodic regions, stretches of at least t words with a period of at most t / 3, take no part in the minimum;
  otherwise they would select a position at every period. Lower scales have found them already, and their periods come
  from there.
* A run of period q >= 1.5 t has at least t positions i for which i + q + 2 t lies in it. Unless the run is a highly
  periodic region, one of them is selected, and so is i + q, with the same context. So pairs of selected positions with
  equal contexts and a distance from 1.5 t to 3 t propose all periods of the scale. Equal contexts lie more than t / 3
  apart, or they would be highly periodic; so a position has fewer than nine partners.
* A proposed period is extended to either side word by word, which settles it. Hashes only select and propose: a
  collision costs time and changes no result.

Of a stretch that has several periods the smallest stands. Short texts are scanned together, parted by words that
occur nowhere else. Memory is a few dozen bytes for each word of the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.llm.base import free_name, query, table, with_text_columns

LEAST = 24
EXPONENT = 3
#: The first scale, and the greatest period that is sought on its own.
FIRST_SCALE = 8
SMALL = 3 * FIRST_SCALE // 2 - 1
#: Words that are scanned together; a longer text is scanned alone.
TOGETHER = 1 << 17

NEVER = np.uint64(2**64 - 1)
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
S29, S32, S1 = np.uint64(29), np.uint64(32), np.uint64(1)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of each two neighbouring stretches from theirs."""
    x = left * ODD[0] + (right ^ (right >> S29)) * ODD[1]
    x ^= x >> S32
    x *= ODD[2]
    return x ^ (x >> S29)


def stretches(w: np.ndarray, d: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest stretches of period ``d`` that have at least ``least`` words."""
    same = np.zeros(max(0, len(w) - d) + 2, dtype=bool)
    np.equal(w[d:], w[:-d], out=same[1:-1])
    edges = np.flatnonzero(same[1:] != same[:-1])
    starts, ends = edges[::2], edges[1::2] + d
    long = ends - starts >= least
    return starts[long], ends[long]


def extent(w: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The longest stretch of period ``d`` round ``i`` and ``i + d``; compares ever larger blocks."""
    end, block = i, 64
    while True:
        b = w[end + d : end + d + block]
        differ = np.flatnonzero(w[end : end + len(b)] != b)
        if len(differ):
            end += int(differ[0])
            break
        end += len(b)
        if len(b) < block:
            break
        block = min(2 * block, 1 << 16)
    start, block = i, 64
    while start:
        from_ = max(0, start - block)
        differ = np.flatnonzero(w[from_:start] != w[from_ + d : start + d])
        if len(differ):
            start = from_ + int(differ[-1]) + 1
            break
        start, block = from_, min(2 * block, 1 << 16)
    return start, end + d


def selected(ids: np.ndarray, t: int) -> np.ndarray:
    """Positions i at which the least id among i to i + t is at either end."""
    least, step = ids, 1
    while step < t:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:-1], ids[t:])
    return np.flatnonzero((least != NEVER) & ((ids[: len(least)] == least) | (ids[t:] == least)))


def proposals(places: np.ndarray, contexts: np.ndarray, t: int) -> list[tuple[int, int]]:
    """(distance, place) of places with equal contexts, for the distances of scale ``t``, in order."""
    by = np.argsort(contexts, kind="stable")
    places, contexts = places[by], contexts[by]
    found, lag = [], 1
    while lag < len(places):
        apart = places[lag:] - places[:-lag]
        near = (contexts[lag:] == contexts[:-lag]) & (apart < 3 * t)
        if not near.any():
            break
        near &= apart >= 3 * t // 2
        found.append(np.column_stack([apart[near], places[:-lag][near]]))
        lag += 1
    pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
    return list(map(tuple, pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist()))


def runs_of(w: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Rows (start, length, period) of all runs in the codes ``w``, by start, then period. ``longest``: an upper bound
    of a run's length, if one is known."""
    longest = len(w) if longest is None else longest
    least: dict[tuple[int, int], int] = {}  # smallest period of each stretch
    regions: list[np.ndarray] = []  # (start, end, period)

    def note(starts, ends, d: int) -> None:
        regions.append(np.column_stack([starts, ends, np.full(len(starts), d)]))
        for key in zip(starts.tolist(), ends.tolist()):
            least.setdefault(key, d)

    for d in range(1, min(SMALL, longest // EXPONENT) + 1):
        note(*stretches(w, d, max(EXPONENT * d, FIRST_SCALE)), d)
    hashes, width = joined(w.astype(np.uint64), w.astype(np.uint64)), 1
    t = FIRST_SCALE
    while 3 * t // 2 * EXPONENT <= longest:
        while width < t:
            hashes, width = joined(hashes[:-width], hashes[width:]), 2 * width
        ids = hashes >> S1
        known = np.concatenate(regions) if regions else np.zeros((0, 3), dtype=np.int64)
        known = known[(3 * known[:, 2] <= t) & (known[:, 1] - known[:, 0] >= t)]
        if len(known):
            depth = np.zeros(len(ids) + 1, dtype=np.int64)
            np.add.at(depth, known[:, 0], 1)
            np.add.at(depth, known[:, 1] - t + 1, -1)
            ids[np.cumsum(depth[:-1]) > 0] = NEVER
        places = selected(ids, t)
        seen = (0, 0, 0)
        for d, i in proposals(places, joined(hashes[places], hashes[places + t]), t):
            if d == seen[2] and seen[0] <= i < seen[1] - d:
                continue
            seen = (*extent(w, i, d), d)
            if seen[1] - seen[0] >= EXPONENT * d:
                note(np.array([seen[0]]), np.array([seen[1]]), d)
        t *= 2
    rows = [(s, e - s, q) for (s, e), q in least.items() if e - s >= max(LEAST, EXPONENT * q)]
    rows.sort(key=lambda r: (r[0], r[2]))
    return np.array(rows, dtype=np.int64).reshape(-1, 3)


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """``runs_of`` each of several texts, given as words."""
    words = [w for text in texts for w in text]
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    coded = np.fromiter(map(codes.__getitem__, words), dtype=np.int64, count=len(words))
    parts = len(codes) + np.arange(len(texts))
    found = runs_of(np.insert(coded, np.cumsum(sizes), parts), int(sizes.max(initial=0)))
    starts = np.cumsum(sizes + 1) - sizes - 1
    cuts = np.searchsorted(found[:, 0], np.append(starts, len(coded) + len(texts)))
    return [found[a:b] - [s, 0, 0] for a, b, s in zip(cuts[:-1], cuts[1:], starts)]


def without_repeats(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if len(runs):
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in runs.tolist():
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def with_runs(docs: DataFrame, runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` with all runs of each text, array of (start, length, period) in words by start and period, and the text
    without the words that a run repeats.

    No shuffle; each text is searched whole in one task. Null and empty texts have no runs and an empty collapsed text.
    Repeated rows get equal results. The names of the added columns have to be free.
    """

    def rows(texts: list[bytes | None]) -> dict[str, pa.Array]:
        sizes, table_, left = [], [], []
        held: list[list[bytes]] = []

        def search() -> None:
            for words, found in zip(held, runs_of_texts(held)):
                sizes.append(len(found))
                table_.append(found)
                left.append(without_repeats(words, found))
            held.clear()

        waiting = 0
        for text in texts:
            held.append((text or b"").split())
            waiting += len(held[-1])
            if waiting >= TOGETHER:
                search()
                waiting = 0
        search()
        whole = np.concatenate(table_) if table_ else np.zeros((0, 3), dtype=np.int64)
        fields = [pa.array(np.ascontiguousarray(whole[:, i])) for i in range(3)]
        offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
        spans = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
        return {runs: pa.ListArray.from_arrays(offsets, spans), collapsed: pa.array(left, pa.binary()).cast(pa.string())}

    made = f"`{runs}` array<struct<start: long, length: long, period: long>>, `{collapsed}` string"
    return with_text_columns(docs, "text", made, rows)


def planted(doc_id: Column, text: Column) -> Column:
    """The text, in one document of ten with its words from a place on made periodic; what stands behind words is one
    space there. A null doc_id plants nothing."""
    code = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    draw = F.floor(code / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        at = draw % n
        period = 1 + F.floor((n - at) / (3 + draw % 8))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        own = F.transform(places, lambda i: F.when(i < at, i).otherwise(at + (i - at) % period).cast("int"))
        return F.when(n > 0, F.array_join(F.transform(own, lambda i: F.get(w, i)), " ")).otherwise(text)

    # the array of words is bound once, not made anew for every word
    bound = F.get(F.transform(F.array(words), repeated), F.lit(0))
    return F.when(code % 10 == 0, bound).otherwise(text)


def steepest(runs: Column) -> Column:
    """Of runs by start and period, the first with the greatest length / period, compared as fractions."""
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(
        runs, none,
        lambda best, r: F.when(best.isNull() | (r.length * best.period > best.length * r.period), r).otherwise(best),
    )


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the steepest run, and digests of all runs and of the text without repeats, of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = with_runs(docs)
    best = free_name(found, "best")
    line = lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n"))
    return found.withColumn(best, steepest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"{best}.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr(f"(1000 * {best}.length) div {best}.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
