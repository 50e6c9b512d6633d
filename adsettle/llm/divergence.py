"""Source divergence audit by single-pass in-memory indexing.

How far the sources of a language differ in their words: for each pair of sources the triangular divergence of their
smoothed word frequencies, and for each source the words that set it apart from its language.

Frequencies come from one pass over the texts. A task counts occurrences and documents per (language, source, term) in
a block in memory. Once the block holds BLOCK entries it is spilled as a run: entries sorted by term, cut by hash of
term and language into shards, and within a shard into pieces of at most PIECE entries. Spark's shuffle carries the
pieces to the shard's task and orders them by their first term, nothing else. There a heap merges the runs: it holds the
open pieces by their next term, and gives out, a stretch of terms at a time, all entries below the first term of the
piece that comes next. Terms of fewer than LEAST_DOCS documents of their language are left out there.

Pairs are then made up of corrections, streamed over the postings of each term. If no source had any word, the value of
a pair would be that of the two floor frequencies times the number of terms. A term that occurs in the one source only
changes that by an amount that depends on its count, so these corrections are made for each distinct count. A term that
occurs in both is corrected once more; those corrections are added up in a square of at most TILE by TILE sources
at a time, however many sources a language has, and the squares' sums are added up by a grouping.

All arithmetic is on whole numbers.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adsettle.llm.base import bytes_of, join_by_frequency, query, table
from adsettle.session import stage

LEAST_DOCS = 10
#: Entries of a block before it is spilled, and of a piece of a run.
BLOCK, PIECE = 300_000, 4_096
#: Entries more that the merge opens before it gives out what is complete.
STRETCH = 200_000
#: Pairs of sources whose corrections are made at a time.
PAIRS = 1_000_000
#: Sources by sources whose corrections a task holds at a time.
TILE = 512
#: Terms of a source that are named.
TOP = 10
SCALE = 1_000_000_000
#: Tasks that a language's sources are dealt over where each meets all others.
SALTS = 16

#: Letters A-Z in lower case, other ASCII but a-z as spaces.
TERMS = bytes(32 if b < 65 or 90 < b < 97 or 122 < b < 128 else b + 32 if b < 91 else b for b in range(256))

PIECES = "shard int, first binary, keys array<binary>, sources array<binary>, ns array<long>, docs array<long>"
FREQUENCIES = "lang string, term string, source string, n long, lang_n long, head boolean"
ENTRY = pa.schema([("key", pa.binary()), ("source", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

Block = dict[tuple[bytes, bytes], tuple[Counter, Counter]]


def spilled(block: Block, shards: int) -> pa.RecordBatch:
    """A block as a run: per shard its entries by key, in pieces. A key is the term, a zero byte and the language; no
    term holds a zero byte."""
    parts, numbers = [], []
    for (lang, source), (ns, docs) in block.items():
        terms = list(ns)
        numbers.append(np.fromiter(map(crc32, terms, repeat(crc32(lang))), dtype=np.int64, count=len(terms)) % shards)
        keys = pc.binary_join_element_wise(pa.array(terms, pa.binary()), lang, b"\0")
        own = [keys, pa.repeat(pa.scalar(source, pa.binary()), len(terms)), pa.array(list(ns.values()), pa.int64())]
        parts.append(pa.table([*own, pa.array(list(map(docs.__getitem__, terms)), pa.int64())], schema=ENTRY))
    entries = pa.concat_tables(parts).combine_chunks()
    by_key = pc.sort_indices(entries["key"]).to_numpy()
    shard = np.concatenate(numbers)[by_key]
    order = np.argsort(shard, kind="stable")
    entries, shard = entries.take(by_key[order]).combine_chunks(), shard[order]
    begins = np.flatnonzero(np.diff(shard, prepend=-1))
    sizes = np.diff(begins, append=len(shard))
    starts = np.concatenate([np.arange(at, at + n, PIECE) for at, n in zip(begins, sizes)])
    offsets = pa.array(np.append(starts, len(shard)), pa.int32())
    flat = [entries[c].chunk(0) for c in ENTRY.names]
    lists = [pa.ListArray.from_arrays(offsets, c) for c in flat]
    heads = [pa.array(shard[starts], pa.int32()), flat[0].take(pa.array(starts))]
    return pa.RecordBatch.from_arrays([*heads, *lists], names=["shard", "first", "keys", "sources", "ns", "docs"])


def runs(texts: DataFrame, shards: int) -> DataFrame:
    """Pieces of runs of (lang, source, text) rows."""

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*[bytes_of(batch.column(i)) for i in range(3)]):
                words = (text or b"").translate(TERMS).split()
                if not words:
                    continue
                ns, docs = block.setdefault((lang, source), (Counter(), Counter()))
                before = len(ns)
                ns.update(words)
                docs.update(set(words))
                size += len(ns) - before
                if size >= BLOCK:
                    yield spilled(block, shards)
                    block, size = {}, 0
        if block:
            yield spilled(block, shards)

    return texts.select("lang", "source", "text").mapInArrow(index, PIECES)


def merged(pieces: Iterable[pa.Table]) -> Iterator[pa.Table]:
    """Of pieces (tables of ENTRY, each by key) in the order of their first keys, tables that hold all entries of their
    keys, in the order of the keys.

    A heap holds the open pieces by their next keys. What is below the first key of the newest piece is complete, as
    every later piece begins there or after. So whenever STRETCH entries more are open, all pieces with a next key below it are
    taken from the heap, cut there, and what they go on with is put back.
    """
    heap: list[tuple[bytes, int, int, pa.Table]] = []
    held, enough = 0, STRETCH

    def until(bound: bytes | None) -> Iterator[pa.Table]:
        nonlocal held
        cuts = []
        while heap and (bound is None or heap[0][0] < bound):
            _, order, at, piece = heapq.heappop(heap)
            keys = piece["key"]
            end = len(piece) if bound is None else bisect_left(range(len(piece)), bound, at, key=lambda i: keys[i].as_py())
            cuts.append(piece.slice(at, end - at))
            held -= end - at
            if end < len(piece):
                heapq.heappush(heap, (keys[end].as_py(), order, end, piece))
        if cuts:
            yield pa.concat_tables(cuts)

    for order, piece in enumerate(pieces):
        first = piece["key"][0].as_py()
        if held >= enough:
            yield from until(first)
            enough = held + STRETCH
        heapq.heappush(heap, (first, order, 0, piece))
        held += len(piece)
    yield from until(None)


def summed(entries: pa.Table, least_docs: int) -> pa.RecordBatch:
    """Rows of FREQUENCIES of all keys in ``entries`` that have at least ``least_docs`` documents."""
    keys, sources = (entries[c].combine_chunks().dictionary_encode() for c in ("key", "source"))
    if isinstance(keys, pa.ChunkedArray):
        keys, sources = keys.unify_dictionaries().combine_chunks(), sources.unify_dictionaries().combine_chunks()
    place = keys.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    order = np.argsort(place, kind="stable")
    place = place[order]
    begins = np.flatnonzero(np.diff(place, prepend=-1))
    n, docs = (np.add.reduceat(entries[c].to_numpy()[order], begins) for c in ("n", "docs"))
    of_key, of_source = np.divmod(place[begins], len(sources.dictionary))
    heads = np.flatnonzero(np.diff(of_key, prepend=-1))
    sizes = np.diff(heads, append=len(of_key))
    kept = np.repeat(np.add.reduceat(docs, heads) >= least_docs, sizes)
    lang_n = np.repeat(np.add.reduceat(n, heads), sizes)
    head = np.zeros(len(n), dtype=bool)
    head[heads] = True
    used, again = np.unique(of_key[kept], return_inverse=True)
    named = [k.partition(b"\0")[::2] for k in keys.dictionary.take(pa.array(used)).to_pylist()]
    terms, langs = (pa.array([x[i] for x in named], pa.binary()).cast(pa.string()) for i in range(2))
    at = pa.array(again)
    names = sources.dictionary.take(pa.array(of_source[kept])).cast(pa.string())
    columns = [langs.take(at), terms.take(at), names, *(pa.array(x[kept]) for x in (n, lang_n, head))]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in FREQUENCIES.split(", ")])


def frequencies(texts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, source, n, lang_n, head) of every term in at least ``least_docs`` of its language's rows: its
    occurrences in a source where it has any, and in the language; head marks one row of each term.

    There are as many hash shards as the session has shuffle partitions. Every row counts as a document.
    """
    spark = texts.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[pa.Table]:
            for b in batches:
                for i in range(len(b)):
                    yield pa.table([b.column(c)[i].values for c in ("keys", "sources", "ns", "docs")], schema=ENTRY)

        for entries in merged(pieces()):
            rows = summed(entries, least_docs)
            yield from (rows.slice(at, 20_000) for at in range(0, len(rows), 20_000))

    dealt = runs(texts, shards).repartition(shards, "shard").sortWithinPartitions("first")
    return dealt.select("first", "keys", "sources", "ns", "docs").mapInArrow(merge, FREQUENCIES)


def share(n: Column, whole: Column, terms: Column) -> Column:
    """Smoothed frequency in billionths, at least 1; 1 if there are no terms."""
    wide = lambda c: c.cast("decimal(19,0)")
    size = wide(whole) + 2 * wide(terms)
    return F.when(
        terms > 0, F.lit(1).cast("long") + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (wide(n) + 2), size)
    ).otherwise(1)


def apart(p: Column, q: Column) -> Column:
    """What a term of these frequencies adds to the divergence."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def plain_apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def pairs_within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i < j, of all pairs within stretches of these sizes that lie one after the other."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    after = ends - np.arange(len(ends)) - 1  # how many follow in the stretch
    i = np.repeat(np.arange(len(ends)), after)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
    return i, j


def common_corrections(postings: DataFrame) -> DataFrame:
    """(lang, a, b, value), a < b: over the terms that two sources share, what both occurring changes beyond what each
    one does. ``postings``: (lang, tile_a, tile_b, of), ``of`` an array of a term's (at, p, p0) in both tiles."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, square = None, np.zeros((0, 0), dtype=np.int64)

        def out() -> pa.RecordBatch:
            i, j = np.nonzero(square)
            lang, a, b = tile
            columns = [pa.array([lang] * len(i), pa.string()), pa.array(i + a * TILE), pa.array(j + b * TILE)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(square[i, j])], names=["lang", "a", "b", "value"])

        for batch in batches:
            lists = batch.column(3)
            sizes = np.asarray(lists.value_lengths()).astype(np.int64)
            flat, ends = lists.flatten(), np.cumsum(sizes)
            tiles = list(zip(*[batch.column(k).to_pylist() for k in range(3)]))
            row = 0
            while row < len(tiles):
                # some terms of one square, so many that they make about PAIRS pairs
                own, last, made = tiles[row], row, 0
                while last < len(tiles) and tiles[last] == own and made < PAIRS:
                    made += int(sizes[last]) ** 2 // 2
                    last += 1
                if own != tile:
                    if tile is not None:
                        yield out()
                    tile, square = own, np.zeros((TILE, TILE), dtype=np.int64)
                part = flat.slice(ends[row] - sizes[row], ends[last - 1] - ends[row] + sizes[row])
                at, p, p0 = (np.asarray(part.field(k)) for k in ("at", "p", "p0"))
                order = np.lexsort((at, np.repeat(np.arange(last - row), sizes[row:last])))
                at, p, p0 = at[order], p[order], p0[order]
                i, j = pairs_within(sizes[row:last])
                if own[1] != own[2]:
                    across = (at[i] // TILE == own[1]) & (at[j] // TILE == own[2])
                    i, j = i[across], j[across]
                change = plain_apart(p[i], p[j]) - plain_apart(p[i], p0[j]) - plain_apart(p0[i], p[j]) + plain_apart(p0[i], p0[j])
                np.add.at(square, (at[i] % TILE, at[j] % TILE), change)
                row = last
        if tile is not None:
            yield out()

    return postings.mapInArrow(run, "lang string, a long, b long, value long")


def groups_of(texts: DataFrame, found: DataFrame) -> DataFrame:
    """One row per occurring (lang, source): its number ``at`` in the language, occurrences of kept terms ``whole``,
    of the language ``lang_whole``, kept terms of the language ``v``, frequency ``p0`` of a term it hasn't, and
    ``n``, its rows in ``found``."""
    sizes = found.groupBy("lang", "source").agg(
        F.count("*").alias("n"), F.sum("n").alias("whole"), F.sum(F.col("head").cast("long")).alias("heads")
    )
    occurring = texts.groupBy("lang", "source").agg(F.lit(0).cast("long").alias("none"))
    whole = Window.partitionBy("lang")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return (
        occurring.join(sizes, ["lang", "source"], "left")
        .select(
            "lang", "source", zero(F.col("n")).alias("n"), zero(F.col("whole")).alias("whole"),
            zero(F.sum("heads").over(whole)).alias("v"), zero(F.sum("whole").over(whole)).alias("lang_whole"),
            (F.row_number().over(whole.orderBy("source")) - 1).cast("long").alias("at"),
        )
        .withColumn("p0", share(F.lit(0), F.col("whole"), F.col("v")))
    )


def pair_values(groups: DataFrame, placed: DataFrame) -> DataFrame:
    """(lang, a, b, value) of all ordered pairs of sources of a language, by their numbers."""
    salt = F.pmod(F.xxhash64("at", "n"), F.lit(SALTS))
    others = groups.select(
        F.col("lang").alias("other_lang"), F.col("at").alias("b"), F.col("p0").alias("q0"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("other_salt"),
    )
    met = lambda rows: rows.withColumn("salt", salt.cast("int")).join(
        others, (F.col("lang") == F.col("other_lang")) & (F.col("salt") == F.col("other_salt")) & (F.col("at") != F.col("b"))
    )
    floors = apart(F.col("p0"), F.col("q0"))
    none = met(groups.select("lang", "at", "p0", "v", F.lit(0).alias("n"))).select(
        "lang", F.col("at").alias("a"), "b", (F.col("v") * floors).alias("value")
    )
    counts = placed.groupBy("lang", "at", "p0", "p", "n").agg(F.count("*").alias("terms"))
    one = met(counts).groupBy("lang", F.col("at").alias("a"), "b").agg(
        F.sum(F.col("terms") * (apart(F.col("p"), F.col("q0")) - floors)).alias("value")
    )
    tiles = F.floor((F.col("sources") - 1) / TILE)
    own = F.floor(F.col("at") / TILE)
    squares = F.transform(
        F.sequence(F.lit(0).cast("long"), tiles),
        lambda t: F.struct(F.least(t, own).alias("tile_a"), F.greatest(t, own).alias("tile_b")),
    )
    postings = (
        placed.select("lang", "term", F.struct("at", "p", "p0").alias("posting"), F.explode(squares).alias("tile"))
        .groupBy("lang", "term", "tile.tile_a", "tile.tile_b")
        .agg(F.collect_list("posting").alias("of"))  # at most 2 TILE
        .filter(F.size("of") > 1)
        .select("lang", "tile_a", "tile_b", "of")
        .sortWithinPartitions("lang", "tile_a", "tile_b")
    )
    both = common_corrections(postings)
    mirrored = lambda rows: rows.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    parts = [none, one, mirrored(one), both, mirrored(both)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): for each source all others of its language by divergence (part pair),
    and its ``top`` terms by what they add to the divergence from the language, of those more frequent than there
    (part term).

    Null text, lang and source count as empty; an empty lang or source is one like any other. Every row is a document,
    repeated ones too. Ties are ranked by UTF-8. A source without terms, or a language without kept ones, still has its
    pairs. An empty table gives none. Columns of other names are not read.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    texts = docs.select(*[empty(c).alias(c) for c in ("lang", "source", "text")])
    found = stage(frequencies(texts, least_docs), "frequencies")
    groups = stage(groups_of(texts, found), "sources")
    per_lang = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    keyed = groups.join(per_lang, "lang").select(
        F.struct("lang", "source").alias("place"), F.col("n").alias("rows"), "at", "whole", "v", "lang_whole", "p0", "sources"
    )
    key = F.struct(F.col("lang").alias("lang"), F.col("source").alias("source"))
    placed = join_by_frequency(found, keyed, key, "place", "rows", found.count(), F.col("term")).select(
        "lang", "term", "source", "n", "at", "p0", "sources",
        share(F.col("n"), F.col("whole"), F.col("v")).alias("p"),
        share(F.col("lang_n"), F.col("lang_whole"), F.col("v")).alias("q"),
    )
    named = groups.select("lang", "at", "source")
    pairs = (
        pair_values(groups, placed)
        .join(named.withColumnRenamed("at", "a"), ["lang", "a"])
        .join(named.select("lang", F.col("at").alias("b"), F.col("source").alias("item")), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    terms = placed.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(terms).filter(F.col("rank") <= top))


AUDIT_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT i) >= {LEAST_DOCS}),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS whole FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sources AS (
  SELECT lang, source, coalesce((SELECT sum(c.n) FROM counts c WHERE c.lang = d.lang AND c.source = d.source), 0)::HUGEINT AS whole
  FROM (SELECT DISTINCT lang, source FROM docs) d),
dense AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + {SCALE} * (coalesce(c.n, 0) + 2) // (s.whole + 2 * l.v) AS p, 1 + {SCALE} * (k.n + 2) // (l.whole + 2 * l.v) AS q
  FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM dense WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= {TOP}
"""


@query(AUDIT_SQL)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of all sources of a language, and the terms that set each apart."""
    return audit(table(spark, sf_dir, "documents"))
