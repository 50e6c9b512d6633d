"""Near-duplicates by SimHash and multi-index hashing.

A text's fingerprint has the bits set in over half the hashes of its 3-word shingles. Fingerprints within RADIUS bits
are linked, and texts reachable by links form a group.

Links are sought among distinct fingerprints, so that copies cost nothing. Of two fingerprints within 3 bits, one half
of 32 bits differs in at most 1 bit. So each fingerprint lies in a table under either half as it is, and asks the
table for either half and for the halves that have one more bit set (the partner with the bit asks for nothing, as it
is found from the other side). What is fetched is verified on all 64 bits.

A table entry that more than CROWD fingerprints share would cost the square of its size. Its members are linked
another way, exactly and in linear work: each is put down at every point within 2 bits. Fingerprints that are 3 apart
have a point that is 1 from the one and 2 from the other; so where somebody within 1 bit of a point has been put down,
everybody at the point is within 3 bits of that one, and all belong together.

What grows with the corpus is never broadcast: a fingerprint's 34 requests or 2,081 points look to Spark as small as the
file of fingerprints they are made from. Only tables of few rows are, after these have been counted.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.llm.base import free_name, join_by_frequency, query, side, table, with_text_columns
from adsettle.session import stage

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints that may share a half before its members are linked by points instead of pairs.
CROWD = 256

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
LOW_HALF = 0xFFFFFFFF


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of a text's word shingles, unsigned."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    k = min(size, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())],
        dtype=np.uint64,
        count=len(starts),
    )
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes, in blocks of bounded size."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, name: str = "fp") -> DataFrame:
    """``docs`` with each text's fingerprint as a signed long. Null and empty texts have 0."""

    def rows(texts: list[bytes | None]) -> dict[str, pa.Array]:
        made = np.fromiter((fingerprint(t or b"") for t in texts), dtype=np.uint64, count=len(texts))
        return {name: pa.array(made.view(np.int64))}

    return with_text_columns(docs, "text", f"`{name}` long", rows)


def high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, 32)


def low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(LOW_HALF))


def entries(fps: DataFrame) -> DataFrame:
    """The two table entries of each fingerprint: (segment, half, fp)."""
    fp = F.col("fp")
    return fps.select(
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("segment"), high(fp).alias("half")),
                F.struct(F.lit(1).alias("segment"), low(fp).alias("half")),
            )
        ).alias("e"),
        "fp",
    ).select("e.segment", "e.half", "fp")


BITS = [1 << i for i in range(32)]


def requests(table_entries: DataFrame) -> DataFrame:
    """The halves each fingerprint asks for: its own, and those with one more bit."""
    flips = F.filter(
        F.array(*[F.lit(b).cast("long") for b in BITS]), lambda b: F.col("half").bitwiseAND(b) == 0
    )
    asked = F.concat(F.array(F.col("half")), F.transform(flips, lambda b: F.col("half").bitwiseOR(b)))
    return table_entries.select("segment", F.explode(asked).alias("half"), "fp")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def pair_links(fps: DataFrame, crowded: DataFrame) -> DataFrame:
    """(a, b) of all fingerprints within RADIUS that meet at a table entry that isn't ``crowded``, a side of a join."""
    own = entries(fps)
    calm = own.join(crowded, ["segment", "half"], "left_anti")
    asking = requests(own).withColumnRenamed("fp", "asking")
    met = calm.join(asking.hint("merge"), ["segment", "half"]).filter(
        (F.col("fp") != F.col("asking")) & (distance(F.col("fp"), F.col("asking")) <= RADIUS)
    )
    return met.select(F.least("fp", "asking").alias("a"), F.greatest("fp", "asking").alias("b"))


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def point_links(members: DataFrame) -> DataFrame:
    """Links that connect all members within RADIUS of each other, in place of every pair.

    Points are put down in two steps of one bit each, so that no expression lists all 2,081 of them.
    """
    singles = [signed(1 << i) for i in range(64)]
    near = members.select(
        "fp", F.explode(F.array(F.lit(0).cast("long"), *[F.lit(m).cast("long") for m in singles])).alias("m")
    )
    pairs = members.sparkSession.createDataFrame(
        [(signed(1 << i), signed(1 << i | 1 << j)) for i, j in combinations(range(64), 2)], "first long, m long"
    ).groupBy("first").agg(F.collect_list("m").alias("ms"))  # fixed values: 63 rows
    far = near.join(F.broadcast(pairs), F.col("m") == F.col("first")).select("fp", F.explode("ms").alias("m"))
    points = near.select(F.col("fp").bitwiseXOR(F.col("m")).alias("point"), "fp", F.lit(True).alias("close")).union(
        far.select(F.col("fp").bitwiseXOR(F.col("m")).alias("point"), "fp", F.lit(False).alias("close"))
    )
    heads = (
        points.groupBy("point")
        .agg(F.min(F.when(F.col("close"), F.col("fp"))).alias("head"), F.count("*").alias("n"))
        .filter("head IS NOT NULL AND n > 1")
        .select("point", "head")
    )
    # Each point is within 2 bits of its head's fingerprint and of at most 2,081 members', so no point is hot.
    return (
        points.join(heads.hint("merge"), "point")
        .filter("fp != head")
        .select(F.least("fp", "head").alias("a"), F.greatest("fp", "head").alias("b"))
        .distinct()
    )


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(fp, root) of every fingerprint that has an edge: the smallest fingerprint it reaches.

    Alternates between linking each node's larger neighbours to its smallest and its smaller ones to the smallest,
    until nothing changes. The number of edges never grows beyond that of nodes and first edges; a round is written to
    the shared folder. A node with very many neighbours occurs in one row per neighbour and is never gathered.
    """
    edges = stage(edges.select("a", "b").distinct(), "edges")
    for _ in range(most_rounds):
        n = edges.count()
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # larger neighbours of each node now hang on the smallest of its neighbourhood
        large = (
            both.filter("b > a").join(side(least, 2 * n, "least"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        large = stage(large, "edges-large")  # rows (node, smaller node), one per edge at most
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(side(down, n, "down"), "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
            .select(F.col("e.b").alias("x"), F.col("e.m").alias("y"))
            .filter("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        edges = stage(small, "edges")
        children = edges.select(F.col("b").alias("a")).distinct()
        # done once every node hangs on one root only, and no root hangs on anything
        state = edges.groupBy("b").agg(F.count("*").alias("n"))
        loose = state.filter("n > 1").isEmpty() and edges.join(
            side(children, edges.count(), "children"), "a", "left_semi"
        ).isEmpty()
        if loose:
            own = edges.select(F.col("a").alias("fp"), F.col("a").alias("root")).distinct()
            return own.union(edges.select(F.col("b").alias("fp"), F.col("a").alias("root")))
    raise RuntimeError(f"components aren't settled after {most_rounds} rounds")


def distinct_prints(prints: DataFrame) -> DataFrame:
    """Of (doc_id, fp) rows, one row per distinct fingerprint: fp, n (rows) and the smallest doc_id."""
    return stage(
        prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "fingerprints"
    )


def groups(prints: DataFrame) -> DataFrame:
    """Of (doc_id, fp) rows, one row per distinct fingerprint: fp, n (rows) and component_id."""
    fps = distinct_prints(prints)
    crowded = entries(fps).groupBy("segment", "half").count().filter(F.col("count") > CROWD)
    crowded = stage(crowded.select("segment", "half"), "crowded")
    n = crowded.count()
    crowded = side(crowded, n)
    links = pair_links(fps, crowded)
    if n:
        asked = requests(entries(fps)).join(crowded, ["segment", "half"], "left_semi")
        links = links.union(point_links(asked.select("fp").distinct()))
    return named_groups(fps, links)


def named_groups(fps: DataFrame, links: DataFrame) -> DataFrame:
    """fp, n and component_id of the distinct fingerprints, given links (a, b) among them."""
    roots = stage(components(links), "roots")
    n = roots.count()
    roots = side(roots, n)
    rooted = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    linked = fps.join(roots, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(side(linked, n // 2, "linked"), "root", "left")
    return named.select("fp", "n", F.coalesce("component_id", "least").alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id of every row: the smallest doc_id that is reached over links.

    Null and empty texts have fingerprint 0 and are linked like any other. Rows without doc_id take part and get the
    group's id, which is null only if nobody in the group has one. Repeated rows are in one group.
    """
    prints = stage(fingerprints(docs.select("doc_id", "text")).drop("text"), "prints")
    return with_groups(prints, groups(prints))


def with_groups(prints: DataFrame, grouped: DataFrame) -> DataFrame:
    """``prints`` with the component_id of each row's fingerprint."""
    found = stage(grouped, "groups")
    renamed = found.withColumnRenamed("fp", "group_fp")
    total = prints.count()
    return join_by_frequency(prints, renamed, F.col("fp"), "group_fp", "n", total, F.col("doc_id")).drop("n")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without copies: of each group the row with the smallest doc_id stays, once if it is repeated. Rows
    without doc_id stay, as nothing tells them apart. Columns are those of ``docs``."""
    name, n = free_name(docs, "_doc_id"), free_name(docs, "_rows")
    stays = (
        near_duplicates(docs)
        .filter("doc_id = component_id")
        .groupBy(F.col("doc_id").alias(name))
        .agg(F.count("*").alias(n))
    )
    stays = stage(stays, "kept")
    same = docs["doc_id"] == F.col(name)
    # One row per group: it grows with the corpus, and in memory to many times its file, so it isn't to be broadcast.
    kept = docs.join(stays.filter(F.col(n) == 1).hint("merge"), same, "left_semi")
    repeated = stays.filter(F.col(n) > 1)
    if many := repeated.count():
        copies = docs.join(side(repeated, many), same, "left_semi")
        kept = kept.unionByName(copies.dropDuplicates(["doc_id"]))
    return kept.unionByName(docs.filter(docs["doc_id"].isNull()))


@query()
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
