"""Benchmark decontamination by SimHash of item-sized windows.

Of every document, windows as long as an item are fingerprinted and looked up among the items' fingerprints of that
length. The 64 bits are cut into BLOCKS blocks; two fingerprints within RADIUS bits differ in at most RADIUS // BLOCKS
bits in one of them, so looking up that small Hamming ball of each block finds every item within RADIUS. What is found
is verified by the weighted Jaccard similarity of word shingles, the weight of a shingle being its count.

Windows that can't reach the similarity are not fingerprinted: a window and an item with n shingles each must share
m = 2 n s / (1 + s) of them (counted with repeats) for similarity s, so fewer than m positions that hold a shingle of
the item rule a window out. This loses nothing. A text shorter than an item is one window as a whole; of n' shingles it
must share (n + n') s / (1 + s).

Items are processed in blocks of about BLOCK_WORDS words, so that what the driver and a task hold of the benchmark is
bounded however large it is. A benchmark of one block is one pass. Of several, one block after the other is sent out,
sought in the texts and forgotten; only what it finds is kept, by row.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.llm.base import free_name, query, table, with_text_columns
from adsettle.session import stage

SHINGLE = 5
SIMILARITY = 0.8
#: Fingerprints of texts that similar differ in 9 bits on average, at most, with a deviation below 3.
RADIUS = 23
BLOCKS = 8
BLOCK_WORDS = 2_000_000

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def rolled(ids: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit code of each run of k word ids, equal for equal runs."""
    n = len(ids) - k + 1
    code = np.zeros(max(n, 0), dtype=np.uint64)
    if n > 0:
        for j in range(k):
            code = code * BASE + ids[j : j + n]
            code ^= code >> np.uint64(29)
    return code


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    return np.array(
        [xxhash.xxh64_intdigest(b" ".join(words[i : i + k])) for i in range(len(words) - k + 1)], dtype=np.uint64
    )


def sim_hash(bits: np.ndarray) -> int:
    """Fingerprint of the shingles whose bits are the rows (0 or 1)."""
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(bits)).tobytes(), "big")


def ball(width: int, radius: int) -> list[int]:
    """All differences of up to ``radius`` bits."""
    return [
        sum(1 << b for b in flips) for r in range(radius + 1) for flips in combinations(range(width), r)
    ]


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of shingle counts."""
    shared = sum((a & b).values())
    whole = sum(a.values()) + sum(b.values()) - shared
    return shared / whole if whole else 0.0


@dataclass
class Items:
    """A block of items, as tasks hold it."""

    ids: list[int]
    words: list[list[bytes]]
    radius: int = RADIUS
    least: float = SIMILARITY
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    size: list[int] = field(default_factory=list)  # shingle size of an item: SHINGLE, or its length if that is less
    needs: list[int] = field(default_factory=list)
    codes: dict[int, np.ndarray] = field(default_factory=dict)  # by size: sorted codes of the items' shingles
    owners: dict[int, list[list[int]]] = field(default_factory=dict)  # beside them: the items that hold each
    shingles: list[Counter] = field(default_factory=list)
    prints: list[int] = field(default_factory=list)
    blocks: dict[tuple, list[int]] = field(default_factory=lambda: defaultdict(list))

    def __post_init__(self) -> None:
        owners: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for at, words in enumerate(self.words):
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
            k = min(SHINGLE, len(words))
            n = len(words) - k + 1
            codes = self.runs(words, k).tolist()
            for code in set(codes):
                owners[k][code].append(at)
            self.size.append(k)
            self.needs.append(self.need(n, n))
            self.shingles.append(Counter(tuple(words[i : i + k]) for i in range(n)))
            print_ = sim_hash(self.bits(words, k))
            self.prints.append(print_)
            for block in range(BLOCKS):
                self.blocks[len(words), block, self.part(print_, block)].append(at)
        for k, by_code in owners.items():
            self.codes[k] = np.array(sorted(by_code), dtype=np.uint64)
            self.owners[k] = [by_code[c] for c in sorted(by_code)]
        self.differences = ball(64 // BLOCKS, self.radius // BLOCKS)

    def need(self, n: int, m: int) -> int:
        """Shingles that n and m have to share for the similarity."""
        return int(np.ceil((n + m) * self.least / (1 + self.least) - 1e-9))

    @staticmethod
    def part(print_: int, block: int) -> int:
        width = 64 // BLOCKS
        return print_ >> block * width & (1 << width) - 1

    @staticmethod
    def bits(words: list[bytes], k: int) -> np.ndarray:
        hashes = shingle_hashes(words, k)
        return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)

    def runs(self, words: list[bytes], k: int) -> np.ndarray:
        get = self.vocabulary.get
        return rolled(np.array([get(w, 0) for w in words], dtype=np.uint64), k)

    def lookup(self, length: int, print_: int) -> list[int]:
        """Items of that many words whose fingerprint is within the radius."""
        found = set()
        for block in range(BLOCKS):
            part = self.part(print_, block)
            for d in self.differences:
                found.update(self.blocks.get((length, block, part ^ d), ()))
        return [i for i in found if (self.prints[i] ^ print_).bit_count() <= self.radius]

    def search(self, text: bytes) -> dict[int, tuple[float, int, int]]:
        """Per item place: the greatest similarity of a window that reaches ``least``, its first word and length."""
        words = words_of(text)
        ids = np.fromiter(map(self.vocabulary.get, words, [0] * len(words)), dtype=np.uint64, count=len(words))
        best: dict[int, tuple[float, int, int]] = {}
        for k, codes in self.codes.items():
            runs = rolled(ids, k)
            if not len(runs):
                continue
            place = np.minimum(np.searchsorted(codes, runs), len(codes) - 1)
            hits = np.flatnonzero(codes[place] == runs)
            if not len(hits):
                continue
            by_item: dict[int, list[int]] = defaultdict(list)
            owners = self.owners[k]
            for hit, code in zip(hits.tolist(), place[hits].tolist()):
                for item in owners[code]:
                    by_item[item].append(hit)
            starts: dict[int, set[int]] = defaultdict(set)  # by window length
            for item, own in by_item.items():
                need = self.needs[item]
                n = len(self.words[item]) - k + 1
                if len(runs) < n:  # the whole text is the window
                    if len(own) >= self.need(n, len(runs)):
                        starts[len(self.words[item])].add(0)
                    continue
                for i in range(len(own) - need + 1):
                    # positions that a window must start at to hold this hit and the need - 1 after it
                    low, high = max(own[i + need - 1] - n + 1, 0), min(own[i], len(runs) - n)
                    if i:
                        low = max(low, own[i - 1] + 1)
                    starts[len(self.words[item])].update(range(low, high + 1))
            for length, places in starts.items():
                for start in sorted(places):
                    window = words[start : start + length]
                    for item in self.lookup(length, sim_hash(self.bits(window, k))):
                        if self.size[item] != k:
                            continue
                        shared = Counter(tuple(window[i : i + k]) for i in range(len(window) - k + 1))
                        value = similarity(shared, self.shingles[item])
                        if value >= self.least and value > best.get(item, (0.0, 0, 0))[0]:
                            best[item] = (value, start, len(window))
        return best


def item_blocks(benchmark: DataFrame, most_words: int = BLOCK_WORDS) -> list[DataFrame]:
    """The benchmark in blocks of about ``most_words`` words, dealt by a hash of the item. Items without a word have
    no windows and are left out; repeated rows count once."""
    items = benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text")) / 4).first()[0] or 0
    n = int(total // most_words) + 1
    if n == 1:
        return [items]
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def load(items: DataFrame) -> tuple[list[int], list[list[bytes]]]:
    """Ids and words of a block's items."""
    rows = [(r.item_id, words_of(r.text.encode())) for r in items.collect()]  # at most a block
    rows = sorted((i, w) for i, w in rows if w)
    return [i for i, _ in rows], [w for _, w in rows]


FOUND = "array<struct<item_id:long,similarity:double,start:int,n_words:int>>"
FOUND_TYPE = pa.list_(
    pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("start", pa.int32()), ("n_words", pa.int32())])
)


def with_leaks(docs: DataFrame, benchmark: DataFrame, name: str) -> DataFrame:
    """``docs`` with the items found in each text, as an array under ``name`` that is empty for clean rows, by item. Of
    an item found more than once, the most similar window is given, the first of equals."""
    blocks = item_blocks(benchmark)
    if len(blocks) == 1:
        return search_block(docs, blocks[0], name)[0]
    row, found = free_name(docs, "_row"), free_name(docs, "_found")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    texts, pieces = numbered.select(row, "text"), []
    for block in blocks:
        searched, shared = search_block(texts, block, found)
        pieces.append(stage(searched.filter(F.size(found) > 0).select(row, found), "leaks"))
        shared.destroy()  # the next block takes its place
    by_row = reduce(DataFrame.union, pieces).groupBy(row).agg(F.flatten(F.collect_list(found)).alias(found))
    leaks = F.coalesce(F.array_sort(found), F.array().cast(FOUND))
    return numbered.join(by_row, row, "left").select(*[F.col(f"`{c}`") for c in docs.columns], leaks.alias(name))


def search_block(docs: DataFrame, block: DataFrame, name: str) -> tuple[DataFrame, Broadcast]:
    """``docs`` with what is found of one block, and the block as sent to the tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(load(block))
    return with_text_columns(docs, "text", f"`{name}` {FOUND}", searcher(shared, name)), shared


def searcher(shared, name):
    built: list[Items] = []  # once per task

    def rows(texts: list[bytes | None]) -> dict[str, pa.Array]:
        if not built:
            built.append(Items(*shared.value))
        items, out = built[0], []
        for t in texts:
            best = items.search(t) if t else {}
            out.append([(items.ids[i], *found) for i, found in sorted(best.items())])
        return {name: pa.array(out, FOUND_TYPE)}

    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item. Null and empty texts hold none; repeated rows share their
    fate; with an empty benchmark everything stays. Columns are those of ``docs``."""
    name = free_name(docs, "_leaks")
    return with_leaks(docs, benchmark, name).filter(F.size(name) == 0).drop(name)


@query()
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the benchmark items its text holds, how many, and the greatest similarity."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_leaks(docs, table(spark, sf_dir, "benchmark"), "leaks")
    return found.select(
        "doc_id",
        F.size("leaks").cast("long").alias("n_links"),
        F.array_sort(F.transform("leaks", lambda x: x["item_id"])).alias("item_ids"),
        F.array_max(F.transform("leaks", lambda x: x["similarity"])).alias("similarity"),
        (F.size("leaks") > 0).alias("contaminated"),
    )
