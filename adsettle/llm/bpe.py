"""Byte-level BPE by longest matches and backtracking.

The ranks of a vocabulary define greedy merging: the lowest-ranked adjacent pair merges first. The same result comes
without merging: take the longest token at a place, and keep it if it and the token before it could stand side by side
after merging, that is if undoing their last merges shows no pair that would have merged earlier across their border;
else try the next shorter token, and step back where none is left. Whether two tokens go together depends on these two
alone and is remembered. Every place is left at most once, so the work is linear in the length.

Vocabulary bytes are mapped to Latin-1 characters one to one, so that the automaton's characters are bytes. The
vocabulary is read on the driver and broadcast; its size is that of the file.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable
from itertools import chain
from operator import itemgetter

import ahocorasick
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession

from adsettle.llm.base import query, table, with_text_columns

#: Words and token pairs remembered in a Python worker, in two generations of words: when the younger is full, the
#: older is forgotten. Longer words than LONGEST aren't remembered.
REMEMBERED = 400_000
LONGEST = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank by token of a vocabulary file: a line per token, base64 and rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merged(token: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Greedy merging of the token's bytes by the ranks under ``below``."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 1:
        rank, place = min(
            (ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1)
        )
        if rank >= below:
            break
        parts[place : place + 2] = [parts[place] + parts[place + 1]]
    return parts


def split_table(ranks: dict[bytes, int]) -> list[tuple[bytes, int, int, int]]:
    """(token, id, left, right) in order of merging, left and right being places in this list.

    Single bytes come first and are their own halves. A token that merging its bytes never yields has -1 for both: it
    stands only for a piece that is equal to it, by the rule that whole tokens are taken as they are.
    """
    ordered = sorted(ranks, key=lambda t: (len(t) > 1, ranks[t]))
    place = {t: i for i, t in enumerate(ordered)}
    out = []
    for i, token in enumerate(ordered):
        if len(token) == 1:
            halves = (i, i)
        else:
            parts = merged(token, ranks, ranks[token])
            halves = (place[parts[0]], place[parts[1]]) if len(parts) == 2 else (-1, -1)
        out.append((token, ranks[token], *halves))
    return out


class Codec:
    """Encodes and decodes with one vocabulary. Not shared between processes."""

    def __init__(self, splits: list[tuple[bytes, int, int, int]], pattern: str):
        self.find = regex.compile(pattern).findall
        by_id = {i: token for token, i, _, _ in splits}
        self.bytes_of_id = [by_id.get(i) for i in range(max(by_id) + 1)]
        self.text_of_id = [str(i) for i in range(max(by_id) + 1)]
        self.id_of_bytes = {token: i for token, i, _, _ in splits}
        self.ids = [i for _, i, _, _ in splits]
        self.lengths = [len(token) for token, _, _, _ in splits]
        self.left = [left for _, _, left, _ in splits]
        self.right = [right for _, _, _, right in splits]
        usable = {token: i for i, (token, _, left, _) in enumerate(splits) if left >= 0}
        missing = [b for b in range(256) if bytes([b]) not in usable]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.merge = {
            (left, right): i for i, (_, _, left, right) in enumerate(splits) if left >= 0 and left != i
        }
        self.shorter = [-1] * len(splits)
        for token, i in usable.items():
            for n in range(len(token) - 1, 0, -1):
                if token[:n] in usable:
                    self.shorter[i] = usable[token[:n]]
                    break
        self.automaton = ahocorasick.Automaton()
        for token, i in usable.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def goes_with(self, first: int, second: int) -> bool:
        """Whether greedy merging can leave the two tokens side by side."""
        known = self.compatible.get((first, second))
        if known is not None:
            return known
        a, b, limit, merge = first, second, len(self.ids), self.merge
        while True:
            if merge.get((a, b), limit) < limit:
                found = False
                break
            # Undo the later of the two merges next to the border.
            if a > b:
                half, edge = self.right[a], a
                if half != a:
                    a, limit = half, edge
                    continue
                half = self.left[b]
                if half == b:
                    found = True
                    break
                b, limit = half, b + 1
            else:
                half, edge = self.left[b], b + 1
                if half != b:
                    b, limit = half, edge
                    continue
                half = self.right[a]
                if half == a:
                    found = True
                    break
                a, limit = half, a
        if len(self.compatible) >= REMEMBERED:
            self.compatible.clear()
        self.compatible[first, second] = found
        return found

    def piece(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one piece."""
        whole = self.id_of_bytes.get(piece)
        if whole is not None:
            return (whole,)
        text, lengths, known, shorter = piece.decode("latin-1"), self.lengths, self.compatible, self.shorter
        size = len(text)
        longest = [-1] * (size + 1)
        for end, token in self.automaton.iter(text):  # by end, so the last to write a start is the longest
            longest[end - lengths[token] + 1] = token
        dead: set[int] = set()
        chosen: list[int] = []
        at, before, token = 0, -1, longest[0]
        while at < size:
            while token >= 0:
                end = at + lengths[token]
                if end not in dead:
                    if before < 0:
                        break
                    fits = known.get((before, token))
                    if fits or fits is None and self.goes_with(before, token):
                        break
                token = shorter[token]
            if token >= 0:
                chosen.append(token)
                at, before, token = end, token, longest[end]
            else:  # nothing goes on from here
                dead.add(at)
                token = chosen.pop()
                at -= lengths[token]
                before = chosen[-1] if chosen else -1
        ids = self.ids
        return tuple([ids[t] for t in chosen])

    def word(self, word: str) -> tuple[int, ...]:
        """The ids of a space and ``word``, which neither begins nor ends with white space, within a text."""
        ids = self.old.get(word)
        if ids is None:
            if word.isascii() and word.isalpha():
                ids = self.piece(b" " + word.encode())
            else:
                made: list[int] = []
                for piece in self.find(" " + word):
                    part = self.known.get(piece[1:]) if piece[0] == " " else None
                    made.extend(part or self.piece(piece.encode()))
                ids = tuple(made)
        if len(word) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.old, self.known = self.known, {}
            self.known[word] = ids
        return ids

    def plain(self, text: str) -> list[int]:
        return list(chain.from_iterable([self.piece(x.encode()) for x in self.find(text)]))

    def encode(self, text: str) -> list[int]:
        """The ids of a text, each match of the pattern by itself.

        A space with no white space on either side always begins a match, so the text is cut there and the words'
        ids are remembered. The pattern is taken to have this property, as those of byte-level vocabularies do.
        """
        words = text.split(" ")
        found = list(map(self.known.get, words))
        found[0] = self.plain(words[0])
        if words[0][-1:].isspace() or not words[0]:
            return self.encode_loose(words)
        at = 0
        try:
            while True:
                at = found.index(None, at + 1)
                word = words[at]
                if not word or word[0].isspace() or word[-1].isspace():
                    return self.encode_loose(words)
                found[at] = self.word(word)
        except ValueError:
            return list(chain.from_iterable(found))

    def encode_loose(self, words: list[str]) -> list[int]:
        """As encode, where white space stands beside some of the spaces: such words stay together."""
        runs: list[list[str]] = [[words[0]]]
        for word in words[1:]:
            left = runs[-1][-1]
            if not word or word[0].isspace() or not left or left[-1].isspace():
                runs[-1].append(word)
            else:
                runs.append([word])
        texts = [" ".join(run) for run in runs]
        out = self.plain(texts[0])
        for text in texts[1:]:
            if text[-1].isspace():  # the end of the whole text
                out.extend(self.plain(" " + text))
            else:
                out.extend(self.known.get(text) or self.word(text))
        return out

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) < 2:
            return b"".join([self.bytes_of_id[i] for i in ids])
        return b"".join(itemgetter(*ids)(self.bytes_of_id))

    def digest(self, ids: list[int]) -> str:
        """Hexadecimal SHA-256 of the decimal ids, joined by commas."""
        texts = itemgetter(*ids)(self.text_of_id) if len(ids) > 1 else map(str, ids)
        return hashlib.sha256(",".join(texts).encode()).hexdigest()


_CODECS: dict[tuple, Codec] = {}


def codec(shared: Broadcast) -> Codec:
    """The codec of a broadcast vocabulary, built once in a Python worker."""
    splits, pattern = shared.value
    key = (hash(tuple(splits[:: max(1, len(splits) // 97)])), len(splits), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(splits, pattern)
    return _CODECS[key]


def share(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """A vocabulary for the tasks. Its file is read here, on the driver, and needs to be nowhere else."""
    return spark.sparkContext.broadcast((split_table(read_ranks(path)), pattern))


def encode(df: DataFrame, shared: Broadcast, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of a text column as ``array<int>``. A null text counts as empty: no ids. Whole texts are
    encoded whatever their length; rows are neither moved nor merged."""

    def rows(texts: list[bytes | None]) -> dict[str, pa.Array]:
        c = codec(shared)
        made = [c.encode(t.decode()) if t else [] for t in texts]
        return {ids: pa.array(made, pa.list_(pa.int32()))}

    return with_text_columns(df, text, f"`{ids}` array<int>", rows)


def decode(df: DataFrame, shared: Broadcast, ids: str = "ids", content: str = "content") -> DataFrame:
    """``df`` with the bytes of an id column. A null list gives null; an unknown id fails the task."""
    names = df.columns
    place = names.index(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            c = codec(shared)
            made = [None if x is None else c.decode(x) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.binary())], names=[*names, content]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{content}` binary")


def digests(docs: DataFrame, shared: Broadcast, with_ids: bool = False) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_tokens and the digests of the ids and of the bytes they decode to.

    Ids live no longer than their text's turn in a task, unless ``with_ids`` asks for them in a column. A null or
    empty text has no tokens and the digests of nothing. Repeated rows give repeated results; other columns are left
    out.
    """

    def rows(texts: list[bytes | None]) -> dict[str, pa.Array]:
        c = codec(shared)
        n, of_ids, of_bytes, lists = [], [], [], []
        for t in texts:
            ids = c.encode(t.decode()) if t else []
            n.append(len(ids))
            of_ids.append(c.digest(ids))
            of_bytes.append(hashlib.sha256(c.decode(ids)).hexdigest())
            if with_ids:
                lists.append(pa.array(ids, pa.int32()))
        made = {
            "n_tokens": pa.array(n, pa.int64()),
            "ids_sha256": pa.array(of_ids, pa.string()),
            "decoded_sha256": pa.array(of_bytes, pa.string()),
        }
        if with_ids:
            made["ids"] = pa.array([x.to_numpy() for x in lists], pa.list_(pa.int32()))
        return made

    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return with_text_columns(docs.select("doc_id", "text"), "text", added, rows).drop("text")


@query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded by the multi-language ranks, and decoded again."""
    import public_tokenizers as P

    shared = share(spark, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    return digests(table(spark, sf_dir, "documents"), shared)
