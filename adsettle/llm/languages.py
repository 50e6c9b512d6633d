"""Language identification with a blended-spectrum string kernel.

A text is the set of its byte n-grams of 1 to 3 bytes, letters of A-Z lowered: k(x, z) is the number of n-grams both
have, divided by the root of the product of their numbers. Texts are compared with a few landmark texts only (Nyström):
their kernel values, whitened by the landmarks' own kernel matrix, are the features of one ridge regression per
language against the others. A batch of texts is scored by two matrix products.

Counted are the n-grams that stand in some training text; what is fitted is bounded for each language: even parts of TRAINED
texts and of LANDMARKS landmarks, but EACH texts and one landmark at least, and the GRAMS n-grams that most training texts
hold. Every language of the table is learned. Which texts are taken depends on a hash of doc_id and text alone. Every text is
scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adsettle.llm.base import free_name, query, table, with_text_columns

#: Training texts and landmarks, shared out among the languages; texts of each language at least; n-grams.
TRAINED = 2400
EACH = 8
LANDMARKS = 120
GRAMS = 6000
RIDGE = 1e-3
FOLDS = 5

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
LETTER = regex.compile(r"\p{L}")
#: n-grams have codes by length: 1 byte from 0, 2 bytes from 2**8, 3 bytes from 2**17.
CODES = (1 << 17) + (1 << 24)


def gram_codes(text: bytes) -> list[np.ndarray]:
    """Codes of all n-grams of a text, with repeats, an array per length."""
    b = np.frombuffer(text.translate(LOWER), dtype=np.uint8).astype(np.int32)
    two = (b[:-1] << 8) | b[1:]
    return [b, two + (1 << 8), ((two[:-1] << 8) | b[2:]) + (1 << 17)]


def gram_set(text: bytes) -> np.ndarray:
    return np.unique(np.concatenate(gram_codes(text)))


def has_letter(text: bytes) -> bool:
    head = text[:4096].decode(errors="ignore")
    return bool(LETTER.search(head) or len(text) > 4096 and LETTER.search(text.decode()))


@dataclass
class Model:
    languages: list[str]
    place: np.ndarray  # by n-gram code: its column, or the last column for those that aren't counted
    columns: int
    landmarks: np.ndarray  # landmark presence rows, divided by the root of their size
    weights: np.ndarray  # landmark kernel values (and 1) to a score per language

    def presence(self, texts: list[bytes]) -> np.ndarray:
        """Rows of n-gram presence, divided by the root of the number present."""
        seen = np.zeros((len(texts), self.columns + 1), dtype=np.float32)
        for row, text in zip(seen, texts):
            for codes in gram_codes(text):
                row[self.place[codes]] = 1
        seen = seen[:, : self.columns]
        seen /= np.sqrt(np.maximum(seen.sum(axis=1, keepdims=True), 1))
        return seen

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Texts by languages, in blocks of bounded size."""
        out = [np.zeros((0, len(self.languages)))]
        for at in range(0, len(texts), 512):
            kernel = self.presence(texts[at : at + 512]) @ self.landmarks.T
            out.append(np.column_stack([kernel, np.ones(len(kernel))]) @ self.weights)
        return np.concatenate(out)


def fit(grams: list[np.ndarray], langs: list[str]) -> Model | None:
    """A model from the n-gram sets of texts and their languages, or None without texts."""
    if not grams:
        return None
    languages = sorted(set(langs))
    counts = np.bincount(np.concatenate(grams), minlength=CODES)
    by_count = np.argsort(-counts, kind="stable")[:GRAMS]
    kept = np.sort(by_count[counts[by_count] > 0])
    place = np.full(CODES, len(kept), dtype=np.int16)
    place[kept] = np.arange(len(kept))
    seen = np.zeros((len(grams), len(kept) + 1), dtype=np.float32)
    for row, own in zip(seen, grams):
        row[place[own]] = 1
    seen = seen[:, : len(kept)]
    seen /= np.sqrt(np.maximum(seen.sum(axis=1, keepdims=True), 1))
    # landmarks: the languages in turn
    order: dict[str, list[int]] = {lang: [] for lang in languages}
    for i, lang in enumerate(langs):
        order[lang].append(i)
    each = max(1, LANDMARKS // len(languages))
    chosen = [i for lang in languages for i in order[lang][:each]]
    landmarks = seen[chosen]
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    solid = values > 1e-6 * values.max()
    whiten = vectors[:, solid] / np.sqrt(values[solid])
    features = np.column_stack([(seen @ landmarks.T) @ whiten, np.ones(len(seen))])
    targets = np.where(np.array(langs)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # each language weighs the same, however many texts it has
    weight = np.array([1 / len(order[lang]) for lang in langs])[:, None] * len(langs) / len(languages)
    ridge = RIDGE * len(langs) * np.eye(features.shape[1])
    solved = np.linalg.solve(features.T @ (weight * features) + ridge, features.T @ (weight * targets))
    weights = np.vstack([whiten @ solved[:-1], solved[-1:]])
    return Model(languages, place, len(kept), landmarks, weights)


def training_rows(docs: DataFrame) -> DataFrame:
    """(lang, text) of the training texts: not held out, with text and lang; of each language those with the smallest
    hash of their doc_id, then of their text.

    The hash first leaves about twice as many per language as are wanted, in the scan; only then are they ranked, so
    that the ranking sees a bounded number of rows.
    """
    usable = docs.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").filter(
        F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0
    )
    counts = usable.groupBy("lang").count().orderBy("lang").collect()  # one row per language
    each = max(EACH, TRAINED // max(1, len(counts)))
    limits = [(r.lang, min((1 << 63) - 1, int((2 * each + 50) / r["count"] * (1 << 64)) - (1 << 63))) for r in counts]
    bounds = docs.sparkSession.createDataFrame(limits, "lang string, most long")
    near = usable.join(F.broadcast(bounds), "lang").filter(F.xxhash64("doc_id") <= F.col("most"))
    rank = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text")
    return near.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= each).select("lang", "text")


def train(docs: DataFrame) -> Model | None:
    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([gram_set(t).tolist() for t in texts], pa.list_(pa.int32()))],
                names=["lang", "grams"],
            )

    rows = training_rows(docs).mapInArrow(run, "lang string, grams array<int>").collect()
    rows.sort(key=lambda r: (r.lang, r.grams))
    return fit([np.array(r.grams, dtype=np.int32) for r in rows], [r.lang for r in rows])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (text and others) with lang_pred and score, or the first free names if ``docs`` has these: lang_pred_ and
    so on.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if there was nothing to learn
    from. Of languages with equal scores the first by name is taken. Repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(texts: list[bytes | None]) -> dict[str, pa.Array]:
        own = shared.value
        lang, score = ["und"] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if own and t and has_letter(t)]
        if known:
            values = own.scores([texts[i] for i in known])
            best = values.argmax(axis=1)
            for i, b, v in zip(known, best.tolist(), values.max(axis=1)):
                lang[i] = own.languages[b]
                score[i] = min(1.0, max(0.0, (1 + v) / 2))
        return {names[0]: pa.array(lang, pa.string()), names[1]: pa.array(score)}

    names = [free_name(docs, "lang_pred"), free_name(docs, "score")]
    return with_text_columns(docs, "text", f"`{names[0]}` string, `{names[1]}` double", rows)


@query()
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from four folds, the fifth held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )
