"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are hashed n-grams of one to three characters, weighted by TF-IDF and scaled to length one.
Document frequencies are counted over all rows the model may learn from. The weights are fitted to a
bounded sample of these rows by follow-the-regularised-leader with elastic-net penalties, which sets
most of them to zero, and a temperature fitted to rows kept apart makes the scores probabilities.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.byte_bpe import plain_rows, text_batches

#: Slots of the hashed features.
SLOTS = 1 << 15
#: Rows of each language that the weights are fitted to, about; every fifth of them sets the temperature,
#: where a language has so many that enough are left to learn it from.
PER_LANGUAGE, ENOUGH = 1000, 20
EPOCHS = 2
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-4
CALIBRATION = 5
#: Characters taken at a time from a text, whatever its length.
PART = 1 << 20
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_SALTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def counts(text: str) -> np.ndarray:
    """How often each slot occurs in the text: lower-case n-grams, with a space before and after."""
    out = np.zeros(SLOTS, np.float32)
    for at in range(0, max(1, len(text)), PART):
        part = text[max(0, at - 2) : at + PART].lower()
        chars = np.frombuffer((part if at else " " + part).encode("utf-32-le", "replace"), np.uint32)
        skip = 2 if at else 0
        code = chars * _SALTS[0]
        for n in range(3):
            if n:
                code = code[:-1] * _SALTS[n] + chars[n:] * _SALTS[0]
                code ^= code >> np.uint32(15)
            fresh = code[max(0, skip - n) :]
            out += np.bincount(((fresh * _SALTS[2]) >> np.uint32(17)).astype(np.int64), minlength=SLOTS)
    return out


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # slots by languages
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, slot_counts: np.ndarray) -> np.ndarray:
        x = slot_counts * self.idf
        norm = float(np.sqrt(x @ x)) or 1.0
        return (x @ self.weights) / norm + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its probability; undetermined without letters or without any language."""
        if not text or not self.languages or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        p = _softmax(self.logits(counts(text)) / self.temperature)
        best = int(p.argmax())  # of equal scores the first in alphabetical order
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_weights(rows: list[tuple[int, np.ndarray, np.ndarray]], n_languages: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases for rows of (language, slots, values), by FTRL-proximal, row after row."""
    z, n = np.zeros((SLOTS + 1, n_languages)), np.zeros((SLOTS + 1, n_languages))

    def weights(at: np.ndarray) -> np.ndarray:
        zs, penalty = z[at], np.where(at == SLOTS, 0.0, L1)[:, None]
        w = -(zs - np.sign(zs) * penalty) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zs) <= penalty, 0.0, w)

    for _ in range(epochs):
        for language, slots, values in rows:
            at, x = np.append(slots, SLOTS), np.append(values, 1.0)  # the last slot is the bias
            w = weights(at)
            error = _softmax(x @ w)
            error[language] -= 1.0
            g = x[:, None] * error
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    w = weights(np.arange(SLOTS + 1))
    return w[:-1].astype(np.float32), w[-1].astype(np.float32)


def fit_temperature(logits: np.ndarray, languages: np.ndarray) -> float:
    """The temperature under which the right languages are likeliest, by golden section on its log."""
    if not len(languages):
        return 1.0

    def loss(log_t: float) -> float:
        return float(-np.log(_softmax(logits / np.exp(log_t))[np.arange(len(languages)), languages] + 1e-12).mean())

    low, high, ratio = np.log(0.02), np.log(10.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, n = np.zeros(SLOTS, np.int64), 0
    for _, texts in text_batches(batches):
        for text in texts:
            found += counts(text) > 0
            n += 1
    if n:
        slots = np.append(np.nonzero(found)[0], SLOTS)  # the last slot counts the rows
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(np.append(found[slots[:-1]], n))], ["slot", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column("text"):
            c = counts(text.as_py() or "")
            slots = np.nonzero(c)[0]
            out.append((slots.astype("<i4").tobytes(), c[slots].astype("<f4").tobytes()))
        columns = [batch.column("lang"), batch.column("doc_id"), *(pa.array(x, pa.binary()) for x in (zip(*out) if out else ((), ())))]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "doc_id", "slots", "values"])


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model of ``docs`` (doc_id, text, lang), from rows with id and language that are not held out.

    The sample is chosen by a hash of the id, per language, so it is the same in every run and never
    grows with the table; what comes to the driver are its features and one count per slot.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = known.groupBy("lang").count().collect()  # as the weights, one column per language
    languages = sorted(r.lang for r in sizes)
    found = known.select("doc_id", "text").mapInArrow(_frequencies, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(SLOTS + 1)
    frequency[found["slot"].to_numpy()] = found["n"].to_numpy()
    idf = (np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1).astype(np.float32)
    if not languages:
        return Model([], idf, np.zeros((SLOTS, 0), np.float32), np.zeros(0, np.float32))

    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).cast("double") / float(1 << 30)
    shares = F.from_json(F.lit(json.dumps({r.lang: per_language / r["count"] for r in sizes})), "map<string, double>")
    sample = known.where(share < F.element_at(shares, F.col("lang"))).select("lang", "doc_id", "text").mapInArrow(_features, "lang string, doc_id long, slots binary, values binary").toPandas()
    number = {name: i for i, name in enumerate(languages)}
    taken = sample["lang"].value_counts()
    fitted, apart = [], []
    for row in sample.sort_values(["doc_id", "lang"], kind="stable").itertuples():
        slots = np.frombuffer(row.slots, "<i4")
        x = np.frombuffer(row.values, "<f4") * idf[slots]
        entry = (number[row.lang], slots, x / (np.linalg.norm(x) or 1.0))
        (apart if taken[row.lang] >= ENOUGH and _mixed(row.doc_id) % CALIBRATION == 0 else fitted).append(entry)
    order = np.random.default_rng(0).permutation(len(fitted))
    weights, bias = fit_weights([fitted[i] for i in order], len(languages))
    model = Model(languages, idf, weights, bias)
    if apart:
        logits = np.array([x @ weights[slots] + bias for _, slots, x in apart])
        model.temperature = fit_temperature(logits, np.array([language for language, _, _ in apart]))
    return model


def _mixed(doc_id: int) -> int:
    return doc_id * 2654435761 % 2**32 >> 7


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, one row per row of ``docs``, from the whole text alone.

    * NULL and empty texts, and texts without a letter, are undetermined with score 0; so is every
      text where there was nothing to learn from.
    * Otherwise score is the calibrated probability of lang_pred among the learned languages.
    * Repeated rows give repeated rows, an empty table none. A NULL doc_id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # slots x languages at most, whatever the table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_batches(batches):
            languages, scores = zip(*map(shared.value.predict, texts)) if texts else ((), ())
            yield pa.RecordBatch.from_arrays([ids, pa.array(languages, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    found = plain_rows(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, model: Model, min_score: float) -> DataFrame:
    """The rows of ``docs`` whose language is determined with ``min_score`` or more, with all columns.

    Decided where the row is read, so nothing is joined or shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(x.as_py()) for x in batch.column("text")]
            yield batch.filter(pa.array([name != UNDETERMINED and score >= min_score for name, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predicted(docs, fit(docs))
