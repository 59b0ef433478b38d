"""Language of a text from averaged hashed subword embeddings.

A text becomes the mean of the vectors of its character sequences of one to four letters inside words,
hashed into ``BUCKETS`` rows of a table; a linear softmax over that mean gives the languages. Table and
softmax are trained by stochastic gradient descent in numpy at the driver, from hashed counts that the
executors make of a bounded sample of labelled texts. Part of the sample is kept from training and sets
the temperature of the softmax and, per language, the score below which a prediction is not accepted.

Sample: about ``per_language`` texts of each lang value, chosen by a hash of the id among all rows with a
text and a lang outside the held-out fold.

Results for special inputs: texts that are null or without letters are ``und`` with score 0; texts are read
whole; rows with a null id are predicted and never learned from; repeated rows give repeated rows; an empty
table, or one without labelled rows, predicts ``und``; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import batched, byte_texts, hash_sample, in_fold

BUCKETS = 1 << 13
UNKNOWN = "und"
PASS_BYTES = 1 << 20
_SALTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint64)


def _is_letter() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


_LETTERS: list[np.ndarray] = []


def hashed_counts(texts: list[str]) -> Iterator[np.ndarray]:
    """For each text, how often its letter sequences fall into each bucket (an empty array: no letters)."""
    if not _LETTERS:
        _LETTERS.append(_is_letter())
    joined = "\n".join(t.lower() for t in texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype="<u4")
    lengths = [len(t.lower()) + 1 for t in texts]
    letter = _LETTERS[0][codes]
    # A word's letters stand between marks, so that beginnings and ends differ from the middle.
    symbol = np.where(letter, codes, 1).astype(np.uint64)
    rolling = np.zeros(len(codes) + 4, dtype=np.uint64)
    rolling[: len(codes)] = symbol
    buckets = []
    key = np.zeros(len(codes), dtype=np.uint64)
    inside = np.ones(len(codes), dtype=bool)
    for size in range(4):
        # A sequence may begin with a mark and end with one, but not run over one.
        if size > 1:
            inside = inside & np.concatenate([letter[size - 1 :], np.zeros(size - 1, dtype=bool)])
        key = (key * np.uint64(0x100000001B3)) ^ rolling[size : size + len(codes)]
        mixed = (key + _SALTS[size]) * np.uint64(0xFF51AFD7ED558CCD)
        hashed = (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)
        use = letter if size == 0 else inside & (letter | np.concatenate([letter[1:], [False]]))
        buckets.append(np.where(use, hashed, BUCKETS))
    start = 0
    for length in lengths:
        part = [b[start : start + length - 1] for b in buckets]
        seen = letter[start : start + length - 1].any()
        start += length
        yield np.bincount(np.concatenate(part), minlength=BUCKETS + 1)[:BUCKETS] if seen else np.zeros(0, np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """Languages, the table already multiplied with the softmax weights, and the calibration."""

    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    bias: np.ndarray
    temperature: float
    least: np.ndarray  # per language, the score that is accepted

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        out = []
        for counts in hashed_counts(texts):
            if not len(counts) or not self.languages:
                out.append((UNKNOWN, 0.0, False))
                continue
            p = softmax((counts / counts.sum()) @ self.weights + self.bias, self.temperature)
            best = int(p.argmax())
            out.append((self.languages[best], float(p[best]), bool(p[best] >= self.least[best])))
        return out


def softmax(logits: np.ndarray, temperature: float = 1.0) -> np.ndarray:
    x = logits / temperature
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: list[str], dimensions: int = 16, epochs: int = 12, rate: float = 40.0, reject_share: float = 0.01, seed: int = 2) -> LanguageModel:
    """Gradient descent over texts given as (buckets, counts, language number)."""
    pick = np.random.default_rng(seed)
    kinds = len(languages)
    table = pick.normal(0, 1 / dimensions, (BUCKETS, dimensions)).astype(np.float32)
    head = np.zeros((dimensions, kinds), dtype=np.float32)
    bias = np.zeros(kinds, dtype=np.float32)
    order = pick.permutation(len(rows))
    kept = order[: max(1, len(rows) // 5)] if len(rows) >= 20 else order
    learn = order[len(rows) // 5 :] if len(rows) >= 20 else order
    shares = [(b, (c / c.sum()).astype(np.float32)) for b, c, _ in rows]
    head[:] = pick.normal(0, 0.1, head.shape)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in pick.permutation(learn):
            (at, share), kind = shares[i], rows[i][2]
            mean = share @ table[at]
            error = softmax(mean @ head + bias)
            error[kind] -= 1
            slope = head @ error
            head -= 0.01 * step * np.outer(mean, error)
            bias -= 0.001 * step * error
            table[at] -= step * share[:, None] * slope
    weights = (table @ head).astype(np.float64)
    logits = np.stack([shares[i][1] @ weights[rows[i][0]] + bias for i in kept])
    truth = np.array([rows[i][2] for i in kept])
    temperatures = np.geomspace(0.05, 20, 60)
    losses = [-np.log(np.maximum(softmax(logits, t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in temperatures]
    temperature = float(temperatures[int(np.argmin(losses))])
    p = softmax(logits, temperature)
    right = p.argmax(axis=1) == truth
    least = np.zeros(kinds)
    for kind in range(kinds):
        scores = p[right & (truth == kind), kind]
        least[kind] = np.quantile(scores, reject_share) if len(scores) else 0.5
    return LanguageModel(languages, weights, bias.astype(np.float64), temperature, least)


def learn(docs: DataFrame, held_out: tuple[int, int] = (4, 2), per_language: int = 400, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> LanguageModel:
    """A model of the lang values of about ``per_language`` texts each."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"))
    usable = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~in_fold("id", *held_out))
    sample = hash_sample(usable, "lang", "id", per_language, seed=2).select("id", "lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            texts = [x.decode("utf-8", "replace") for x in byte_texts(batch.column(2))]
            counts = list(hashed_counts(texts))
            found = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([at.astype(np.int32) for at in found], pa.list_(pa.int32())),
                    pa.array([c[at].astype(np.int32) for c, at in zip(counts, found, strict=True)], pa.list_(pa.int32())),
                ],
                ["id", "lang", "buckets", "counts"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    # Bounded by the parameter: a row of at most BUCKETS counts per sampled text.
    table = sample.mapInArrow(count, f"id {kind}, lang string, buckets array<int>, counts array<int>").toArrow()
    found = sorted(zip(*(table[c].to_pylist() for c in ("lang", "id")), range(table.num_rows), strict=True))
    at = [table["buckets"][i].values.to_numpy() for _, _, i in found]
    counts = [table["counts"][i].values.to_numpy() for _, _, i in found]
    languages = sorted({lang for lang, _, _ in found})
    number = {lang: n for n, lang in enumerate(languages)}
    usable_rows = [(b, c, number[lang]) for b, c, (lang, _, _) in zip(at, counts, found, strict=True) if len(b)]
    if not usable_rows:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, np.zeros(0))
    return train(usable_rows, languages)


def identify(docs: DataFrame, model: LanguageModel, held_out: tuple[int, int] = (4, 2), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, held_out, lang_pred, score and accepted of every text."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            rows = model.predict([x.decode("utf-8", "replace") for x in byte_texts(batch.column(1))])
            columns = [
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.float64()),
                pa.array([r[2] for r in rows], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, accepted boolean")
    return out.select(F.col("id").alias(id_column), in_fold("id", *held_out).alias("held_out"), "lang_pred", "score", "accepted")
