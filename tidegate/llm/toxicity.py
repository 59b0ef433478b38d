"""Toxic passages by maximum-scoring segments.

Features are words and their beginnings of several lengths, so that inflected forms count together. A
feature's score is its log-odds in toxic against clean texts under an informative Dirichlet prior (the
features of all texts of the sample, scaled to a share of its size), kept where it is significant. A word
scores as its most significant feature; a word without one costs a little, as the sample says. In a text, one linear scan finds all maximal scoring
segments. The score of a segment is compared with what chance gives in a text of that length, by extreme
value theory: with lambda the root of E[exp(lambda * score)] = 1 among clean words, lambda * score -
log(length) is its evidence. A logistic curve, fitted on the sampled texts that have such words, turns a
text's summed evidence into a probability; texts without any get the share of toxic ones among them.

Learning takes a sample of about ``per_label`` labelled texts of each label, chosen by a hash of the id
from all labelled rows outside the held-out fold. How often a word occurs counts families of texts, not
texts: texts with the same least hash over their five-word sequences are one family, so that copies don't
make their words look toxic.

Results for special inputs: null and empty texts score as texts without toxic words; texts are read whole;
rows with a null id are scored and never learned from; of several labels of one id the largest counts;
without labels of both kinds every text scores 0; repeated rows give repeated rows; an empty table gives an
empty result; other columns are ignored by ``score_texts`` and kept as they are by ``drop_toxic``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import batched, byte_texts, cut, hash_sample, in_fold, work_folder

PASS_BYTES = 4 << 20
#: Evidence of a text without any toxic word, whatever its length.
NO_EVIDENCE = -12.0
#: Bytes of the beginnings that are features.
LENGTHS = (4, 5, 6, 8)
PUNCTUATION = b".,;:!?\"'()[]{}<>*#$%&|"


@dataclass(frozen=True)
class ToxicModel:
    """Scores and significance of features, the cost of any other word, and the calibration."""

    features: dict[bytes, tuple[float, float]]  # z and score
    other: float
    scale: float  # lambda
    slope: float
    offset: float
    without: float  # score of a text without significant words

    @cached_property
    def heads(self) -> frozenset[bytes]:
        return frozenset(f[: LENGTHS[0]] for f in self.features)

    def word_score(self, word: bytes) -> float | None:
        found = [self.features[f] for f in word_features(word) if f in self.features]
        return max(found)[1] if found else None

    def evidence(self, text: bytes) -> tuple[float, int]:
        """Summed evidence of the significant segments, and how many there are."""
        tokens = text.lower().split()
        heads, size = self.heads, LENGTHS[0]
        words = [t.strip(PUNCTUATION) for t in tokens]
        likely = [i for i, w in enumerate(words) if w[:size] in heads]
        hits = [(i, s) for i in likely if (s := self.word_score(words[i])) is not None]
        chance = math.log(len(tokens) + 1)
        over = [self.scale * s - chance for s, _, _ in segments(hits, self.other)]
        strong = [x for x in over if x > 0]
        return (sum(strong) if strong else max(over, default=NO_EVIDENCE)), len(strong)

    def score(self, text: bytes) -> tuple[float, int]:
        evidence, passages = self.evidence(text)
        if evidence == NO_EVIDENCE:
            return self.without, 0
        x = self.slope * evidence + self.offset
        return (1 / (1 + math.exp(-x)) if x > -700 else 0.0), passages


def word_features(word: bytes) -> list[bytes]:
    """A word, and its beginnings (marked by a space after them) that are shorter than it."""
    return [word, *[word[:n] + b" " for n in LENGTHS if n < len(word)]]


def segments(hits: list[tuple[int, float]], other: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last) of a sequence given by its non-neutral positions.

    Positions between hits score ``other`` (negative). The scan keeps candidate segments with the sums
    before and up to them; a new one joins the last candidate that starts lower and ends lower, and merges
    on until no candidate is left to join. Each step removes a candidate, so the time is linear.
    """
    found: list[tuple[float, float, int, int]] = []  # sum before, sum up to, first, last
    total, at = 0.0, 0
    for position, score in hits:
        total += other * (position - at)
        at = position + 1
        if score <= 0:
            total += score
            continue
        before, first = total, position
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= before:
                j -= 1
            if j < 0 or found[j][1] >= total:
                break
            before, first = found[j][0], found[j][2]
            del found[j:]
        found.append((before, total, first, position))
    return [(upto - before, first, last) for before, upto, first, last in found]


def _family(words: list[bytes]) -> int:
    """The least hash over the five-word sequences of a text."""
    runs = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
    return min(xxhash.xxh64_intdigest(run) for run in runs) >> 1


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, family, toxic) for each feature of each sampled text."""
    for batch in batches:
        for text, toxic in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            words = [w for t in text.lower().split() if (w := t.strip(PUNCTUATION))]
            distinct = list({f for w in set(words) for f in word_features(w)})
            if not distinct:
                continue
            columns = [
                pa.array(distinct, pa.binary()),
                pa.array(np.full(len(distinct), _family(words), dtype=np.int64)),
                pa.array(np.full(len(distinct), toxic, dtype=np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["word", "family", "toxic"])


def _solve(shares: list[tuple[float, float]]) -> float:
    """The positive root of sum of share * exp(x * score) = 1."""
    low, high = 0.0, 1.0
    value = lambda x: sum(p * math.exp(min(700.0, x * s)) for s, p in shares) - 1
    while value(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by regularised Newton steps; classes weigh the same."""
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    design = np.stack([x, np.ones_like(x)], axis=1)
    theta = np.zeros(2)
    ridge = np.array([1e-3, 1e-3]) * len(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + ridge * theta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    held_out: tuple[int, int] = (3, 1),
    per_label: int = 2500,
    prior_share: float = 0.1,
    least_z: float = 3.5,
    seed: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> ToxicModel:
    """The model from a sample of about ``per_label`` texts of each label outside the held-out fold."""
    spark = docs.sparkSession
    marked = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("toxic"))
    usable = marked.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~in_fold("id", *held_out))
    one_each = usable.groupBy("id").agg(F.max("toxic").alias("toxic"))
    chosen = hash_sample(one_each, "toxic", "id", per_label, seed)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where(F.col("text").isNotNull())
    # The chosen ids are bounded by the parameter: about twice per_label rows.
    sample = cut(texts.join(F.broadcast(chosen), "id").select("text", "toxic"), work_folder(spark), "sample")

    rows = sample.mapInArrow(_word_rows, "word binary, family long, toxic int")
    counted = (
        rows.distinct()
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("both"))
        .where(F.col("both") > 1)
    )
    totals = counted.agg(F.sum("toxic").alias("toxic"), F.sum("both").alias("both")).first()
    n_toxic, n_both = totals["toxic"] or 0, totals["both"] or 0
    n_clean = n_both - n_toxic
    if not n_toxic or not n_clean:
        return ToxicModel({}, 0.0, 1.0, 0.0, 0.0, 0.0)
    prior = prior_share * n_both
    alpha = F.col("both") * (prior / n_both)
    in_toxic, in_clean = F.col("toxic") + alpha, F.col("both") - F.col("toxic") + alpha
    odds = F.log(in_toxic / (n_toxic + prior - in_toxic)) - F.log(in_clean / (n_clean + prior - in_clean))
    scored = counted.select("word", "toxic", "both", odds.alias("odds"), (odds / F.sqrt(1 / in_toxic + 1 / in_clean)).alias("z"))
    # Bounded by the sample: at most its distinct words.
    kept = scored.where(F.col("z") >= least_z).collect()
    features = {bytes(r["word"]): (float(r["z"]), float(r["odds"])) for r in kept}
    if not features:
        return ToxicModel({}, 0.0, 1.0, 0.0, 0.0, 0.0)
    hits_toxic = sum(r["toxic"] for r in kept)
    hits_clean = sum(r["both"] - r["toxic"] for r in kept)
    share_toxic, share_clean = hits_toxic / n_toxic, (hits_clean + 0.5) / (n_clean + 1)
    other = min(-0.02, math.log((1 - min(share_toxic, 0.9)) / (1 - share_clean)))
    by_score = Counter(round(s, 2) for _, s in features.values())
    shares = [(s, share_clean * n / len(features)) for s, n in by_score.items()] + [(other, 1 - share_clean)]
    raw = ToxicModel(features, other, _solve(shares), 1.0, 0.0, 0.0)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [raw.evidence(text)[0] for text in byte_texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), batch.column(1)], ["x", "toxic"])

    # One number per sampled text.
    pairs = sample.mapInArrow(weigh, "x double, toxic int").toArrow()
    x, y = pairs["x"].to_numpy(), pairs["toxic"].to_numpy()
    order = np.lexsort((y, x))  # sums don't depend on the order of arrival
    x, y = x[order], y[order]
    with_words = x > NO_EVIDENCE
    slope, offset = _logistic(x[with_words], y[with_words].astype(float))
    without = float((y[~with_words].sum() + 0.5) / ((~with_words).sum() + 1))
    return ToxicModel(features, other, raw.scale, max(slope, 0.0), offset, min(without, 0.5))


def score_texts(docs: DataFrame, model: ToxicModel, held_out: tuple[int, int] = (3, 1), threshold: float = 0.7, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, held_out, score, predicted and passages (significant toxic segments) of every text."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            rows = [model.score(text) for text in byte_texts(batch.column(1))]
            columns = [pa.array([s for s, _ in rows], pa.float64()), pa.array([n for _, n in rows], pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "score", "passages"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, score double, passages int")
    return out.select(
        F.col("id").alias(id_column),
        in_fold("id", *held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "passages",
    )


def drop_toxic(docs: DataFrame, model: ToxicModel, threshold: float = 0.7, text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores below the threshold."""
    text_at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            keep = [model.score(text)[0] < threshold for text in byte_texts(batch.column(text_at))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
