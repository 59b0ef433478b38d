"""Quality of texts by counting rules and by divergence from language references.

A reference holds, per language, the shares of character classes and of the common words among all words of
all its documents. A text is compared with every language; that with the nearest common words is its own. It
is rejected when its character classes, or its common words, are farther from that reference than a
threshold, as Jensen-Shannon distance (the square root of the divergence in bits, 0 to 1). Texts too short
for a histogram to mean much are not judged by it: the guards are a number of words and of characters.

How far common words may be depends on the language and on the length: the fewer words, the more their shares
scatter. For each language and length band the threshold is a high quantile of the distances of all its own
documents, from counts per thousandth of distance, but always below ``most_of_none`` of the distance that a text
without any common word has; so such a text is rejected whatever share of a language its common words are. A text
whose lang has no reference is not judged by words.

Common words are those with at least ``word_share`` of a language's words, counted over all documents. A
word that common in a language is nearly as common in some batch of it, so batches name candidates in a
first pass, and a second counts the candidates exactly: what is gathered is bounded by the share, not by the
vocabulary. Languages with less than ``language_share`` of all words get no reference, which bounds their
number.

Results for special inputs: null and empty texts have no words, count 0 everywhere and fail the base rule;
rows without lang count for no reference but are judged like others; without any reference only the base
rule decides; of equally near languages the first by name is taken; texts of any length count whole; repeated rows give repeated rows; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import batched, byte_texts, cut, work_folder
from tidegate.llm.words import mix, word_hashes

PASS_BYTES = 1 << 20
SYMBOLS = b"#*$%&|<>"
#: Words at which length bands begin; shorter texts are in the first.
BANDS = (50, 100, 200, 400, 800, 1600)
#: Steps of distance that thresholds are counted in.
STEPS = 1000
#: Character classes of bytes; continuation bytes of UTF-8 count for none.
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "symbol", "other", "control", "wide")


def _class(byte: int) -> int:
    c = chr(byte)
    if byte >= 0xC0:
        return CLASSES.index("wide")
    if byte >= 0x80:
        return len(CLASSES)
    if c.isalpha():
        return CLASSES.index("lower" if c.islower() else "upper")
    named = {"digit": "0123456789", "space": " \t", "line": "\n\r", "stop": ".,;:!?'\"()-", "symbol": SYMBOLS.decode()}
    for name, members in named.items():
        if c in members:
            return CLASSES.index(name)
    return CLASSES.index("control" if byte < 32 or byte == 127 else "other")


_CLASS = np.array([_class(b) for b in range(256)], dtype=np.uint8)


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]


def repeated_words(hashes: np.ndarray, at: np.ndarray, size: int = 5) -> np.ndarray:
    """For each text, its words in windows of ``size`` words that occur at least twice in it."""
    covered = np.zeros(len(hashes) + 1, dtype=np.int64)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    if len(hashes) >= size:
        count = len(hashes) - size + 1
        key = mix(owner[:count].astype(np.uint64))
        for i in range(size):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + count])
        inside = np.flatnonzero(owner[:count] == owner[size - 1 :])
        key = key[inside]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        begins = inside[twice]
        np.add.at(covered, begins, 1)
        np.add.at(covered, begins + size, -1)
    marks = np.concatenate([[0], np.cumsum(np.cumsum(covered)[:-1] > 0)])
    return marks[at[1:]] - marks[at[:-1]]


def base_counts(texts: list[bytes]) -> dict[str, list[int]]:
    """The counts of the base rules for each text."""
    hashes, at = word_hashes(texts, exact=True)
    chars, symbols, lines = [], [], []
    for text in texts:
        joined = np.frombuffer(b"".join(text.split()), np.uint8)
        chars.append(int(np.count_nonzero(joined & 0xC0 != 0x80)))
        symbols.append(sum(text.count(bytes([s])) for s in SYMBOLS))
        full = [line for line in text.split(b"\n") if line.strip()]
        lines.append(len(full) - len(set(full)))
    return {
        "n_words": np.diff(at).tolist(),
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": lines,
        "n_repeat_words": repeated_words(hashes, at).tolist(),
    }


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance along the last axis."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return np.sqrt(np.clip(terms.sum(axis=-1) / 2, 0, 1))


@dataclass(frozen=True)
class References:
    """Per language the class shares, and the shares of its common words with the rest as last bin."""

    languages: list[str]
    classes: np.ndarray  # languages x classes
    number: dict[bytes, int]  # common word of any language -> column
    columns: np.ndarray  # languages x most words of a language; len(number): unused
    shares: np.ndarray  # languages x (most words + 1)
    limits: np.ndarray | None = None  # languages x BANDS: largest distance of common words

    def distances(self, text: bytes) -> tuple[str | None, float, float]:
        """Nearest language, distance of its words, distance of its character classes."""
        words = text.lower().split()
        if not self.languages or not words:
            return None, 0.0, 0.0
        find = self.number
        found = np.bincount([find[w] for w in words if w in find], minlength=len(find) + 1)
        own = found[self.columns] / len(words)
        own = np.concatenate([own, 1 - own.sum(axis=1, keepdims=True)], axis=1)
        apart = distance(own, self.shares)
        best = int(apart.argmin())
        counts = class_counts(text)
        return self.languages[best], float(apart[best]), float(distance(counts / counts.sum(), self.classes[best]))

    def limit(self, language: str | None, words: int) -> float:
        """The largest distance of common words that a text of so many words may have."""
        if language is None or self.limits is None:
            return 1.0
        return float(self.limits[self.languages.index(language), band(words)])

    def without(self) -> np.ndarray:
        """Per language the distance of a text that has none of its common words."""
        none = np.zeros_like(self.shares)
        none[:, -1] = 1
        return distance(none, self.shares)


def band(words: int) -> int:
    """The length band of a text."""
    return bisect_right(BANDS, words) - 1 if words >= BANDS[0] else 0


def learn(docs: DataFrame, word_share: float = 0.002, language_share: float = 0.001, text_column: str = "text", lang_column: str = "lang", quantile: float = 0.999, most_of_none: float = 0.985) -> References:
    """References from all rows with a lang and a text."""
    folder = work_folder(docs.sparkSession)
    rows = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    slack = word_share / 10

    def by_language(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
        found: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
            found.setdefault(lang, []).append(text)
        return found

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            out = []
            for lang, texts in by_language(batch).items():
                words = Counter()
                for text in texts:
                    words.update(text.lower().split())
                total = words.total()
                out += [(lang, "w", w, n) for w, n in words.items() if n >= slack * total]
                classes = sum(class_counts(t) for t in texts)
                out += [(lang, "c", str(i).encode(), int(n)) for i, n in enumerate(classes)]
                out.append((lang, "n", b"", total))
            yield _rows(out)

    schema = "lang string, kind string, word binary, n long"
    parts = rows.mapInArrow(gather, schema).groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    parts = cut(parts, folder, "parts")
    totals = parts.where("kind = 'n'").select("lang", F.col("n").alias("total"))
    everything = totals.agg(F.sum("total")).first()[0] or 0
    # At most 1 / language_share rows.
    sizes = {r["lang"]: r["total"] for r in totals.where(F.col("total") >= max(1, language_share * everything)).collect()}
    big = parts.where(F.col("lang").isin(list(sizes))).join(totals, "lang")
    classes = big.where("kind = 'c'").collect()
    # A word of the share lacks at most the slack of each batch: at most 1 / (0.9 * word_share) per language.
    likely = big.where("kind = 'w'").where(F.col("n") >= (word_share - slack) * F.col("total")).collect()
    wanted: dict[str, set[bytes]] = {lang: set() for lang in sizes}
    for r in likely:
        wanted[r["lang"]].add(bytes(r["word"]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            out = []
            for lang, texts in by_language(batch).items():
                words, mine = Counter(), wanted.get(lang)
                for text in texts if mine else ():
                    words.update(w for w in text.lower().split() if w in mine)
                out += [(lang, "w", w, n) for w, n in words.items()]
            yield _rows(out)

    exact = rows.mapInArrow(count, schema).groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()
    languages = sorted(sizes)
    common = {lang: [] for lang in languages}
    for r in exact:
        if r["n"] >= word_share * sizes[r["lang"]]:
            common[r["lang"]].append((bytes(r["word"]), r["n"] / sizes[r["lang"]]))
    number = {w: i for i, w in enumerate(sorted({w for words in common.values() for w, _ in words}))}
    most = max((len(words) for words in common.values()), default=0)
    columns = np.full((len(languages), most), len(number), dtype=np.int64)
    shares = np.zeros((len(languages), most + 1))
    by_class = np.zeros((len(languages), len(CLASSES)))
    for i, lang in enumerate(languages):
        for j, (word, share) in enumerate(sorted(common[lang])):
            columns[i, j], shares[i, j] = number[word], share
        shares[i, -1] = 1 - shares[i].sum()
    for r in classes:
        by_class[languages.index(r["lang"]), int(r["word"])] = r["n"]
    by_class /= np.maximum(1, by_class.sum(axis=1, keepdims=True))
    return _with_limits(rows, References(languages, by_class, number, columns, shares), quantile, most_of_none)


def _with_limits(rows: DataFrame, references: References, quantile: float, most_of_none: float) -> References:
    """Thresholds from the distances of all documents of a language, counted per language, band and step."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            found: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                if lang in known and (words := len(text.split())) >= BANDS[0]:
                    nearest, apart, _ = references.distances(text)
                    if nearest == lang:
                        found[lang, band(words), int(apart * STEPS)] += 1
            keys = list(found)
            columns = [pa.array([k[i] for k in keys], kind) for i, kind in enumerate([pa.string(), pa.int32(), pa.int32()])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(found.values()), pa.int64())], names)

    known, names = set(references.languages), ["lang", "band", "step", "n"]
    limits = np.repeat(most_of_none * references.without()[:, None], len(BANDS), axis=1)
    # At most STEPS rows per band and language.
    counted = rows.mapInArrow(count, "lang string, band int, step int, n long").groupBy("lang", "band", "step")
    sums: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for r in counted.agg(F.sum("n").alias("n")).collect():
        sums.setdefault((r["lang"], r["band"]), []).append((r["step"], r["n"]))
    for (lang, number), steps in sums.items():
        total, below = sum(n for _, n in steps), 0
        for step, n in sorted(steps):
            below += n
            if below >= quantile * total:
                at = references.languages.index(lang), number
                limits[at] = min(limits[at], (step + 1) / STEPS)
                break
    return replace(references, limits=limits)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.binary(), pa.int64()]
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["lang", "kind", "word", "n"])


def judge(
    docs: DataFrame,
    references: References,
    most_class_distance: float = 0.30,
    least_words: int = 50,
    least_chars: int = 200,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """id, the base counts, base_failed, kept, nearest language, both distances and the limit of words of every text."""
    kind = docs.schema[id_column].dataType.simpleString()
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            texts = byte_texts(batch.column(1))
            base = base_counts(texts)
            nearest = [references.distances(t) for t in texts]
            langs = batch.column(2).to_pylist()
            limits = [
                references.limit(near[0] if lang is None or lang in known else None, words)
                for near, lang, words in zip(nearest, langs, base["n_words"], strict=True)
            ]
            columns = [batch.column(0), *[pa.array(base[c], pa.int64()) for c in counted]]
            columns += [pa.array([x[i] for x in nearest], k) for i, k in enumerate([pa.string(), pa.float64(), pa.float64()])]
            columns.append(pa.array(limits, pa.float64()))
            names = ["id", *counted, "nearest", "word_distance", "class_distance", "word_limit"]
            yield pa.RecordBatch.from_arrays(columns, names)

    known = set(references.languages)
    lang = F.col(lang_column).cast("string") if lang_column in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), lang.alias("lang"))
    longs = ", ".join(f"{c} long" for c in counted)
    out = rows.mapInArrow(run, f"id {kind}, {longs}, nearest string, word_distance double, class_distance double, word_limit double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    far_words = (F.col("n_words") >= least_words) & (F.col("word_distance") > F.col("word_limit"))
    far_classes = (F.col("word_chars") >= least_chars) & (F.col("class_distance") > most_class_distance)
    return out.withColumns({"base_failed": failed, "kept": ~failed & ~far_words & ~far_classes}).withColumnRenamed("id", id_column)
