"""Language-model scores of texts by a weighted backoff automaton.

The model is an n-gram model over words with absolute discounting, learnt from all texts outside the
held-out fold. Its n-grams are the states of an automaton: an arc leads from the state of a context to that
of the context with the next word, with a log10 probability; where a context has no arc for a word, its
failure arc leads to the next shorter context, with the log10 weight that backing off costs. The lowest
state has an arc for every word that occurs in training, and one for all others. A text is read once from
left to right, carrying the state and adding what the arcs cost. Its last token is the end of the text, and
its first context is the boundary between texts.

What is gathered grows with the corpus, so it is split by size:

* *Frequent* words have at least ``word_share`` of all training tokens. Their number is bounded by
  1 / word_share, whatever the corpus. They, and the arcs of their pairs with at least ``hot_share`` of the
  tokens, are the automaton that every task gets.
* All word pairs of training, as many as the corpus has, stay in a table of exact counts, and so do all
  contexts with their failure weights. A task lists the pairs that its automaton has no arc for, and those are
  joined: with the table of pairs, and what is still open with the table of contexts.

Counts are exact over all training texts; no pair is left out. ``gram_share`` asks for a smaller model than
that: pairs with a lower share of the tokens are no arcs at all, rare words are no contexts, and the automaton
holds the whole model but for the counts of rare words.

Base score: the sum over tokens of log10((c + 0.5) / (N + 0.5 * (V + 1))), which is also the model's
distribution at the lowest state.

Results for special inputs: null and empty texts are one end token; texts are read whole; rows with a null
id are scored and never learnt from; repeated rows give repeated rows; an empty table gives an empty result;
without training texts every token costs as an unseen one (log10 of 1); other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import batched, byte_texts, cut, in_fold, work_folder

PASS_BYTES = 4 << 20
#: Distinct words or n-grams that a task counts before it passes the counts on; memory only.
HELD = 300_000
#: The end of a text; no word contains a space.
END = b" "
#: Context and word, each by its number, or as -1 with the word itself behind.
Pair = tuple[int, int, bytes, bytes]
PAIR = ["a", "b", "wa", "wb"]


@dataclass(frozen=True)
class BackoffAutomaton:
    """Arcs per state. State 0 is the empty context; state 1 + i is frequent word i as context."""

    words: dict[bytes, int]
    low: list[float]  # log10 probability of each frequent word at state 0
    arcs: list[dict[int, float]]  # per word as context: next word -> log10 probability
    failure: list[float]  # per word as context: log10 weight of its failure arc

    def read(self, words: list[bytes]) -> tuple[float, float, Counter]:
        """Score and base score of a text without its rare words, and the rare words with their counts.

        For models with ``gram_share``: what is no arc here backs off.
        """
        find, low, arcs, failure = self.words.get, self.low, self.arcs, self.failure
        score = base = 0.0
        state = self.words.get(END, -1)
        rare: list[bytes] = []
        for word in [*words, END]:
            number = find(word, -1)
            if state >= 0:
                cost = arcs[state].get(number)
                if cost is None:
                    score += failure[state]
                    cost = low[number] if number >= 0 else 0.0
                score += cost
            elif number >= 0:
                score += low[number]
            if number >= 0:
                base += low[number]
            else:
                rare.append(word)
            state = number
        return score, base, Counter(rare)

    def open_pairs(self, words: list[bytes]) -> tuple[float, float, list[Pair]]:
        """What the arcs of a text cost, its base score without rare words, and its pairs without an arc here."""
        find, low, arcs = self.words.get, self.low, self.arcs
        score = base = 0.0
        before = END
        state = find(END, -1)
        pairs: list[Pair] = []
        for word in [*words, END]:
            number = find(word, -1)
            cost = None
            if number >= 0:
                base += low[number]
                if state >= 0:
                    cost = arcs[state].get(number)
            if cost is None:
                pairs.append((state, number, b"" if state >= 0 else before, b"" if number >= 0 else word))
            else:
                score += cost
            state, before = number, word
        return score, base, pairs


def _counts(batches: Iterator[pa.RecordBatch], keys) -> Iterator[pa.RecordBatch]:
    """(key, n) of what ``keys`` adds to a counter for each text, in parts of bounded size."""
    held: Counter = Counter()
    for batch in batched(batches, PASS_BYTES):
        for text in byte_texts(batch.column(0)):
            keys(held, text.lower().split())
            if len(held) > HELD:
                yield _counted(held)
                held.clear()
    if held:
        yield _counted(held)


def _counted(held: Counter) -> pa.RecordBatch:
    keys = list(held)
    kind = pa.binary() if isinstance(keys[0], bytes) else pa.int64()
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(list(held.values()), pa.int64())], ["key", "n"])


def _pair_columns(pairs: list[Pair]) -> list[pa.Array]:
    a, b, wa, wb = zip(*pairs, strict=True) if pairs else ((), (), (), ())
    return [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(wa, pa.binary()), pa.array(wb, pa.binary())]


@dataclass(frozen=True)
class LanguageModel:
    """The automaton, the table (word, c) of all training words, and the totals.

    ``pairs`` is the table (a, b, wa, wb, n) of all training pairs and ``contexts`` the table (a, wa, c, failure) of
    all contexts; both are None for models with ``gram_share``.
    """

    automaton: BackoffAutomaton
    counts: DataFrame
    tokens: int
    distinct: int
    discount: float = 0.75
    pairs: DataFrame | None = None
    contexts: DataFrame | None = None

    def low(self, count: int) -> float:
        if not self.tokens:
            return 0.0
        return math.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def low_column(self, count: Column) -> Column:
        if not self.tokens:
            return F.lit(0.0)
        return F.log10((F.coalesce(count, F.lit(0)) + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def learn(docs: DataFrame, held_out: tuple[int, int] = (5, 1), word_share: float = 4e-6, gram_share: float | None = None, discount: float = 0.75, id_column: str = "doc_id", text_column: str = "text", hot_share: float = 2e-6) -> LanguageModel:
    """A model of word pairs from all texts outside the held-out fold; of all pairs unless gram_share is given."""
    folder = work_folder(docs.sparkSession)
    usable = docs.where(F.col(id_column).isNotNull() & ~in_fold(id_column, *held_out))
    texts = usable.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))

    def add_words(held: Counter, words: list[bytes]) -> None:
        held.update(words)
        held[END] += 1

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counts(batches, add_words)

    parts = texts.mapInArrow(count_words, "key binary, n long")
    counts = cut(parts.groupBy(F.col("key").alias("word")).agg(F.sum("n").alias("c")), folder, "words")
    totals = counts.agg(F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("distinct")).first()
    tokens, distinct = totals["tokens"] or 0, totals["distinct"]
    # At most 1 / word_share rows.
    frequent = counts.where(F.col("c") >= max(1, word_share * tokens)).collect()
    frequent = sorted(((r["c"], bytes(r["word"])) for r in frequent), key=lambda x: (-x[0], x[1]))
    number = {word: i for i, (_, word) in enumerate(frequent)}
    model = LanguageModel(BackoffAutomaton({}, [], [], []), counts, tokens, distinct, discount)
    low = [model.low(c) for c, _ in frequent]
    if gram_share is None:
        return _learn_all(texts, model, frequent, number, low, hot_share, folder)
    # A pair reaches its share only if both words do; END bounds every text and may be rare.
    least = max(1, gram_share * tokens)
    inner = {word: i for word, i in number.items() if frequent[i][0] >= least}
    width = len(frequent)

    def add_pairs(held: Counter, words: list[bytes]) -> None:
        ids = [inner.get(w, -1) for w in words]
        end = inner.get(END, -1)
        held.update([a * width + b for a, b in zip([end, *ids], [*ids, end], strict=True) if a >= 0 and b >= 0])

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counts(batches, add_pairs)

    pairs = texts.mapInArrow(count_pairs, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # At most 1 / gram_share rows.
    kept = pairs.where(F.col("n") >= least).collect()
    arcs: list[dict[int, float]] = [{} for _ in frequent]
    left = np.zeros(width)  # discounted counts of the kept arcs, and their mass at the lower state
    below = np.zeros(width)
    for r in kept:
        a, b = divmod(r["key"], width)
        arcs[a][b] = math.log10((r["n"] - discount) / frequent[a][0])
        left[a] += r["n"] - discount
        below[a] += 10 ** low[b]
    failure = [
        math.log10(max(1e-12, 1 - left[i] / c) / max(1e-12, 1 - below[i])) if arcs[i] else 0.0
        for i, (c, _) in enumerate(frequent)
    ]
    return replace(model, automaton=BackoffAutomaton(number, low, arcs, failure))


def _learn_all(texts: DataFrame, model: LanguageModel, frequent: list, number: dict[bytes, int], low: list[float], hot_share: float, folder: str) -> LanguageModel:
    """The model of all pairs."""

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        find = number.get
        for batch in batched(batches, PASS_BYTES):
            for text in byte_texts(batch.column(0)):
                words = [END, *text.lower().split(), END]
                ids = [find(w, -1) for w in words]
                rare = [b"" if i >= 0 else w for i, w in zip(ids, words, strict=True)]
                held.update(zip(ids[:-1], ids[1:], rare[:-1], rare[1:], strict=True))
                if len(held) > HELD:
                    yield counted(held)
                    held.clear()
        if held:
            yield counted(held)

    def counted(held: Counter) -> pa.RecordBatch:
        columns = [*_pair_columns(list(held)), pa.array(list(held.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, [*PAIR, "n"])

    parts = texts.mapInArrow(count_pairs, "a int, b int, wa binary, wb binary, n long")
    pairs = cut(parts.groupBy(*PAIR).agg(F.sum("n").alias("n")), folder, "pairs")

    # The mass of a context's followers at the lower state; rare followers meet their counts by word.
    def add_low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = 10 ** np.array(low)
        for batch in batches:
            below = mass[batch.column(2).to_numpy()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(below), batch.column(3)], ["a", "wa", "below", "n"])

    known = pairs.where("b >= 0").select("a", "wa", "b", "n").mapInArrow(add_low, "a int, wa binary, below double, n long")
    rare = pairs.where("b < 0").join(model.counts, F.col("wb") == F.col("word"))
    rare = rare.select("a", "wa", F.pow(F.lit(10.0), model.low_column(F.col("c"))).alias("below"), "n")
    sums = known.union(rare).groupBy("a", "wa").agg(F.sum("below").alias("below"), F.sum("n").alias("c"), F.count(F.lit(1)).alias("k"))
    # What discounting leaves over, spread over all other words.
    spare = F.lit(model.discount) * F.col("k") / F.col("c")
    failure = F.log10(F.greatest(spare, F.lit(1e-12)) / F.greatest(1 - F.col("below"), F.lit(1e-12)))
    contexts = cut(sums.select("a", "wa", "c", failure.alias("failure")), folder, "contexts")

    # At most 1 / hot_share pairs and 1 / word_share contexts.
    hot = pairs.where((F.col("n") >= max(1, hot_share * model.tokens)) & (F.col("a") >= 0) & (F.col("b") >= 0))
    arcs: list[dict[int, float]] = [{} for _ in frequent]
    for r in hot.select("a", "b", "n").collect():
        arcs[r["a"]][r["b"]] = math.log10((r["n"] - model.discount) / frequent[r["a"]][0])
    weights = [0.0] * len(frequent)
    for r in contexts.where("a >= 0").select("a", "failure").collect():
        weights[r["a"]] = r["failure"]
    return replace(model, automaton=BackoffAutomaton(number, low, arcs, weights), pairs=pairs, contexts=contexts)


def score_texts(docs: DataFrame, model: LanguageModel, held_out: tuple[int, int] = (5, 1), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text."""
    # Rows are told apart by their place in the input, so that repeated rows stay apart.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    sums = _score_all(rows, model) if model.pairs is not None else _score_kept(rows, model)
    return sums.select(
        F.col("id").alias(id_column),
        in_fold("id", *held_out).alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        F.col("score").alias("score"),
    )


def _score_all(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """row, id, tokens, known, base and score by the model of all pairs.

    Every text gives one row with what its arcs cost, under a pair that no text has, and one row for each pair
    without an arc. All meet the table of pairs. What frequent words add is known by their numbers, of which
    there are 1 / word_share at most; what rare words add is summed by text and word, and meets the table of contexts.
    """
    folder = work_folder(rows.sparkSession)
    kind = rows.schema["id"].dataType.simpleString()
    automaton = model.automaton

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            place, pairs = [], []
            tokens, base, score = [], [], []
            for i, text in enumerate(byte_texts(batch.column(2))):
                words = text.lower().split()
                s, b, more = automaton.open_pairs(words)
                pairs.append((-2, batch.column(0)[i].as_py() % (1 << 31), b"", b""))
                pairs += more
                place.append(len(more) + 1)
                tokens.append(len(words) + 1)
                base.append(b)
                score.append(s)
            own = np.cumsum([0, *place[:-1]])
            at = pa.array(np.repeat(np.arange(len(place)), place))
            open_at = np.ones(len(pairs), dtype=bool)
            open_at[own] = False

            def spread(values: list, kind: pa.DataType, open_at=open_at, own=own) -> pa.Array:
                wide = np.zeros(len(open_at), dtype=kind.to_pandas_dtype())
                wide[own] = values
                return pa.array(wide, kind, mask=open_at)

            columns = [batch.column(0).take(at), batch.column(1).take(at), *_pair_columns(pairs)]
            columns += [spread(tokens, pa.int64()), spread(base, pa.float64()), spread(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", *PAIR, "tokens", "base", "score"])

    schema = f"row long, id {kind}, a int, b int, wa binary, wb binary, tokens long, base double, score double"
    listed = rows.mapInArrow(read, schema)
    common = model.contexts.where("a >= 0")
    by_context = F.broadcast(common.select("a", F.log10("c").alias("a_c"), F.col("failure").alias("a_failure")))
    by_word = F.broadcast(common.select(F.col("a").alias("b"), model.low_column(F.col("c")).alias("b_low")))
    met = listed.join(model.pairs, PAIR, "left").join(by_context, "a", "left").join(by_word, "b", "left")

    zero = F.lit(0.0)
    seen, pair = F.col("n").isNotNull(), F.col("a") >= -1
    hit = F.log10(F.col("n") - model.discount) - F.coalesce("a_c", zero)
    miss = F.coalesce("a_failure", zero) + F.coalesce("b_low", zero)
    cost = F.when(~pair, F.col("score")).when(seen, hit).otherwise(miss)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    seen_one, unseen_one = F.when(seen, one).otherwise(none), F.when(seen, none).otherwise(one)

    def part(word, tokens, base, score, hits, misses, times, missed):
        values = {"word": word, "tokens": tokens, "base": base, "score": score, "hits": hits, "misses": misses, "times": times, "missed": missed}
        return F.struct(*[v.alias(k) for k, v in values.items()])

    own = part(F.lit(b""), F.coalesce("tokens", none), F.coalesce("base", zero), cost, none, none, none, none)
    as_context = part(F.col("wa"), none, zero, zero, seen_one, unseen_one, none, none)
    as_word = part(F.col("wb"), none, zero, zero, none, none, one, unseen_one)
    parts = F.concat(
        F.array(own),
        F.when(F.length("wa") > 0, F.array(as_context)).otherwise(F.array().cast(_parts_type(own, met))),
        F.when(F.length("wb") > 0, F.array(as_word)).otherwise(F.array().cast(_parts_type(own, met))),
    )
    spread = met.select("row", "id", F.inline(parts))
    names = ["tokens", "base", "score", "hits", "misses", "times", "missed"]
    summed = cut(spread.groupBy("row", "id", "word").agg(*[F.sum(x).alias(x) for x in names]), folder, "met")

    # A rare word as context: hits divide by its count, misses cost its failure arc. As a word: its cost at the lowest state.
    table = model.contexts.where("a < 0").select(F.col("wa").alias("word"), "c", "failure")
    rare = summed.where(F.length("word") > 0).join(table, "word", "left")
    low = model.low_column(F.col("c"))
    by_row = rare.select(
        "row",
        "id",
        none.alias("tokens"),
        F.when(F.col("c").isNull(), -F.col("times")).otherwise(none).alias("known"),
        (low * F.col("times")).alias("base"),
        (
            low * F.col("missed") + F.coalesce(F.col("failure") * F.col("misses") - F.log10("c") * F.col("hits"), zero)
        ).alias("score"),
    )
    plain = summed.where(F.length("word") == 0).select("row", "id", "tokens", F.col("tokens").alias("known"), "base", "score")
    whole = plain.union(by_row).groupBy("row", "id")
    return whole.agg(*[F.sum(x).alias(x) for x in ("tokens", "known", "base", "score")])


def _parts_type(part: Column, rows: DataFrame):
    return rows.limit(0).select(F.array(part).alias("x")).schema["x"].dataType


def _score_kept(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """row, id, tokens, known, base and score by a model with gram_share.

    Every text gives one row with what the automaton says, and one row for each of its rare words; both meet
    the table of counts by word and then their text.
    """
    folder = work_folder(rows.sparkSession)
    kind = rows.schema["id"].dataType.simpleString()
    automaton = model.automaton

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            tokens, known, base, score, rare = [], [], [], [], []
            for text in byte_texts(batch.column(2)):
                words = text.lower().split()
                s, b, left = automaton.read(words)
                tokens.append(len(words) + 1)
                known.append(len(words) + 1 - left.total())
                base.append(b)
                score.append(s)
                rare.append(left)
            lists = [[list(r) for r in rare], [list(r.values()) for r in rare]]
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(tokens, pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(score, pa.float64()),
                pa.array(lists[0], pa.list_(pa.binary())),
                pa.array(lists[1], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "tokens", "known", "base", "score", "rare", "times"])

    schema = f"row long, id {kind}, tokens long, known long, base double, score double, rare array<binary>, times array<int>"
    texts = cut(rows.mapInArrow(read, schema), folder, "read")

    rare = texts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", "w.rare", "w.times")
    cost = model.low_column(F.col("c"))
    met = rare.join(model.counts, rare["rare"] == model.counts["word"], "left").select(
        "row",
        (cost * F.col("times")).alias("cost"),
        F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0).alias("seen"),
    )
    sums = met.groupBy("row").agg(F.sum("cost").alias("cost"), F.sum("seen").alias("seen"))
    whole = texts.drop("rare", "times").join(sums, "row", "left")
    more = F.coalesce("cost", F.lit(0.0))
    return whole.select(
        "row",
        "id",
        "tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("known"),
        (F.col("base") + more).alias("base"),
        (F.col("score") + more).alias("score"),
    )
