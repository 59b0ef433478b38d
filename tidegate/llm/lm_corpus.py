"""Language-model scores of a whole corpus by the model learnt from it, chunk by chunk.

The model is that of ``llm.lm``: word pairs with absolute discounting as arcs of a weighted backoff automaton, its
states the contexts, with a failure arc each. All pairs of the training texts are arcs. Such an automaton is as
large as the corpus, so no task gets it whole; each chunk of texts gets the part that its own texts walk over.

1. The texts are written once, in chunks of bounded size, bucketed by chunk.
2. Every chunk sends its distinct words and pairs, as 64-bit keys with its own training count, once each: sorted, cut
   into ranges of keys, and as differences whose bytes of one rank lie together, which is how they compress. A range of
   keys is merged over all chunks by one task; it sends every chunk the sums in the order of the chunk's own
   keys, so keys travel one way only. There are so many ranges that one holds about ``RANGE_KEYS`` keys.
3. A chunk builds its automaton, its states being the words in it, and its texts are read: a text starts at the state
   of the boundary between texts, and each word leads over an arc, or over the failure arc of the state to the lowest
   state, which has an arc for every word. The state after a word is that word, so the steps of a chunk are known
   at once and are taken together.
4. The weight of a failure arc needs all followers of its context. Every pair belongs to the first chunk that has
   it; that chunk adds it to its context. Only texts that were not learnt from can miss an arc: their misses are listed
   by context and meet the weights.

Two words, or two pairs, with the same 64-bit key would count as one; among a thousand million different keys that
happens with a probability of 3 %, and changes the counts of these two only.

Results for special inputs are those of ``llm.lm``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.bucketed import Bucketed
from tidegate.llm.common import batched, byte_texts, cut, in_fold, work_folder
from tidegate.llm.words import mix, word_hashes

#: Bytes of text in a chunk, which one task holds as keys; a longer text is a chunk by itself.
CHUNK_BYTES = 10 << 20
#: Keys of one range, about, which one task merges in memory.
RANGE_KEYS = 8 << 20
PASS_BYTES = 2 << 20
DISCOUNT = 0.75
_END = np.uint64(0x8F14E45FCEEA167A)
_WORD, _PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
#: What a row of a reading is about.
TEXT, MISS, CONTEXT, TOTAL = range(4)


def _chunked(rows: DataFrame, kind: str) -> DataFrame:
    """(chunk, place, id, learn, text): each task deals its rows to chunks of at most CHUNK_BYTES or one text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, place = TaskContext.get().partitionId() << 24, 0, 0
        for batch in batched(batches, PASS_BYTES):
            chunks, places = [], []
            for size in [len(t) for t in byte_texts(batch.column(2))]:
                if held and held + size > CHUNK_BYTES:
                    chunk, held, place = chunk + 1, 0, 0
                chunks.append(chunk)
                places.append(place)
                held, place = held + size + 1, place + 1
            columns = [pa.array(chunks, pa.int64()), pa.array(places, pa.int64()), *batch.columns]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "place", "id", "learn", "text"])

    return rows.mapInArrow(run, f"chunk long, place long, id {kind}, learn boolean, text string")


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, each text followed by its end, and the number of tokens of each text."""
    parts, counts, start, size = [], [], 0, 0
    for at, text in enumerate(texts):
        size += len(text) + 1
        if size < PASS_BYTES and at + 1 < len(texts):
            continue
        hashes, bounds = word_hashes(texts[start : at + 1])
        words = np.diff(bounds)
        out = np.full(len(hashes) + len(words), _END, dtype=np.uint64)
        out[np.arange(len(hashes)) + np.repeat(np.arange(len(words)), words)] = hashes
        parts.append(out)
        counts.append(words + 1)
        start, size = at + 1, 0
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(counts)


def _keys(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of each token's word, and of the pair that it ends; a text's first pair begins with an end."""
    with np.errstate(over="ignore"):
        before = np.concatenate([tokens[-1:], tokens[:-1]])
        return mix(tokens ^ _WORD), mix(mix(before + _PAIR) * np.uint64(0xFF51AFD7ED558CCD) + tokens)


def _planes(values: np.ndarray) -> bytes:
    """64-bit integers, first all their lowest bytes, then all the next ones, and so on."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _edges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins in sorted keys, and the end of the last one."""
    width = ((1 << 64) + ranges - 1) // ranges
    starts = np.array([width * i for i in range(1, ranges)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, starts), [len(keys)]])


def _sent(texts: DataFrame, ranges: int) -> DataFrame:
    """(range, chunk, keys, counts): every word and pair of a chunk, with its count in texts to learn from."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names = ["range", "chunk", "keys", "counts"]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        if not table.num_rows:
            return pa.table({n: pa.array([], k) for n, k in zip(names, kinds, strict=True)})
        tokens, counts = _tokens([x for part in table.column("text").chunks for x in byte_texts(part)])
        both = np.stack(_keys(tokens))
        learnt = np.repeat(np.array(table.column("learn").to_pylist(), dtype=bool), counts)
        known, times = np.unique(both[:, learnt], return_counts=True)
        keys = np.union1d(known, np.unique(both[:, ~learnt]))
        own = np.zeros(len(keys), dtype=np.int64)
        own[np.searchsorted(keys, known)] = times
        edges = _edges(keys, ranges)
        rows = [r for r in range(ranges) if edges[r] < edges[r + 1]]
        parts = [slice(edges[r], edges[r + 1]) for r in rows]
        columns = [
            pa.array(rows, kinds[0]),
            pa.array([table.column("chunk")[0].as_py()] * len(rows), kinds[1]),
            pa.array([_planes(np.diff(keys[p], prepend=np.uint64(0))) for p in parts], kinds[2]),
            pa.array([_planes(own[p]) for p in parts], kinds[3]),
        ]
        return pa.table(columns, names)

    schema = "range int, chunk long, keys binary, counts binary"
    return texts.select("chunk", "learn", "text").groupBy("chunk").applyInArrow(run, schema)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    """For several lists of distinct keys with counts: the sum of each key's counts over all lists, doubled, plus one in
    the first list that counts it."""
    sizes = [len(k) for k in keys]
    every, own = np.concatenate(keys), np.concatenate(counts)
    source = np.repeat(np.arange(len(keys)), sizes)
    order = np.argsort(every, kind="stable")
    sorted_keys = every[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(every))))
    total = np.add.reduceat(own[order], starts)[group]
    first = np.minimum.reduceat(np.where(own > 0, source, len(keys))[order], starts)[group]
    out = np.empty(len(every), dtype=np.uint64)
    out[order] = total * 2 + (first == source[order])
    return np.split(out, np.cumsum(sizes)[:-1])


def _back(sent: DataFrame) -> DataFrame:
    """(chunk, range, sums): what ``merged`` says of each chunk's keys, in their order."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk").combine_chunks()
        keys = [np.cumsum(_values(k), dtype=np.uint64) for k in table.column("keys").to_pylist()]
        counts = [_values(c).astype(np.int64) for c in table.column("counts").to_pylist()]
        sums = [_planes(x) for x in merged(keys, counts)] if keys else []
        return pa.table([table.column("chunk"), table.column("range"), pa.array(sums, pa.binary())], ["chunk", "range", "sums"])

    return sent.groupBy("range").applyInArrow(run, "chunk long, range int, sums binary")


def read_chunk(texts: list[bytes], learn: np.ndarray, sums: np.ndarray) -> dict[int, dict[str, np.ndarray]]:
    """What a chunk tells of its texts, their missing arcs, the contexts of its own pairs, and totals.

    ``sums`` are those of ``merged`` for all words and pairs of the chunk, in the order of their keys.
    """
    tokens, counts = _tokens(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    learnt = np.repeat(learn, counts)
    keys, number = np.unique(np.concatenate(_keys(tokens)), return_inverse=True)
    total, mine = (sums >> np.uint64(1)).astype(np.int64), (sums & np.uint64(1)).astype(bool)
    # A state is a word, an arc is a pair; both go by the number of their key.
    state, arc = number[: len(tokens)], number[len(tokens) :]
    before = np.concatenate([state[-1:], state[:-1]])
    weight, context = total[arc], total[before]
    hit = weight > 0
    low = np.log10(total[state] + 0.5)
    with np.errstate(divide="ignore", invalid="ignore"):
        cost = np.where(hit, np.log10(weight - DISCOUNT) - np.log10(context), low)
    told = {
        "x1": counts,
        "x2": np.bincount(owner, total[state] > 0, len(texts)).astype(np.int64),
        "x3": np.bincount(owner, ~hit, len(texts)).astype(np.int64),
        "y1": np.bincount(owner, low, len(texts)),
        "y2": np.bincount(owner, cost, len(texts)),
    }
    # A state that no training text passed has no failure arc to pay for.
    fails = np.flatnonzero(~hit & (context > 0))
    fallen, times = np.unique(owner[fails] * len(keys) + before[fails], return_counts=True)
    # Where each pair of this chunk's own occurs first, its context and its word.
    first = np.empty(len(keys), dtype=np.int64)
    first[arc[::-1]] = np.arange(len(tokens))[::-1]
    is_pair = np.zeros(len(keys), dtype=bool)
    is_pair[arc] = True
    own = first[mine & is_pair & (total > 0)]
    followers = np.bincount(before[own], minlength=len(keys))
    mass = np.zeros(len(keys), dtype=np.int64)
    np.add.at(mass, before[own], total[state[own]])
    contexts = np.flatnonzero(followers)
    is_word = np.zeros(len(keys), dtype=bool)
    is_word[state] = True
    return {
        TEXT: told,
        MISS: {"place": fallen // max(1, len(keys)), "key": keys[fallen % max(1, len(keys))], "x1": times},
        CONTEXT: {"key": keys[contexts], "x1": followers[contexts], "x2": mass[contexts], "x3": total[contexts]},
        TOTAL: {"x1": np.array([learnt.sum()]), "x2": np.array([(mine & is_word & (total > 0)).sum()])},
    }


_COLUMNS = ["kind", "chunk", "place", "id", "key", "x1", "x2", "x3", "y1", "y2"]


def _readings(texts: DataFrame, back: DataFrame, kind: str) -> DataFrame:
    """The rows of ``read_chunk`` of all chunks, in one table."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        if not left.num_rows:
            return pa.table({c: pa.array([], t) for c, t in kinds(left).items()})
        texts = [x for part in left.column("text").chunks for x in byte_texts(part)]
        learn = np.array(left.column("learn").to_pylist(), dtype=bool)
        parts = []
        sums = [_values(x) for x in right.sort_by("range").column("sums").to_pylist()]
        for number, values in read_chunk(texts, learn, np.concatenate(sums)).items():
            size = len(next(iter(values.values())))
            cells = {"kind": np.full(size, number), "chunk": np.full(size, left.column("chunk")[0].as_py())}
            if number == TEXT:
                cells |= {"place": left.column("place"), "id": left.column("id")}
            elif "place" in values:
                values = values | {"place": left.column("place").to_numpy()[values["place"]]}
            cells |= {c: v.view(np.int64) if v.dtype == np.uint64 else v for c, v in values.items()}
            arrays = [pa.array(cells[c], t) if isinstance(cells.get(c), np.ndarray) else cells.get(c, pa.nulls(size, t)) for c, t in kinds(left).items()]
            parts.append(pa.table(dict(zip(_COLUMNS, arrays, strict=True))))
        return pa.concat_tables(parts)

    def kinds(left: pa.Table) -> dict[str, pa.DataType]:
        long, double = pa.int64(), pa.float64()
        return dict(zip(_COLUMNS, [pa.int32(), long, long, left.schema.field("id").type, *[long] * 4, double, double], strict=True))

    schema = f"kind int, chunk long, place long, id {kind}, key long, x1 long, x2 long, x3 long, y1 double, y2 double"
    return texts.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(run, schema)


def score_corpus(docs: DataFrame, held_out: tuple[int, int] = (5, 1), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    The model is learnt from all texts outside the held-out fold (a row without id is not learnt from).
    """
    spark = docs.sparkSession
    folder = work_folder(spark)
    kind = docs.schema[id_column].dataType.simpleString()
    learn = F.col(id_column).isNotNull() & ~in_fold(id_column, *held_out)
    rows = docs.select(F.col(id_column).alias("id"), learn.alias("learn"), F.col(text_column).alias("text"))
    tables = Bucketed(spark, folder, int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        texts = tables.write(_chunked(rows, kind), "texts", "chunk", codec="zstd")
        size = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
        # Words are at least two bytes apart, and every one gives a word and a pair at most.
        ranges = max(tables.buckets, -(-size // RANGE_KEYS))
        back = _back(_sent(texts, ranges))
        read = cut(_readings(texts, back, kind), folder, "read")
    finally:
        tables.drop_all()

    totals = read.where(F.col("kind") == TOTAL).agg(F.sum("x1").alias("tokens"), F.sum("x2").alias("distinct")).first()
    tokens, distinct = totals["tokens"] or 0, totals["distinct"] or 0
    whole = tokens + 0.5 * (distinct + 1)
    sums = read.where(F.col("kind") == CONTEXT).groupBy("key")
    sums = sums.agg(F.sum("x1").alias("k"), F.sum("x2").alias("mass"), F.max("x3").alias("c"))
    # What discounting leaves over, spread over all other words.
    spare = F.lit(DISCOUNT) * F.col("k") / F.col("c")
    below = (F.col("mass") + 0.5 * F.col("k")) / whole
    failure = F.log10(F.greatest(spare, F.lit(1e-12)) / F.greatest(1 - below, F.lit(1e-12)))
    contexts = cut(sums.select("key", failure.alias("failure")), folder, "contexts")
    misses = read.where(F.col("kind") == MISS).select("chunk", "place", "key", F.col("x1").alias("times"))
    paid = misses.join(contexts, "key").groupBy("chunk", "place").agg(F.sum(F.col("times") * F.col("failure")).alias("paid"))
    own = read.where(F.col("kind") == TEXT).select("chunk", "place", "id", "x1", "x2", "x3", "y1", "y2")
    scored = own.join(paid, ["chunk", "place"], "left")
    low = F.log10(F.lit(whole))
    return scored.select(
        F.col("id").alias(id_column),
        in_fold("id", *held_out).alias("held_out"),
        F.col("x1").alias("n_tokens"),
        F.col("x2").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("y1") - F.col("x1") * low).alias("base_score"),
        (F.col("y2") - F.col("x3") * low + F.coalesce("paid", F.lit(0.0))).alias("score"),
    )
