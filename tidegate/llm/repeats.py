"""Removal of long repeated byte strings, by a logarithmic family of suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in the same text or another.

**Suffixes.** Of all suffixes of a text those at anchors are indexed. Each window of LENGTH bytes holds
LENGTH - HEAD + 1 strings of HEAD bytes; the one with the least hash (the first of equals) is its anchor, so equal
windows have their anchors at the same offset. Successive windows mostly share one: about one position in 69 is an
anchor. A suffix is ordered by a 64-bit digest of its first HEAD bytes, since all that matters is which suffixes
agree so far.

**Levels.** Every batch of texts becomes a sorted, bucketed table of (key, owner, place), its suffix array. A task
that has a key several times gives all its suffixes as matches at once and sends one of them, so a passage that
fills a third of the texts is a row per task. The array is
merge-scanned with all levels that exist: they are bucketed and sorted alike, so this moves no rows. Suffixes whose
key has a neighbour are matches and go on, each once. Levels of the same size are merged into one of twice the size
before the next batch comes, so n batches leave about log2(n) levels and every suffix is rewritten that often.

**Long matches.** The windows of one anchor form a segment. Matched segments get two 64-bit digests of all their
bytes: if another segment has the same, all its windows repeat. Where segments agree at the anchor but differ as a
whole, and one of them is the only one of its kind, one segment of each kind is opened and its windows are compared
one by one, again by two digests: the bytes of up to ``MOST_KINDS`` kinds meet in one task, more kinds are compared
window by window all over the cluster. So the result is exact, as far as 128 bits tell strings apart.

Equal texts are one text with a number of copies from the start: with two copies, all its windows repeat. Texts are
written once, bucketed by their digest; later passes bring their findings to them and don't move texts again.

Results for special inputs: null and empty texts have 0 bytes, nothing to remove and the digest of the empty
string; texts shorter than LENGTH stay whole; texts of any length count whole; repeated rows, also with equal ids,
are copies of each other; strings that overlap themselves count; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.bucketed import Bucketed
from tidegate.llm.common import batched, byte_texts, cut, work_folder
from tidegate.llm.words import mix

#: Bytes of a repeated string, and of the digest that orders suffixes.
LENGTH, HEAD = 200, 64
#: Batches that a table is fed to the index in.
BATCHES = 4
#: Kinds of segments with one key whose bytes are compared by one task; their windows are rows of their own beyond.
MOST_KINDS = 4096
#: Suffixes that a task holds before it sends them; memory only.
HELD = 1 << 20
#: Bytes of text per pass, and of a part of a long text; memory only. Places in a part have 20 bits.
PASS_BYTES = 1 << 20
PART = 1 << 19
_WINDOWS = LENGTH - HEAD + 1
_PICK = np.random.default_rng(12)
_VALUES = _PICK.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(x) * 4 + 3 for x in _PICK.integers(1, 1 << 61, 2)]
_INVERSES = [pow(base, -1, 1 << 64) for base in _BASES]
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < count:
        size = max(count, PASS_BYTES + LENGTH)
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        with np.errstate(over="ignore"):
            _POWERS[base] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS[base][:count]


class Strings:
    """Digests of any strings of a byte array."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes, self._sums = codes, {}

    def digests(self, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        """64 bits of each string, by one of two polynomials."""
        with np.errstate(over="ignore"):
            if which not in self._sums:
                terms = _VALUES[which][self.codes] * _powers(_BASES[which], len(self.codes))
                self._sums[which] = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
            sums, back = self._sums[which], _powers(_INVERSES[which], len(self.codes) + 1)
            return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))

    def heads(self) -> np.ndarray:
        """The digest of the HEAD bytes at every place that has so many."""
        count = max(0, len(self.codes) - HEAD + 1)
        with np.errstate(over="ignore"):
            self.digests(np.zeros(0, np.int64), np.zeros(0, np.int64))
            sums = self._sums[0]
            differences = sums[HEAD : HEAD + count] - sums[:count]
            return mix(differences * _powers(_INVERSES[0], len(self.codes) + 1)[:count] + np.uint64(HEAD))


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` successive values, by minima from both sides of blocks."""
    count = len(values) - size + 1
    blocks = -(-len(values) // size)
    padded = np.full(blocks * size, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, size)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[size - 1 : size - 1 + count])


def segments(strings: Strings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, key, first window, last window) of every segment of one text."""
    if len(strings.codes) < LENGTH:
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing.astype(np.uint64), nothing, nothing
    heads = strings.heads()
    anchors = np.empty(len(strings.codes) - LENGTH + 1, dtype=np.int64)
    low, bits = np.uint64((1 << 20) - 1), ~np.uint64((1 << 20) - 1)
    for at in range(0, len(anchors), PART):  # places count from the start of a part
        part = heads[at : at + PART + _WINDOWS - 1]
        ranked = (part & bits) | np.arange(len(part), dtype=np.uint64)
        least = _least(ranked, _WINDOWS)[: len(anchors) - at][:PART]
        anchors[at : at + len(least)] = (least & low).astype(np.int64) + at
    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(anchors) - 1]])
    places = anchors[first]
    return places, heads[places], first, last


def span(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Windows from first to last, of one segment, as one integer."""
    return first << 8 | (last - first)


def covered(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of bytes under the windows of spans, as starts and ends."""
    starts = np.sort(spans)
    ends = np.maximum.accumulate((starts >> 8) + (starts & 255) + LENGTH) if len(starts) else starts
    starts = starts >> 8
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = starts[1:] > ends[:-1]
    at = np.flatnonzero(fresh)
    return starts[at], ends[np.concatenate([at[1:] - 1, [len(ends) - 1]])] if len(at) else ends


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def _distinct_texts(docs: DataFrame, text_column: str) -> DataFrame:
    """(o1, o2, text, copies): a text's digest in two halves; each task sends a text once, and counts the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["o1", "o2", "text", "copies"]
        more: dict[bytes, int] = {}
        for batch in batched(batches, PASS_BYTES):
            digests = [hashlib.sha256(x).digest()[:16] for x in byte_texts(batch.column(0))]
            fresh = []
            for at, digest in enumerate(digests):
                if digest in more:
                    more[digest] += 1
                else:
                    more[digest] = 0
                    fresh.append(at)
            halves = np.frombuffer(b"".join(digests[at] for at in fresh), dtype=">i8").astype(np.int64).reshape(-1, 2)
            texts = batch.column(0).take(pa.array(fresh, pa.int64()))
            columns = [_signed(halves[:, 0]), _signed(halves[:, 1]), texts, pa.array([1] * len(fresh), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)
        counted = [(digest, count) for digest, count in more.items() if count]
        for at in range(0, len(counted), 10_000):
            part = counted[at : at + 10_000]
            halves = np.frombuffer(b"".join(d for d, _ in part), dtype=">i8").astype(np.int64).reshape(-1, 2)
            texts = pa.nulls(len(part), pa.binary())
            columns = [_signed(halves[:, 0]), _signed(halves[:, 1]), texts, pa.array([c for _, c in part], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    texts = docs.select(F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(run, "o1 long, o2 long, text binary, copies long")


def _suffixes(texts: DataFrame) -> DataFrame:
    """Anchors of (o1, text): one row per key and part of a task to index, with ``given`` 1 if the part has the key
    several times, and then a row with ``match`` 1 for each of its places."""

    def grouped(keys: list[np.ndarray], owners: list[np.ndarray], places: list[np.ndarray]) -> pa.RecordBatch:
        key, owner, place = (np.concatenate(x) for x in (keys, owners, places))
        order = np.argsort(key, kind="stable")
        key, owner, place = key[order], owner[order], place[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        several = np.concatenate([~first[1:], [False]]) | ~first
        at = np.concatenate([np.flatnonzero(first), np.flatnonzero(several)])
        match = np.repeat(np.array([0, 1]), [first.sum(), several.sum()])
        given = several[at].astype(np.int64)
        columns = [_signed(key[at]), _signed(owner[at]), _signed(place[at]), _signed(given), _signed(match)]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        places: list[np.ndarray] = []
        held = 0
        for batch in batched(batches, PASS_BYTES):
            for owner, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                place, key, _, _ = segments(Strings(np.frombuffer(text, dtype=np.uint8)))
                keys.append(key)
                places.append(place)
                owners.append(np.full(len(place), owner, dtype=np.int64))
                held += len(place)
            if held >= HELD:
                yield from _sliced(grouped(keys, owners, places))
                keys, owners, places, held = [], [], [], 0
        if held:
            yield from _sliced(grouped(keys, owners, places))

    names = ["key", "owner", "place", "given", "match"]
    return texts.select("o1", "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _sliced(batch: pa.RecordBatch, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


class SuffixLevels:
    """Suffix arrays of batches, merged like the digits of a binary counter."""

    def __init__(self, tables: Bucketed) -> None:
        self._tables, self._count, self._sent = tables, 0, []
        #: (batches, table name) of each level, oldest first.
        self.levels: list[tuple[int, str]] = []

    def _merge(self) -> None:
        """Levels of one size become one of twice the size, from the newest on."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, newer), (_, older) = self.levels.pop(), self.levels.pop()
            both = self._tables.rows(older).unionByName(self._tables.rows(newer))
            # The rank makes the merge run bucket by bucket; nothing is moved.
            rank = F.row_number().over(Window.partitionBy("key").orderBy("owner", "place"))
            merged = both.withColumn("rank", rank).where("rank > 0").drop("rank")
            name = f"level{self._count}x{2 * size}"
            self._tables.write(merged, name, "key")
            self._tables.drop(newer)
            self._tables.drop(older)
            self.levels.append((2 * size, name))

    def add(self, texts: DataFrame) -> DataFrame:
        """Index a batch (o1, text); give the suffixes (owner, place), new or old, that now have a neighbour.

        A suffix is given once: old ones only if they were alone with their key before.
        """
        self._merge()
        self._count += 1
        name, folder = f"batch{self._count}", f"{self._tables.folder}/sent{self._count}"
        self._sent.append(f"sent{self._count}")
        _suffixes(texts).write.partitionBy("match").parquet(folder)
        sent = self._tables.spark.read.schema("key long, owner long, place long, given long, match int").parquet(folder)
        array = sent.where("match = 0").drop("match").repartition(self._tables.buckets, "key")
        self._tables.write(array, name, "key")
        every = self._tables.rows(name).withColumn("old", F.lit(0))
        for _, level in self.levels:
            every = every.unionByName(self._tables.rows(level).withColumn("old", F.lit(1)))
        self.levels.append((1, name))
        group = Window.partitionBy("key")
        counted = every.select("*", F.count(F.lit(1)).over(group).alias("all"), F.sum("old").over(group).alias("before"))
        found = counted.where("given = 0 and all > 1 and (old = 0 or (before = 1 and all > before))")
        return found.select("owner", "place").unionByName(sent.where("match = 1").select("owner", "place"))

    def forget_sent(self) -> None:
        """Delete what tasks sent, when the matches of all batches so far have been read."""
        while self._sent:
            self._tables.delete(self._sent.pop())


def _matched_segments(texts: DataFrame, places: DataFrame) -> DataFrame:
    """(key, s1, s2, o1, o2, span) of the segments at given (owner, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            columns: list[list[np.ndarray]] = [[] for _ in range(6)]
            wanted = batch.column(3).to_pylist()
            owners = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for (o1, o2), text, some in zip(owners, byte_texts(batch.column(2)), wanted, strict=True):
                strings = Strings(np.frombuffer(text, dtype=np.uint8))
                place, key, first, last = segments(strings)
                at = np.flatnonzero(np.isin(place, np.array(some, dtype=np.int64)))
                place, key, first, last = place[at], key[at], first[at], last[at]
                lead = mix((place - first).astype(np.uint64))
                for column, values in zip(
                    columns,
                    (
                        key,
                        strings.digests(first, last + LENGTH, 0) ^ lead,
                        strings.digests(first, last + LENGTH, 1) ^ lead,
                        np.full(len(at), o1, dtype=np.int64),
                        np.full(len(at), o2, dtype=np.int64),
                        span(first, last),
                    ),
                    strict=True,
                ):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate(c)) for c in columns], names)

    names = ["key", "s1", "s2", "o1", "o2", "span"]
    listed = places.groupBy(F.col("owner").alias("o1")).agg(F.collect_list("place").alias("places"))
    joined = texts.join(listed, "o1").select("o1", "o2", "text", "places")
    return joined.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _with_spans(texts: DataFrame, spans: DataFrame, buckets: int, columns: list[str], how: str) -> DataFrame:
    """Texts with the lists of their spans; only the spans are moved."""
    near = spans.repartition(buckets, "o1").groupBy("o1", "o2").agg(*[F.collect_list(c).alias(c) for c in columns])
    near = near.withColumnRenamed("o1", "n1").withColumnRenamed("o2", "n2")
    # Halves compared by a difference, since texts are bucketed by the first half alone.
    same = (F.col("o1") == F.col("n1")) & (F.col("o2").bitwiseXOR(F.col("n2")) == 0)
    return texts.join(near, same, how).drop("n1", "n2")


def _windows(texts: DataFrame) -> DataFrame:
    """(w1, w2, o1, o2, span, alone) of every window of the listed spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            columns: list[list[np.ndarray]] = [[] for _ in range(6)]
            lists = zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True)
            for text, (o1, o2, spans, alone) in zip(byte_texts(batch.column(2)), lists, strict=True):
                strings, chosen = Strings(np.frombuffer(text, dtype=np.uint8)), np.array(spans, dtype=np.int64)
                counts = (chosen & 255) + 1
                inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                starts = np.repeat(chosen >> 8, counts) + inside
                single = np.repeat(np.array(alone, dtype=np.int64), counts)
                for column, values in zip(
                    columns,
                    (
                        strings.digests(starts, starts + LENGTH, 0),
                        strings.digests(starts, starts + LENGTH, 1),
                        np.full(len(starts), o1, dtype=np.int64),
                        np.full(len(starts), o2, dtype=np.int64),
                        span(starts, starts),
                        single,
                    ),
                    strict=True,
                ):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate(c)) for c in columns], names)

    names = ["w1", "w2", "o1", "o2", "span", "alone"]
    return texts.select("o1", "o2", "text", "span", "alone").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _contents(texts: DataFrame) -> DataFrame:
    """(key, o1, o2, span, alone, bytes) of the listed spans: all bytes that their windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            lengths = batch.column(3).value_lengths()
            at = pa.array(np.repeat(np.arange(batch.num_rows), lengths.to_numpy()))
            spans = batch.column(3).flatten()
            contents = []
            for owner, one in zip(at.to_pylist(), spans.to_pylist(), strict=True):
                first = one >> 8
                contents.append(batch.column(2)[owner].as_buffer()[first : first + (one & 255) + LENGTH].to_pybytes())
            columns = [batch.column(5).flatten(), batch.column(0).take(at), batch.column(1).take(at), spans]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(4).flatten(), pa.array(contents, pa.binary())], names)

    names = ["key", "o1", "o2", "span", "alone", "content"]
    types = "key long, o1 long, o2 long, span long, alone long, content binary"
    return texts.select("o1", "o2", "text", "span", "alone", "key").mapInArrow(run, types)


def _shared_windows(rows: pa.Table) -> pa.RecordBatch | None:
    """(o1, o2, span) of the windows, in runs, that lone segments share with another segment of the table."""
    contents = rows.column("content").to_pylist()
    counts = np.array([len(c) - LENGTH + 1 for c in contents], dtype=np.int64)
    begins = np.cumsum([0, *[len(c) for c in contents[:-1]]])
    owner = np.repeat(np.arange(len(contents)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    strings = Strings(np.frombuffer(b"".join(contents), dtype=np.uint8))
    starts = begins[owner] + inside
    digests = np.stack([strings.digests(starts, starts + LENGTH, i) for i in (0, 1)])
    order = np.lexsort(digests)
    same = (digests[:, order[1:]] == digests[:, order[:-1]]).all(axis=0)
    shared = np.zeros(len(starts), dtype=bool)
    shared[order[1:][same]] = shared[order[:-1][same]] = True
    shared &= rows.column("alone").to_numpy()[owner] == 1
    at = np.flatnonzero(shared)
    if not len(at):
        return None
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
    heads = np.flatnonzero(fresh)
    tails = np.concatenate([heads[1:] - 1, [len(at) - 1]])
    low = (rows.column("span").to_numpy() >> 8)[owner[at[heads]]]
    spans = span(low + inside[at[heads]], low + inside[at[tails]])
    owners = pa.array(owner[at[heads]])
    columns = [rows.column(c).take(owners).combine_chunks() for c in ("o1", "o2")]
    return pa.RecordBatch.from_arrays([*columns, _signed(spans)], ["o1", "o2", "span"])


def _compared(contents: DataFrame) -> DataFrame:
    """``_shared_windows`` of all segments with one key, which are few enough for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batched(batches, PASS_BYTES):
            keys = batch.column(0).to_numpy()
            # All keys but the last one of the batch are complete.
            cut_at = int(np.searchsorted(keys, keys[-1], side="left"))
            if cut_at or (held and held[-1].column(0)[-1].as_py() != keys[0]):
                found = _shared_windows(pa.Table.from_batches([*held, batch.slice(0, cut_at)]))
                held = []
                if found is not None:
                    yield found
            held.append(batch.slice(cut_at))
        if held:
            found = _shared_windows(pa.Table.from_batches(held))
            if found is not None:
                yield found

    return contents.repartition("key").sortWithinPartitions("key").mapInArrow(run, "o1 long, o2 long, span long")


def kept(text: bytes, spans: np.ndarray, copies: int) -> tuple[int, int, int, str]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of a text."""
    if copies > 1 and len(text) >= LENGTH:
        return len(text), len(text), 1, hashlib.sha256(b"").hexdigest()
    starts, ends = covered(spans)
    digest, at, view = hashlib.sha256(), 0, memoryview(text)
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        digest.update(view[at:start])
        at = end
    digest.update(view[at:])
    return len(text), int((ends - starts).sum()), len(starts), digest.hexdigest()


def _verdicts(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            copies, spans = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            rows = [
                kept(text, np.array(some or [], dtype=np.int64), count)
                for text, count, some in zip(byte_texts(batch.column(2)), copies, spans, strict=True)
            ]
            found = [pa.array([r[i] for r in rows], pa.int64() if i < 3 else pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names)

    names = ["o1", "o2", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    types = "o1 long, o2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return texts.select("o1", "o2", "text", "copies", "span").mapInArrow(run, types)


def find_repeats(docs: DataFrame, text_column: str, folder: str, batches: int = BATCHES) -> DataFrame:
    """(o1, o2, n_bytes, n_removed, n_spans, kept_sha256) of every distinct text, written below the folder."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = Bucketed(spark, folder, buckets)
    try:
        sent = _distinct_texts(docs, text_column).repartition(buckets, "o1")
        whole = sent.groupBy("o1", "o2").agg(F.max("text").alias("text"), F.sum("copies").alias("copies"))
        whole = whole.withColumn("batch", F.pmod("o2", F.lit(batches)).cast("int"))
        texts = tables.write(whole, "texts", "o1", "batch").drop("batch")
        index, places = SuffixLevels(tables), []
        for batch in range(batches):
            some = tables.rows("texts").where(F.col("batch") == batch)
            places.append(cut(index.add(some), folder, f"places{batch}"))
            index.forget_sent()
        every = places[0]
        for more in places[1:]:
            every = every.unionByName(more)
        found = cut(_matched_segments(texts, every), folder, "segments")

        kinds = found.groupBy("key", "s1", "s2").agg(
            F.count(F.lit(1)).alias("times"), F.min(F.struct("o1", "o2", "span")).alias("one")
        )
        kinds = cut(kinds, folder, "kinds")
        same = found.join(kinds.where("times > 1").select("key", "s1", "s2"), ["key", "s1", "s2"])
        several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.min("times").alias("least"))
        several = cut(several.where("kinds > 1 and least = 1").select("key", "kinds"), folder, "several")
        opened = kinds.join(several, "key").select("one.*", "key", "kinds", (F.col("times") == 1).cast("long").alias("alone"))
        opened = cut(opened, folder, "opened")
        few, many = opened.where(F.col("kinds") <= MOST_KINDS), opened.where(F.col("kinds") > MOST_KINDS)
        open_spans = _compared(_contents(_with_spans(texts, few, buckets, ["span", "alone", "key"], "inner")))
        windows = cut(_windows(_with_spans(texts, many, buckets, ["span", "alone"], "inner")), folder, "windows")
        again = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("times"))
        again = cut(again.where("times > 1").select("w1", "w2"), folder, "again")
        hot_spans = windows.where("alone = 1").join(again, ["w1", "w2"]).select("o1", "o2", "span")
        open_spans = open_spans.unionByName(hot_spans)
        spans = same.select("o1", "o2", "span").unionByName(open_spans)
        return cut(_verdicts(_with_spans(texts, spans, buckets, ["span"], "left")), folder, "verdicts")
    finally:
        tables.drop_all()


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", batches: int = BATCHES) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 (of the remaining bytes) for every row."""
    folder = work_folder(docs.sparkSession)
    found = find_repeats(docs, text_column, folder, batches)

    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            joined = b"".join(hashlib.sha256(x).digest()[:16] for x in byte_texts(batch.column(1)))
            halves = np.frombuffer(joined, dtype=">i8").astype(np.int64).reshape(-1, 2)
            columns = [batch.column(0), _signed(halves[:, 0]), _signed(halves[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["id", "o1", "o2"])

    named = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    named = named.mapInArrow(run, f"id {kind}, o1 long, o2 long")
    return named.join(found, ["o1", "o2"]).drop("o1", "o2").withColumnRenamed("id", id_column)
