"""Benchmark passages in documents, by edit distance over words.

The CGK embedding reads a sequence by a random walk: at each of a number of steps it writes the current
word and moves on, or stays, by a random bit of that step and word. Two sequences under the same bits that
differ by few edits walk together again soon after each edit, so edit distance becomes Hamming distance of
what was written. Bit sampling then takes a few of the written positions as a bucket key.

Windows are as long as the shortest item of a size class; an item is covered by all its windows, and a
document by the window at every one of its words. A document window in the bucket of an item's window is a
candidate, at the place where the item would begin. Recall is measured when the tables are built, for each
length of items by itself, on copies with as many random edits as the threshold allows, and walks are added until
the worst length reaches the target. A length that does not get there by ``MOST_WALKS`` (short items whose edits
leave no stretch for a walk) is searched by the pieces of its items as well: of edits + 1 pieces of an item one
is whole in every match, so nothing of that length is missed. Every candidate is decided by the exact edit distance between the item and the best stretch of
the document around the place, which also gives the stretch.

Words are runs of letters and digits, A-Z as a-z. A match has at most (1 - similarity) * words edits.

Benchmark items are the stated query set. They are taken in blocks of at most ``MOST_WORDS`` words, which is
the bound of what goes to every task; each block is one pass over the documents.

Results for special inputs: null or empty texts match nothing, nor do items without words; repeated
items or documents give their matches each; a null item_id is a name like others; texts of any length are
searched whole; empty tables give an empty result or drop nothing; other columns are ignored by
``find_leaks`` and kept as they are by ``drop_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidegate.llm.common import batched, byte_texts
from tidegate.llm.words import mix, word_hashes

MOST_WORDS = 100_000
PASS_BYTES = 1 << 20
#: Steps of the walk per size class, sampled positions, samples per walk, and most walks.
STEPS = (20, 10, 5, 2)
SAMPLED, SAMPLES, MOST_WALKS = 4, 3, 3
#: Copies per item length on which recall is measured.
COPIES = 400
_FILTER_BITS = 20


def edit_matches(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """The stretch of the text with the least edit distance to the item: (distance, start, end).

    Of equal distances the first end and then the latest start are taken; None above ``most`` edits.
    Bit-parallel: one integer holds a column of the dynamic programme as differences.
    """
    best, end = _scan(item, text, len(item))
    if best > most:
        return None
    # Backwards from the end, the same distance is first met at the latest start.
    back, length = _scan(item[::-1], text[:end][::-1], best, anchored=True)
    return best, end - length, end


def _scan(item: np.ndarray, text: np.ndarray, wanted: int, anchored: bool = False) -> tuple[int, int]:
    """Least distance of the item to text ending (anchored: from 0) at each place, and the first such place.

    With ``anchored`` the first place with distance ``wanted`` ends the scan.
    """
    size = len(item)
    full, top = (1 << size) - 1, 1 << (size - 1)
    places: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    up, down, distance = full, 0, size
    best, at = size, 0
    for j, word in enumerate(text.tolist(), 1):
        equal = places.get(word, 0)
        across = equal | down
        equal |= ((equal & up) + up) ^ up
        rise = down | (~(equal | up) & full)
        fall = up & equal
        if rise & top:
            distance += 1
        elif fall & top:
            distance -= 1
        rise = (rise << 1 | (1 if anchored else 0)) & full
        fall = fall << 1 & full
        up = (fall | (~(across | rise) & full)) & full
        down = rise & across
        if distance < best:
            best, at = distance, j
            if anchored and best <= wanted:
                break
    return best, at


class Searcher:
    """The tables of one block of items."""

    def __init__(self, names: list, texts: list[bytes], similarity: float, recall: float, seed: int = 3) -> None:
        hashes, at = word_hashes(texts, plain=True)
        pairs = [(n, hashes[s:e]) for n, s, e in zip(names, at, at[1:], strict=False) if e > s]
        self.names, self.items = [n for n, _ in pairs], [w for _, w in pairs]
        self.most = [int((1 - similarity) * len(w) + 1e-9) for w in self.items]
        self.pick = np.random.default_rng(seed)
        self.known = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.known[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.known[0] = True  # what stands for words beyond an item's end
        self.classes: dict[int, list[int]] = {}
        for i, words in enumerate(self.items):
            steps = next((s for s in STEPS if s <= 1.4 * len(words)), STEPS[-1] // 2)
            self.classes.setdefault(steps, []).append(i)
        self.seeds: list[np.uint64] = []
        self.samples: dict[tuple[int, int], list[list[int]]] = {}  # by walk and steps
        self.tables: dict[tuple[int, int, int], tuple] = {}  # by walk, steps and sample
        self.pieces: dict[int, tuple] = {}  # by words of a piece
        #: The share of copies with the most edits that is found, by length of the item.
        self.measured: dict[int, float] = {}
        copies = self._edited_copies()
        low = sorted({len(w) for w in self.items})
        while low and len(self.seeds) < MOST_WALKS:
            self._add_walk()
            if len(self.seeds) > 1:
                low = self._measure(copies, recall)
        self._add_pieces(low)
        self.measured |= {n: 1.0 for n in low}

    def _measure(self, copies: list[tuple[int, np.ndarray]], recall: float) -> list[int]:
        """The lengths whose copies are found too seldom."""
        all_of, hits = {}, {}
        for start in range(0, len(copies), 1000):  # at the driver, so not too many at once
            part = copies[start : start + 1000]
            for (i, _), some in zip(part, self._hits([w for _, w in part]), strict=True):
                size = len(self.items[i])
                all_of[size] = all_of.get(size, 0) + 1
                hits[size] = hits.get(size, 0) + (i in some)
        self.measured = {n: hits[n] / all_of[n] for n in all_of}
        return [n for n, share in self.measured.items() if share < recall]

    def _edited_copies(self) -> list[tuple[int, np.ndarray]]:
        """COPIES copies for each length, of some of its items, with as many random edits as are allowed."""
        by_length: dict[int, list[int]] = {}
        for i, words in enumerate(self.items):
            by_length.setdefault(len(words), []).append(i)
        copies = []
        for members in by_length.values():
            for i in self.pick.choice(members, COPIES).tolist():
                words = self.items[i].tolist()
                for _ in range(self.most[i]):
                    at, kind = int(self.pick.integers(len(words))), int(self.pick.integers(3))
                    new = [int(self.pick.integers(1 << 62))]
                    words[at : at + (kind != 1)] = new if kind < 2 else []
                    words = words or new
                copies.append((i, np.array(words, dtype=np.uint64)))
        return copies

    def _add_pieces(self, lengths: list[int]) -> None:
        """For each item of a length the keys of its pieces, one more than it may have edits."""
        found: dict[int, list[tuple]] = {}
        for i, words in enumerate(self.items):
            if len(words) not in lengths:
                continue
            size = len(words) // (self.most[i] + 1)
            for piece in range(self.most[i] + 1):
                at = piece * size
                found.setdefault(size, []).append((int(self._grams(words, size, np.array([at]))[0]), i, at))
        for size, rows in found.items():
            rows.sort()
            keys = np.array([r[0] for r in rows], dtype=np.uint64)
            flags = np.zeros(1 << _FILTER_BITS, dtype=bool)
            flags[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.pieces[size] = keys, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), flags

    @staticmethod
    def _grams(words: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
        """The keys of the runs of ``size`` words at some places."""
        key = np.full(len(starts), size, dtype=np.uint64)
        for i in range(size):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + words[starts + i])
        return key

    def _add_walk(self) -> None:
        walk = len(self.seeds)
        self.seeds.append(np.uint64(self.pick.integers(1, 1 << 63)))
        for steps, members in self.classes.items():
            taken = min(SAMPLED, max(1, steps // 2))
            width = steps / taken
            # One position in each of equal stretches of the walk, so that they lie on different words.
            self.samples[walk, steps] = [
                [int(width * k + self.pick.integers(max(1, int(width)))) for k in range(taken)] for _ in range(SAMPLES)
            ]
            words = np.concatenate([np.append(self.items[i], np.zeros(steps, np.uint64)) for i in members])
            lengths = [len(self.items[i]) for i in members]
            first = np.cumsum([0, *[n + steps for n in lengths[:-1]]])
            starts = np.concatenate([f + np.arange(n) for f, n in zip(first, lengths, strict=True)])
            owner = np.repeat(np.array(members), lengths)
            offset = starts - np.repeat(first, lengths)
            limit = np.repeat(first + np.array(lengths), lengths)
            written = self._walk(words, starts, walk, steps)
            for number, sample in enumerate(self.samples[walk, steps]):
                # A window counts if what is sampled lies inside the item; the first one always does.
                inside = (written[sample[-1]] < limit) | (offset == 0)
                keys = self._keys(words, [written[step] for step in sample])[inside]
                order = np.argsort(keys, kind="stable")
                flags = np.zeros(1 << _FILTER_BITS, dtype=bool)
                flags[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
                self.tables[walk, steps, number] = (keys[order], owner[inside][order], offset[inside][order], flags)

    def _walk(self, words: np.ndarray, starts: np.ndarray, walk: int, steps: int) -> dict[int, np.ndarray]:
        """The places of all walks at the steps that are sampled."""
        wanted = {step for key, found in self.samples.items() if key[0] == walk for sample in found for step in sample}
        hashed = mix(words ^ self.seeds[walk]).view(np.uint8).reshape(-1, 8)[:, :3]
        bits = np.ascontiguousarray(np.unpackbits(hashed, axis=1, bitorder="little").T)
        at, places = starts.astype(np.int64), {}
        for step in range(steps):
            if step in wanted:
                places[step] = at.copy()
            at += bits[step].take(at)
        return places

    @staticmethod
    def _keys(words: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
        key = words.take(places[0])
        for place in places[1:]:
            key = key * np.uint64(0x9E3779B97F4A7C15) + words.take(place)
        return mix(key)

    def _candidates(self, words: np.ndarray) -> np.ndarray:
        """Distinct (begin of the item, item) for the windows at all words; begins may lie outside."""
        if not self.items or not len(words):
            return np.zeros((0, 2), dtype=np.int64)
        longest = max(self.classes)
        padded = np.append(words, np.zeros(longest, np.uint64))
        starts = np.arange(len(words))
        # A key can only be an item's if all its words are; that is looked at first.
        known = self.known.take(padded >> np.uint64(64 - _FILTER_BITS))
        found = []
        for walk in range(len(self.seeds)):
            places = self._walk(padded, starts, walk, longest)
            for steps in self.classes:
                for number, sample in enumerate(self.samples[walk, steps]):
                    table, owner, offset, flags = self.tables[walk, steps, number]
                    maybe = known.take(places[sample[0]])
                    for step in sample[1:]:
                        maybe &= known.take(places[step])
                    maybe = np.flatnonzero(maybe)
                    keys = self._keys(padded, [places[step][maybe] for step in sample])
                    hit = flags.take((keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64))
                    found.append(self._begins(maybe[hit], keys[hit], table, owner, offset))
        for size, (table, owner, offset, flags) in self.pieces.items():
            count = max(0, len(words) - size + 1)
            maybe = np.ones(count, dtype=bool)
            for i in range(size):
                maybe &= known[i : i + count]
            maybe = np.flatnonzero(maybe)
            keys = self._grams(words, size, maybe)
            hit = flags.take((keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64))
            found.append(self._begins(maybe[hit], keys[hit], table, owner, offset))
        return np.unique(np.concatenate(found), axis=0)

    @staticmethod
    def _begins(places: np.ndarray, keys: np.ndarray, table: np.ndarray, owner: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """(begin of the item, item) for every entry of the table with one of the keys."""
        low = np.searchsorted(table, keys, "left")
        count = np.searchsorted(table, keys, "right") - low
        which = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.stack([np.repeat(places, count) - offset[which], owner[which]], axis=1)

    def _hits(self, texts: list[np.ndarray]) -> list[set[int]]:
        """The items that are candidates in each text."""
        edges = np.cumsum([0, *[len(t) for t in texts]])
        rows = self._candidates(np.concatenate(texts))
        hits: list[set[int]] = [set() for _ in texts]
        at = np.clip(np.searchsorted(edges, rows[:, 0] + max(self.most, default=0), "right") - 1, 0, len(texts) - 1)
        for text, item in zip(at.tolist(), rows[:, 1].tolist(), strict=True):
            hits[text].add(item)
        return hits

    def search(self, texts: list[bytes]) -> list[list[tuple]]:
        """For each text its matches, without overlaps per item: item name, edits, first word, end word, similarity, measured recall."""
        words, at = word_hashes(texts, plain=True)
        rows = self._candidates(words)
        out: list[list[tuple]] = [[] for _ in texts]
        size = np.array([len(w) for w in self.items] or [0])
        middle = rows[:, 0] + size[rows[:, 1]] // 2
        # A candidate near an edge may belong to the text before or after it; its middle decides first.
        owners = np.clip(np.searchsorted(at, np.clip(middle, 0, max(0, len(words) - 1)), "right") - 1, 0, len(texts) - 1)
        taken: dict[tuple[int, int], int] = {}
        for begin, item, text in zip(rows[:, 0].tolist(), rows[:, 1].tolist(), owners.tolist(), strict=True):
            if begin < taken.get((text, item), -(1 << 60)):
                continue
            most, length = self.most[item], len(self.items[item])
            low, high = max(int(at[text]), begin - 2 * most), min(int(at[text + 1]), begin + length + 2 * most)
            match = edit_matches(self.items[item], words[low:high], most) if high > low else None
            if match:
                edits, start, end = match
                taken[text, item] = low + end
                first = low + start - int(at[text])
                share = 1 - edits / length
                out[text].append((self.names[item], edits, first, first + end - start, share, self.measured[length]))
        return out


def searchers(benchmark: DataFrame, similarity: float, recall: float, id_column: str, text_column: str) -> Iterator[Searcher]:
    """One searcher for each block of items."""
    items = benchmark.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # Words are at least two bytes apart, so half the bytes bound the words.
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (2 * MOST_WORDS)))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text", "id"), F.lit(blocks)) == block).collect()
        rows.sort(key=lambda r: (str(r["id"]), r["text"] or ""))
        yield Searcher([r["id"] for r in rows], [(r["text"] or "").encode() for r in rows], similarity, recall)


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """One row per occurrence of an item in a document: ids, edits, similarity, first_word, end_word, and recall, the share of most edited copies of items of that length that the search found when it was built."""
    kind = docs.schema[id_column].dataType.simpleString()
    item_kind = benchmark.schema[item_column].dataType.simpleString()
    item_type = to_arrow_type(benchmark.schema[item_column].dataType)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = f"id {kind}, item {item_kind}, edits int, first_word int, end_word int, similarity double, recall double"
    found = None
    for searcher in searchers(benchmark, similarity, recall, item_column, "text"):

        def run(batches: Iterator[pa.RecordBatch], searcher: Searcher = searcher) -> Iterator[pa.RecordBatch]:
            for batch in batched(batches, PASS_BYTES):
                matches = searcher.search(byte_texts(batch.column(1)))
                at = pa.array([i for i, m in enumerate(matches) for _ in m], pa.int64())
                flat = [x for m in matches for x in m]
                kinds = [item_type, pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
                columns = [pa.array([x[i] for x in flat], k) for i, k in enumerate(kinds)]
                names = ["id", "item", "edits", "first_word", "end_word", "similarity", "recall"]
                if flat:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *columns], names)

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found.select(
        F.col("id").alias(id_column), F.col("item").alias(item_column), "edits", "similarity", "first_word", "end_word", "recall"
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99, text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """The rows, with all their columns, that hold no item."""
    at = docs.columns.index(text_column)
    for searcher in searchers(benchmark, similarity, recall, item_column, "text"):

        def run(batches: Iterator[pa.RecordBatch], searcher: Searcher = searcher) -> Iterator[pa.RecordBatch]:
            for batch in batched(batches, PASS_BYTES):
                found = searcher.search(byte_texts(batch.column(at)))
                yield batch.filter(pa.array([not x for x in found], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
