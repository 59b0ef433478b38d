"""Near-duplicate documents by b-bit MinHash.

Each text's set of word shingles gets ``MINIMA`` minima under random hash functions. Bands of ``ROWS`` full
minima give candidate buckets; of every minimum the lowest ``BITS`` bits are packed into the signature. The
similarity of two candidates is estimated from the number of equal positions, by bit counts, corrected for
positions that are equal by chance; pairs far below the threshold are left, all others are confirmed on
their full sets.

Texts with the same set are one class from the start and only its smallest id goes on. Classes of a bucket
are joined to the bucket's smallest one, and the components of these candidate edges hold everything that
can be linked. A component is compared in blocks: its classes are dealt to blocks of bounded size, and every
pair of blocks is one group of rows for one task, which returns a spanning set of the confirmed links
inside it and never a list of pairs. Components of the confirmed links are the result. Work within a
candidate component grows with the square of its number of *different* sets, spread over the cluster; copies
cost nothing.

At a similarity of 0.85 a pair shares no bucket with a probability of 4e-7 (0.80: 5e-5).

Results for special inputs: texts that are null or have no words have an empty set, are linked with nothing
and are kept; rows with a null id are kept and linked with nothing; rows with equal ids are one document;
texts of any length count whole; an empty table gives an empty result; other columns are ignored by
``near_duplicates`` and kept as they are by ``drop_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import batched, byte_texts, cut, remove, work_folder
from tidegate.llm.components import components
from tidegate.llm.words import shingles, word_hashes

MINIMA, ROWS, BANDS, BITS = 128, 5, 25, 2
#: Bytes of text per pass, classes per block, and bytes of sets per block; memory only.
PASS_BYTES = 1 << 20
BLOCK_CLASSES = 400
BLOCK_BYTES = 16 << 20
#: Standard deviations below the threshold at which an estimate rules a pair out (one in 300,000).
DEVIATIONS = 4.5
_PICK = np.random.default_rng(9)
_FACTOR = (_PICK.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_SHIFT = _PICK.integers(0, 1 << 32, MINIMA, dtype=np.uint32)[:, None]
_EVEN = np.uint64(0x5555555555555555)


def minima(members: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set of 64-bit members."""
    folded = (members >> np.uint64(32)).astype(np.uint32)
    least = np.full(MINIMA, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(folded), 2048):
        part = folded[start : start + 2048]
        np.minimum(least, (_FACTOR * part + _SHIFT).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.zeros(BANDS, dtype=np.uint64)
    rows = least[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    for i in range(ROWS):
        key = (key ^ rows[:, i]) * np.uint64(0x9FB21C651E98DF25)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def pack(least: np.ndarray) -> bytes:
    """The lowest two bits of each minimum, 32 minima to a 64-bit word."""
    low = (least & np.uint32(3)).astype(np.uint64).reshape(-1, 32)
    shifts = np.arange(32, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << shifts, axis=1).tobytes()


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarities estimated from packed signatures: equal positions, less those equal by chance."""
    differ = one ^ others
    unequal = np.bitwise_count((differ | differ >> np.uint64(1)) & _EVEN).sum(axis=1, dtype=np.int64)
    chance = 1 / (1 << BITS)
    return (1 - unequal / MINIMA - chance) / (1 - chance)


def least_estimate(similarity: float) -> float:
    chance = 1 / (1 << BITS)
    equal = chance + (1 - chance) * similarity
    return similarity - DEVIATIONS * (equal * (1 - equal) / MINIMA) ** 0.5 / (1 - chance)


def confirmed(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, on full sets."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def spanning_links(sets: list[np.ndarray], packed: np.ndarray, first_block: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Confirmed links that connect all that is linked: inside one block, or between two.

    ``first_block`` marks the first of two different blocks; without any mark all pairs are compared.
    """
    sizes = np.array([len(s) for s in sets])
    label = np.arange(len(sets))
    least = least_estimate(percent / 100)
    rows = np.flatnonzero(first_block) if first_block.any() else np.arange(len(sets))
    links = []
    for i in rows.tolist():
        other = ~first_block if first_block.any() else np.arange(len(sets)) > i
        small, large = np.minimum(sizes, sizes[i]), np.maximum(sizes, sizes[i])
        close = other & (label != label[i]) & (100 * small >= percent * large)
        near = np.flatnonzero(close)
        if not len(near):
            continue
        guess = estimates(packed[i], packed[near])
        keep = guess >= least
        for j in near[keep][np.argsort(-guess[keep], kind="stable")].tolist():
            if label[j] != label[i] and confirmed(sets[i], sets[j], percent):
                links.append((i, j))
                label[label == label[j]] = label[i]
    return links


def signatures(docs: DataFrame, size: int, id_column: str, text_column: str) -> DataFrame:
    """(id, n, class, bands, packed) of every row; the last three are null for empty sets."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            hashes, at = word_hashes(byte_texts(batch.column(1)))
            counts, classes, bands, packed = [], [], [], []
            for start, end in zip(at, at[1:], strict=False):
                members = shingles(hashes[start:end], size)
                counts.append(len(members))
                least = minima(members) if len(members) else None
                classes.append(None if least is None else hashlib.blake2b(members.tobytes(), digest_size=16).digest())
                bands.append(None if least is None else band_keys(least))
                packed.append(None if least is None else pack(least))
            columns = [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(classes, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(packed, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "class", "bands", "packed"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n long, class binary, bands array<long>, packed binary")


def _candidates(nodes: DataFrame, folder: str) -> DataFrame:
    """Edges from every class to the smallest class of each of its buckets.

    The buckets are written before they are joined, so that the join can split one that holds very many.
    """
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    firsts = buckets.groupBy("band", "key").agg(F.min("node").alias("b"), F.max("node").alias("last"))
    shared = cut(firsts.where("b <> last").select("band", "key", "b"), folder, "buckets")
    return buckets.join(shared, ["band", "key"]).where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def _blocks(members: DataFrame, folder: str) -> DataFrame:
    """(node, part, group columns) once for every pair of blocks that a class takes part in."""
    sums = members.groupBy("component").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("shingles"))
    count = F.greatest(F.ceil(F.col("classes") / BLOCK_CLASSES), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES))
    counts = cut(sums.select("component", count.cast("int").alias("count")), folder, "blocks")
    dealt = members.join(counts, "component")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("count")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    return paired.select(
        "component",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "node",
        "packed",
        "block",
    )


def _links(texts: DataFrame, size: int, percent: int, kind: str) -> DataFrame:
    """Confirmed links (a, b) of rows (component, i, j, node, packed, block, text) grouped by the first three."""

    def compared(group: list[dict], key: tuple) -> Iterator[tuple]:
        distinct = {row["node"]: row for row in group}
        rows = [distinct[node] for node in sorted(distinct)]
        hashes, at = word_hashes([row["text"] for row in rows])
        sets = [shingles(hashes[s:e], size) for s, e in zip(at, at[1:], strict=False)]
        packed = np.stack([np.frombuffer(row["packed"], dtype=np.uint64) for row in rows])
        first = np.array([row["block"] == key[1] and key[1] != key[2] for row in rows])
        for a, b in spanning_links(sets, packed, first, percent):
            yield rows[a]["node"], rows[b]["node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, found, schema = None, [], [], None
        for batch in batches:
            schema = batch.schema.field("node").type
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in ("component", "i", "j", "node", "packed", "block")}
                row["text"] = batch.column("text")[at].as_py() or b""
                if (new := (row["component"], row["i"], row["j"])) != key:
                    found += compared(group, key) if group else ()
                    key, group = new, []
                group.append(row)
        found += compared(group, key) if group else ()
        if found:
            columns = [pa.array([f[i] for f in found], schema) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    groups = ["component", "i", "j"]
    dealt = texts.repartition(*groups).sortWithinPartitions(*groups)
    return dealt.mapInArrow(run, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_shingles, component_id and kept for every row: linked where similarity reaches percent / 100."""
    folder = work_folder(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    signed = cut(signatures(docs, size, id_column, text_column), folder, "signatures")
    usable = signed.where(F.col("class").isNotNull() & F.col("id").isNotNull())
    classes = cut(usable.groupBy("class").agg(F.min("id").alias("node")), folder, "classes")
    first = usable.join(classes, (usable["class"] == classes["class"]) & (usable["id"] == classes["node"]))
    nodes = cut(first.select("node", "n", "bands", "packed"), folder, "nodes")

    loose = components(_candidates(nodes, folder), folder, "loose")
    members = loose.join(nodes.drop("bands"), "node").dropDuplicates(["node"])
    dealt = _blocks(members, folder)
    texts = docs.select(F.col(id_column).alias("node"), F.col(text_column).cast("binary").alias("text"))
    # The text of each class in question, once; then once for every pair of blocks.
    needed = texts.join(members.select("node"), "node").dropDuplicates(["node"])
    links = cut(_links(dealt.join(needed, "node"), size, percent, kind), folder, "links")
    linked = components(links, folder, "linked")

    named = classes.join(linked, "node", "left").select("class", F.coalesce("component", "node").alias("component"))
    found = usable.select("id", "n", "class").join(named, "class").select("id", "n", "component")
    alone = signed.where(F.col("class").isNull() | F.col("id").isNull()).select("id", "n", F.col("id").alias("component"))
    found = cut(found.unionByName(alone), folder, "found")
    remove(docs.sparkSession, folder, "signatures", "classes", "nodes", "buckets", "blocks", "links")
    return found.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def drop_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, of the smallest id of each group of near duplicates."""
    found = near_duplicates(docs, size, percent, id_column, text_column)
    gone = found.where(~F.col("kept")).select(F.col(id_column).alias("gone_id")).distinct()
    return docs.join(gone, docs[id_column] == gone["gone_id"], "left_anti")
