"""Near-duplicate documents: MinHash candidates, sequential Bayesian pruning, exact verification.

Texts with equal sets of word shingles form a class, and only the smallest doc_id of a class goes on. Candidates
share all MinHash values of a band. In a bucket of candidates each member is first compared with the smallest one, and
with the smallest one of a small group; buckets whose members are not all connected by that are then compared in
blocks, across what is connected already.
A candidate pair is compared batch by batch of its signatures and dropped as soon as the posterior probability of
a similarity above the threshold falls below the miss probability; for the blocks, whose pairs are many, the signatures are
longer, and pairs go that cannot have enough in common. What is left is verified on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitloom.llm.batches import arrow_rows, free_name, map_pieces
from visitloom.llm.components import connected_components
from visitloom.session import through_storage

SHINGLE = 5
PERCENT = 75  # least similarity
BANDS, BAND_ROWS = 32, 4  # a pair at 0.75 shares no band with probability 5e-6
HASHES = BANDS * BAND_ROWS
LONG = 1024  # values of the signatures of those in buckets that stay open
BATCH = 16  # signature values compared at a time
MISS = 1e-6
# Members of a block, on average; how large a bucket is does not matter.
BLOCK = 64
# Members of a small group of a bucket, on average.
GROUP = 8
# Rows given to Python at a time: pairs with two sets, and blocks of members.
PAIR_ROWS, BLOCK_ROWS = 256, 64
_WORDS_KEPT = 200_000

_random = np.random.default_rng(20_240_501)
_PLACE = _random.integers(1, 2**63, SHINGLE, np.uint64) | np.uint64(1)
_FACTOR = _random.integers(1, 2**63, LONG, np.uint64) | np.uint64(1)
_SHIFT = _random.integers(0, 2**63, LONG, np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles: SHINGLE words each, or all words of a shorter text."""
    words = (text or "").encode().lower().split()
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    count = max(len(values) - SHINGLE + 1, min(len(values), 1))
    size = min(len(values), SHINGLE)
    sums = np.full(count, size, np.uint64)
    for place in range(size):
        sums += values[place : place + count] * _PLACE[place]
    return np.unique(_mixed(sums))


def signature(shingles: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """Minima of the hashed shingles."""
    least = np.full(hashes, 2**32 - 1, np.uint64)
    for at in range(0, len(shingles), 1024):
        part = shingles[None, at : at + 1024] * _FACTOR[:hashes, None] + _SHIFT[:hashes, None]
        np.minimum(least, (part >> np.uint64(32)).min(axis=1), out=least)
    return least


def fewest_matches(percent: int = PERCENT, miss: float = MISS, hashes: int = HASHES) -> list[int]:
    """The fewest matches after BATCH, 2 * BATCH, ... compared values with which a pair is not dropped.

    Values of 8 bits match with probability r = s + (1 - s) / 256 at similarity s. With all r equally likely
    before, the probability of r > x after m matches of n is that of at most m successes of n + 1 at x.
    """
    s = percent / 100
    x = s + (1 - s) / 256
    least = []
    for n in range(BATCH, hashes + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * x**m * (1 - x) ** (n + 1 - m)
        least.append(m)
    return least


def surviving(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Numbers of the pairs of signature rows that are not dropped in any batch."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for step, fewest in enumerate(least):
        part = slice(step * BATCH, (step + 1) * BATCH)
        matches = matches + (a[alive, part] == b[alive, part]).sum(axis=1)
        keep = matches >= fewest
        alive, matches = alive[keep], matches[keep]
    return alive


def _sketches(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, h1, h2: hash of the whole set, bands, values: 8 bits of each minimum)."""

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        hashes = _WordHashes()
        numbers = np.arange(BANDS, dtype=np.uint64)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, first, second, bands, values = [], [], [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), hashes)
                sizes.append(len(shingles))
                if not len(shingles):
                    for column in (first, second, bands, values):
                        column.append(None)
                    continue
                whole = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
                minima = signature(shingles)
                key = numbers
                for row in minima.reshape(BANDS, BAND_ROWS).T:
                    key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + row)
                first.append(int(whole[0]))
                second.append(int(whole[1]))
                bands.append(key.view(np.int64))
                values.append((minima & np.uint64(255)).astype(np.uint8).tobytes())
            return pa.record_batch(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(values, pa.binary()),
                ],
                ["doc_id", "n_shingles", "h1", "h2", "bands", "values"],
            )

        return handle

    schema = "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, values binary"
    return map_pieces(documents, start, schema)


def _signatures(column: pa.Array, hashes: int = HASHES) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, hashes)


def _not_dropped(pairs: DataFrame, values: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) that sequential comparison does not drop."""
    least = fewest_matches(percent, miss)

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            alive = surviving(_signatures(batch.column(2)), _signatures(batch.column(3)), least)
            return pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).take(pa.array(alive))

        return handle

    rows = pairs.join(values.select(F.col("doc_id").alias("a"), F.col("values").alias("values_a")), "a").join(
        values.select(F.col("doc_id").alias("b"), F.col("values").alias("values_b")), "b"
    )
    return map_pieces(rows.select("a", "b", "values_a", "values_b"), start, "a long, b long")


def _full_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the wanted doc_ids."""

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        hashes = _WordHashes()

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(x.as_py(), hashes).tobytes() for x in batch.column(1)]
            return pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

        return handle

    # What is wanted grows with the documents, so it is merged, not broadcast, at every size.
    held = texts.join(wanted.hint("merge"), "doc_id", "left_semi")
    return map_pieces(held, start, "doc_id long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            similar = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                similar.append(100 * both >= percent * (len(a) + len(b) - both))
            links = pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"])
            return links.filter(pa.array(similar, pa.bool_()))

        return handle

    rows = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b"
    )
    return map_pieces(rows.select("a", "b", "set_a", "set_b"), start, "a long, b long")


def _with_shared_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n, shared): sizes of the sets of which at least `percent` of the shingles are in another of the sets
    as well, and how many those are.

    A set with fewer has no set as similar as that, and no two sets have more in common than the lesser of their shared.
    """

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            whole = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
            return pa.record_batch([batch.column(0), pa.array(whole, pa.list_(pa.int64()))], ["doc_id", "shingles"])

        return handle

    listed = map_pieces(sets, start, "doc_id long, shingles array<long>")
    each = listed.select("doc_id", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    ends = each.groupBy("shingle").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = each.join(ends.where("first < last").select("shingle"), "shingle")
    counts = shared.groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("shared"))
    return counts.where(f"100 * shared >= {percent} * n")


def _across_components(
    members: DataFrame, components: DataFrame, sets: DataFrame, percent: int, miss: float
) -> DataFrame:
    """Pairs (a, b) of different components in one bucket that sequential comparison does not drop, each once.

    Members of the bucket's largest component are at home, the others away. Away members are compared with
    all others but those of their component, in blocks: home with away, and away with away. Two members of several
    buckets are compared in that of the smallest key; both are in a block there too, as their components differ.
    """
    least = fewest_matches(percent, miss, LONG)
    labelled = members.join(components.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component")
    )
    open_ = through_storage(_several_components(labelled), "open-buckets")
    wanted = open_.select(F.col("rep").alias("doc_id")).distinct()
    able = _with_shared_shingles(sets.join(wanted, "doc_id", "left_semi"), percent)
    able = through_storage(able.withColumnRenamed("doc_id", "rep"), "able")
    open_ = _several_components(open_.drop("at_home").join(able, "rep"), "n", "shared")
    open_ = through_storage(open_, "open-buckets")
    values = _long_signatures(sets.join(open_.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    sizes = open_.groupBy("key").agg(
        F.expr(f"ceil(count_if(at_home) / {BLOCK})").alias("home_blocks"),
        F.expr(f"ceil(count_if(NOT at_home) / {BLOCK})").alias("away_blocks"),
    )
    block = F.pmod(F.xxhash64("rep"), F.when(F.col("at_home"), F.col("home_blocks")).otherwise(F.col("away_blocks")))
    # As many keys as a signature has bands, at most.
    keys = open_.groupBy("rep").agg(F.collect_set("key").alias("keys"))
    placed = (
        open_.join(sizes, "key")
        .join(values.select(F.col("doc_id").alias("rep"), "values"), "rep")
        .join(keys, "rep")
        .withColumn("block", block)
    )
    # Blocks (home i, away j) are numbered (i, j), and (away i, away j) with i <= j are numbered (-1 - i, j).
    meets = F.expr("""
        CASE WHEN at_home THEN transform(sequence(0L, away_blocks - 1), j -> struct(block AS i, j AS j))
        ELSE concat(
            transform(sequence(0L, home_blocks - 1), i -> struct(i AS i, block AS j)),
            transform(sequence(0L, away_blocks - 1), k -> struct(-1 - least(block, k) AS i, greatest(block, k) AS j)))
        END""")
    blocks = (
        placed.select("key", F.struct("rep", "component", "at_home", "values", "n", "shared", "keys", "block").alias("member"), F.explode(meets).alias("at"))
        .groupBy("key", "at")
        .agg(F.collect_list("member").alias("members"))
        .select("key", (F.col("at.i") == -1 - F.col("at.j")).alias("one_block"), "members")
    )

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def pairs(key: int, one_block: bool, block: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
            rep, component = (block.field(i).to_numpy() for i in (0, 1))
            home, rows = block.field(2).to_numpy(zero_copy_only=False), _signatures(block.field(3), LONG)
            size, shared = block.field(4).to_numpy(), block.field(5).to_numpy()
            away = np.flatnonzero(~home)
            others = np.flatnonzero(home) if home.any() else away
            a, b = np.repeat(away, len(others)), np.tile(others, len(away))
            # Members of one block meet in that block alone, not in those that it is part of.
            number = block.field(7).to_numpy()
            differ = (component[a] != component[b]) & (home[b] | (a < b) & (one_block | (number[a] != number[b])))
            a, b = a[differ], b[differ]
            # What both could have in common at most has to suffice for their sizes.
            able = (100 + percent) * np.minimum(shared[a], shared[b]) >= percent * (size[a] + size[b])
            a, b = a[able], b[able]
            lower = _keys_below(key, block.field(6))
            elsewhere = (lower[a] & lower[b]).any(axis=1)
            a, b = a[~elsewhere], b[~elsewhere]
            alive = surviving(rows[a], rows[b], least)
            return rep[a[alive]], rep[b[alive]]

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [pairs(key.as_py(), one.as_py(), members.values) for key, one, members in zip(*batch.columns)]
            a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
            b = np.concatenate([x for _, x in found]) if found else a
            return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        return handle

    return map_pieces(blocks, start, "a long, b long")


def _keys_below(key: int, keys: pa.ListArray) -> np.ndarray:
    """For each list of keys, as bits of a row: which keys it has below `key`, of those that several lists have."""
    values, owner = keys.flatten().to_numpy(), np.repeat(np.arange(len(keys)), keys.value_lengths().to_numpy())
    values, owner = values[values < key], owner[values < key]
    _, number, counts = np.unique(values, return_inverse=True, return_counts=True)
    several = counts[number] > 1
    number, owner = number[several], owner[several]
    bits = np.zeros((len(keys), len(counts) // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (owner, number // 64), np.uint64(1) << (number % 64).astype(np.uint64))
    return bits


def _long_signatures(sets: DataFrame) -> DataFrame:
    """(doc_id, values): 8 bits of each of LONG minima."""

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            minima = [signature(np.frombuffer(x.as_buffer(), np.uint64), LONG) for x in batch.column(1)]
            values = [(m & np.uint64(255)).astype(np.uint8).tobytes() for m in minima]
            return pa.record_batch([batch.column(0), pa.array(values, pa.binary())], ["doc_id", "values"])

        return handle

    return map_pieces(sets, start, "doc_id long, values binary")


def _several_components(labelled: DataFrame, *more: str) -> DataFrame:
    """Members (key, rep, component, more) of buckets with more than one component; at_home: in the largest one."""
    parts = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = parts.groupBy("key").agg(F.max_by("component", "n").alias("home"), F.count(F.lit(1)).alias("components"))
    return labelled.join(buckets.where("components > 1").select("key", "home"), "key").select(
        "key", "rep", "component", *more, (F.col("component") == F.col("home")).alias("at_home")
    )


def _linked_to_first(several: DataFrame) -> DataFrame:
    """(a, b) of each rep b of a doc_id and its smallest rep a."""
    first = several.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return several.withColumnRenamed("rep", "b").join(first, "doc_id").where("a < b").select("a", "b")


def near_duplicates(
    documents: DataFrame,
    percent: int = PERCENT,
    miss: float = MISS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept.

    n_shingles is the size of its set: distinct shingles of SHINGLE words, A-Z lower-cased, or all words of a
    shorter text as one. Documents are linked from `percent` similarity (intersection to union of the sets) on.
    component_id is the smallest doc_id that links reach, itself included; kept tells whether that is its own.
    A document without words, or with a null text, is linked with nothing. Repeated rows each give a row; rows of
    one doc_id are one document, in the component of all its texts. A row with a null doc_id is linked with
    nothing, has a null component_id and is kept. Other columns play no part; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketches = through_storage(_sketches(texts), "sketches")
    known = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = through_storage(known.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep")), "classes")
    # The texts of one doc_id belong together.
    whole = F.struct("h1", "h2")
    repeated = known.groupBy("doc_id").agg(F.min(whole).alias("first"), F.max(whole).alias("last"))
    repeated = known.join(repeated.where("first < last"), "doc_id", "left_semi").select("doc_id", "h1", "h2")
    several = _linked_to_first(repeated.join(classes, ["h1", "h2"]).select("doc_id", "rep"))

    # A row for each class; the rep is part of the key, so that no class is a hot one.
    chosen = known.join(classes.select("h1", "h2", F.col("rep").alias("doc_id")), ["doc_id", "h1", "h2"])
    chosen = chosen.dropDuplicates(["doc_id", "h1", "h2"]).withColumn("rep", F.col("doc_id"))
    values = through_storage(chosen.select("doc_id", "values"), "signatures")
    rows = chosen.select("rep", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(
        F.min("rep").alias("pivot"), F.max("rep").alias("last"), F.count(F.lit(1)).alias("n")
    )
    small = F.pmod(F.xxhash64("rep", "key"), F.expr(f"ceil(n / {GROUP})")).alias("group")
    placed = rows.join(buckets.where("pivot < last").drop("last"), "key").select("key", "rep", "pivot", small)
    placed = through_storage(placed.distinct(), "buckets")
    # The smallest of the bucket, and of a small group in it: the many groups of all bands connect what is similar.
    groups = placed.groupBy("key", "group").agg(F.min("rep").alias("first"))
    grouped = placed.join(groups, ["key", "group"]).select(F.col("first").alias("a"), F.col("rep").alias("b"))
    candidates = placed.select(F.col("pivot").alias("a"), F.col("rep").alias("b")).union(grouped).where("a < b").distinct()

    likely = through_storage(_not_dropped(candidates, values, percent, miss).distinct(), "likely")
    # The sets of all that are in a bucket with others, for both rounds of verification.
    sets = through_storage(_full_sets(texts, placed.select(F.col("rep").alias("doc_id")).distinct()), "sets")
    with arrow_rows(spark, PAIR_ROWS):
        links = through_storage(_verified(likely, sets, percent).distinct().union(several.distinct()), "verified")
    components = through_storage(connected_components(links), "components")

    rest = _across_components(placed.select("key", "rep"), components, sets, percent, miss)
    with arrow_rows(spark, BLOCK_ROWS):
        rest = through_storage(rest.join(likely, ["a", "b"], "left_anti"), "likely-across")
    with arrow_rows(spark, PAIR_ROWS):
        more = through_storage(_verified(rest, sets, percent).distinct(), "verified-across")
    if not more.isEmpty():
        components = connected_components(links.union(more))

    named = classes.join(components.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", F.coalesce("component", "rep").alias("component")
    )
    found = sketches.join(named, ["h1", "h2"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
    found = found.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`documents` with one document of each group of `near_duplicates`: that of the smallest doc_id.

    Of repeated rows of one doc_id one stays, that with the smallest hash of its text. Rows with a null doc_id stay.
    """
    removed_id, number = free_name(documents, "removed_id"), free_name(documents, "row_of_id")
    gone = near_duplicates(documents, doc_id=doc_id, text=text).where("NOT kept")
    gone = gone.select(F.col("doc_id").alias(removed_id)).distinct()
    named = documents.where(F.col(doc_id).isNotNull())
    named = named.join(gone, F.col(doc_id).cast("long") == F.col(removed_id), "left_anti")
    first = Window.partitionBy(doc_id).orderBy(F.xxhash64(text))
    one = named.withColumn(number, F.row_number().over(first)).where(F.col(number) == 1).drop(number)
    return one.unionByName(documents.where(F.col(doc_id).isNull()))
