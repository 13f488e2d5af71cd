"""Near duplicates by bottom-k sketches of one hash function.

A document's set holds the hashes of its distinct five-word shingles, its
sketch the smallest of them. Documents with the same set are one class.
Inverted lists of the rare retained values bring classes that may be near
together as families; in a family the sketch of the union estimates the
overlap, and the full sets decide.

Two sets of the wanted similarity share so many retained values that they
share one among the first few in the order from rare to frequent, so only
these are listed. Passages and lines that very many documents have come last
in that order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flarebook.llm.graph import components
from flarebook.llm.tables import held_here, scratch, utf8, word_chunks

WORDS = 5
SIMILAR = (85, 100)
RETAINED = 64  # values in the inverted lists
ESTIMATED = 256  # values in the sketch of a union
MISSED = 1e-9  # chance that sampling hides a pair that is just similar enough
BLOCK_CLASSES = 128

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(int(BASE), -1, 2**64))
FACTORS = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], U)
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += U(32)
LOWER += U(1)  # so that no byte counts as nothing
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Weights:
    """A fixed random odd factor for each place in a word, made once per worker.

    Places have no algebra in common, unlike powers of a base: with those, long
    words of two letters in a certain order would always have the same sum.
    """

    of_place = np.ones(0, U)

    @classmethod
    def reach(cls, length: int) -> np.ndarray:
        if len(cls.of_place) < length:
            cls.of_place = mixed(np.arange(1, (1 << max(12, length.bit_length())) + 1, dtype=U) * BASE) | U(1)
        return cls.of_place


class Powers:
    """Powers of the base and of its inverse, made once per worker."""

    up = np.ones(1, U)
    down = np.ones(1, U)

    @classmethod
    def reach(cls, length: int) -> None:
        if len(cls.up) <= length:
            size = 1 << max(20, length.bit_length())
            cls.up = np.cumprod(np.concatenate(([U(1)], np.full(size, BASE, U))))
            cls.down = np.cumprod(np.concatenate(([U(1)], np.full(size, BASE_INVERSE, U))))


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of a value spread over all bits."""
    values = (values ^ (values >> U(30))) * U(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> U(27))) * U(0x94D049BB133111EB)
    return values ^ (values >> U(31))


def word_hashes(text: memoryview) -> np.ndarray:
    """A hash of each word in order, A-Z made lower case."""
    found = [np.zeros(0, U)]
    for chunk in word_chunks(text, 1 << 20):
        data = np.frombuffer(chunk, np.uint8)
        words = ~BLANK[data]
        inside = np.concatenate(([False], words, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        lengths = edges[1::2] - edges[::2]
        if len(lengths):
            starts = np.cumsum(lengths) - lengths
            weights = Weights.reach(int(lengths.max()))
            places = np.arange(lengths.sum()) - np.repeat(starts, lengths)
            found.append(mixed(np.add.reduceat(LOWER[data[words]] * weights[places], starts) + lengths.astype(U)))
    return np.concatenate(found)


def shingles(text: memoryview) -> np.ndarray:
    """The sorted distinct hashes of all runs of five words; of all words if there are fewer."""
    words = word_hashes(text)
    run = min(WORDS, len(words))
    if not run:
        return words
    count = len(words) - run + 1
    total = np.full(count, U(run), U)
    for i in range(run):
        total += words[i : i + count] * FACTORS[i]
    return np.unique(mixed(total))


def digest(values: np.ndarray) -> tuple[int, int]:
    """128 bits that are the same for the same set."""
    both = (mixed(values ^ FACTORS[0]).sum(dtype=U), mixed(values ^ FACTORS[1]).sum(dtype=U) + U(len(values)))
    return tuple(np.array(both, U).view(np.int64).tolist())


def least_shared(retained: int, similar: tuple[int, int] = SIMILAR) -> int:
    """How many of so many values of a union two similar sets share, but for a chance of ``MISSED``."""
    share, below = similar[0] / similar[1], 0.0
    for count in range(retained + 1):
        below += math.comb(retained, count) * share**count * (1 - share) ** (retained - count)
        if below > MISSED:
            return count
    return retained


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, the digest ``d1``, ``d2`` and the ``sketch`` of each whole text."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_here("sketches", dict)
        for batch in batches:
            rows = []
            for text in utf8(batch.column("text")):
                values = shingles(text)
                low = values[:RETAINED].view(np.int64)
                rows.append((len(values), *digest(values), low))
            sizes, first, second, low = zip(*rows) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()),
                 pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(low, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_shingles", "d1", "d2", "sketch"],
            )

    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("string").alias("text"),
    )
    return given.mapInArrow(
        made, "doc_id long, text_key long, n_shingles long, d1 long, d2 long, sketch array<long>"
    )


def families(classes: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """``node``, ``root``: classes that share a rare retained value, and those joined through others."""
    spread = classes.select("cid", "n_shingles", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    # Counted before they are joined, so a value of very many classes is one row a task.
    times = spread.groupBy("value").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    shared = spread.join(times, "value")
    small = F.col("n_shingles") * similar[1] <= RETAINED * similar[0]
    exact = F.ceil(F.col("n_shingles") * similar[0] / similar[1]) - 1
    needed = F.greatest(F.when(small, exact).otherwise(least_shared(RETAINED, similar)), F.lit(1))
    own = Window.partitionBy("cid")
    rare_only = F.col("kept") - F.count(F.lit(1)).over(own)
    turn = F.row_number().over(own.orderBy("classes", "value"))
    listed = shared.withColumn("turn", turn + rare_only).filter(F.col("turn") <= F.col("kept") - needed + 1)
    listed = listed.select("cid", "value")
    first = listed.groupBy("value").agg(F.min("cid").alias("first"))
    return components(listed.join(first, "value").select(F.col("cid").alias("a"), F.col("first").alias("b")))


def union_share(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How many of the smallest values of the union are in both, and how many were looked at."""
    both, times = np.unique(np.concatenate((a[:ESTIMATED], b[:ESTIMATED])), return_counts=True)
    return int((times[:ESTIMATED] == 2).sum()), min(ESTIMATED, len(both))


def is_similar(a: np.ndarray, b: np.ndarray, similar: tuple[int, int]) -> bool:
    shared = np.intersect1d(a, b, assume_unique=True).size
    return shared * similar[1] >= similar[0] * (len(a) + len(b) - shared)


def links(cids: list[int], sets: list[np.ndarray], across: np.ndarray | None, similar: tuple[int, int]) -> list[tuple]:
    """Links that join all similar sets; a pair that others have joined already is not looked at.

    With ``across``, only pairs from different sides of it.
    """
    sizes = np.array([len(s) for s in sets])
    low = [s[:ESTIMATED] for s in sets]
    owner = np.repeat(np.arange(len(low)), [len(s) for s in low])
    values, place, times = np.unique(np.concatenate(low), return_inverse=True, return_counts=True)
    often = np.flatnonzero(times > 1)
    column = np.full(len(values), -1)
    column[often] = np.arange(len(often))
    held = np.zeros((len(sets), len(often)), np.float32)
    seen = column[place] >= 0
    held[owner[seen], column[place][seen]] = 1
    shared = held @ held.T
    least, most = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    fits = least * similar[1] >= most * similar[0]
    whole = most <= ESTIMATED
    exact = shared * similar[1] >= similar[0] * (sizes[:, None] + sizes[None, :] - shared)
    needed = min(least_shared(ESTIMATED, similar), similar[0] * ESTIMATED * similar[0] // similar[1] ** 2)
    maybe = np.triu(fits & np.where(whole, exact, shared >= needed), 1)
    if across is not None:
        maybe &= across[:, None] != across[None, :]
    root = list(range(len(sets)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    found = []
    for i, j in np.argwhere(maybe).tolist():
        a, b = top(i), top(j)
        if a == b:
            continue
        both, looked = union_share(sets[i], sets[j])
        if looked == ESTIMATED and both < least_shared(ESTIMATED, similar):
            continue
        if is_similar(sets[i], sets[j], similar):
            root[max(a, b)] = min(a, b)
            found.append((cids[i], cids[j]))
    return found


def verified(docs: DataFrame, members: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """``a``, ``b``: confirmed links of classes. ``members`` has ``cid``, ``root``, ``d1``, ``d2`` and the
    row that stands for a class, ``min_doc`` and ``min_key``.

    A family is cut into blocks of about ``BLOCK_CLASSES``; each pair of blocks
    is a task of its own that holds the full sets of these two only.
    """
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES).alias("blocks"))
    placed = members.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    keys = placed.select(
        "cid", "root", "block", "blocks", "d1", "d2", F.col("min_doc").alias("of_doc"), F.col("min_key").alias("of_key")
    )
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("string").alias("text"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_key"))
    wanted = texts.join(keys, same).select(
        "text", "cid", "root", "block", "blocks", "d1", "d2"
    )

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["root", "low", "high", "block", "cid", "values"]
        kinds = [pa.int64()] * 5 + [pa.binary()]
        sent: set[int] = set()
        for batch in batches:
            known = [batch.column(c).to_pylist() for c in ("cid", "root", "block", "blocks", "d1", "d2")]
            for text, cid, root, block, blocks, d1, d2 in zip(utf8(batch.column("text")), *known):
                if cid in sent:  # a row that repeats id and text
                    continue
                values = shingles(text)
                if digest(values) != (d1, d2):  # another text with this id and hash
                    continue
                sent.add(cid)
                held = values.tobytes()
                rows = [(root, min(block, x), max(block, x), block, cid, held) for x in range(blocks)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def compare(tile: pa.Table) -> pa.Table:
        rows = {r["cid"]: r for r in tile.select(["cid", "block", "values", "low", "high"]).to_pylist()}
        cids = sorted(rows)
        sets = [np.frombuffer(rows[c]["values"], U) for c in cids]
        blocks = np.array([rows[c]["block"] for c in cids])
        one = rows[cids[0]]
        found = links(cids, sets, None if one["low"] == one["high"] else blocks, similar) if len(cids) > 1 else []
        columns = zip(*found) if found else [[], []]
        return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=["a", "b"])

    spread = wanted.mapInArrow(tiles, "root long, low long, high long, block long, cid long, values binary")
    return spread.groupBy("root", "low", "high").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``text_key``, ``component`` of each row.

    Reads ``doc_id`` and ``text``; ``text_key`` is xxhash64 of the text, for
    joins where ids repeat. ``component`` is a number that tells components
    apart where ids repeat or are null; it is null for a text without words. Words are runs without ASCII blanks, A-Z
    made lower case; a text of fewer than five words is one shingle. A null or
    empty text, or one without words, is linked with nothing. Two documents
    are linked if their sets share ``similar`` of their union; a component is
    all that links reach, its id the smallest ``doc_id`` in it. A null
    ``doc_id`` takes part and is never the smallest, unless there is no other.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "sketches")
    sketches(docs).write.parquet(folder)
    rows = spark.read.parquet(folder)
    folder = scratch(spark, "classes")
    first_key = F.coalesce(F.min_by("text_key", "doc_id"), F.min("text_key"))
    (
        rows.filter("n_shingles > 0")
        .groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("min_doc"), first_key.alias("min_key"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
        .withColumn("cid", F.monotonically_increasing_id())
        .write.parquet(folder)
    )
    classes = spark.read.parquet(folder)
    family = families(classes, similar)
    members = classes.select("cid", "min_doc", "min_key", "d1", "d2").join(
        family.select(F.col("node").alias("cid"), "root"), "cid"
    )
    joined = components(verified(docs, members, similar)).select(F.col("node").alias("cid"), "root")
    known = classes.select("cid", "min_doc", "d1", "d2").join(joined, "cid")
    least = known.groupBy("root").agg(F.min("min_doc").alias("component"))
    linked = known.join(least, "root").select("cid", "root", "component")
    ids = classes.select("cid", "d1", "d2", "min_doc").join(linked, "cid", "left")
    smallest = F.when(F.col("root").isNull(), F.col("min_doc")).otherwise(F.col("component"))
    ids = ids.select("d1", "d2", F.coalesce("root", "cid").alias("root"), smallest.alias("component"))
    component: Column = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return (
        rows.select("doc_id", "n_shingles", "d1", "d2", "text_key")
        .join(ids, ["d1", "d2"], "left")
        .select("doc_id", "n_shingles", component.alias("component_id"), "text_key", "root")
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
            "text_key",
            F.when(F.col("n_shingles") > 0, F.col("root")).alias("component"),
        )
    )


def one_of_each(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """Rows of ``docs``: of each component one, all of texts without words.

    It is the row with the smallest id, among equal ids the smallest hash of
    the text; a null id is the last. Of rows that repeat id and text one stays.
    """
    found = near_duplicates(docs, similar)
    rows = found.filter("n_shingles > 0").groupBy("component", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "rows")).alias("first")
    chosen = rows.groupBy("component").agg(first).select("first.doc_id", "first.text_key", "first.rows")
    without = found.filter("n_shingles = 0").select("doc_id", "text_key").distinct().withColumn("rows", F.lit(1))
    chosen = chosen.unionByName(without).toDF("own_doc_id", "own_text_key", "own_rows")
    prefix = "own_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"{prefix}_"
    chosen = chosen.toDF(*[f"{prefix}{c}" for c in ("doc_id", "text_key", "rows")])
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(f"{prefix}doc_id"))
    same &= F.xxhash64("text") == F.col(f"{prefix}text_key")
    alone, several = (docs.join(chosen.filter(f"{prefix}rows {how}"), same, "left_semi") for how in ("= 1", "> 1"))
    return alone.unionByName(several.dropDuplicates(["doc_id", "text"]))
