"""Repeated passages by a distributed merge sort of suffixes.

A byte goes if a string of ``length`` bytes that covers it starts anywhere
else as well. All strings of that length with the same bytes have the same
anchor: the place of their smallest hashed piece. So it is enough to sort the
suffixes that begin at anchors, each with the bytes before it:

* Anchors whose piece occurs once cannot repeat and go first. Contexts that
  are equal as a whole are counted, and one of them stands for all.
* Each task sorts its suffixes and sends them as front-coded runs. A run's
  reader merges all runs of its part with a loser tree that keeps the common
  prefix of each loser with its winner and compares from there on only.
* A group of more suffixes than a merge holds is split by what its strings have
  in common besides the piece, further bytes behind it or before it, and goes
  to as many merge groups.
* Neighbours in that order have the longest common prefixes. Joining them from
  the longest down, next to those with the longest common text before the
  anchor, tells for each suffix which strings around its anchor repeat.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flarebook.llm.near_dup import Powers, U, mixed
from flarebook.llm.tables import held_here, scratch, utf8

LENGTH = 200
PIECE = 32
CHUNK = 1 << 20  # strings looked at together
RUN_BYTES = 24_000_000  # of suffixes that a task sorts at once
ROWS_AT_ONCE = 200_000  # anchors or strings that a task sends on together
HOT = 2000  # contexts around a piece, or more common bytes, that one merge group holds
BYTES = np.arange(1, 257, dtype=np.uint64)


def smallest_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    count = len(values) - width + 1
    padded = np.concatenate((values, np.full(-len(values) % width, np.iinfo(np.uint64).max, U))).reshape(-1, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def chunks_of_anchors(text: memoryview, length: int, piece: int = PIECE) -> Iterator[tuple[np.ndarray, ...]]:
    """``anchors`` of each chunk of a text, in order of their places."""
    strings = len(text) - length + 1
    for start in range(0, max(strings, 0), CHUNK):
        count = min(CHUNK, strings - start)
        data = np.frombuffer(text[start : start + count + length - 1], np.uint8)
        Powers.reach(len(data))
        sums = np.concatenate(([U(0)], np.cumsum(BYTES[data] * Powers.up[: len(data)])))
        pieces = mixed((sums[piece:] - sums[:-piece]) * Powers.down[: len(data) - piece + 1])
        # Ordered by hash, then by place: equal strings choose the same anchor.
        ranked = (pieces >> U(24) << U(24)) | np.arange(len(pieces), dtype=U)
        chosen = (smallest_ahead(ranked, length - piece + 1) & U(0xFFFFFF)).astype(np.int64)
        firsts = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        lasts = np.concatenate((firsts[1:], [count])) - 1
        place = chosen[firsts]
        around = (sums[lasts + length] - sums[firsts]) * Powers.down[firsts]
        most, least = place - firsts, place - lasts
        context = mixed(around ^ (most * 65536 + least).astype(U) * U(0x9E3779B97F4A7C15))
        yield place + start, least, most, pieces[place].view(np.int64), context.view(np.int64)


def anchors(text: memoryview, length: int = LENGTH, piece: int = PIECE) -> tuple[np.ndarray, ...]:
    """Anchors of all strings of ``length``: place, least and most bytes before it, hash of the piece, of the context.

    An anchor serves the strings that begin ``least`` to ``most`` bytes before
    it; its context is all their bytes. A text is looked at in chunks; the
    strings around a cut may meet one anchor in two rows.
    """
    found = list(chunks_of_anchors(text, length, piece))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(column) for column in zip(*found))


def touching(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans in order; those that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate(([True], starts[1:] > ends[:-1]))) if len(starts) else order
    return starts[first], ends[np.concatenate((first[1:], [len(ends)])) - 1] if len(first) else ends


def without_copies(found: tuple[np.ndarray, ...], length: int) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """The first anchor of each context in a chunk, with how often it occurs there; spans of those that occur again."""
    place, least, most, piece, context = found
    order = np.lexsort((context, piece))
    ahead, behind = order[:-1], order[1:]
    new = np.concatenate(([True], (piece[behind] != piece[ahead]) | (context[behind] != context[ahead])))
    heads = np.flatnonzero(new)
    times = np.diff(np.concatenate((heads, [len(order)])))
    again = order[np.repeat(times > 1, times)]
    kept = order[heads]
    rows = (place[kept], least[kept], most[kept], piece[kept], context[kept], times)
    return rows, touching(place[again] - most[again], place[again] - least[again] + length)


def shared_from(a: bytes, b: bytes, start: int) -> int:
    """The length of the common prefix, of which ``start`` bytes are known."""
    end = min(len(a), len(b))
    while start < end and a[start : start + 32] == b[start : start + 32]:
        start += 32
    if start >= end:
        return end
    while start < end and a[start] == b[start]:
        start += 1
    return start


def front_coded(rows: list[tuple[bytes, bytes]]) -> bytes:
    """Sorted keys with what they share with the key before them left out, each with a value."""
    out, before = [], b""
    for key, value in rows:
        shared = shared_from(before, key, 0)
        out.append(struct.pack("<HHH", shared, len(key) - shared, len(value)))
        out += (key[shared:], value)
        before = key
    return b"".join(out)


def decoded(run: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """Of each key in a run: what it shares with the one before it, the key, its value."""
    at, key = 0, b""
    while at < len(run):
        shared, rest, size = struct.unpack_from("<HHH", run, at)
        at += 6
        key = key[:shared] + run[at : at + rest]
        yield shared, key, run[at + rest : at + rest + size]
        at += rest + size


class LoserTree:
    """Merges sorted runs; of each run it knows what its next key shares with the last key given out."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes, bytes]]]):
        self.runs = runs
        self.size = 1 << max(0, len(runs) - 1).bit_length()
        self.key: list[bytes | None] = [None] * self.size
        self.value = [b""] * self.size
        self.shared = [0] * self.size
        for i in range(len(runs)):
            self._next(i)
        self.losers = [0] * self.size
        winners = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            winners[node], self.losers[node] = self._play(winners[2 * node], winners[2 * node + 1])
        self.winner = winners[1] if self.size > 1 else 0

    def _next(self, i: int) -> None:
        row = next(self.runs[i], None)
        self.shared[i], self.key[i], self.value[i] = row or (0, None, b"")

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser. Who shares more with the last key is smaller; only equals are compared, past that."""
        if self.key[b] is None:
            return a, b
        if self.key[a] is None:
            return b, a
        if self.shared[a] != self.shared[b]:
            return (a, b) if self.shared[a] > self.shared[b] else (b, a)
        one, two = self.key[a], self.key[b]
        same = shared_from(one, two, self.shared[a])
        winner, loser = (a, b) if one[same : same + 1] <= two[same : same + 1] else (b, a)
        self.shared[loser] = same
        return winner, loser

    def __iter__(self) -> Iterator[tuple[int, bytes, bytes]]:
        while self.key[self.winner] is not None:
            i = self.winner
            yield self.shared[i], self.key[i], self.value[i]
            self._next(i)
            node = (i + self.size) // 2
            while node:
                i, self.losers[node] = self._play(i, self.losers[node])
                node //= 2
            self.winner = i


def repeated(prefixes: list[int], before: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Of each suffix of a sorted group, ranges of bytes before the anchor at which a repeated string begins.

    ``prefixes`` are shared with the suffix ahead, ``before`` holds the bytes
    before the anchors, backwards. A string that begins o bytes before the
    anchor repeats if some other suffix shares length - o bytes after the
    anchor and o bytes before it. Groups of suffixes are joined from long to
    short common prefixes; a smaller group is put into a larger one, in the
    order of the bytes before, and what matters is next to each other then.
    """
    count = len(before)
    order = sorted(range(count), key=before.__getitem__)
    rank = [0] * count
    for place, i in enumerate(order):
        rank[i] = place
    found: list[list[tuple[int, int]]] = [[] for _ in range(count)]
    group = list(range(count))
    members: dict[int, list[int]] = {i: [rank[i]] for i in range(count)}

    def top(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for at in sorted(range(1, count), key=lambda i: -prefixes[i]):
        large, small = top(at - 1), top(at)
        if len(members[large]) < len(members[small]):
            large, small = small, large
        ranks = members[large]
        for place in members.pop(small):
            at_rank = bisect_left(ranks, place)
            i = order[place]
            for near in (at_rank - 1, at_rank):
                if 0 <= near < len(ranks):
                    j = order[ranks[near]]
                    least, most = length - prefixes[at], shared_from(before[i], before[j], 0)
                    if least <= most:
                        found[i].append((least, most))
                        found[j].append((least, most))
            ranks.insert(at_rank, place)
        group[small] = large
    return found


CONTEXT = "<qqqBhhB"  # document, its key, anchor, whether it has no id, least, most, whole


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def spans_array(counts: list[int], starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Lists of so many spans each."""
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
    values = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["start", "end"])
    return pa.ListArray.from_arrays(offsets, values, type=SPANS)


def entries(column: pa.Array) -> Iterator[dict[str, pa.Array]]:
    """The fields of each row's list of structs, without a Python value for each; null is an empty list."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values, start = column.flatten(), 0
    fields = {field.name: pc.struct_field(values, field.name) for field in values.type}
    for size in sizes.tolist():
        yield {name: field.slice(start, size) for name, field in fields.items()}
        start += size


def numbers(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


def of_document(fields: dict[str, pa.Array], doc: int | None) -> dict[str, np.ndarray]:
    """The entries that name a document, as numbers."""
    ids = fields["doc_id"]
    own = numbers(ids.is_null() if doc is None else pc.fill_null(pc.equal(ids, doc), False))
    return {name: numbers(field)[own] for name, field in fields.items() if name != "doc_id"}


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that not all of a large one exists as Python values."""
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            yield batch.slice(start, 500)


def keyed(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``text``, ``carried_<i>`` and ``key``. Rows with the same id and text share a key, and their result."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    others = [F.col(name).alias(f"carried_{i}") for i, name in enumerate(carried)]
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *others)
    return given.withColumn("key", F.xxhash64("doc_id", "text"))


def repeated_anchors(texts: DataFrame, length: int, folder: str) -> DataFrame:
    """Anchors whose piece occurs twice: ``whole`` if all their context does, ``wanted`` if it must be looked at.

    ``hot`` ones have a piece with more than ``HOT`` contexts, to be split. Of a context that
    a chunk of a text has more than once only the first anchor is there;
    ``spans``, on one of them in a chunk, are what all of them cover.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_here("anchors", dict)
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("key")
            held: list[tuple] = []
            size = 0
            for row, text in enumerate(utf8(batch.column("text"))):
                for chunk in chunks_of_anchors(text, length):
                    held.append((row, *without_copies(chunk, length)))
                    size += len(held[-1][1][0])
                    if size >= ROWS_AT_ONCE:
                        yield out(ids, keys, held)
                        held, size = [], 0
            if held:
                yield out(ids, keys, held)

    def out(ids: pa.Array, keys: pa.Array, held: list[tuple]) -> pa.RecordBatch:
        which = pa.array(np.repeat([row for row, _, _ in held], [len(rows[0]) for _, rows, _ in held]))
        columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*[rows for _, rows, _ in held])]
        counts = []
        for _, rows, (starts, _) in held:
            of_chunk = np.zeros(len(rows[0]), np.int64)
            # On a row that stays: its context occurs again.
            of_chunk[int(np.argmax(rows[5] > 1))] = len(starts)
            counts.append(of_chunk)
        spans = spans_array(np.concatenate(counts), *(np.concatenate(c) for c in zip(*[found for _, _, found in held])))
        names = ["doc_id", "key", "anchor", "least", "most", "piece", "context", "times", "spans"]
        return pa.RecordBatch.from_arrays([ids.take(which), keys.take(which), *columns, spans], names=names)

    found = texts.select("doc_id", "key", "text").mapInArrow(
        find,
        "doc_id long, key long, anchor long, least long, most long, piece long, context long, times long,"
        " spans array<struct<start: long, end: long>>",
    )
    same = Window.partitionBy("piece", "context")
    around = Window.partitionBy("piece")
    first = F.row_number().over(same.orderBy("doc_id", "key", "anchor")) == 1
    judged = (
        found.withColumn("first", first)
        .withColumn("whole", F.sum("times").over(same) > 1)
        .withColumn("wanted", (F.min("context").over(around) < F.max("context").over(around)) & F.col("first"))
        .withColumn("hot", F.count_if("first").over(around) > HOT)
        .filter(F.col("whole") | F.col("wanted"))
    )
    judged.select("doc_id", "key", "anchor", "least", "most", "whole", "wanted", "hot", "spans").write.parquet(folder)
    return texts.sparkSession.read.parquet(folder)


CONTEXTS = "doc_id long, key long, anchor long, least long, most long, whole boolean, bytes binary"


def contexts_in(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple]:
    """Of each anchor of joined texts: document, key, anchor, least, most, whole, the bytes of all strings it serves."""
    for batch in small(batches):
        known = zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), utf8(batch.column("text")))
        for (doc, key, text), fields in zip(known, entries(batch.column("items"))):
            own = of_document(fields, doc)
            for at, least, most, whole in zip(*(own[name].tolist() for name in ("anchor", "least", "most", "whole"))):
                yield doc, key, at, least, most, whole, bytes(text[at - most : at - least + length])


def with_anchors(texts: DataFrame, found: DataFrame) -> DataFrame:
    items = found.groupBy("key").agg(
        F.collect_list(F.struct("doc_id", "anchor", "least", "most", "whole")).alias("items")
    )
    return with_lists(texts.select("doc_id", "key", "text"), items, "items")


CONTEXTS = "doc_id long, key long, anchor long, least long, most long, whole boolean, bytes binary"


def contexts(texts: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """The bytes of all strings that each anchor serves."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [one.split()[0] for one in CONTEXTS.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.binary()]
        for rows in batched(contexts_in(batches, length), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return with_anchors(texts, found).mapInArrow(cut, CONTEXTS)


def halved(rows: DataFrame, length: int) -> DataFrame:
    """Each context as up to two: for the strings that begin further before the anchor, and for the others.

    ``low`` to ``high`` bytes before the anchor the strings of a group begin, so
    they have ``low`` bytes before it and ``length - high`` behind in common:
    ``shared``. ``bytes`` are cut to what the strings of the half have.
    """
    middle = F.floor((F.col("low") + F.col("high")) / 2)
    sides = F.array(
        F.struct(F.col("low").alias("from"), middle.alias("to")),
        F.struct((middle + 1).alias("from"), F.col("high").alias("to")),
    )
    cut = rows.withColumn("side", F.explode(sides)).select(
        "doc_id", "key", "anchor", "whole", "bytes", F.col("most").alias("had"), F.col("side.from").alias("low"),
        F.col("side.to").alias("high"), F.greatest("least", "side.from").alias("least"),
        F.least("most", "side.to").alias("most"),
    ).filter("least <= most")
    return cut.select(
        "doc_id", "key", "anchor", "whole", "low", "high", "least", "most",
        F.expr(f"substring(bytes, CAST(had - most + 1 AS INT), CAST(most - least + {length} AS INT))").alias("bytes"),
    ).withColumn("shared", F.expr(f"substring(bytes, CAST(most - low + 1 AS INT), CAST(low + {length} - high AS INT))"))


def split_groups(rows: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """Contexts in groups that a merge holds, and spans of those that are equal as a whole.

    Groups are halved until they are small enough. Contexts that are equal in
    all that a half has of them are counted, and one of them goes on, so the
    strings of a passage in very many documents soon are one context, and only
    the half that reaches over the passage's end is large again. Groups and
    contexts are told apart by their bytes. In the end a half is one string,
    and a group one context.
    """
    spark = rows.sparkSession
    context = ["low", "high", "least", "most", "bytes"]
    ready, spans = None, []
    rows = rows.withColumn("low", F.lit(0).cast("long")).withColumn("high", F.lit(length - PIECE).cast("long"))
    while True:
        folder = scratch(spark, "halves")
        halved(rows, length).write.parquet(folder)
        rows = spark.read.parquet(folder)
        folder = scratch(spark, "contexts")
        (
            rows.groupBy(*context)
            .agg(
                F.count(F.lit(1)).alias("times"),
                F.min(F.struct("doc_id", "key", "anchor")).alias("first"),
                F.bool_or("whole").alias("known"),
                F.first("shared").alias("shared"),
            )
            .write.parquet(folder)
        )
        distinct = spark.read.parquet(folder)
        again = distinct.filter("times > 1").select(*context)
        spans.append(rows.filter("NOT whole").join(again, context).select("doc_id", "key", *span_of_anchor(length)))
        sizes = distinct.groupBy("low", "high", "shared").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        folder = scratch(spark, "groups")
        distinct.join(sizes, ["low", "high", "shared"]).select(
            "first.*", *context, (F.col("known") | (F.col("times") > 1)).alias("whole"), "size"
        ).write.parquet(folder)
        groups = spark.read.parquet(folder)
        fits = groups.filter(F.col("size") <= HOT).drop("size")
        ready = fits if ready is None else ready.unionByName(fits)
        rows = groups.filter(F.col("size") > HOT).drop("size")
        if rows.isEmpty():
            return ready, spans


def span_of_anchor(length: int) -> list[Column]:
    start, end = F.col("anchor") - F.col("most"), F.col("anchor") - F.col("least") + length
    return [start.alias("start"), end.alias("end")]


HEAD = "<HH"  # the least and most bytes before the anchor at which the strings of a merge group begin


def runs_of(rows: Iterator[tuple], length: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Contexts, each with its group's ``low`` and ``high``, as runs by part: sorted by group and suffix, front-coded.

    A key is a group's place among its like, the bytes that its strings have in
    common before the anchor, and the suffix.
    """
    held: dict[int, list[tuple[bytes, bytes]]] = {}
    size = 0

    def out() -> pa.RecordBatch:
        coded = [front_coded(sorted(rows)) for rows in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.int64()), pa.array(coded)], names=["part", "run"])

    for doc, key, at, least, most, whole, data, low, high in rows:
        sort_key = struct.pack(HEAD, low, high) + data[most - low :]
        fixed = struct.pack(CONTEXT, doc or 0, key, at, doc is None, least, most, whole)
        part = zlib.crc32(sort_key[: group_prefix(low, high, length)]) % parts
        held.setdefault(part, []).append((sort_key, fixed + data[:most][::-1]))
        size += len(data) + most + 200
        if size >= RUN_BYTES:
            yield out()
            held, size = {}, 0
    if held:
        yield out()


def sorted_runs(texts: DataFrame, wanted: DataFrame, length: int, parts: int) -> DataFrame:
    """``part``, ``run`` of the suffixes at wanted anchors; what has a piece in common is a group."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return runs_of(((*row, 0, length - PIECE) for row in contexts_in(batches, length)), length, parts)

    return with_anchors(texts, wanted).mapInArrow(runs, "part long, run binary")


def sorted_runs_of_groups(rows: DataFrame, length: int, parts: int) -> DataFrame:
    """``part``, ``run`` of groups that were split."""
    names = ("doc_id", "key", "anchor", "least", "most", "whole", "bytes", "low", "high")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (row for batch in small(batches) for row in zip(*(batch.column(name).to_pylist() for name in names)))
        return runs_of(given, length, parts)

    return rows.select(*names).mapInArrow(runs, "part long, run binary")


def group_prefix(low: int, high: int, length: int) -> int:
    """How much of their keys the contexts of a merge group share."""
    return struct.calcsize(HEAD) + low + length - high


def with_lists(texts: DataFrame, lists: DataFrame, name: str, how: str = "inner") -> DataFrame:
    """Joined on the key alone, by which the texts are laid out. Entries name their document, for keys that collide."""
    return texts.join(lists.select(F.col("key").alias("of_key"), name), F.col("key") == F.col("of_key"), how).drop("of_key")


def merged(runs: DataFrame, length: int) -> DataFrame:
    """``doc_id``, ``key``, ``start``, ``end`` of what the merge of each part finds repeated."""

    def merge(given: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        tree = LoserTree([decoded(run) for run in given.column("run").to_pylist()])
        prefixes: list[int] = []
        held: list[tuple] = []
        before: list[bytes] = []

        def close() -> None:
            if len(held) > 1:
                for (doc, key, at, no_doc, least, most, whole), ranges in zip(held, repeated(prefixes, before, length)):
                    if not whole:
                        for low, high in ranges:
                            if max(low, least) <= min(high, most):
                                span = (at - min(high, most), at - max(low, least) + length)
                                rows.append((None if no_doc else doc, key, *span))
            for kept in (prefixes, held, before):
                kept.clear()

        for shared, key, value in tree:
            low, high = struct.unpack_from(HEAD, key)
            if shared < group_prefix(low, high, length):
                close()
            prefixes.append(shared - struct.calcsize(HEAD) - low)
            held.append(struct.unpack_from(CONTEXT, value))
            before.append(value[struct.calcsize(CONTEXT) :])
        close()
        columns = zip(*set(rows)) if rows else [[], [], [], []]
        names = ["doc_id", "key", "start", "end"]
        return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=names)

    return runs.groupBy("part").applyInArrow(merge, "doc_id long, key long, start long, end long")


def around_cut(text: memoryview, cut: int) -> tuple[int, int]:
    """Start and end of the character that a cut falls into; the cut itself if it falls between two."""
    first = max(cut - 3, 0)
    near = bytes(text[first : cut + 3])
    for start in range(cut - first - 1, -1, -1):
        if near[start] >= 0xC0:
            end = start + 2 + (near[start] >= 0xE0) + (near[start] >= 0xF0)
            rest = near[cut - first : end]
            inside = cut - first < end <= len(near) and all(b & 0xC0 == 0x80 for b in rest)
            return (first + start, first + end) if inside else (cut, cut)
        if near[start] < 0x80:
            break
    return cut, cut


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, carried: tuple[str, ...] = (), whole_characters: bool = False
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` and ``kept`` of each row, and the ``carried`` columns unchanged.

    Reads ``doc_id`` and ``text``, a whole text as UTF-8 bytes; a null text is
    empty. A byte goes if a string of ``length`` bytes that covers it also
    starts at another place, in the same document or another; all places of a
    repeated string go. ``spans`` are the maximal runs removed, struct(start,
    end) in bytes of the text; ``kept`` is the rest as binary. Strings never
    cross documents. A text shorter than ``length`` is kept, also where whole
    rows repeat; longer rows that repeat go as a whole. With
    ``whole_characters`` spans also take the characters that they begin or end
    within, so the rest of a text has only characters of it.
    """
    if not PIECE < length <= 30_000:
        raise ValueError("the length must lie between the piece's and 30,000")
    spark = docs.sparkSession
    texts = keyed(docs, carried)
    found = repeated_anchors(texts, length, scratch(spark, "anchors"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    moved = texts.repartition(parts, "key")  # once, for both joins
    runs = sorted_runs(moved, found.filter("wanted and not hot"), length, parts)
    hot, spans = found.filter("wanted and hot"), []
    if not hot.isEmpty():
        groups, spans = split_groups(contexts(moved, hot, length), length)
        runs = runs.unionByName(sorted_runs_of_groups(groups, length, parts))
    resolved = merged(runs, length)
    for more in spans:
        resolved = resolved.unionByName(more)
    own = F.array(F.struct(*span_of_anchor(length)))
    whole = found.filter("whole").select("doc_id", "key", F.explode(F.concat(own, "spans")).alias("span"))
    lists = (
        whole.select("doc_id", "key", "span.*").unionByName(resolved).groupBy("key").agg(F.collect_list(F.struct("doc_id", "start", "end")).alias("spans"))
    )

    places = [f"carried_{i}" for i in range(len(carried))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "spans", "kept", *places]
        for batch in small(batches):
            sizes, counts, starts, ends, kept = [], [], [], [], []
            known = zip(batch.column("doc_id").to_pylist(), entries(batch.column("spans")))
            for text, (doc, fields) in zip(utf8(batch.column("text")), known):
                own = of_document(fields, doc)
                gone = touching(own["start"], own["end"])
                if whole_characters:
                    wide = [
                        [around_cut(text, cut)[side] for cut in cuts.tolist()] for side, cuts in enumerate(gone)
                    ]
                    gone = touching(*(np.array(cuts, np.int64) for cuts in wide))
                edges = [0, *np.stack(gone, axis=1).ravel().tolist(), len(text)]
                sizes.append(len(text))
                counts.append(len(gone[0]))
                starts.append(gone[0])
                ends.append(gone[1])
                kept.append(b"".join(bytes(text[a:b]) for a, b in zip(edges[::2], edges[1::2])))
            spans = spans_array(counts, np.concatenate(starts), np.concatenate(ends))
            made = [pa.array(sizes, pa.int64()), spans, pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made, *map(batch.column, places)], names=names)

    schema = StructType.fromDDL(
        "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    )
    for place in places:
        schema.add(texts.schema[place])
    made = with_lists(moved, lists, "spans", "left").mapInArrow(cut, schema)
    return made.select(
        "doc_id", "n_bytes", "spans", "kept", *[F.col(p).alias(c) for p, c in zip(places, carried)]
    )


def as_text(kept: Column) -> Column:
    """The rest as text. Bytes that are no whole character go; valid text, also its replacement characters, stays."""
    # Marked while bytes are made valid, as that brings replacement characters in.
    marked = F.replace(F.replace(kept.cast("string"), F.lit("\x01"), F.lit("\x01a")), F.lit("\ufffd"), F.lit("\x01b"))
    valid = F.replace(F.make_valid_utf8(marked), F.lit("\ufffd"), F.lit(""))
    return F.replace(F.replace(valid, F.lit("\x01b"), F.lit("\ufffd")), F.lit("\x01a"), F.lit("\x01"))
