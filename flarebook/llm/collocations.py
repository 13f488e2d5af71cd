"""Phrase collocations by partitioned mining.

Texts become shards of a bounded number of words, each of one language. A
phrase that occurs often enough in all of a language occurs often enough, for
the shard's share of the words, in at least one shard. So each shard is mined
completely at its own lowered support, what is frequent in any shard is a
candidate, and the counts that the other shards have of the candidates are
added exactly.

Phrases grow by a word a level: one of m words is a pair of the two of m - 1
words that it begins and ends with, and only pairs of frequent ones are looked
at. A shard numbers what it has by itself; what is frequent gets one number
everywhere, which goes back to the shard before the next level.

Counts meet by parts of what is counted. A shard tells a part all that it has
of it as one row of columns, sorted and compressed, and hears from it in the
same way; so a count takes a few bytes where it is written, not a row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flarebook.llm.tables import give_back, scratch, utf8, word_chunks

SUPPORT = 10
LONGEST = 3
NESTED = (50, 100)  # a phrase goes if a longer one has at least this share of its occurrences
FIRST = 2000  # rows of each language
SHARD_WORDS = 4_000_000
SHARD_BYTES = 64_000_000  # of a shard's distinct words
PART_WORDS = 4_000_000  # of all words, for each part of what is counted: a task's memory, and how many rows shards tell
CHUNK = 500_000  # numbers or distinct words of a shard in a row
RANK_PARTS = 32

END = b"\xff"  # between pieces; no byte of UTF-8
BYTES = bytearray(range(256))
BYTES[65:91] = range(97, 123)
for _byte in b".,;:!?\n\x0b\x0c\r":
    BYTES[_byte] = END[0]
BYTES = bytes(BYTES)


class Numbers(dict):
    """Numbers from 1 in the order of first use."""

    def __init__(self) -> None:
        super().__init__({END: 0})
        self.bytes = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.bytes += len(word)
        return number


def packed(numbers: np.ndarray, kind: str = "<u4") -> bytes:
    """Numbers of a fixed width, their first bytes together, compressed."""
    width = np.dtype(kind).itemsize
    planes = np.ascontiguousarray(numbers.astype(kind).view(np.uint8).reshape(-1, width).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, length: int, kind: str = "<u4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = pa.decompress(data, decompressed_size=width * length, codec="zstd", asbytes=True)
    flat = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, length).T)
    return flat.view(kind).reshape(length).astype(np.int64)


def packed_columns(*columns: np.ndarray) -> bytes:
    return packed(np.concatenate(columns), "<i8")


def unpacked_columns(data: bytes, length: int, columns: int) -> np.ndarray:
    return unpacked(data, columns * length, "<i8").reshape(columns, length)


def packed_words(words: list[bytes]) -> bytes:
    """Words, none of which has the byte ``END``, led by the size of all."""
    data = END.join(words)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked_words(data: bytes) -> list[bytes]:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True).split(END)


class Shard:
    """Words of one language as numbers; 0 ends a piece."""

    def __init__(self) -> None:
        self.numbers = Numbers()
        self.parts: list[np.ndarray] = []
        self.words = 0

    def add(self, text: memoryview) -> None:
        for chunk in word_chunks(text):
            found = chunk.translate(BYTES).replace(END, b" \xff ").split()
            part = np.fromiter(map(self.numbers.__getitem__, found), np.uint32, len(found))
            self.parts.append(part)
            self.words += int(np.count_nonzero(part))
        self.parts.append(np.zeros(1, np.uint32))

    def rows(self, shard: int, lang: str) -> Iterator[pa.RecordBatch]:
        numbers = np.concatenate(self.parts)
        words = [word for word in self.numbers if word != END]
        counts = np.bincount(numbers, minlength=len(words) + 1)[1:]
        for start in range(0, len(numbers), CHUNK):
            part = numbers[start : start + CHUNK]
            yield batch(SHARDS, [(shard, lang, start, len(part), packed(part), None, None, self.words)])
        for start in range(0, len(words), CHUNK):
            part, often = words[start : start + CHUNK], packed(counts[start : start + CHUNK], "<i8")
            yield batch(SHARDS, [(shard, lang, start + 1, len(part), None, packed_words(part), often, self.words)])


KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def fields(columns: str) -> pa.Schema:
    return pa.schema([(name, KINDS[kind]) for name, kind in (one.split() for one in columns.split(", "))])


def batch(columns: str, rows: list[tuple]) -> pa.RecordBatch:
    schema = fields(columns)
    values = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(values, schema.types)], schema=schema)


SHARDS = "shard long, lang string, place long, length int, numbers binary, words binary, counts binary, count long"


def to_shards(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[pa.RecordBatch]:
    """For each shard rows with its numbers from ``place`` on, and rows with its distinct words from number ``place`` on.

    Each has ``count``, the words of the shard.
    """
    made, number = {}, TaskContext.get().partitionId() << 32

    def finished() -> Iterator[pa.RecordBatch]:
        nonlocal number
        for lang, shard in made.items():
            yield from shard.rows(number, lang)
            number += 1
        made.clear()
        give_back()

    for rows in batches:
        for lang, text in zip(rows.column(0).to_pylist(), utf8(rows.column(1))):
            if len(text):
                made.setdefault(lang, Shard()).add(text)
                held = sum(shard.words for shard in made.values())
                if held >= shard_words or sum(shard.numbers.bytes for shard in made.values()) >= SHARD_BYTES:
                    yield from finished()
    yield from finished()


def neighbours(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose number and the next are both not 0, and the two as one number."""
    places = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
    return places, numbers[places] * (int(numbers.max(initial=0)) + 1) + numbers[places + 1]


MINED = "shard long, lang string, part long, place long, support long, length int, data binary, words binary"


def words_in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's words dealt out by what they are; ``data`` has their numbers and counts."""
    for rows in batches:
        for row in rows.to_pylist():
            words, seed = unpacked_words(row["words"]), zlib.crc32(row["lang"].encode())
            hashes = np.fromiter((zlib.crc32(word, seed) for word in words), np.int64, len(words))
            places = row["place"] + np.arange(len(words))
            counts = unpacked(row["counts"], len(words), "<i8")
            out = []
            for part, own in dealt(hashes % row["parts"]):
                data = packed_columns(np.diff(places[own], prepend=0), counts[own])
                told = packed_words([words[i] for i in own])
                out.append((row["shard"], row["lang"], part, row["place"], row["support"], len(own), data, told))
            yield batch(MINED, out)
    give_back()


def dealt(parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that is there, with its places in order."""
    order = np.argsort(parts, kind="stable")
    starts = np.flatnonzero(np.diff(parts[order], prepend=-1))
    for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
        yield int(parts[order[start]]), order[start:stop]


def part_of(p: np.ndarray, q: np.ndarray, parts: int) -> np.ndarray:
    """The part that counts a pair."""
    mixed = p.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + q.astype(np.uint64)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(factor)
    return ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def heard(bound: pa.Table, level: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """What the parts of one level tell a shard: the part, places, and the numbers that these have everywhere."""
    for row in bound.to_pylist():
        if row["level"] == level:
            places, ids = np.cumsum(unpacked_columns(row["data"], row["length"], 2), axis=1)
            yield row["part"], places, ids + (row["part"] << 32)


def mine(shard: pa.Table, bound: pa.Table) -> pa.Table:
    """All pairs of one level in a shard, dealt out by what they are; ``data`` has the pairs and their counts.

    ``bound`` has the number of what is frequent everywhere for each level
    below: of words by their own number, of pairs by their place among those
    that the shard told the part. The rows of both come in any order. Here
    what is frequent is numbered in the order of its number everywhere, so
    a level's pairs come out the same whenever they are made.
    """
    shard = shard.sort_by("place")
    row = shard.drop_columns("numbers").slice(0, 1).to_pylist()[0]
    chunks = zip(shard["numbers"].to_pylist(), shard["length"].to_pylist())
    numbers = np.concatenate([unpacked(data, length) for data, length in chunks])
    told: dict[int, np.ndarray] = {}
    for below in range(1, row["level"]):
        known, names = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for part, places, ids in heard(bound, below):
            known.append(places if below == 1 else told[part][places] + 1)
            names.append(ids)
        known, names = np.concatenate(known), np.concatenate(names)
        order = np.argsort(names)
        known, names = known[order], names[order]
        renumbered = np.zeros(max(int(numbers.max(initial=0)), int(known.max(initial=0))) + 1, np.int64)
        renumbered[known] = np.arange(1, len(known) + 1)
        numbers = renumbered[numbers]
        base = int(numbers.max(initial=0)) + 1
        at, pairs = neighbours(numbers)
        names = np.concatenate([[0], names]).astype(np.int64)
        if below + 1 < row["level"]:
            distinct, inverse = np.unique(pairs, return_inverse=True)
            numbers = np.zeros(len(numbers), np.int64)
            numbers[at] = inverse + 1
            told = dict(dealt(part_of(names[distinct // base], names[distinct % base], row["parts"])))
    distinct, counts = np.unique(pairs, return_counts=True)
    p, q = names[distinct // base], names[distinct % base]
    out = []
    for part, own in dealt(part_of(p, q, row["parts"])):
        data = packed_columns(np.diff(p[own], prepend=0), q[own], counts[own])
        out.append((row["shard"], None, part, 0, row["support"], len(own), data, None))
    del numbers, at, pairs, distinct, counts, p, q
    give_back()
    return pa.Table.from_batches([batch(MINED, out)])


COUNTED = "shard long, level int, part long, length int, data binary, " \
    "id long, lang string, word binary, p long, q long, f long"  # fmt: skip


def count(rows: pa.Table, level: int, support: int, answer: bool) -> pa.Table:
    """Of one part, what is frequent everywhere with its count ``f`` and number ``id``, and with ``answer`` a row for each shard.

    What some shard finds frequent by its own support is a candidate, and
    the counts that all shards have of it are added, also those below a
    shard's support.
    """
    rows = rows.sort_by([("shard", "ascending"), ("place", "ascending")])
    part, lengths = rows["part"][0].as_py(), rows["length"].to_pylist()
    columns = [unpacked_columns(d, n, 3 - (level == 1)) for d, n in zip(rows["data"].to_pylist(), lengths)]
    counts = np.concatenate([own[-1] for own in columns])
    marked_from = np.repeat(rows["support"].to_numpy(), lengths)
    if level == 1:
        places = [np.cumsum(own[0]) for own in columns]
        words = [
            lead + word
            for lang, data in zip(rows["lang"].to_pylist(), rows["words"].to_pylist())
            for lead in [lang.encode() + END]
            for word in unpacked_words(data)
        ]
        coded = pa.array(words, pa.large_binary()).dictionary_encode()
        key, kinds = coded.indices.to_numpy(), len(coded.dictionary)
    else:
        places = [np.arange(length) for length in lengths]
        p = np.concatenate([np.cumsum(own[0]) for own in columns])
        q = np.concatenate([own[1] for own in columns])
        order = np.lexsort((q, p))
        begins = np.diff(p[order], prepend=-1) != 0
        begins |= np.diff(q[order], prepend=-1) != 0
        key = np.empty(len(order), np.int64)
        key[order] = np.cumsum(begins) - 1
        first = order[begins]
        kinds = len(first)
        del order, begins
    del columns
    f, candidate = np.zeros(kinds, np.int64), np.zeros(kinds, bool)
    np.add.at(f, key, counts)
    candidate[key[counts >= marked_from]] = True
    frequent = candidate & (f >= support)
    index = np.cumsum(frequent) - 1
    none = [None] * int(frequent.sum())
    ids = (part << 32) + np.arange(len(none))
    langs = words = pairs_p = pairs_q = none
    if level == 1:
        found = [name.split(END) for name in coded.dictionary.take(pa.array(np.flatnonzero(frequent))).to_pylist()]
        langs, words = [lang.decode() for lang, _ in found], [word for _, word in found]
    else:
        pairs_p, pairs_q = p[first[frequent]], q[first[frequent]]
    values = [none, none, none, none, none, ids, langs, words, pairs_p, pairs_q, f[frequent]]
    schema = fields(COUNTED)
    arrays = [pa.array(v, kind) for v, kind in zip(values, schema.types)]
    out = [pa.RecordBatch.from_arrays(arrays, schema=schema)]
    if answer:
        start, told = 0, []
        for shard, length, own in zip(rows["shard"].to_pylist(), lengths, places):
            named = key[start : start + length]
            stays = frequent[named]
            start += length
            if stays.any():
                data = packed_columns(np.diff(own[stays], prepend=0), np.diff(index[named[stays]], prepend=0))
                told.append((shard, level, part, int(stays.sum()), data, *[None] * 6))
        out.append(batch(COUNTED, told))
    del counts, marked_from, places, key
    give_back()
    return pa.Table.from_batches(out, schema)


def counted(local: DataFrame, keys: list[str], support: int) -> DataFrame:
    """Local counts of what is frequent everywhere, with its count ``f`` and its number ``id``.

    The number is the smallest of its rows' numbers, so the row that has it as
    ``row`` stands for the phrase.
    """
    own = Window.partitionBy(*keys)
    found = local.withColumn("f", F.sum("count").over(own)).withColumn("id", F.min("row").over(own))
    return found.filter(F.col("f") >= support)


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    first: int | None = FIRST,
    shard_words: int = SHARD_WORDS,
    part_words: int = PART_WORDS,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of each language's best phrases.

    Words are what blanks and tabs separate within pieces, which end at
    ``.,;:!?`` and line ends; A-Z are lower-cased. A phrase of 2 to ``longest``
    words that occurs at least ``support`` times (``a``) is cut where
    ``a * a / (l * r)`` of its two parts is smallest, floored in millionths.
    It goes if a longer candidate that holds it has half of its occurrences.
    With ``first=None`` all are returned.

    Null texts are empty, a null language is ``und``, repeated rows count
    each, and a table without words has no rows. Very long texts are read in
    chunks; the words of a text are spread over shards as whole texts are, so
    a shard can be longer than ``shard_words`` by one text.
    """
    if longest < 2 or support < 1:
        raise ValueError("phrases have two words or more and occur")
    spark = docs.sparkSession

    def stored(frame: DataFrame, purpose: str) -> DataFrame:
        folder = scratch(spark, purpose)
        frame.write.parquet(folder)
        return spark.read.schema(frame.schema).parquet(folder)

    def numbered(frame: DataFrame) -> DataFrame:
        return frame.withColumn("row", F.monotonically_increasing_id() + 1)

    def counts(mined: DataFrame, level: int) -> DataFrame:
        own = mined.groupBy("part").applyInArrow(lambda rows: count(rows, level, support, level < longest), COUNTED)
        return stored(own, f"phrase-counts-{level}")

    texts = docs.select(F.coalesce("lang", F.lit("und")), "text").filter(F.col("text").isNotNull())
    made = stored(texts.mapInArrow(lambda rows: to_shards(rows, shard_words), SHARDS), "phrase-shards")
    totals = made.filter("numbers IS NOT NULL AND place = 0").groupBy("lang").agg(F.sum("count").alias("n"))
    every_word = totals.agg(F.sum("n")).first()[0] or 0
    share = F.expr(f"({support} * CAST(count AS DECIMAL(20, 0)) + n - 1) DIV nullif(n, 0)")
    made = made.join(F.broadcast(totals), "lang").withColumn("support", F.greatest(F.lit(1), share).cast("long"))
    made = made.withColumn("parts", F.lit(-(-every_word // part_words) or 1).cast("long"))
    shards = made.filter(F.col("numbers").isNotNull()).select("shard", "support", "parts", "place", "length", "numbers")
    words = made.filter(F.col("words").isNotNull()).select(
        "shard", "lang", "support", "parts", "place", "words", "counts"
    )

    counted_here = counts(words.mapInArrow(words_in_parts, MINED), 1)
    bound = counted_here.filter("data IS NOT NULL").select("shard", "level", "part", "length", "data")
    level = counted_here.filter("id IS NOT NULL").select(
        "id", "lang", F.col("word").cast("string").alias("phrase"), "f", F.array().cast("array<long>").alias("starts"),
        F.array().cast("array<long>").alias("ends"),
    )
    level = level.withColumn("last", F.col("phrase"))
    found: list[DataFrame] = []
    for length in range(2, longest + 1):
        own = shards.withColumn("level", F.lit(length))
        pairs = own.groupBy("shard").cogroup(bound.groupBy("shard")).applyInArrow(mine, MINED)
        counted_here = counts(pairs, length)
        frequent = counted_here.filter("id IS NOT NULL").select("id", "p", "q", "f")
        if length < longest:
            bound = bound.unionByName(counted_here.filter("data IS NOT NULL").select(*bound.columns))
        if found:  # a longer candidate that has enough of the occurrences takes a phrase out
            nested = frequent.select(F.explode(F.array("p", "q")).alias("id"), F.col("f").alias("longer"))
            nested = nested.groupBy("id").agg(F.max("longer").alias("longer"))
            part, whole = NESTED
            kept = found[-1].join(nested, "id", "left")
            enough = F.coalesce(F.col("longer") * whole >= F.col("f") * part, F.lit(False))
            found[-1] = kept.filter(~enough).drop("longer")
        starts = level.select(F.col("id").alias("p"), "lang", F.col("phrase").alias("begin"),
                              F.col("f").alias("p_f"), F.col("starts").alias("p_starts"))
        ends = level.select(F.col("id").alias("q"), "last", F.col("f").alias("q_f"), F.col("ends").alias("q_ends"))
        level = frequent.join(starts, "p").join(ends, "q").select(
            "id", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "f",
            F.concat("p_starts", F.array("p_f")).alias("starts"), F.concat("q_ends", F.array("q_f")).alias("ends"),
            "last",
        )
        if length < longest:
            level = stored(level, f"phrase-texts-{length}")
        found.append(level)
    every = found[0].drop("last")
    for more in found[1:]:
        every = every.unionByName(more.drop("last"))
    return ranked(every.join(totals, "lang"), first)


def ranked(found: DataFrame, first: int | None) -> DataFrame:
    """Scores by the weakest cut, best first. Products are exact for counts below 10^14."""
    cuts = F.expr(
        """transform(starts, (x, i) -> struct(
             CAST((1000000 * CAST(f AS DECIMAL(14, 0)) * CAST(f AS DECIMAL(14, 0)))
               DIV (CAST(x AS DECIMAL(14, 0)) * CAST(ends[size(ends) - i - 1] AS DECIMAL(14, 0))) AS LONG) AS score,
             i AS k, x AS l, ends[size(ends) - i - 1] AS r))"""
    )
    scored = found.withColumn("cut", F.array_min(cuts)).select(
        "lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score"
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if first is not None:  # the best of each part before they meet in one task
        part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
        scored = scored.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= first).drop("rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    best = scored.withColumn("rank", rank)
    best = best if first is None else best.filter(F.col("rank") <= first)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

