"""Likelihood of texts over all segmentations of their words into pieces.

The pieces are those of an existing vocabulary, whose file has an order but no
probabilities. Each piece has a unigram score; a word's probability is the sum
over all ways to write it as pieces, by a forward recursion in logarithms over
the lattice of matches. The scores begin as a power law of the vocabulary's
order and are learned from the training words by expected counts over the same
lattices. What the training words say of a word as a whole is weighed with its
lattice, by how many of them occur just once.

Each distinct word goes through the lattice once, wherever it occurs. Texts
become blocks of a bounded size, a block knows its distinct words, and only
these are looked up, so neither vocabulary nor texts meet in one place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flarebook.llm.collocations import Numbers, counted, packed, unpacked
from flarebook.llm.tables import give_back, scratch, utf8, word_chunks

ROUNDS = 2  # of expected counts
PRIOR = 1000.0  # occurrences that the vocabulary's own order counts as
BLOCK_BYTES = 32_000_000
WORDS_AT_ONCE = 20_000
FIXED = 1 << 20  # expected counts are added up as whole numbers of this part

START, APART = chr(256), chr(257)  # before a word and between words; bytes are characters below
MARK = "▁"  # what a vocabulary's file writes for the blank before a word

Scores = tuple[np.ndarray, float]


@lru_cache(maxsize=4)
def pieces_of(path: str) -> tuple[tuple[str, ...], np.ndarray]:
    """Pieces as strings of bytes, those that begin a word led by ``START``, and their first scores.

    Bytes that no piece spells have pieces of their own, so every word has a
    segmentation. Of equal strings the first counts.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[str, int] = {}
    for place in range(model.get_piece_size()):
        if model.is_control(place) or model.is_unknown(place) or model.is_unused(place):
            continue
        piece = model.id_to_piece(place)
        if model.is_byte(place):
            text = chr(int(piece[3:-1], 16))
        else:
            begins = piece.startswith(MARK)
            text = (START if begins else "") + piece[begins:].encode().decode("latin-1")
            if MARK.encode().decode("latin-1") in text or any("A" <= letter <= "Z" for letter in text):
                continue  # words have no blank, and no capitals of ASCII
        found.setdefault(text, place)
    for needed in [START, *map(chr, range(256))]:
        found.setdefault(needed, model.get_piece_size())
    order = np.array([1.0 / (1.0 + place) for place in found.values()])
    return tuple(found), order


def scored(pieces: tuple[str, ...], order: np.ndarray, expected: np.ndarray, words: float) -> Scores:
    """Log probabilities of pieces that begin words and of those that go on, and of a word's end after a piece."""
    begins = np.array([piece[0] == START for piece in pieces])
    logs = np.empty(len(pieces))
    for own in (begins, ~begins):
        prior = PRIOR * order[own] / order[own].sum()
        logs[own] = np.log((expected[own] + prior) / (expected[own].sum() + PRIOR))
    ends = (words + 1.0) / (expected.sum() + 2.0)
    logs[~begins] += math.log1p(-ends)
    return logs, math.log(ends)


@lru_cache(maxsize=2)
def automaton_of(path: str) -> tuple[ahocorasick.Automaton, np.ndarray]:
    pieces, _ = pieces_of(path)
    automaton = ahocorasick.Automaton()
    for index, piece in enumerate(pieces):
        automaton.add_word(piece, index)
    automaton.make_automaton()
    return automaton, np.array([len(piece) for piece in pieces])


class Lattices:
    """The lattices of some words, side by side on one line of characters."""

    def __init__(self, words: list[bytes], path: str):
        automaton, lengths = automaton_of(path)
        sizes = np.array([len(word) + 2 for word in words])  # with the start and what stands between words
        self.first = np.cumsum(sizes) - sizes
        self.last = self.first + sizes - 1
        line = APART.join(START + word.decode("latin-1") for word in words)
        matches = np.array(list(automaton.iter(line)), np.int64).reshape(-1, 2)
        self.end, self.piece = matches[:, 0] + 1, matches[:, 1]
        self.start = self.end - lengths[self.piece]
        self.word = np.searchsorted(self.first, self.start, side="right") - 1
        self.nodes = int(sizes.sum())

    def _steps(self, nodes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arcs by their node's distance from the word's start: the arcs and where each node's begin."""
        away = nodes - self.first[self.word]
        order = np.lexsort((nodes, away))
        edges = np.flatnonzero(np.diff(away[order], prepend=-1))
        for begin, stop in zip(edges, [*edges[1:], len(order)]):
            arcs = order[begin:stop]
            yield arcs, np.flatnonzero(np.diff(nodes[arcs], prepend=-1))

    def forward(self, scores: Scores) -> tuple[np.ndarray, np.ndarray]:
        """Log of the sum over all ways to reach each node, and the words' log probabilities."""
        logs, ends = scores
        reached = np.full(self.nodes, -np.inf)
        reached[self.first] = 0.0
        for arcs, groups in self._steps(self.end):
            ways = reached[self.start[arcs]] + logs[self.piece[arcs]]
            reached[self.end[arcs[groups]]] = np.logaddexp.reduceat(ways, groups)
        return reached, reached[self.last] + ends

    def expected(self, scores: Scores, pieces: int) -> np.ndarray:
        """How often each piece is used, over all segmentations of each word once."""
        logs, _ = scores
        reached, _ = self.forward(scores)
        left = np.full(self.nodes, -np.inf)
        left[self.last] = 0.0
        steps = list(self._steps(self.start))
        for arcs, groups in reversed(steps):
            ways = left[self.end[arcs]] + logs[self.piece[arcs]]
            left[self.start[arcs[groups]]] = np.logaddexp.reduceat(ways, groups)
        used = reached[self.start] + logs[self.piece] + left[self.end] - reached[self.last[self.word]]
        return np.bincount(self.piece, np.exp(used), pieces)


def some(words: list[bytes]) -> Iterator[list[bytes]]:
    """Words by length, so that few steps serve many."""
    words = sorted(words, key=len)
    for start in range(0, len(words), WORDS_AT_ONCE):
        yield words[start : start + WORDS_AT_ONCE]


def word_logs(words: list[bytes], path: str, scores: Scores) -> dict[bytes, float]:
    """Natural logarithm of each word's probability over all segmentations."""
    return {
        word: value
        for part in some(words)
        for word, value in zip(part, Lattices(part, path).forward(scores)[1].tolist())
    }


BLOCKS = "block long, doc_id long, held_out boolean, place int, word binary, count long, numbers binary, counts binary"


class Block:
    """Distinct words of some texts, and the texts as their numbers."""

    def __init__(self) -> None:
        self.numbers = Numbers()
        self.trained = np.zeros(0, np.int64)
        self.docs: list[tuple] = []
        self.bytes = 0

    def add(self, doc_id: int | None, held_out: bool, text: memoryview) -> None:
        found = times = np.zeros(0, np.int64)
        for chunk in word_chunks(text):
            words = chunk.lower().split()
            part = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
            part, often = np.unique(part, return_counts=True)
            found, where = np.unique(np.concatenate([found, part]), return_inverse=True)
            times = np.bincount(where, np.concatenate([times, often]), len(found)).astype(np.int64)
        if not held_out:
            grown = np.zeros(max(len(self.numbers), len(self.trained)), np.int64)
            grown[: len(self.trained)] = self.trained
            grown[found] += times
            self.trained = grown
        self.docs.append((doc_id, held_out, len(found), int(times.sum()), packed(found), packed(times)))
        self.bytes += len(text)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        names = [one.split()[0] for one in BLOCKS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]

        def batch(*columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

        for start in range(0, len(self.docs), 1000):
            ids, held, sizes, counts, found, times = zip(*self.docs[start : start + 1000])
            yield batch([block] * len(ids), ids, held, sizes, [None] * len(ids), counts, found, times)
        words = list(self.numbers)
        trained = np.zeros(len(words), np.int64)
        trained[: len(self.trained)] = self.trained
        for start in range(1, len(words), 50_000):
            part = words[start : start + 50_000]
            none = [None] * len(part)
            places = np.arange(start, start + len(part))
            yield batch([block] * len(part), none, none, places, part, trained[start : start + len(part)], none, none)


def to_blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """A row for each text (``place`` is its number of distinct words, ``count`` of words) and each word of a block."""
    block, number = Block(), TaskContext.get().partitionId() << 32
    for rows in batches:
        for doc_id, held_out, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), utf8(rows.column(2))):
            block.add(doc_id, held_out, text)
            if block.bytes + 64 * len(block.docs) + block.numbers.bytes >= block_bytes:
                yield from block.rows(number)
                block, number = Block(), number + 1
    yield from block.rows(number)
    give_back()


def held_out() -> Column:
    """Every tenth document by its id; one without an id is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))


RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_texts(docs: DataFrame, pieces_path: str, rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of each row.

    A text's tokens are its words between ASCII blanks, A-Z in lower case, and
    one end. ``base_score`` weighs words by their smoothed training counts.
    ``score`` is the model's: a token's probability is
    (c + k * b) / (N + k), with its c of the N training tokens, the number k
    of training words that occur once (and one), and b, for an end the share
    of ends, for a word the rest times the word's lattice. Both are sums of
    decimal logarithms.

    Null texts are empty and have the end only; repeated rows count each; rows
    without an id are learned from. Without training documents the
    vocabulary's order alone scores. A word of any length is one lattice.
    """
    spark = docs.sparkSession

    def stored(frame: DataFrame, purpose: str) -> DataFrame:
        folder = scratch(spark, purpose)
        frame.write.parquet(folder)
        return spark.read.schema(frame.schema).parquet(folder)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    made = texts.mapInArrow(lambda rows: to_blocks(rows, block_bytes), BLOCKS)
    made = stored(made.withColumn("row", F.monotonically_increasing_id()), "text-blocks")
    of_words = F.col("word").isNotNull()
    local = stored(counted(made.filter(of_words), ["word"], 0), "text-words")
    lexicon = local.filter("row = id").select("id", "word", "f")
    ends, words = made.filter(~of_words & ~F.col("held_out")).agg(
        F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0))
    ).first()
    kinds, once = lexicon.agg(F.count_if(F.col("f") > 0), F.count_if(F.col("f") == 1)).first()
    tokens, distinct = ends + words, kinds + (ends > 0)

    scores = learned(lexicon.filter("f > 0").select("word"), pieces_path, rounds, kinds)
    weight, end = once + 1.0, (ends + 1.0) / (tokens + 2.0)

    def smoothed(count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (tokens + 0.1 * (distinct + 1)))

    def of_lexicon(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(1).to_pylist()
            if found:
                by_word = word_logs(found, pieces_path, scores)
                natural = np.array([by_word[word] for word in found]) + math.log1p(-end)
                count = batch.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(smoothed(count)), pa.array(mixed(count, natural, weight, tokens))],
                    names=["id", "base", "own"],
                )

    each = stored(lexicon.mapInArrow(of_lexicon, "id long, base double, own double"), "word-scores")
    bound = local.select("block", "place", "id", (F.col("f") > 0).alias("known")).join(each, "id").drop("id")
    base_end, own_end = float(smoothed(ends)), math.log10((ends + weight * end) / (tokens + weight))

    def of_block(rows: pa.Table, known: pa.Table) -> pa.Table:
        size = int(max(known["place"].to_numpy(), default=0)) + 1
        values = np.zeros((3, size))
        for at, name in enumerate(("known", "base", "own")):
            values[at, known["place"].to_numpy()] = known[name].to_numpy().astype(float)
        out = []
        for row in rows.to_pylist():
            found = unpacked(row["numbers"], row["place"]) if row["place"] else np.zeros(0, np.int64)
            times = unpacked(row["counts"], row["place"]) if row["place"] else np.zeros(0, np.int64)
            n_known = int(times[values[0, found] > 0].sum()) + (ends > 0)
            sums = [math.fsum(times * values[at, found]) for at in (1, 2)]
            out.append((row["doc_id"], row["held_out"], row["count"] + 1, n_known, sums[0] + base_end, sums[1] + own_end))
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        columns = list(zip(*out)) or [()] * 6
        return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    of_texts = made.filter(~of_words).select("block", "doc_id", "held_out", "place", "count", "numbers", "counts")
    result = of_texts.groupBy("block").cogroup(bound.groupBy("block")).applyInArrow(
        of_block, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    result = result.withColumn("train_tokens", F.lit(tokens).cast("long"))
    return result.select(*[one.split()[0] for one in RESULT.split(", ")])


def mixed(count: np.ndarray, natural: np.ndarray, weight: float, tokens: int) -> np.ndarray:
    """log10((c + k * b) / (N + k)) with b by its logarithm, which may be too small for a number."""
    with np.errstate(divide="ignore"):
        whole = np.logaddexp(np.log(count.astype(float)), natural + math.log(weight))
    return (whole - math.log(tokens + weight)) / math.log(10)


def learned(words: DataFrame, path: str, rounds: int, kinds: int) -> Scores:
    """Scores after some rounds over the training words, each once.

    A round adds up a number for each piece of the vocabulary; no more than
    these reach the driver. They are whole numbers, so their sum does not
    depend on the order in which tasks end.
    """
    pieces, order = pieces_of(path)
    scores = scored(pieces, order, np.zeros(len(pieces)), 0.0)
    for _ in range(rounds):

        def expected(batches: Iterator[pa.RecordBatch], scores: Scores = scores) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(len(pieces), np.int64)
            for batch in batches:
                for part in some(batch.column(0).to_pylist()):
                    sums += np.rint(Lattices(part, path).expected(scores, len(pieces)) * FIXED).astype(np.int64)
            used = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["piece", "times"])

        sums = words.mapInArrow(expected, "piece long, times long").groupBy("piece").agg(
            F.sum(F.col("times").cast("decimal(38,0)")).alias("times")
        )
        counts = np.zeros(len(pieces))
        for piece, times in sums.collect():
            counts[piece] = float(times) / FIXED
        scores = scored(pieces, order, counts, float(kinds))
    return scores
