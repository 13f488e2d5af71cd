"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read as runs of letters and of other characters, A-Z made lower
case, each with a blank as its end mark. The network goes over the bytes of a
run in both directions and gives a language distribution for every position. A
document's distribution is the mean over all positions of its whole text. A
run's share does not depend on its neighbours, so each distinct run is looked
at once per Python worker.

Trained here, in numpy, by backpropagation through time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flarebook.llm.tables import held_here, utf8, word_chunks

UNKNOWN = "und"
UNITS = 16
LONGEST_SEGMENT = 64  # bytes; a longer run is read in segments of this length
RUN = re.compile(rb"[a-z\x80-\xff]+|[^a-z\x80-\xff\s]+")
KNOWN_RUNS = 400_000
KNOWN_BYTES = 64_000_000  # of these runs and their table
RUNS_AT_ONCE = 2048  # of one length, in one step of the network
TEXT_AT_ONCE = 2_000_000  # bytes whose new runs go through the network together
HELD_OUT = 2  # of the remainders by 4

#: Bounds of the sample the network is fitted on.
MOST_LANGUAGES = 256
DOCS_PER_LANGUAGE = 400
WORDS_PER_DOC = 250
RANK_PARTS = 64
STEPS = 700
BATCH = 384
LEARNING_RATE = 0.01


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Weights of both directions and of the layer that labels positions."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], units: int, random: np.random.Generator) -> Network:
        def normal(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) / np.sqrt(units)).astype(np.float32)

        weights = {}
        for side in ("forth", "back"):
            weights[f"{side}_in"] = normal(256, 3 * units)
            weights[f"{side}_gates"] = normal(units, 2 * units)
            weights[f"{side}_new"] = normal(units, units)
            weights[f"{side}_out"] = normal(units, len(languages))
        weights["bias"] = np.zeros(len(languages), np.float32)
        return cls(languages, weights)

    def states(self, side: str, steps: np.ndarray, keep: bool) -> tuple[np.ndarray, list[tuple]]:
        """Hidden state at each step (step, word, unit) and, to ``keep``, what the way back needs."""
        w = self.weights
        units = w[f"{side}_new"].shape[0]
        inputs = w[f"{side}_in"]
        hidden = np.zeros((steps.shape[1], units), np.float32)
        out, kept = np.empty((*steps.shape, units), np.float32), []
        for t, bytes_now in enumerate(steps):
            given = inputs[bytes_now]
            gates = sigmoid(given[:, : 2 * units] + hidden @ w[f"{side}_gates"])
            update, reset = gates[:, :units], gates[:, units:]
            recalled = hidden @ w[f"{side}_new"]
            new = np.tanh(given[:, 2 * units :] + reset * recalled)
            if keep:
                kept.append((hidden, update, reset, recalled, new))
            hidden = new + update * (hidden - new)
            out[t] = hidden
        return out, kept

    def positions(self, words: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """Language distribution of each position (step, word, language), and what the way back needs."""
        steps = np.ascontiguousarray(words.T)
        forth, kept_forth = self.states("forth", steps, keep)
        back, kept_back = self.states("back", steps[::-1], keep)
        back = back[::-1]
        w = self.weights
        scores = forth @ w["forth_out"] + back @ w["back_out"] + w["bias"]
        scores -= scores.max(axis=2, keepdims=True)
        chances = np.exp(scores)
        chances /= chances.sum(axis=2, keepdims=True)
        return chances, (steps, forth, back, kept_forth, kept_back)

    def gradients(self, words: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over positions, by backpropagation through time."""
        chances, (steps, forth, back, kept_forth, kept_back) = self.positions(words, keep=True)
        wrong = chances.copy()
        wrong[:, np.arange(len(labels)), labels] -= 1
        wrong /= wrong.shape[0] * wrong.shape[1]
        units = forth.shape[2]
        flat = wrong.reshape(-1, wrong.shape[2])
        w = self.weights
        found = {
            "bias": flat.sum(axis=0),
            "forth_out": forth.reshape(-1, units).T @ flat,
            "back_out": back.reshape(-1, units).T @ flat,
        }
        found |= self._through_time("forth", steps, kept_forth, wrong @ w["forth_out"].T)
        found |= self._through_time("back", steps[::-1], kept_back, (wrong @ w["back_out"].T)[::-1])
        return found

    def _through_time(self, side: str, steps: np.ndarray, kept: list[tuple], wrong: np.ndarray) -> dict:
        w_gates, w_new = self.weights[f"{side}_gates"], self.weights[f"{side}_new"]
        units = w_new.shape[0]
        d_gates, d_new = np.zeros_like(w_gates), np.zeros_like(w_new)
        d_given = np.empty((*steps.shape, 3 * units), np.float32)
        later = np.zeros((steps.shape[1], units), np.float32)
        for t in range(len(steps) - 1, -1, -1):
            hidden, update, reset, recalled, new = kept[t]
            d_hidden = wrong[t] + later
            d_inner = d_hidden * (1 - update) * (1 - new * new)
            d_update = d_hidden * (hidden - new) * update * (1 - update)
            d_reset = d_inner * recalled * reset * (1 - reset)
            d_both = np.concatenate((d_update, d_reset), axis=1)
            d_recalled = d_inner * reset
            d_gates += hidden.T @ d_both
            d_new += hidden.T @ d_recalled
            d_given[t] = np.concatenate((d_both, d_inner), axis=1)
            later = d_hidden * update + d_both @ w_gates.T + d_recalled @ w_new.T
        seen = np.zeros((steps.size, 256), np.float32)
        seen[np.arange(steps.size), steps.ravel()] = 1
        return {
            f"{side}_gates": d_gates,
            f"{side}_new": d_new,
            f"{side}_in": seen.T @ d_given.reshape(-1, 3 * units),
        }


def runs(text: bytes) -> list[bytes]:
    return RUN.findall(text.lower())


def segments(run: bytes) -> list[bytes]:
    """A run and its end mark, in pieces of bounded length."""
    run += b" "
    return [run[i : i + LONGEST_SEGMENT] for i in range(0, len(run), LONGEST_SEGMENT)]


def by_length(pieces: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pieces of one length, and their bytes as a matrix."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    order = np.argsort(lengths, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(pieces) else []:
        joined = b"".join(pieces[i] for i in places)
        yield places, np.frombuffer(joined, np.uint8).reshape(len(places), -1)


def fit(words: list[bytes], labels: list[str], units: int = UNITS, steps: int = STEPS, seed: int = 7) -> Network:
    """Train on words and the languages of their documents (Adam; batches of words of one length)."""
    languages = sorted(set(labels), key=lambda v: v.encode())
    random = np.random.default_rng(seed)
    network = Network.fresh(languages, units, random)
    number = {name: i for i, name in enumerate(languages)}
    pieces, classes = [], []
    for word, label in zip(words, labels):
        for run in runs(word):
            for piece in segments(run):
                pieces.append(piece)
                classes.append(number[label])
    if len(languages) < 2:
        return network
    every = np.array(classes)
    groups = [(matrix, every[places]) for places, matrix in by_length(pieces)]
    weight = np.array([len(matrix) for matrix, _ in groups], float)
    mean = {k: np.zeros_like(v) for k, v in network.weights.items()}
    square = {k: np.zeros_like(v) for k, v in network.weights.items()}
    for step in range(1, steps + 1):
        matrix, classes_here = groups[random.choice(len(groups), p=weight / weight.sum())]
        rows = random.integers(0, len(matrix), BATCH)
        rate = LEARNING_RATE * (1 - 0.9 * step / steps)
        for k, g in network.gradients(matrix[rows], classes_here[rows]).items():
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.01 * (g * g - square[k])
            change = (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
            network.weights[k] -= (rate * change).astype(np.float32)
    return network


class RunVotes(dict):
    """Places of known runs in the table of their summed position distributions.

    Columns: a sum for each language, the number of positions, whether there
    is a letter. It forgets all when ``most`` runs, or
    ``KNOWN_BYTES`` of them and the table, are known.
    """

    def __init__(self, network: Network, most: int = KNOWN_RUNS):
        super().__init__()
        self.network, self.most, self.bytes = network, most, 0
        self.table = np.zeros((0, len(network.languages) + 2), np.float32)

    def sums(self, texts: Iterable[memoryview]) -> np.ndarray:
        """The columns' sums over all runs of each text."""
        out, held, size = [], [], 0
        for place, text in enumerate(texts):
            out.append(np.zeros(len(self.network.languages) + 2))
            for chunk in word_chunks(text):
                held.append((place, runs(chunk)))
                size += len(chunk)
                if size >= TEXT_AT_ONCE:
                    self._count(held, out)
                    held, size = [], 0
        self._count(held, out)
        return np.array(out).reshape(len(out), len(self.network.languages) + 2)

    def _count(self, held: list[tuple[int, list[bytes]]], out: list[np.ndarray]) -> None:
        self._learn(set().union(*[found for _, found in held]))
        for place, found in held:
            places = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
            out[place] += self.table[places].sum(axis=0, dtype=float)

    def _learn(self, found: set[bytes]) -> None:
        new = [run for run in found if run not in self]
        if len(self) + len(new) > self.most or self.bytes + 4 * self.table.shape[1] * len(self) > KNOWN_BYTES:
            self.clear()
            self.bytes, self.table = 0, self.table[:0].copy()
            new = list(found)
        start, width = len(self), self.table.shape[1]
        self.bytes += sum(map(len, new))
        if start + len(new) > len(self.table):
            grown = np.zeros((max((start + len(new)) * 3 // 2, 4096), width), np.float32)
            grown[:start] = self.table[:start]
            self.table = grown
        rows = self.table[start : start + len(new)]
        rows[:] = 0
        pieces, owner = [], []
        for i, run in enumerate(new):
            self[run] = start + i
            rows[i, -1] = any(map(str.isalpha, run.decode("utf-8", "replace")))
            for piece in segments(run):
                pieces.append(piece)
                owner.append(i)
        owners = np.array(owner)
        for places, matrix in by_length(pieces):
            for at in range(0, len(places), RUNS_AT_ONCE):
                part, owned = matrix[at : at + RUNS_AT_ONCE], owners[places[at : at + RUNS_AT_ONCE]]
                np.add.at(rows[:, :-2], owned, self.network.positions(part)[0].sum(axis=0))
                np.add.at(rows[:, -2], owned, part.shape[1])


def known_runs(network: Network) -> RunVotes:
    """Those of the last network used in this Python worker, kept from task to task."""
    print_ = hashlib.sha256()
    print_.update(repr(network.languages).encode())
    for name in sorted(network.weights):
        print_.update(network.weights[name].tobytes())
    return held_here(f"runs of {print_.hexdigest()}", lambda: RunVotes(network))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))


def train(
    docs: DataFrame,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    words_per_doc: int = WORDS_PER_DOC,
    steps: int = STEPS,
    most_languages: int | None = MOST_LANGUAGES,
) -> Network:
    """Fit the network on a bounded sample of the labelled documents that are not held out.

    Learns the ``most_languages`` most frequent languages, or all. At most ``docs_per_language`` documents of each language (those first in
    the order of a hash of ``doc_id``; rows with equal id and text are one), at most ``words_per_doc`` words of
    each, spread evenly over its whole text, at most 256 characters of a word.
    """
    known = docs.select(F.col("doc_id"), F.col("text"), F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    labelled = known.withColumn("text_key", F.xxhash64("text"))
    document = ["lang", "doc_id", "text_key"]
    turn = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text_key")
    step = F.greatest(F.size("words") / words_per_doc, F.lit(1.0))
    spread = F.transform(
        F.sequence(F.lit(0), F.least(F.size("words"), F.lit(words_per_doc)) - 1),
        lambda i: F.substring(F.get("words", F.floor(i * step).cast("int")), 1, 256),
    )
    # The first of each part of a language, before the parts meet.
    part = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(RANK_PARTS)).alias("part")
    in_part = Window.partitionBy("lang", "part").orderBy(F.xxhash64("doc_id"), "doc_id", "text_key")
    ranked = labelled.select(*document, part).distinct().withColumn("turn", F.row_number().over(in_part))
    ranked = ranked.filter(F.col("turn") <= docs_per_language).withColumn("turn", F.row_number().over(turn))
    ids = ranked.filter(F.col("turn") <= docs_per_language).select(document)
    if most_languages is not None:
        frequent = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages)
        ids = ids.join(F.broadcast(frequent), "lang", "left_semi")
    # At most docs_per_language rows of a language, also where ids or whole rows repeat.
    rows = (
        labelled.join(F.broadcast(ids), document, "left_semi")
        .dropDuplicates(document)
        .select("lang", "doc_id", F.split(F.trim("text"), r"[\x20\x09-\x0D]+").alias("words"))
        .select("lang", "doc_id", spread.alias("words"))
        .collect()
    )
    rows.sort(key=lambda row: (row.doc_id, row.lang, row.words))
    words, labels = [], []
    for lang, _, some in rows:
        kept = [w.encode() for w in some if w]
        words += kept
        labels += [lang] * len(kept)
    return fit(words, labels, steps=steps)


def with_letters(docs: DataFrame) -> DataFrame:
    """Rows whose text has a letter, by the rule that ``predict`` has for ``und``. All columns stay."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (bytes(text).decode("utf-8", "replace") for text in utf8(batch.column("text")))
            yield batch.filter(pa.array([any(map(str.isalpha, text)) for text in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def predict(docs: DataFrame, network: Network, carried: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every whole text.

    Reads ``doc_id`` and ``text``; ``carried`` columns come along unchanged,
    after these. ``score`` is the mean probability of the predicted language
    over all positions, ``lang_pred`` the smallest language among equals. A
    text that is null or has no letter is ``und`` with score 0, and so is
    every text if no language was learned.
    """
    languages = network.languages
    places = ["text" if name == "text" else f"carried_{i}" for i, name in enumerate(carried)]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = known_runs(network)
        for batch in batches:
            if languages:
                sums = votes.sums(utf8(batch.column("text")))
            else:
                sums = np.zeros((batch.num_rows, 2))
            names, scores = [], []
            for row in sums:
                chances = np.round(row[:-2] / max(row[-2], 1), 6)
                known = bool(row[-1])
                best = int(np.argmax(chances)) if known else 0
                names.append(languages[best] if known else UNKNOWN)
                scores.append(min(1.0, float(chances[best])) if known else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64()), *map(batch.column, places)],
                names=["doc_id", "held_out", "lang_pred", "score", *places],
            )

    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        F.col("text").cast("string").alias("text"),
        *[F.col(name).alias(place) for name, place in zip(carried, places) if place != "text"],
    )
    schema = StructType.fromDDL("doc_id long, held_out boolean, lang_pred string, score double")
    for place in places:
        schema.add(given.schema[place])
    made = given.mapInArrow(label, schema)
    return made.select(
        "doc_id", "held_out", "lang_pred", "score", *[F.col(p).alias(c) for p, c in zip(places, carried)]
    )
