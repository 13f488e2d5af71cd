"""Phrases, vector codes and text scores beside plain Python."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from flarebook.llm import codes, collocations, lattice
from fixtures import LONG_TEXT, ROWS, documents, no_documents

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def best_phrases(rows, support: int, longest: int, first: int) -> list[tuple]:
    counts: dict[str, Counter] = {}
    for _, text, lang, _ in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            words = tuple(re.findall("[^ \t]+", piece))
            for size in range(1, longest + 1):
                own.update(words[i : i + size] for i in range(len(words) - size + 1))
    out = []
    for lang, own in counts.items():
        n = sum(a for phrase, a in own.items() if len(phrase) == 1)
        candidates = {phrase: a for phrase, a in own.items() if len(phrase) > 1 and a >= support}
        inside: dict[tuple, int] = {}
        for phrase, a in candidates.items():
            for size in range(2, len(phrase)):
                for i in range(len(phrase) - size + 1):
                    part = phrase[i : i + size]
                    inside[part] = max(a, inside.get(part, 0))
        found = []
        for phrase, a in candidates.items():
            if 100 * inside.get(phrase, 0) >= 50 * a:
                continue
            cuts = [(own[phrase[:k]], own[phrase[k:]]) for k in range(1, len(phrase))]
            score, _, left, right = min((10**6 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
            found.append((" ".join(phrase), a, left, right, n, score))
        found.sort(key=lambda row: (-row[-1], -row[1], row[0].encode()))
        out += [(lang, rank, *row) for rank, row in enumerate(found[:first], 1)]
    return sorted(out)


PHRASES = [
    *ROWS,
    *[(100 + i, "one two three. One two, one\ttwo three! four five", "en", "a") for i in range(30)],
    *[(200 + i, "aa aa aa aa aa. x y z w x y z w; \x00 é Ü", None, "a") for i in range(12)],
    (300, "z " * 5000, "z", "a"),
]


@pytest.mark.parametrize("shard_words, longest", [(7, 3), (40, 4), (collocations.SHARD_WORDS, 3)])
def test_phrases(spark, shard_words, longest):
    rows = [row for row in PHRASES if row[1] != LONG_TEXT] if shard_words == 7 else PHRASES
    got = collocations.collocations(documents(spark, rows), 10, longest, 50, shard_words)
    assert sorted(tuple(row) for row in got.collect()) == best_phrases(rows, 10, longest, 50)


def test_low_support_keeps_all(spark):
    rows = [row for row in ROWS if row[1] != LONG_TEXT]
    got = collocations.collocations(documents(spark, rows), support=1, first=None, shard_words=10)
    assert sorted(tuple(row) for row in got.collect()) == best_phrases(rows, 1, 3, 10**9)


def test_phrases_in_any_order_of_a_shards_rows(spark, monkeypatch):
    """A shuffle between executors, or one that spills, brings a shard's rows in another order each time."""
    mine = collocations.mine

    def in_other_order(shard, bound):
        return mine(shard, bound.take(np.random.default_rng(shard["level"][0].as_py()).permutation(len(bound))))

    monkeypatch.setattr(collocations, "mine", in_other_order)
    rows = [row for row in PHRASES if row[1] != LONG_TEXT]
    rows += [(400 + i, "four words come together. words come apart, together four words", "en", "a") for i in range(15)]
    for longest, shard_words in ((3, 200), (4, collocations.SHARD_WORDS)):
        got = collocations.collocations(documents(spark, rows), 10, longest, 50, shard_words)
        assert sorted(tuple(row) for row in got.collect()) == best_phrases(rows, 10, longest, 50)


@pytest.mark.parametrize("part_words, longest", [(3, 4), (1000, 3)])
def test_phrases_counted_in_parts(spark, part_words, longest):
    rows = [row for row in PHRASES if row[1] != LONG_TEXT]
    rows += [(500, "a b c " * 20, "aen", "a"), (501, "na b c " * 20, "ae", "a")]
    got = collocations.collocations(documents(spark, rows), 10, longest, 50, 200, part_words)
    assert sorted(tuple(row) for row in got.collect()) == best_phrases(rows, 10, longest, 50)


def test_phrases_take_few_bytes_a_word_of_scratch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(collocations, "scratch", lambda spark, purpose: f"{tmp_path}/{purpose}")
    draw = np.random.default_rng(11)
    rows = [(i, " ".join(f"w{n}" for n in draw.zipf(1.3, 1000) % 3000), "en", "a") for i in range(300)]
    got = collocations.collocations(documents(spark, rows).repartition(10, "doc_id"), 10, 3, 50)
    assert sorted(tuple(row) for row in got.collect()) == best_phrases(rows, 10, 3, 50)
    assert sum(path.stat().st_size for path in tmp_path.rglob("*.parquet")) < 5 * 300_000


def test_no_phrases(spark):
    assert collocations.collocations(no_documents(spark)).collect() == []
    assert collocations.collocations(documents(spark, [(1, " .\n", None, None)])).collect() == []


def test_large_counts_are_exact(spark):
    a, left, right = 3 * 10**12 + 7, 4 * 10**12 + 1, 10**13 + 3
    rows = spark.createDataFrame(
        [("en", "a b", a, [left], [right], 10**14)],
        "lang string, phrase string, f long, starts array<long>, ends array<long>, n long",
    )
    assert collocations.ranked(rows, 5).first().score == 10**6 * a * a // (left * right)


def test_curve_steps_to_neighbours():
    side = 8
    cells = np.array(list(itertools.product(range(side), repeat=3)), np.uint32)
    keys = [key.tobytes() for key in codes.hilbert_keys(cells, 3)]
    walk = cells[sorted(range(len(cells)), key=keys.__getitem__)].astype(int)
    assert len(set(keys)) == len(cells) and (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def plain_codes(rows, parts: int, entries: int, rounds: int) -> tuple[list[tuple], str]:
    kept = [row for row in rows if row[1] is not None and all(x is not None and math.isfinite(x) for x in row[1])]
    width = -(-max((len(row[1]) for row in kept), default=0) // parts) * parts
    step = width // parts
    whole = [[math.floor(4096 * x) if abs(x) < 2**50 else 4096 * int(x) for x in row[1]] for row in kept]
    whole = [row + [0] * (width - len(row)) for row in whole]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[whole[i][p * step : (p + 1) * step] for i in order] for p in range(parts)]

    def nearest(p: int, own: list[int]) -> tuple[int, int]:
        return min((sum((x - c) ** 2 for x, c in zip(own, entry)), at) for at, entry in enumerate(books[p]))

    for turn in range(rounds + 1):
        found = [[nearest(p, row[p * step : (p + 1) * step]) for p in range(parts)] for row in whole]
        if turn == rounds:
            break
        for p in range(parts):
            for at in range(len(books[p])):
                own = [row[p * step : (p + 1) * step] for row, near in zip(whole, found) if near[p][1] == at]
                if own:
                    books[p][at] = [sum(column) // len(own) for column in zip(*own)]
    errors = [sum(error for error, _ in near) for near in found]
    by_label: dict = {}
    for row, error in zip(kept, errors):
        by_label[row[2]] = by_label.get(row[2], 0) + error
    short = lambda x: x if x < 2**63 else None
    out = [
        (row[0], "".join(f"{at:02x}" for _, at in near), short(error), short(by_label[row[2]]))
        for row, near, error in zip(kept, found, errors)
    ]
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(out, key=str), hashlib.sha256(flat.encode()).hexdigest()


def embedded(spark, rows):
    names = "vec_id long, embedding array<double>, label int, code int, `row` int, part int, error int, own_label int"
    return spark.createDataFrame([(*row, *[None] * 5) for row in rows], names).repartition(3)


def some_vectors(count: int, width: int, seed: int = 3) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width))
    return [
        (i, (centres[i % 9] + rng.normal(size=width) / 9).tolist(), None if i % 5 == 0 else i % 4) for i in range(count)
    ]


ODD_VECTORS = [
    *some_vectors(60, 8),
    (5, [0.5] * 8, 2), (5, [0.5] * 8, 2), (None, [0.25] * 8, None), (61, None, 1), (62, [math.nan] * 8, 1),
    (63, [1.0, None, *[0.0] * 6], 1), (64, [math.inf] * 8, 1), (-3, [-0.0001] * 8, 7), (65, [1.0], 7), (66, [], 7),
]


@pytest.mark.parametrize(
    "rows, parts, entries, block",
    [
        (ODD_VECTORS, 8, 16, 4),
        (ODD_VECTORS, 3, 5, 256),
        (some_vectors(7, 16), 8, 16, 256),
        ([*some_vectors(40, 16), (41, [1e9] * 16, 3), (42, [-1e30] * 16, 3)], 4, 6, 8),
        ([*some_vectors(40, 16), *[(1000 + i, [0.5] * 16, 1) for i in range(300)]], 8, 16, 16),
        ([(1, [], None), (2, [], 1)], 8, 16, 16),
    ],
)
def test_codes(spark, rows, parts, entries, block):
    got = codes.encode(embedded(spark, rows), parts, entries, 6, block_parts=block).collect()
    wanted, digest = plain_codes(rows, parts, entries, 6)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str) == wanted
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_no_vectors(spark):
    assert codes.encode(embedded(spark, [(1, None, 1)])).collect() == []
    assert codes.encode(embedded(spark, []).limit(0)).columns == [
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    ]


def test_shortlists_keep_what_is_nearest():
    rng = np.random.default_rng(1)
    entries = rng.integers(-50, 50, (16, 2))
    for _ in range(200):
        own = rng.integers(-50, 50, 2) + rng.integers(-9, 9, (30, 2))
        listed = codes.shortlists(own.min(0)[None], own.max(0)[None], entries)[0]
        every, _ = codes.nearest(own, entries, np.arange(16))
        assert listed[every].all()


def all_ways(word: str, pieces: dict[str, float]) -> float:
    if not word:
        return 1.0
    return sum(p * all_ways(word[len(piece) :], pieces) for piece, p in pieces.items() if word.startswith(piece))


def test_words_have_the_sum_over_all_segmentations():
    pieces, order = lattice.pieces_of(PIECES)
    scores = lattice.scored(pieces, order, np.zeros(len(pieces)), 0.0)
    by_piece = dict(zip(pieces, np.exp(scores[0]).tolist()))
    words = [b"the", b"thonre", "éé".encode(), b"\x00<s>", "▁x".encode(), b"q"]
    found = lattice.word_logs(words, PIECES, scores)
    for word in words:
        line = lattice.START + word.decode("latin-1")
        own = {piece: p for piece, p in by_piece.items() if piece in line}
        assert found[word] == pytest.approx(math.log(all_ways(line, own)) + scores[1], rel=1e-12)


def test_expected_counts_spell_the_words():
    pieces, order = lattice.pieces_of(PIECES)
    scores = lattice.scored(pieces, order, np.zeros(len(pieces)), 0.0)
    words = [b"thonre", b"a", b"inging" * 40]
    used = lattice.Lattices(words, PIECES).expected(scores, len(pieces))
    assert used @ np.array([len(piece) for piece in pieces]) == pytest.approx(sum(len(word) + 1 for word in words))
    before = sum(lattice.word_logs(words, PIECES, scores).values())
    after = sum(lattice.word_logs(words, PIECES, lattice.scored(pieces, order, 1000 * used, 3000.0)).values())
    assert after > before


def test_probabilities_of_pieces_add_up_to_one():
    pieces, order = lattice.pieces_of(PIECES)
    logs, end = lattice.scored(pieces, order, np.arange(len(pieces)) % 7.0, 55.0)
    begins = np.array([piece[0] == lattice.START for piece in pieces])
    assert np.exp(logs[begins]).sum() == pytest.approx(1.0)
    assert np.exp(logs[~begins]).sum() + math.exp(end) == pytest.approx(1.0)


def plain_scores(rows) -> list[tuple]:
    split = lambda text: re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    held = lambda doc: doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0
    counts, ends = Counter(), 0
    for doc, text, _, _ in rows:
        if not held(doc):
            counts.update(split(text))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    log = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    return [
        (
            doc, held(doc), len(words) + 1, sum(counts[w] > 0 for w in words) + (ends > 0), n,
            round(math.fsum(log(counts[w]) for w in words) + log(ends), 6),
        )
        for doc, text, _, _ in rows
        for words in [split(text)]
    ]


@pytest.mark.parametrize("block_bytes", [200, lattice.BLOCK_BYTES])
@pytest.mark.parametrize("kept", [lambda row: True, lambda row: row[0] == 29, lambda row: row[0] is None])
def test_scores(spark, block_bytes, kept):
    rows = [row for row in [*ROWS, (18, "the quick\x00 ok", "en", "a"), (29, "Held-out words", "en", "a")] if kept(row)]
    got = lattice.score_texts(documents(spark, rows), PIECES, 1, block_bytes).collect()
    plain = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(plain, key=str) == sorted(plain_scores(rows), key=str)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_no_texts_to_score(spark):
    assert lattice.score_texts(no_documents(spark), PIECES).collect() == []


def test_scores_add_up_word_by_word(spark):
    rows = [(1, "aa bb aa", "en", "a"), (2, "aa zz", "en", "a"), (29, "bb new", "en", "a")]
    assert [zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in rows] == [False, False, True]
    got = {r.doc_id: r for r in lattice.score_texts(documents(spark, rows), PIECES, 0).collect()}
    pieces, order = lattice.pieces_of(PIECES)
    words = lattice.word_logs([b"aa", b"bb", b"new"], PIECES, lattice.scored(pieces, order, np.zeros(len(pieces)), 0.0))
    n, once, ends = 7, 2, 2
    end = (ends + 1) / (n + 2)

    def log(count: int, word: bytes) -> float:
        return math.log10((count + (once + 1) * (1 - end) * math.exp(words[word])) / (n + once + 1))

    last = math.log10((ends + (once + 1) * end) / (n + once + 1))
    assert got[29].score == pytest.approx(log(1, b"bb") + log(0, b"new") + last, rel=1e-9)
    assert got[1].score == pytest.approx(2 * log(3, b"aa") + log(1, b"bb") + last, rel=1e-9)
