from __future__ import annotations

import random

import numpy as np

from flarebook.llm import near_dup
from flarebook.llm.graph import components
from fixtures import documents, no_documents


def shingle_set(text: str | None) -> frozenset:
    letters = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = (text or "").translate(letters).encode().split()
    if not words:
        return frozenset()
    run = min(5, len(words))
    return frozenset(tuple(words[i : i + run]) for i in range(len(words) - run + 1))


def brute_force(rows: list[tuple]) -> dict[int, tuple]:
    sets = [(row[0], shingle_set(row[1])) for row in rows]
    group = list(range(len(sets)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                group[top(i)] = top(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(sets):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(((doc, len(s), least.get(top(i))) for i, (doc, s) in enumerate(sets)), key=str)


def found(frame) -> list[tuple]:
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=str)


def test_odd_rows(spark):
    from fixtures import ROWS

    rows = near_dup.near_duplicates(documents(spark)).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)
    assert got == brute_force(ROWS)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_no_rows(spark):
    assert near_dup.near_duplicates(no_documents(spark)).collect() == []


def test_random_copies_of_all_sizes(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 20, 60, 90, 300, 900]))]
        for _ in range(rng.randint(1, 8)):
            copy = list(words)
            for _ in range(rng.randint(0, 1 + len(words) // 60)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy), "en", "a"))
    assert found(near_dup.near_duplicates(documents(spark, rows))) == brute_force(rows)


def test_large_family_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_CLASSES", 8)
    rng = random.Random(5)
    words = [f"w{rng.randrange(1000)}" for _ in range(200)]
    rows = []
    for _ in range(60):
        copy = list(words)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(200)] = f"x{rng.randrange(1000)}"
        rows.append((len(rows), " ".join(copy), "en", "a"))
    assert found(near_dup.near_duplicates(documents(spark, rows))) == brute_force(rows)


def test_union_sketch_and_bound():
    import numpy as np

    a, b = np.arange(1000, dtype=np.uint64), np.arange(100, 1100, dtype=np.uint64)
    assert near_dup.union_share(a, b) == (156, 256)
    assert near_dup.least_shared(64) < 0.85 * 64
    assert near_dup.is_similar(a, b, (81, 100)) and not near_dup.is_similar(a, b, (82, 100))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(100, 160)} == {100} and 200 not in got


def test_repeated_ids_do_not_multiply(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(24):
        words = list(base)
        words[5 * i] = "changed"
        rows.append((None if i % 2 else 7, " ".join(words), "en", "a"))
    rows += rows[:3] * 2
    handed = []
    frame = type(spark.range(0))
    run = frame.mapInArrow

    def counted(self, function, schema, *args):
        if function.__name__ == "tiles":
            handed.append(self.count())
        return run(self, function, schema, *args)

    monkeypatch.setattr(frame, "mapInArrow", counted)
    assert found(near_dup.near_duplicates(documents(spark, rows))) == brute_force(rows)
    assert handed == [len(rows)]


def test_words_of_two_letters_in_a_self_similar_order_differ():
    order = [bin(i).count("1") % 2 for i in range(4096)]
    words = ["".join("ab"[b] for b in order), "".join("ba"[b] for b in order)]
    hashes = [near_dup.word_hashes(memoryview(word.encode()))[0] for word in words]
    assert hashes[0] != hashes[1]
    again = near_dup.word_hashes(memoryview((" \n" + " x ".join(words).upper() + "\t").encode()))
    assert again[0] == hashes[0] and again[2] == hashes[1] and len(again) == 3


def test_values_in_lists_meet_by_chance_in_no_large_corpus():
    """Of n texts with 64 listed values each, the expected chance pairs are (64 n)^2 / 2 / 2^64."""
    kept = near_dup.shingles(memoryview(" ".join(map(str, range(400))).encode()))[: near_dup.RETAINED]
    assert kept.dtype == np.uint64 and len(np.unique(kept & np.uint64(2**32 - 1))) == len(kept)
    assert (near_dup.RETAINED * 10**8) ** 2 / 2 / 2**64 < 10
