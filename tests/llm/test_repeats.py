from __future__ import annotations

import random

import pytest
from flarebook.llm import repeats
from flarebook.llm.repeats import LoserTree, as_text, decoded, front_coded, remove_repeats, repeated
from fixtures import ROWS, documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def brute_force(texts: list[str | None], length: int) -> list[bytes]:
    encoded = [(t or "").encode() for t in texts]
    times: dict[bytes, int] = {}
    for text in encoded:
        for i in range(len(text) - length + 1):
            times[text[i : i + length]] = times.get(text[i : i + length], 0) + 1
    rest = []
    for text in encoded:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if times[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        rest.append(bytes(b for b, out in zip(text, gone) if not out))
    return rest


def check(spark, rows, length):
    got = remove_repeats(documents(spark, rows), length).collect()
    wanted = brute_force([row[1] for row in rows], length)
    assert sorted((str(r.doc_id), bytes(r.kept)) for r in got) == sorted(
        (str(row[0]), rest) for row, rest in zip(rows, wanted)
    )
    for r in got:
        assert r.n_bytes - len(r.kept) == sum(s.end - s.start for s in r.spans)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_odd_rows(spark):
    check(spark, [row for row in ROWS if row[0] != 10], 200)


def test_no_rows(spark):
    assert remove_repeats(no_documents(spark)).collect() == []


def test_random_texts_with_few_letters(spark):
    rng = random.Random(1)
    rows = []
    for doc in range(60):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(0, 300)))
        if doc % 3 == 0:
            text = text * 2
        rows.append((doc, text, "en", "a"))
    check(spark, rows, 40)


def test_shared_passages_with_edits(spark):
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz é"
    passages = ["".join(rng.choice(letters) for _ in range(rng.choice([45, 60, 150, 400]))) for _ in range(6)]
    rows = []
    for doc in range(80):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 200)))
        for _ in range(rng.randint(0, 3)):
            some = list(rng.choice(passages))
            if rng.random() < 0.5:
                some[rng.randrange(len(some))] = "#"
            at = rng.randint(0, len(text))
            text = text[:at] + "".join(some) + text[at:]
        rows.append((doc, text, "en", "a"))
    check(spark, rows, 50)


def test_chunks_of_a_long_text_agree(spark, monkeypatch):
    from flarebook.llm import repeats

    rng = random.Random(4)
    one = "".join(rng.choice("abcdefgh") for _ in range(1500))
    rows = [(1, one, "en", "a"), (2, "x" + one[300:900], "en", "a"), (3, one[100:400] + "y" + one[700:], "en", "a")]
    wanted = [repeats.anchors(memoryview(one.encode()), 50)]
    monkeypatch.setattr(repeats, "CHUNK", 97)
    cut = repeats.anchors(memoryview(one.encode()), 50)
    assert set(cut[0].tolist()) == set(wanted[0][0].tolist())
    check(spark, rows, 50)


def test_text_after_a_cut_within_a_character(spark):
    frame = spark.createDataFrame([(bytearray("aé".encode()[:2] + b"b"),)], "kept binary")
    assert frame.select(as_text(F.col("kept"))).first()[0] == "ab"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=6), max_size=9))
def test_merge_of_front_coded_runs(runs):
    coded = [front_coded([(key, str(i).encode()) for key in sorted(run)]) for i, run in enumerate(runs)]
    merged = list(LoserTree([decoded(run) for run in coded]))
    assert [key for _, key, _ in merged] == sorted(key for run in runs for key in run)
    before = b""
    for shared, key, _ in merged:
        same = next((i for i, (x, y) in enumerate(zip(before, key)) if x != y), min(len(before), len(key)))
        assert shared == same
        before = key


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=4, max_size=4), st.text("ab", max_size=4)), min_size=1, max_size=12))
def test_ranges_cover_what_pairs_share(items):
    items = sorted((after.encode(), before.encode()) for after, before in items)

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    prefixes = [0, *(common(a[0], b[0]) for a, b in zip(items, items[1:]))]
    got = repeated(prefixes, [before for _, before in items], 4)
    for i, (after, before) in enumerate(items):
        wanted = {
            o
            for j, (other_after, other_before) in enumerate(items)
            if i != j
            for o in range(4 - common(after, other_after), common(before, other_before) + 1)
        }
        assert {o for low, high in got[i] for o in range(low, high + 1)} == wanted


def passage_in_all(n):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh") for _ in range(120))
    texts = [passage.join("".join(rng.choice("ijklmnop") for _ in range(70)) for _ in range(2)) for _ in range(n)]
    return [(i, text, "en", "a") for i, text in enumerate(texts)] + [(None, texts[0][9:], "en", "a"), (3, texts[3], "en", "a")]


@pytest.mark.parametrize("hot", [1, 3, 12])
def test_split_groups_agree_with_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "ROWS_AT_ONCE", 50)
    check(spark, passage_in_all(30), 50)


def test_split_groups_with_few_letters(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 2)
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(30, 200))), "en", "a") for i in range(80)]
    check(spark, rows, 40)


def test_no_merge_group_holds_more_contexts_than_it_may(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(repeats, "HOT", 10)
    texts = repeats.keyed(documents(spark, passage_in_all(60)))
    found = repeats.repeated_anchors(texts, 50, str(tmp_path / "anchors"))
    hot = repeats.contexts(texts, found.filter("wanted and hot"), 50)
    assert hot.count() > 100
    groups, _ = repeats.split_groups(hot, 50)
    shared = F.expr("substring(bytes, CAST(most - low + 1 AS INT), CAST(low + 50 - high AS INT))")
    sizes = groups.groupBy("low", "high", shared).count().collect()
    assert all(1 < row["count"] <= 10 for row in sizes)


def test_runs_of_one_character_are_few_rows(spark, tmp_path):
    rows = [(1, "a" * 300_000, "en", "a"), (2, "xyz" * 50_000 + "end", "en", "a"), (3, "b" + "a" * 260, "en", "a")]
    texts = repeats.keyed(documents(spark, rows))
    found = repeats.repeated_anchors(texts, 200, str(tmp_path / "anchors"))
    assert found.count() < 200
    assert found.selectExpr("sum(size(spans))").first()[0] < 10
    got = {r.doc_id: (bytes(r.kept), len(r.spans)) for r in remove_repeats(documents(spark, rows)).collect()}
    assert got == {1: (b"", 1), 2: (b"end", 1), 3: (b"b", 1)}
