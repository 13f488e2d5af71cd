"""The stages on a small fixture, each against brute force over its own input."""

from __future__ import annotations

import random
import struct

import corpus_pipeline
import public_tokenizers
import pytest
from flarebook.llm.language import held_out
from flarebook.llm.tables import scratch
from fixtures import LONG_TEXT, PASSAGE, ROWS, documents, no_documents
from pyspark.sql import functions as F
from test_native import by_hand, words
from test_near_dup import brute_force as components
from test_repeats import brute_force as rest_of
from tokenizers import Tokenizer


def rows_for_all_stages():
    rng = random.Random(11)
    rows = [row for row in ROWS if row[1] != LONG_TEXT]
    for i in range(100, 160):
        text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "ö", "eps"]) + str(rng.randrange(50)) for _ in range(80))
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice("ab")))
        if i % 5 == 0:
            rows.append((i + 100, text, "en", "a"))
        if i % 7 == 0:
            rows.append((i + 200, text + " " + PASSAGE, "en", "b"))
    return rows


def stored(frame):
    folder = scratch(frame.sparkSession, "test-stage")
    frame.write.parquet(folder)
    return frame.sparkSession.read.parquet(folder)


def content(frame):
    return sorted(((r.doc_id, r.text, r.lang, r.source) for r in frame.collect()), key=str)


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language identification", "near duplicates", "repeated passages", "mixing", "packing",
    ]


def test_every_stage(spark):
    rows = rows_for_all_stages()
    docs = stored(documents(spark, rows))
    columns = docs.columns

    langs = stored(corpus_pipeline.identify_language(spark, docs, ""))
    with_letters = [row for row in rows if row[1] and any(map(str.isalpha, row[1]))]
    assert langs.columns == columns and content(langs) == sorted(with_letters, key=str)

    single = stored(corpus_pipeline.drop_near_duplicates(spark, langs, ""))
    heads = {str(c) for _, _, c in components(with_letters)}
    got = content(single)
    assert single.columns == columns and sorted(str(r[0]) for r in got) == sorted(heads)
    assert set(got) <= set(with_letters)

    cut = stored(corpus_pipeline.drop_repeats(spark, single, ""))
    wanted = rest_of([r[1] for r in got], 200)
    assert cut.columns == columns
    assert content(cut) == sorted(
        ((r[0], rest.decode("utf-8", "ignore"), *r[2:]) for r, rest in zip(got, wanted)), key=str
    )
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    mixed = stored(corpus_pipeline.mix_sources(spark, cut, ""))
    sizes, taken, longest = {}, {}, 0
    for _, text, _, source in content(cut):
        sizes[source] = sizes.get(source, 0) + words(text)
        longest = max(longest, words(text))
    for _, text, _, source in content(mixed):
        taken[source] = taken.get(source, 0) + words(text)
    assert mixed.columns == columns
    for source, target in by_hand(sizes).items():
        assert abs(taken.get(source, 0) - target) <= longest

    pieces = corpus_pipeline.pack_sequences(spark, mixed, "").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = sorted(i for r in mixed.collect() for i in [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1])
    assert sorted(i for p in pieces for i in struct.unpack(f"<{p.length}I", p.ids)) == ids


def test_run_applies_all_stages(spark, tmp_path):
    documents(spark, rows_for_all_stages()).write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert pieces.count() > 50 and "sequence_id" in pieces.columns


def test_empty_table(spark, tmp_path):
    no_documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_replacement_characters_stay_and_cuts_leave_whole_characters(spark):
    shared = "".join(f"shared {i} \ufffd " for i in range(30))
    rows = [
        (1, "x\ufffd\x01ab \x01 é" + shared + "è \ufffd end", "en", "a"),  # the cuts leave C3 and A8, together è
        (2, "y ũ" + shared + "é rest", "en", "a"),
        (3, "clean \ufffd text \ufffd\x01b", "en", "b"),
        (4, None, "en", "b"),
    ]
    got = corpus_pipeline.drop_repeats(spark, documents(spark, rows), "").collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in got} == {
        1: ("x\ufffd\x01ab \x01  \ufffd end", 14), 2: ("y  rest", 7), 3: ("clean \ufffd text \ufffd\x01b", 16), 4: ("", 0),
    }


@pytest.mark.parametrize("labelled", ["none", "held out"])
def test_documents_with_letters_stay_without_a_learned_language(spark, labelled):
    docs = documents(spark, ROWS)
    docs = docs.withColumn("lang", F.when(held_out() if labelled == "held out" else F.lit(False), F.col("lang")))
    langs = corpus_pipeline.identify_language(spark, docs, "")
    wanted = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect() if r.text and any(map(str.isalpha, r.text))]
    assert langs.columns == docs.columns and content(langs) == sorted(wanted, key=str) and len(wanted) > 10


def test_one_of_each_group_stays_where_ids_repeat_or_are_null(spark):
    base = " ".join(f"word{i}" for i in range(200))
    other = " ".join(f"other{i}" for i in range(200))
    rows = [
        (7, base + " a", "en", "a"), (7, base + " b", "en", "a"), (7, base + " b", "en", "a"),
        (None, other + " a", "en", "a"), (None, other + " b", "en", "b"), (None, "alone it is here now", "en", "b"),
        (7, "another text of that id", "en", "a"), (9, other[::-1], "en", "a"), (9, "the same id again here", "en", "a"),
    ]
    got = content(corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), ""))
    texts = [r[1] for r in got]
    assert sum(t.startswith("word0 ") for t in texts) == 1 and sum(t.startswith("other0 ") for t in texts) == 1
    assert sorted(t for t in texts if not t.startswith(("word0 ", "other0 "))) == sorted(r[1] for r in rows[5:])
