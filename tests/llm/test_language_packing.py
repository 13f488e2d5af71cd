from __future__ import annotations

import random
import struct

import numpy as np
import public_tokenizers
import pytest
from flarebook.llm import language, packing
from fixtures import ROWS, documents, no_documents
from tokenizers import Tokenizer

FILE = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text) -> list[int]:
    return Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids


def unpacked(piece) -> list[int]:
    return list(struct.unpack(f"<{piece.length}I", piece.ids))


@pytest.mark.parametrize("longest", [1, 64, 2048])
def test_pieces_of_odd_rows(spark, longest):
    rows = ROWS if longest == 2048 else [row for row in ROWS if row[0] != 10]
    pieces = packing.pack(documents(spark, rows), FILE, longest=longest).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    by_doc: dict = {}
    for piece in sorted(pieces, key=lambda p: (p.sequence_id)):
        by_doc.setdefault(piece.doc_id, []).extend(unpacked(piece))
        assert piece.length <= longest and piece.length & (piece.length - 1) == 0
    by_number: dict = {}
    for row in rows:
        by_number.setdefault(row[0], []).append([*ids_of(row[1]), 1])
    for doc, wanted in by_number.items():
        assert sorted(by_doc[doc]) == sorted(i for ids in wanted for i in ids)
    assert by_doc[1] == [*ids_of(ROWS[0][1]), 1]


def test_no_rows(spark):
    assert packing.pack(no_documents(spark), FILE).collect() == []


def test_binary_pieces():
    assert list(packing.binary_pieces(2048 * 2 + 13, 2048)) == [(0, 2048), (2048, 2048), (4096, 8), (4104, 4), (4108, 1)]
    assert list(packing.binary_pieces(1, 2048)) == [(0, 1)]


def test_lengths_must_be_powers_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(documents(spark), FILE, longest=1000)


def test_buckets_hold_one_length(spark, tmp_path):
    packing.write_buckets(packing.pack(documents(spark, ROWS[:4]), FILE), str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).select("bucket", "length").distinct().collect()
    assert rows and all(row.bucket == row.length for row in rows)


TEXTS = [
    "Don't I'LL they've we'd 12 45a !!'s x's <|endoftext|> a<|startoftext|>b <| É́ é  x\x1cy İstanbul ŉ",
    "tabs\tand\nlines\r\x0b\x0cΣΑΣ ſ – “q” … z\x85 ǅ 漢字 ①²   x y",
    "A" * 300 + " " + "-" * 300,
]


@pytest.mark.parametrize("most", [5, 1000])
def test_ids_are_those_of_the_tokenizer(most):
    known = packing.WordTokens(Tokenizer.from_file(FILE), most)
    assert known.splits
    rng = random.Random(1)
    alphabet = "abzABZ'sStT 09.,<|>éÉßñĳ́\n\x1c’漢"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for text in texts:
        ids = ids_of(text)
        assert known.ids(memoryview(text.encode())) == struct.pack(f"<{len(ids)}I", *ids), text


def test_gradients_are_those_of_the_loss():
    random_ = np.random.default_rng(0)
    network = language.Network.fresh(["a", "b", "c"], 3, random_)
    network.weights = {k: v.astype(float) for k, v in network.weights.items()}
    words = random_.integers(0, 256, (4, 5)).astype(np.uint8)
    labels = np.array([0, 1, 2, 1])

    def loss() -> float:
        chances, _ = network.positions(words)
        return -np.log(chances[:, np.arange(4), labels]).mean()

    found = network.gradients(words, labels)
    for name, weight in network.weights.items():
        flat = weight.reshape(-1)
        places = random_.choice(flat.size, min(8, flat.size), replace=False)
        if name.endswith("_in"):
            places = [int(words[0, 0]) * weight.shape[1] + j for j in range(9)]
        for place in places:
            before = flat[place]
            flat[place] = before + 1e-4
            up = loss()
            flat[place] = before - 1e-4
            down = loss()
            flat[place] = before
            assert found[name].reshape(-1)[place] == pytest.approx((up - down) / 2e-4, abs=2e-4), name


SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["über", "ßen", "sch"], "cc": ["tion", "eau", "ç"]}


def made_up(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def test_learns_and_labels_odd_rows(spark):
    rng = random.Random(6)
    train = [(i, made_up(rng, lang, 60), lang, "s") for i, lang in enumerate(list(SYLLABLES) * 30)]
    network = language.train(documents(spark, train), steps=150)
    assert network.languages == ["aa", "bb", "cc"]
    odd = [(1, None, "x", None), (2, "", None, None), (3, "12 !!", "aa", "s"), (None, "ka lo", None, "s"),
           (5, made_up(rng, "bb", 90_000), None, None), (6, "schüberßen" * 900, "aa", None), (7, "TION EAU", None, None),
           (7, "TION EAU", None, None)]
    docs = documents(spark, odd)
    rows = language.predict(docs, network, tuple(docs.columns)).collect()
    got = sorted(((r[0] or 0, r[2]) for r in rows), key=str)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (0, "aa"), (5, "bb"), (6, "bb"), (7, "cc"), (7, "cc")], key=str)
    assert all(0 <= r[3] <= 1 for r in rows) and {r["source"] for r in rows} == {None, "s"}


def test_a_longer_text_is_the_mean_of_its_parts():
    network = language.Network.fresh(["a", "b"], 4, np.random.default_rng(3))
    votes = language.RunVotes(network, most=3)
    texts = [b"one two three", b"four", b"one two three four"]
    sums = votes.sums(map(memoryview, texts))
    assert sums[2] == pytest.approx(sums[0] + sums[1], abs=1e-5) and sums[0][-2] == len(b"one two three ")


def test_nothing_to_learn_from(spark):
    network = language.train(no_documents(spark))
    rows = language.predict(documents(spark), network).collect()
    assert len(rows) == len(ROWS) and {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    assert language.predict(no_documents(spark), network).collect() == []
    one = language.train(documents(spark, [(i, "only words", "en", "s") for i in range(8)]), steps=2)
    assert {r.lang_pred for r in language.predict(documents(spark, ROWS[:3]), one).collect()} == {"en"}


def test_a_repeated_id_does_not_outgrow_the_sample(spark, monkeypatch):
    texts = ["same"] * 50 + [f"text {i}" for i in range(50)]
    rows = [(1, text, "en", "s") for text in texts] + [(i, f"other {i}", "de", "s") for i in range(3, 12)]
    monkeypatch.setattr(language, "fit", lambda words, labels, steps: (words, labels))
    words, labels = language.train(documents(spark, rows), docs_per_language=4, words_per_doc=1)
    assert labels.count("en") == labels.count("de") == 4 and words.count(b"same") <= 1
