"""Token files and archives: exact round trips, and files that are not whole."""

from __future__ import annotations

import gzip

import numpy as np
import public_tokenizers
import pytest
from flarebook.llm import token_files, warc
from flarebook.llm.tables import scratch
from fixtures import ROWS, documents, no_documents

SEPARATOR = 50256
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def write(spark, docs):
    folder = scratch(spark, "test-tokens")
    token_files.write_token_files(docs, folder, RANKS, public_tokenizers.PATTERN, SEPARATOR)
    return folder


@pytest.mark.parametrize("block_ids", [3, 64, 1 << 19])
def test_documents_across_blocks(spark, block_ids):
    rows = [row for row in ROWS if row[0] != 10] if block_ids == 3 else ROWS
    folder = write(spark, documents(spark, rows))
    encoding = token_files._encoding(RANKS, public_tokenizers.PATTERN)
    wanted = sorted(((row[0], len(encoding.encode_ordinary(row[1] or ""))) for row in rows), key=str)
    got = token_files.scan_token_files(spark, folder, SEPARATOR, block_ids).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == wanted
    assert all(r.complete for r in got)


def test_no_documents(spark):
    assert token_files.scan_token_files(spark, write(spark, no_documents(spark)), SEPARATOR).collect() == []


@pytest.mark.parametrize("block_ids", [2, 7, 1000])
def test_a_file_that_was_cut_off(spark, tmp_path, block_ids):
    def stream(doc, tokens):
        return [*token_files.label_ids(doc), *tokens]

    whole = stream(-5, [1, 2, 3]) + [SEPARATOR] + stream(None, []) + [SEPARATOR] + stream(2**62, [9] * 20)
    np.array(whole, "<u2").tofile(tmp_path / "part-0")
    np.array(whole[:3], "<u2").tofile(tmp_path / "part-1")
    got = token_files.scan_token_files(spark, str(tmp_path), SEPARATOR, block_ids).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.complete) for r in got), key=str) == sorted(
        [(-5, 3, True), (None, 0, True), (2**62, 20, False), (None, 0, False)], key=str
    )


def test_separator_must_be_free(spark):
    with pytest.raises(ValueError):
        token_files.write_token_files(documents(spark), "unused", RANKS, public_tokenizers.PATTERN, 5)


PAGES = [
    (3, "http://a/ b\r\nX: y", "<p>same</p>"),
    (1, None, "<p>same</p>"),
    (2, "http://c", None),
    (5, "http://c", ""),
    (None, "http://d", "<p>same</p>"),
    (None, "http://d", "alone é"),
    (7, "http://e", "x" * 300_000 + "\r\n\r\nWARC/1.1\r\n"),
    (1, None, "<p>same</p>"),
]


def archived(spark, rows, **options):
    folder = scratch(spark, "test-archives")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int, revisit int, first_id int")
    warc.write_archives(pages.repartition(2), folder, **options)
    return folder


def test_archives_round_trip(spark):
    rows = [(*row, None, None, None) for row in PAGES]
    got = warc.read_archives(spark, archived(spark, rows, archive_bytes=500)).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in got) == sorted(
        [
            ("1", "response", None, 11), ("1", "response", None, 11), ("3", "revisit", 1, 11),
            ("None", "revisit", 1, 11), ("None", "response", None, 8), ("2", "response", None, 0),
            ("5", "revisit", 2, 0), ("7", "response", None, 300_014),
        ]
    )
    for r in got:
        if r.record_type == "response":
            assert warc.sha1(bytes(r.payload)) == r.payload_digest
    assert {r.url for r in got if r.page_id == 3} == {"http://a/%20b%0D%0AX:%20y"}


def test_small_payloads_are_not_looked_up(spark):
    rows = [(*row, None, None, None) for row in PAGES]
    got = warc.read_archives(spark, archived(spark, rows, least_bytes=12)).collect()
    assert {r.record_type for r in got} == {"response"}


def test_no_pages(spark):
    assert warc.read_archives(spark, archived(spark, [])).collect() == []


def test_each_record_is_a_gzip_member():
    data = warc.record(4, "http://x", memoryview(b"payload"), None, False) + warc.closing()
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 2
    heads = [warc.parse(one)[0]["WARC-Type"] for one in warc.members(memoryview(data), read_bytes=5)]
    assert heads == ["response", "warcinfo"]


def test_damage_is_noticed():
    good = gzip.decompress(warc.record(4, None, memoryview(b"payload"), None, False))
    with pytest.raises(ValueError, match="digest"):
        warc.parse(good.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"))
    with pytest.raises(ValueError, match="length"):
        warc.parse(good[:-1])
    with pytest.raises(ValueError, match="ends within"):
        list(warc.members(memoryview(warc.closing()[:-4])))


def test_files_are_of_a_bounded_size(spark):
    rows = [(i, f"http://p/{i}", "".join(chr(97 + (i * j * 7919) % 26) for j in range(3000)), None, None, None) for i in range(60)]
    sizes = spark.read.format("binaryFile").load(archived(spark, rows, archive_bytes=2_000)).select("length").collect()
    assert len(sizes) > 4 and all(row.length <= 3_000 for row in sizes)
    folder = scratch(spark, "test-tokens")
    rolled = {"file_documents": 3}
    token_files.write_token_files(documents(spark), folder, RANKS, public_tokenizers.PATTERN, SEPARATOR, **rolled)
    assert spark.read.format("binaryFile").load(folder).count() >= len(ROWS) // 3
    assert token_files.scan_token_files(spark, folder, SEPARATOR).count() == len(ROWS)
