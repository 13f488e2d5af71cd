"""Registered queries beside their SQL, and those without SQL beside brute force."""

from __future__ import annotations

import base64
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from flarebook.llm.queries import oracle_sql, queries
from oracle import differences
from tokenizers import Tokenizer

TABLES = "/root/testdata/sf0.001"
QUERIES, ORACLE = queries(), oracle_sql()


def rows_of(table: str, columns: str) -> list[tuple]:
    return duckdb.connect().execute(f"SELECT {columns} FROM '{TABLES}/{table}.parquet'").fetchall()


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, TABLES), ORACLE[name], TABLES) == []


def test_token_counts(spark):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = {doc: len(encoding.encode_ordinary(text or "")) for doc, text in rows_of("documents", "doc_id, text")}
    assert dict(QUERIES["op1_token_files"](spark, TABLES).collect()) == wanted


def test_packed_pieces(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = QUERIES["op10_packing"](spark, TABLES).collect()
    by_doc: dict[int, list] = {}
    for row in pieces:
        by_doc.setdefault(row.doc_id, []).append(row)
    for doc, text in rows_of("documents", "doc_id, text"):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(by_doc.pop(doc), key=lambda row: row.start)
        assert [row.start for row in own] == [0, *np.cumsum([row.length for row in own])[:-1].tolist()]
        assert sum(row.length for row in own) == len(ids) == own[0].doc_tokens
        for row in own:
            part = ids[row.start : row.start + row.length]
            assert row.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            assert row.length & (row.length - 1) == 0 and row.length <= 2048 and row.offset == 0
    assert not by_doc and len({row.sequence_id for row in pieces}) == len(pieces)


def test_neighbours_found(spark):
    rows = rows_of("embeddings", "vec_id, embedding")
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found: dict[int, list] = {}
    for row in QUERIES["op3_neighbours"](spark, TABLES).orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append((row.vec_id, row.score))
    assert sorted(found) == sorted(i for i in ids.tolist() if i % 100 == 0)
    right = 0
    for query, near in found.items():
        gaps = np.sqrt(((vectors - vectors[ids == query][0]) ** 2).sum(axis=1))
        wanted = [i for i in ids[np.lexsort((ids, gaps))].tolist() if i != query][:10]
        right += len({i for i, _ in near} & set(wanted))
        assert [gap for _, gap in near] == pytest.approx([gaps[ids == i][0] for i, _ in near])
        assert near == sorted(near, key=lambda row: (row[1], row[0]))
    assert right >= 0.9 * 10 * len(found)


def test_language_of_held_out_documents(spark):
    found = {row.doc_id: row for row in QUERIES["op7_language"](spark, TABLES).collect()}
    known = {doc: lang for doc, lang in rows_of("documents", "doc_id, lang") if lang}
    held = [doc for doc in known if found[doc].held_out]
    assert all(found[doc].held_out == (zlib.crc32(str(doc).encode()) % 4 == 2) for doc in known)
    assert sum(found[doc].lang_pred == known[doc] for doc in held) >= 0.95 * len(held)
    assert all(0 <= row.score <= 1 for row in found.values())
