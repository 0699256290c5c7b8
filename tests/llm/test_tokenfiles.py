"""Elias-Fano sequences and files of token ids."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tradelake.llm import bytepairs, eliasfano, tokenfiles
from tradelake.llm.queries import byte_tokenizer
from tradelake.llm.shared import place

ROOT = "/root/testdata/sf0.001"
LONG = "Lorem ipsum dolor sit amet consectetur. " * 3000


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=1500), st.integers(0, 63))
def test_sequence_round_trip(values, shift):
    values = np.sort(np.array(values, np.uint64) >> np.uint64(shift))
    found = eliasfano.Sequence(eliasfano.encode(values))
    assert len(found) == len(values)
    assert (found.slice(0, len(values)) == values).all()
    for i in range(0, len(values), 97):
        assert found.select(i) == values[i]
        assert (found.slice(i, len(values)) == values[i:]).all()


def test_sequence_is_small():
    """Offsets of a million documents of 1,000 ids or so take less than 13 bits each; a 64-bit table takes five times that."""
    offsets = np.cumsum(np.random.default_rng(1).integers(1, 2000, 1_000_000).astype(np.uint64))
    assert len(eliasfano.encode(offsets)) * 8 < 13 * len(offsets)


def test_sequence_must_rise():
    with pytest.raises(ValueError):
        eliasfano.encode(np.array([3, 2], np.uint64))


@pytest.mark.parametrize("text", ["x" * 1_000_000, "ab1!" * 50_000, " " * 50_000 + "x", "\n \n\t" * 9000, "中文字é" * 20_000, "<|endoftext|> it's <|endoftext|>", "a\u0085   b"])
def test_coder_equals_library(library, text):
    assert bytepairs.coder_of(byte_tokenizer()).encode(text).tolist() == library(text)


def test_query(spark, library):
    docs = sorted(spark.read.parquet(f"{ROOT}/documents.parquet").collect(), key=lambda r: r.doc_id)
    at = 0
    for doc, found in zip(docs, sorted(queries()["op13_elias_fano"](spark, ROOT).collect()), strict=True):
        ids = [*library(doc.text), 0]
        assert tuple(found) == (doc.doc_id, at, len(ids), crc(ids))
        at += len(ids)


@pytest.mark.parametrize("file_ids", [1, 50, 1 << 26])
def test_odd_rows(spark, library, tmp_path, file_ids):
    """Missing and repeated ids, repeated rows, negative and largest ids, null, empty and long texts, clashing columns."""
    rows = [
        (None, "no id"), (None, "b"), (3, None), (4, ""), (5, "two"), (5, "one"), (6, "same"), (6, "same"), (7, LONG),
        (-9, "least"), (-(2**63), "x"), (2**63 - 1, "last <|endoftext|>"), (8, "é\U0001f600"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("h", "r", "start", "ids", "part", "_H")}).repartition(5)
    files = tokenfiles.write(docs, byte_tokenizer(), str(tmp_path), file_ids=file_ids)
    found = sorted(tokenfiles.read(files, str(tmp_path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    at = 0
    for r in found:
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    expect = sorted((k is not None, k or 0, [*library(t), 0]) for k, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in found) == expect


def test_list_is_one_file(spark, tmp_path):
    """However many tasks write token files, their list is one file of Parquet."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = tokenfiles.write(spark.range(400).selectExpr("id AS doc_id", "'text' AS text"), byte_tokenizer(), str(tmp_path), file_ids=50)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files.count() > 8 and files.select("part").distinct().count() > 1
    assert len(files.inputFiles()) == 1
    assert tokenfiles.read(files, str(tmp_path)).count() == 400


def test_empty_table(spark, tmp_path):
    files = tokenfiles.write(spark.createDataFrame([], "doc_id long, text string"), byte_tokenizer(), str(tmp_path))
    assert files.count() == 0 and tokenfiles.read(files, str(tmp_path)).count() == 0


def test_doc_id_must_be_a_number(spark, tmp_path):
    with pytest.raises(TypeError):
        tokenfiles.write(spark.createDataFrame([("a", "b")], "doc_id string, text string"), byte_tokenizer(), str(tmp_path))


def test_reader_finds_single_documents_and_damage(spark, library, tmp_path):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    files = tokenfiles.write(docs, byte_tokenizer(), str(tmp_path)).collect()
    system, root = place(str(tmp_path))
    for f in files:
        reader = tokenfiles.Reader(system.open_input_file(f"{root}/{f.file}"))
        for i in (0, f.docs // 2, f.docs - 1):
            assert reader.document(i).tolist() == [*library(f"text {reader.key(i)}"), 0]
    path = tmp_path / files[0].file
    raw = bytearray(path.read_bytes())
    raw[20] ^= 1
    path.write_bytes(raw)
    with pytest.raises(ValueError, match="not those"):
        list(tokenfiles.Reader(system.open_input_file(str(path))).runs())
