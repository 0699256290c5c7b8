"""Perfect hashing, and the alignment of two tokenizers against a plain version."""

import collections
import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tradelake.llm import alignment, perfecthash
from tradelake.llm.queries import byte_tokenizer
from tradelake.llm.words import byte_symbols

ROOT = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def plain(model):
    """The contract in plain loops, with the two libraries."""
    a_side = Tokenizer.from_str(byte_tokenizer())
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_proto=model)
    byte = {c: b for b, c in enumerate(byte_symbols())}
    of_a = {i: bytes(byte[c] for c in p) for p, i in json.loads(byte_tokenizer())["model"]["vocab"].items() if all(c in byte for c in p)}

    def of_b(i):
        name = b_side.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b_side.is_byte(i) else name.replace("▁", " ").encode()

    def groups(text):
        raw = f" {text}".encode()
        a, b = a_side.encode(f" {text}", add_special_tokens=False).ids, b_side.encode(text or "")
        if not text or b"".join(map(of_a.get, a)) != raw or b"".join(map(of_b, b)) != raw:
            return []
        cuts = [np.cumsum([len(x) for x in side]).tolist() for side in (map(of_a.get, a), map(of_b, b))]
        out, at = [], [0, 0]
        for end in sorted(set(cuts[0]) & set(cuts[1])):
            to = [c.index(end) + 1 for c in cuts]
            out.append((a[at[0] : to[0]], b[at[1] : to[1]]))
            at = to
        return out

    def run(rows):
        found = [(key, groups(text)) for key, text in rows]
        counts, best = collections.Counter(), collections.Counter()
        for _, g in found:
            counts.update({(x, y) for a, b in g for x in a for y in b})
        for (x, _), n in counts.items():
            best[x] = max(best[x], n)
        out = []
        for key, g in found:
            links = [(x, y) for a, b in g for x in a for y in b]
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            out.append(
                (key, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links), sum(counts[x] == best[x[0]] for x in links),
                 sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if g else "")
            )
        return sorted(out, key=repr)

    return run


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query(spark, plain):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").collect()
    assert rows_of(queries()["op12_pair_counts"](spark, ROOT)) == plain([(r.doc_id, r.text) for r in docs])


ODD = [
    (1, None), (2, ""), (3, " "), (4, "one two  three\n\n four"), (4, "one two"), (5, "same text"), (5, "same text"), (None, "same text"),
    (6, "a▁b"), (7, "<s> </s> <|endoftext|> <0x0A>"), (8, "é\U0001f600中文字 ß"), (9, "x" * 3000), (10, "abcdefghij" * 300),
    (11, "\x00\x01\x7f"), (12, "\U0001f468‍\U0001f469‍\U0001f467" * 50), (13, "long words and " * 4000),
]


@pytest.mark.parametrize("block", [1 << 25, 300])
def test_odd_rows(spark, plain, model, block):
    """Also in several blocks of slots: the sums may not depend on them."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("row", "a", "B", "n_a", "shard")})
    assert rows_of(alignment.align(docs.repartition(5), byte_tokenizer(), model, block)) == plain(ODD)


def test_empty_table(spark, model):
    found = alignment.align(spark.createDataFrame([], "doc_id long, text string"), byte_tokenizer(), model)
    assert found.count() == 0 and set(found.columns) == set(COLUMNS)


def test_a_table_without_links(spark, model):
    docs = spark.createDataFrame([(1, None), (2, "▁")], "doc_id long, text string")
    assert [r[1:7] for r in alignment.align(docs, byte_tokenizer(), model).collect()] == [(0,) * 6] * 2


@pytest.mark.parametrize("pairs, run", [(1, 1), (3, 4), (1000, 1000)])
def test_small_blocks_inside_tasks(monkeypatch, pairs, run):
    """Documents in runs and pairs in blocks of any size: the same pairs as from all of them at once."""
    import pyarrow as pa

    monkeypatch.setattr(alignment, "PAIRS", pairs)
    monkeypatch.setattr(alignment, "RUN", run)
    aligner = alignment.Aligner(np.array([1, 2, 3]), np.array([1, 2, 4]))
    a, b = [[2, 1, 0, 0, 0, 1], [], [1, 1], [2]], [[1, 2, 2], [], [2], [0, 0, 0]]
    groups = [([2, 1, 0], [1, 2]), ([0, 0, 1], [2]), ([1, 1], [2]), ([2], [0, 0, 0])]
    batch = pa.record_batch([pa.array([np.array(x, "<u4").tobytes() for x in side], pa.binary()) for side in (a, b)], names=["a", "b"])
    links, distinct, n = collections.Counter(), collections.Counter(), 0
    for part, aligned in alignment._runs([batch], aligner):
        n += part.num_rows
        distinct.update(aligned.pairs_of_documents().tolist())
        for _, key, of_a, times in aligned.pairs():
            assert (key // 3 == of_a).all()
            for k, t in zip(key.tolist(), times.tolist(), strict=True):
                links[k] += t
    assert n == 4
    assert links == collections.Counter(x * 3 + y for g in groups for x in g[0] for y in g[1])
    docs = [groups[:2], groups[2:3], groups[3:]]
    assert distinct == collections.Counter(k for d in docs for k in {x * 3 + y for g in d for x in g[0] for y in g[1]})


def test_one_block_is_not_added_up(spark, plain, model):
    """Only the sums of several blocks need a shuffle; a row of a single block is whole as it leaves its task. These rows have 60 pairs."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string").repartition(5)
    found = [alignment.align(docs, byte_tokenizer(), model, block) for block in (60, 20)]
    assert ["Exchange" in df._jdf.queryExecution().executedPlan().toString() for df in found] == [False, True]
    assert [rows_of(df) for df in found] == [plain(ODD)] * 2


@given(st.lists(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2)), max_size=12), max_size=6))
@settings(max_examples=100, deadline=None)
def test_alignment_in_plain_loops(docs):
    """Groups, distinct pairs and digests of a run of documents, whose sides are cut so that they have the same bytes."""
    aligner = alignment.Aligner(np.array([1, 2, 3]), np.array([1, 2, 3]))
    sides = [([x for x, _ in d] + [y for _, y in d], [y for _, y in d] + [x for x, _ in d]) for d in docs]
    found, pairs, texts = aligner.align(*[[np.array(d[i], np.uint32) for d in sides] for i in (0, 1)]) if docs else None, [], []
    for a, b in sides:
        ends = [np.cumsum([i + 1 for i in side]).tolist() for side in (a, b)]
        cuts = [0, *sorted(set(ends[0]) & set(ends[1]))]
        groups = [[[x for x, e in zip(side, at, strict=True) if low < e <= high] for side, at in zip((a, b), ends, strict=True)] for low, high in zip(cuts, cuts[1:], strict=False)]
        pairs += sorted({x * 3 + y for g in groups for x in g[0] for y in g[1]})
        texts.append(hashlib.sha256(";".join("|".join(",".join(map(str, side)) for side in g) for g in groups).encode()).hexdigest() if a else "")
    if docs:
        assert found.pairs_of_documents().tolist() == pairs
        assert found.digests(alignment._names(3, 3)) == texts


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000, 200_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64))
    shard = perfecthash.shard_of(keys)
    parts = [perfecthash.build(keys[shard == s]) for s in range(perfecthash.SHARDS)]
    table = perfecthash.Table(parts)
    mine, slots = table.look_up(keys)
    assert len(mine) == n and sorted(slots.tolist()) == list(range(n))
    assert (table.keys[slots] == keys).all()
    some = perfecthash.Table(parts[100:300], 100)
    mine, slots = some.look_up(keys)
    assert (mine == np.flatnonzero((shard >= 100) & (shard < 300))).all() and sorted(slots.tolist()) == list(range(len(mine)))
    if n > 100:
        assert len(table.words) * 64 < 4.5 * n + 64 * 30 * perfecthash.SHARDS
        with pytest.raises(KeyError):
            table.look_up(np.array([2**63 + 5], np.uint64))
