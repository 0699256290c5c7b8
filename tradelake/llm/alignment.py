"""Alignment of the ids of two tokenizers, with counts of linked id pairs over the whole corpus.

Both tokenizers cut the same bytes. Places where both have an end cut a text into groups, and every id of one side in
a group is linked to every id of the other. How many documents hold a pair of ids linked is counted like this:

1. the ids of both sides are written once; the distinct pairs of all documents are hashed perfectly, shard by shard;
2. documents are aligned and counted into dense vectors by slot of the hash, which are added up in a tree;
3. documents are aligned again, and the counts of their links looked up.

A look-up compares the key that is kept at the slot. Passes 2 and 3 hold a block of at most `block` slots in memory
and are repeated for each block; their sums per document add up. One block holds all pairs of a large corpus.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import perfecthash
from tradelake.llm.bytepairs import ByteCoder, coder_of
from tradelake.llm.common import ship_package
from tradelake.llm.pieces import MARK, Model
from tradelake.llm.shared import place
from tradelake.session import materialize, scratch_path

# Slots a task holds in memory at a time.
BLOCK = 1 << 25
# Ids of one side that are aligned at a time, and pairs that are made at a time.
RUN, PAIRS = 60_000, 1_000_000
# Distinct pairs a task remembers before it passes them on.
REMEMBERED = 1 << 22
RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class PieceCoder:
    """Ids of a SentencePiece model of merges and the bytes of each, with the merges run by tiktoken.

    tiktoken merges bytes, the model characters. So bytes are first merged into characters, by way of their beginnings,
    before any merge of the model; what stays a beginning is spelt in bytes, as the model does with characters it lacks.
    The model's merges follow in order of their scores. Only models that change nothing but spaces are supported; texts
    with spaces in a row go to the sentencepiece library.
    """

    def __init__(self, blob: bytes):
        import sentencepiece
        import tiktoken

        model = Model(blob)
        if not model.plain or model.first_byte is None:
            raise ValueError("only models with a space in front, bytes for unknown characters and no other changes are supported")
        longer = sorted((p for p in model.ids if len(p) > 1), key=lambda p: -model.scores[p])
        tied = [p for p, n in Counter(model.scores[p] for p in longer).items() if n > 1]
        if any(model.scores[p] in tied and MARK * 2 not in p for p in longer):
            raise ValueError("only models whose pieces have different scores, but for runs of spaces, are supported")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.size, self.pieces = len(model.names), model.surface
        characters = [p.encode() for p in model.ids if len(p) == 1]
        begun = {c[:n]: None for c in characters for n in range(2, len(c))}
        one = {bytes([x]): [model.ids.get(chr(x), model.first_byte + x) if x < 0x80 else model.first_byte + x] for x in range(256)}
        # In order of merging: single bytes, beginnings of characters, characters, pieces; each with its ids.
        spelt = {**one, **{c: [model.first_byte + x for x in c] for c in begun}}
        spelt |= {p.encode(): [i] for p, i in model.ids.items() if len(p) == 1} | {p.encode(): [model.ids[p]] for p in longer}
        order = list(spelt)
        self.coder = tiktoken.Encoding("pieces", pat_str=f"{MARK}+[^{MARK}\\n]*|[^{MARK}\\n]+|\\n", mergeable_ranks={p: i for i, p in enumerate(order)}, special_tokens={})
        self.count = np.array([len(spelt[p]) for p in order])
        self.first = np.cumsum(self.count) - self.count
        self.ids = np.array([i for p in order for i in spelt[p]], np.uint32)

    def encode(self, text: str) -> np.ndarray:
        text = MARK + text.replace(" ", MARK) if text else ""
        if MARK * 2 in text:  # pieces of such runs share a score, where the leftmost goes first
            return np.array(self.library.encode(text[1:]), np.uint32)
        found = self.coder.encode_to_numpy(text, disallowed_special=())
        n = self.count[found]
        if len(found) == n.sum():
            return self.ids[self.first[found]]
        return self.ids[np.repeat(self.first[found] - np.cumsum(n) + n, n) + np.arange(n.sum())]


_pieces: dict[bytes, PieceCoder] = {}


def pieces_of(blob: bytes) -> PieceCoder:
    key = hashlib.sha256(blob).digest()
    if key not in _pieces:
        _pieces[key] = PieceCoder(blob)
    return _pieces[key]


def encoded(docs: DataFrame, spec: str, model: bytes) -> DataFrame:
    """row, doc_id, a, b of every row: ids of both sides as little-endian 32-bit numbers, empty where they do not meet.

    Side a is made from a space and the text, side b from the text, before which its model puts the space. A text has
    no ids if it is null or empty, or if the bytes of either side are not those of the space and the text.
    """
    ship_package(docs.sparkSession)

    def encode(batches):
        import pyarrow as pa

        a, b = coder_of(spec), pieces_of(model)
        size_a, size_b = a.lengths(), np.array([len(p) for p in b.pieces])
        for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
            found = ([], [])
            for text in batch.column("text").to_pylist():
                ids = [np.zeros(0, np.uint32)] * 2
                if text:
                    whole = f" {text}"
                    raw, ids_a, ids_b = whole.encode(), a.encode(whole), b.encode(text)
                    # Both give every character as it is, but that b takes a space mark of the text for a space: lengths tell.
                    if size_a[ids_a].sum() == len(raw) == size_b[ids_b].sum():
                        ids = [ids_a, ids_b]
                for column, x in zip(found, ids, strict=True):
                    column.append(x.astype("<u4").tobytes())
            columns = [batch.column("row"), batch.column("doc_id"), *[pa.array(x, pa.binary()) for x in found]]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "a", "b"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    done = rows.mapInArrow(encode, f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, a binary, b binary")
    path = scratch_path(docs.sparkSession, "aligned-ids")
    done.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(done.schema).parquet(path)


class Aligner:
    """Groups and links of many documents at once; `size_a` and `size_b` are the bytes of each id."""

    def __init__(self, size_a: np.ndarray, size_b: np.ndarray):
        self.size_a, self.size_b = size_a, size_b
        self.width = np.uint64(len(size_b))

    def align(self, a: list[np.ndarray], b: list[np.ndarray]) -> "Aligned":
        return Aligned(self, a, b)


def _among(places: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the places are among the others; both rise, are at least 0 and have the same last one."""
    marked = np.zeros(int(others[-1]) + 1 if len(others) else 0, bool)
    marked[others] = True
    return marked[places]


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Each key once, in order. Keys that come sorted in large part are faster sorted than hashed, as `np.unique` does."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


class Aligned:
    def __init__(self, by: Aligner, a: list[np.ndarray], b: list[np.ndarray]):
        self.by, self.docs = by, len(a)
        self.a, self.b = np.concatenate(a).astype(np.int64), np.concatenate(b).astype(np.int64)
        # Both sides of a document have the same bytes, so ends can be counted through all documents.
        ends_a, ends_b = np.cumsum(by.size_a[self.a]), np.cumsum(by.size_b[self.b])
        both_a, both_b = _among(ends_a, ends_b), _among(ends_b, ends_a)
        self.ends = ends_a[both_a]
        self.group_a, self.group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b
        self.n_a, self.n_b = (np.bincount(g, minlength=len(self.ends)) for g in (self.group_a, self.group_b))
        of_a = np.repeat(np.arange(self.docs), [len(x) for x in a])
        last = np.cumsum(self.n_a) - 1
        self.doc = of_a[last] if len(last) else last

    def per_doc(self, of_group: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, of_group, self.docs).astype(np.int64)

    def pairs(self):
        """Blocks of document, key, a and times linked: each group once with each of its distinct pairs of ids."""
        alone = (self.n_a == 1) & (self.n_b == 1)
        if alone.any():  # most groups are one id on each side
            single_a, single_b = self.a[alone[self.group_a]], self.b[alone[self.group_b]]
            for low in range(0, len(single_a), PAIRS):
                some = single_a[low : low + PAIRS]
                key = some.astype(np.uint64) * self.by.width + single_b[low : low + PAIRS].astype(np.uint64)
                yield self.doc[alone][low : low + PAIRS], key, some, np.ones(len(some), np.int64)
        more_a, more_b = ~alone[self.group_a], ~alone[self.group_b]
        a, times_a = np.unique((self.group_a[more_a] << 32) | self.a[more_a], return_counts=True)
        b, times_b = np.unique((self.group_b[more_b] << 32) | self.b[more_b], return_counts=True)
        group, a, group_b, b = a >> 32, a & 0xFFFFFFFF, b >> 32, b & 0xFFFFFFFF
        first_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=len(self.ends)))])
        partners = np.diff(first_b)[group]
        upto = np.cumsum(partners)
        low = 0
        while low < len(a):
            high = max(int(np.searchsorted(upto, upto[low] - partners[low] + PAIRS, "right")), low + 1)
            n = partners[low:high]
            of = np.repeat(np.arange(low, high), n)
            to = first_b[group[of]] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            key = a[of].astype(np.uint64) * self.by.width + b[to].astype(np.uint64)
            yield self.doc[group[of]], key, a[of], times_a[of] * times_b[to]
            low = high

    def pairs_of_documents(self) -> np.ndarray:
        """The key of every distinct pair of every document."""
        bits = (len(self.by.size_a) * int(self.by.width)).bit_length()
        if self.docs.bit_length() + bits > 63:
            raise ValueError("too many documents at a time")
        found = [_distinct((doc.astype(np.uint64) << np.uint64(bits)) | key) for doc, key, _, _ in self.pairs()]
        return (_distinct(np.concatenate(found)) if len(found) > 1 else found[0]) & np.uint64(2**bits - 1) if found else np.zeros(0, np.uint64)

    def digests(self, names) -> list[str]:
        """SHA-256 of each document's groups as text, and nothing for a document without ids. `names` come from `_names`."""
        last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else g.astype(bool) for g in (self.group_a, self.group_b))
        end = np.append(self.doc[1:] != self.doc[:-1], True)[self.group_b] if len(self.doc) else last_b
        line = np.empty(len(self.a) + len(self.b), np.int64)
        before_a, before_b = np.cumsum(self.n_a), np.cumsum(self.n_b) - self.n_b
        line[np.arange(len(self.a)) + before_b[self.group_a]] = self.a * 2 + last_a
        line[np.arange(len(self.b)) + before_a[self.group_b]] = 2 * len(self.by.size_a) + self.b * 3 + last_b + (last_b & end)
        at, out = 0, []
        for n in self.per_doc(self.n_a + self.n_b).tolist():
            sha = hashlib.sha256()
            for low in range(at, at + n, PAIRS):  # the bytes of these names lie one after another
                some = names.take(line[low : min(low + PAIRS, at + n)])
                first, last = np.frombuffer(some.buffers()[1], np.int32)[[0, len(some)]]
                sha.update(memoryview(some.buffers()[2])[first:last])
            out.append(sha.hexdigest() if n else "")
            at += n
        return out


def _names(size_a: int, size_b: int):
    """Each id with what follows it in the text of groups: of a `,` or `|`; of b `,` or `;` or nothing. An Arrow array."""
    import pyarrow as pa

    return pa.array([f"{i}{x}" for i in range(size_a) for x in ",|"] + [f"{i}{x}" for i in range(size_b) for x in (",", ";", "")], pa.string())


def _runs(batches, aligner: Aligner):
    """Record batches cut into runs of documents with about RUN ids, aligned."""
    for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
        columns = [[np.frombuffer(x, "<u4") for x in batch.column(c).to_pylist()] for c in "ab"]
        upto, first = np.cumsum([len(x) for x in columns[0]]), 0
        while first < batch.num_rows:
            done = upto[first - 1] if first else 0
            last = max(int(np.searchsorted(upto, done + RUN, "right")), first + 1)
            yield batch.slice(first, last - first), aligner.align(*[c[first:last] for c in columns])
            first = last


def _batch(schema: str, columns: list):
    """A record batch of columns, either arrays already or values of the simple type that `schema` names."""
    import pyarrow as pa

    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split(" ") for f in schema.split(", ")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=types[t]) for c, (_, t) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _by_shard(keys: np.ndarray):
    """Shard and keys of every shard that has some."""
    shard = perfecthash.shard_of(keys)
    order = np.argsort(shard, kind="stable")
    keys, shard = keys[order], shard[order]
    starts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else shard
    return [(int(shard[i]), part) for i, part in zip(starts, np.split(keys, starts[1:]) if len(keys) else [], strict=True)]


SHARD = "shard int, sizes binary, words binary, keys binary"


def hashed_pairs(rows: DataFrame, aligner: Aligner) -> DataFrame:
    """The perfect hash of all distinct pairs, a row per shard. A shard's keys are merged as they come."""

    def distinct(batches):
        seen, size = [], 0

        def passed_on():
            found = _by_shard(np.unique(np.concatenate(seen)))
            return _batch("shard int, keys binary", [[s for s, _ in found], [k.astype("<u8").tobytes() for _, k in found]])

        for _, run in _runs(batches, aligner):
            for _, key, _, _ in run.pairs():
                seen.append(_distinct(key))
                size += len(seen[-1])
            if size > REMEMBERED:
                seen = [np.unique(np.concatenate(seen))]
                size = len(seen[0])
                if size > REMEMBERED // 2:
                    yield passed_on()
                    seen, size = [], 0
        if seen:
            yield passed_on()

    def build(batches):
        shard, parts, size, merged = None, [], 0, 0

        def hashed():
            return _batch(SHARD, [[shard], *[[x.tobytes()] for x in perfecthash.build(np.unique(np.concatenate(parts)))]])

        for batch in batches:
            for s, raw in zip(batch.column("shard").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                if s != shard:
                    if parts:
                        yield hashed()
                    shard, parts, size, merged = s, [], 0, 0
                parts.append(np.frombuffer(raw, "<u8"))
                size += len(parts[-1])
                if size > 2 * merged + REMEMBERED:
                    parts = [np.unique(np.concatenate(parts))]
                    size = merged = len(parts[0])
        if parts:
            yield hashed()

    found = rows.select("a", "b").mapInArrow(distinct, "shard int, keys binary")
    return materialize(found.repartition("shard").sortWithinPartitions("shard").mapInArrow(build, SHARD), "pair-hash")


def _load(path: str, first: int, last: int) -> tuple[perfecthash.Table, np.ndarray, np.ndarray | None]:
    """The shards first to before last: hash table, where the slots of each begin, and counts by slot if there are any."""
    from pyarrow import parquet

    system, root = place(path)
    found = parquet.read_table(root, filesystem=system, filters=[("shard", ">=", first), ("shard", "<", last)]).to_pylist()
    of = {r["shard"]: r for r in found}
    none = {"sizes": b"", "words": b"", "keys": b"", "counts": b""}
    ordered = [of.get(s, none) for s in range(first, last)]
    read = [[np.frombuffer(r[c], t) for c, t in (("sizes", "<u4"), ("words", "<u8"), ("keys", "<u8"))] for r in ordered]
    begins = np.concatenate([[0], np.cumsum([len(keys) for _, _, keys in read])])
    counts = np.concatenate([np.frombuffer(r["counts"], "<u8") for r in ordered]) if found and "counts" in found[0] else None
    return perfecthash.Table(read, first), begins, counts


def _path(df: DataFrame) -> str | None:
    files = df.inputFiles()
    return files[0].rpartition("/")[0] if files else None


def _blocks(hashed: DataFrame, block: int) -> list[tuple[int, int]]:
    """Ranges of shards that hold about `block` slots or less; shards are of even size, being dealt by hash."""
    slots = hashed.agg(F.sum(F.length("keys") / 8)).first()[0] or 0
    n = min(max(-(-int(slots) // block), 1), perfecthash.SHARDS)
    edges = [perfecthash.SHARDS * i // n for i in range(n + 1)]
    return list(zip(edges, edges[1:], strict=False))


def counted_pairs(rows: DataFrame, hashed: DataFrame, aligner: Aligner, block: int = BLOCK, fan_in: int = 16) -> DataFrame:
    """The hash with counts by slot: in how many documents each pair is linked."""
    path = _path(hashed)

    def count(first: int, last: int):
        def run(batches):
            from pyspark import TaskContext

            table, begins, _ = _load(path, first, last)
            counts, part = np.zeros(len(table.keys), np.uint32), TaskContext.get().partitionId()
            for _, aligned in _runs(batches, aligner):
                keys, times = np.unique(aligned.pairs_of_documents(), return_counts=True)
                mine, slots = table.look_up(keys)
                counts[slots] += times[mine].astype(np.uint32)
            for i in range(0, last - first, 64):
                some = range(i, min(i + 64, last - first))
                yield _batch("shard int, part int, counts binary", [[first + s for s in some], [part] * len(some), [counts[begins[s] : begins[s + 1]].astype("<u8").tobytes() for s in some]])

        return run

    def add_up(batches):
        key, total = None, None
        for batch in batches:
            for s, p, raw in zip(*[batch.column(c).to_pylist() for c in ("shard", "part", "counts")], strict=True):
                if key == (s, p):
                    total += np.frombuffer(raw, "<u8")
                    continue
                if key:
                    yield _batch("shard int, part int, counts binary", [[key[0]], [key[1]], [total.tobytes()]])
                key, total = (s, p), np.frombuffer(raw, "<u8").copy()
        if key:
            yield _batch("shard int, part int, counts binary", [[key[0]], [key[1]], [total.tobytes()]])

    blocks = _blocks(hashed, block)
    vectors = reduce(DataFrame.union, [rows.select("a", "b").mapInArrow(count(*b), "shard int, part int, counts binary") for b in blocks])
    parts = vectors.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // fan_in)
        grouped = vectors.withColumn("part", F.expr(f"part div {fan_in}").cast("int"))
        vectors = grouped.repartition("shard", "part").sortWithinPartitions("shard", "part").mapInArrow(add_up, "shard int, part int, counts binary")
    return materialize(hashed.join(vectors.drop("part"), "shard"), "pair-counts")


def most_of_each(counted: DataFrame, aligner: Aligner) -> np.ndarray:
    """The highest count of each id of side a; the result is as long as its vocabulary."""
    width = int(aligner.width)

    def most(batches):
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                a, counts = (np.frombuffer(keys, "<u8") // np.uint64(width)).astype(np.int64), np.frombuffer(counts, "<u8").astype(np.int64)
                best = np.zeros(len(aligner.size_a), np.int64)
                np.maximum.at(best, a, counts)
                yield _batch("a long, most long", [np.flatnonzero(best), best[best > 0]])

    out = np.zeros(len(aligner.size_a), np.int64)
    for r in counted.select("keys", "counts").mapInArrow(most, "a long, most long").groupBy("a").agg(F.max("most").alias("most")).collect():
        out[r.a] = r.most
    return out


def align(docs: DataFrame, spec: str, model: bytes, block: int = BLOCK) -> DataFrame:
    """doc_id and the figures of RESULT of every row of `docs`.

    Texts without ids (null, empty, or where a side does not give the bytes of the text) have zeros and an empty digest;
    they link nothing. Rows that share an id are rows of their own, repeated rows count as often as they occur. Other
    columns are left out; an empty table gives an empty one. A text is aligned whole; of its links only distinct ones of a
    group are made, in blocks, so that a long stretch without a common end does not hold all its occurrences in memory.
    """
    pieces = pieces_of(model)
    aligner = Aligner(ByteCoder(spec).lengths(), np.array([len(p) for p in pieces.pieces]))
    rows = encoded(docs, spec, model)
    hashed = hashed_pairs(rows, aligner)
    counted = counted_pairs(rows, hashed, aligner, block)
    best, path = most_of_each(counted, aligner), _path(counted)
    out = f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, {RESULT}"

    def look_up(first: int, last: int):
        def run(batches):
            table, _, counts = _load(path, first, last)
            counts = np.zeros(0, np.int64) if counts is None else counts.astype(np.int64)
            names = _names(len(aligner.size_a), len(aligner.size_b))
            for batch, run in _runs(batches, aligner):
                n_best, count_sum = np.zeros(run.docs, np.int64), np.zeros(run.docs, np.int64)
                for doc, key, a, times in run.pairs():
                    mine, slots = table.look_up(key)
                    doc, times, count = doc[mine], times[mine], counts[slots]
                    count_sum += np.bincount(doc, times * count, run.docs).astype(np.int64)
                    n_best += np.bincount(doc, times * (count == best[a[mine]]), run.docs).astype(np.int64)
                # What does not depend on counts is told by the first block alone.
                told = [run.per_doc(run.n_a), run.per_doc(run.n_b), np.bincount(run.doc, minlength=run.docs), run.per_doc(run.n_a * run.n_b)]
                told = told if not first else [np.zeros(run.docs, np.int64)] * 4
                digests = run.digests(names) if not first else [""] * run.docs
                yield _batch(out, [batch.column("row"), batch.column("doc_id"), *told, n_best, count_sum, digests])

        return run

    passes = [rows.mapInArrow(look_up(*b), out) for b in _blocks(counted, block)]
    if len(passes) == 1:
        return passes[0].drop("row")
    sums = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    whole = reduce(DataFrame.union, passes).groupBy("row").agg(F.first("doc_id").alias("doc_id"), *sums, F.max("groups_sha256").alias("groups_sha256"))
    return whole.drop("row")
