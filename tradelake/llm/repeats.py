"""Removal of repeated byte strings with sampled suffixes and induced sorting.

Every byte covered by a string of `SPAN` bytes that also starts somewhere else, in the same document or another, is
removed. Sorting all suffixes is not needed for that:

1. Sampling. Each stretch of SPAN bytes owns an anchor, the stretch's k-gram with the smallest hash, the rightmost
   among equals. Equal stretches own equal anchors at equal distances. Stretches that follow each other and share an
   anchor form a run; only runs whose anchor k-gram occurs twice or more can hold a repeat. The rest, nearly all of a
   corpus, is dropped after one count.
2. Runs that are equal as a whole are repeats as they are.
3. Of each set of equal runs one is sorted among the runs of its anchor: first the suffixes that start at the
   anchors, with the lengths of the prefixes that neighbours have in common; then, byte by byte to the left, the order
   and common prefixes of the suffixes one byte longer are induced from those before. A stretch whose suffix has
   SPAN bytes in common with a neighbour is a repeat.
4. An anchor with more than GROUP different runs is not brought into one task. Its runs are cut into pieces of PIECE
   stretches, and pieces are dealt by the bytes that all stretches of a piece have, so equal stretches meet again. Pieces
   that are equal byte by byte are repeats as they are, and one of each is sorted as in 3. Where more than GROUP different
   pieces have these bytes in common, single stretches are compared byte by byte.

Sorted runs and counts go through Spark's shuffles and sorts, which spill to disk; a task holds the runs of a few
anchors at a time.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tradelake.llm.common import MIN_LONG, drop, free_name, ship_package, stage
from tradelake.llm.hashing import Prefix

SPAN = 200
GRAM = 64
WIDTH = SPAN - GRAM + 1  # k-grams of a stretch
GROUP = 1024
PIECE = 8
# Stretches handled at once, in finding runs; a longer text is read in segments that overlap by SPAN bytes.
SEGMENT = 1 << 19
# Rows handled at once in induced sorting, if the groups allow it.
ROWS = 20_000
_PLACE = np.uint64((1 << 20) - 1)


def find_runs(raw: bytes) -> tuple[np.ndarray, ...]:
    """first, last (starts of the first and last stretch), anchor, key (hash of the anchor k-gram), whole (hash of the run)."""
    found = []
    data = np.frombuffer(raw, np.uint8)
    for begin in range(0, len(raw) - SPAN + 1, SEGMENT):
        part = data[begin : begin + SEGMENT + SPAN - 1]
        prefix = Prefix(part)
        grams = prefix.windows(GRAM)
        # High bits order by hash, low bits prefer the rightmost of equals.
        order = (grams & ~_PLACE) | (_PLACE - np.arange(len(grams), dtype=np.uint64))
        blocks = -(-len(order) // WIDTH)
        square = np.full(blocks * WIDTH, np.uint64(2**64 - 1))
        square[: len(order)] = order
        square = square.reshape(blocks, WIDTH)
        before = np.minimum.accumulate(square, axis=1).ravel()
        after = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(part) - SPAN + 1
        least = np.minimum(after[:n], before[WIDTH - 1 : WIDTH - 1 + n])
        at = (_PLACE - (least & _PLACE)).astype(np.int64)
        edges = np.flatnonzero(np.diff(at)) + 1
        first = np.concatenate([[0], edges])
        last = np.concatenate([edges, [n]]) - 1
        anchor = at[first]
        found.append((first + begin, last + begin, anchor + begin, grams[anchor].view(np.int64), prefix.of(first, last + SPAN).view(np.int64)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def induced_repeats(group: np.ndarray, left: list[bytes], right: list[bytes], nearest: np.ndarray) -> list[tuple[int, int]]:
    """(row, distance) of every stretch that is a repeat: it starts `distance` bytes before the anchor of `row`.

    Rows of one group share an anchor. `left` holds the bytes from the run's first start to the anchor, `right` those
    from the anchor on, `nearest` the distance of the run's last start.
    """
    n = len(group)
    farthest = np.array([len(x) for x in left], np.int64)
    have = np.array([len(x) for x in right], np.int64)
    after = np.frombuffer(b"".join([x.ljust(SPAN, b"\0")[:SPAN] for x in right]), np.uint8).reshape(n, SPAN)
    have = np.minimum(have, SPAN)
    deep = int(farthest.max(initial=0))
    back = np.zeros((deep, n), np.uint8)
    for i, x in enumerate(left):
        back[: len(x), i] = np.frombuffer(x, np.uint8)[::-1]
    order = np.argsort(have, kind="stable")  # a suffix that ends comes before one that goes on with zeros
    order = order[np.argsort(after.view(f"S{SPAN}").ravel()[order], kind="stable")]
    order = order[np.argsort(group[order], kind="stable")]
    # Bytes in common of each row with the one before it in order; -1 across groups.
    differ = np.concatenate([after[order[1:]] != after[order[:-1]], np.ones((max(n - 1, 0), 1), bool)], axis=1)
    common = np.minimum(differ.argmax(1), np.minimum(have[order[1:]], have[order[:-1]]))
    common = np.concatenate([[-1], np.where(group[order[1:]] == group[order[:-1]], common, -1)])
    hits = []

    def note(distance: int) -> None:
        near = np.maximum(common, np.append(common[1:], -1))
        for row in order[(near >= SPAN) & (nearest[order] <= distance)]:
            hits.append((int(row), distance))

    note(0)
    for distance in range(1, deep + 1):
        kept = np.flatnonzero(farthest[order] >= distance)
        if not len(kept):
            break
        byte = back[distance - 1, order[kept]]
        by = kept[np.argsort(group[order[kept]].astype(np.int64) * 256 + byte, kind="stable")]
        rows = order[by]
        same = (group[rows[1:]] == group[rows[:-1]]) & (back[distance - 1, rows[1:]] == back[distance - 1, rows[:-1]])
        new = np.full(len(rows), -1, np.int64)
        if same.any():
            # Neighbours now were apart before: what they had in common is the least of all steps between them.
            pairs = np.flatnonzero(same)
            cuts = np.stack([by[pairs] + 1, by[pairs + 1] + 1], 1).ravel()
            least = np.minimum.reduceat(np.append(common, -1), cuts)[::2]
            new[pairs + 1] = np.where(least >= 0, least + 1, -1)
        order, common = rows, new
        note(distance)
    return hits


def _merge(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends, strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


KEY = "id long, text_key long"
RUN = "first int, last int, anchor int, key long, whole long"


def keyed(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """`docs` with two more columns, which together name a text, and their names, which are new to `docs`."""
    key_id, key = free_name(docs, "_id"), free_name(docs, "_text_key")
    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(MIN_LONG))
    return docs.withColumns({key_id: known, key: F.xxhash64("doc_id", "text")}), key_id, key


def _bodies(docs: DataFrame, key_id: str, key: str) -> DataFrame:
    return docs.select(F.col(key_id).alias("id"), F.col(key).alias("text_key"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))


def runs(bodies: DataFrame) -> DataFrame:
    """All runs of all texts."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            columns = [[] for _ in range(7)]
            for i, t, raw in zip(*[b.column(c).to_pylist() for c in ("id", "text_key", "raw")], strict=True):
                found = find_runs(raw)
                n = len(found[0])
                for column, values in zip(columns, (np.full(n, i), np.full(n, t), *found), strict=True):
                    column.append(values)
            kinds = [np.int64] * 2 + [np.int32] * 3 + [np.int64] * 2
            arrays = [pa.array(np.concatenate(c).astype(k) if c else np.zeros(0, k)) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "text_key", "first", "last", "anchor", "key", "whole"])

    return bodies.mapInArrow(run, f"{KEY}, {RUN}")


def sorted_repeats(cases: DataFrame) -> DataFrame:
    """Repeats found by induced sorting, as (id, text_key, start, stop), from rows with the bytes of their runs."""

    def find(table, pa):
        key = table.column("key").to_numpy()
        group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        first, last, anchor = (table.column(c).to_numpy().astype(np.int64) for c in ("first", "last", "anchor"))
        raw = table.column("bytes").to_pylist()
        left = [x[: a - f] for x, a, f in zip(raw, anchor, first, strict=True)]
        right = [x[a - f :] for x, a, f in zip(raw, anchor, first, strict=True)]
        hits = np.array(induced_repeats(group, left, right, anchor - last), np.int64).reshape(-1, 2)
        hits = hits[np.asarray(table.column("copies").to_numpy() == 1)[hits[:, 0]]]
        # Consecutive distances of a row are one interval.
        hits = hits[np.lexsort((hits[:, 1], hits[:, 0]))]
        cut = np.flatnonzero((np.diff(hits[:, 0]) != 0) | (np.diff(hits[:, 1]) != 1))
        top, low = np.concatenate([cut, [len(hits) - 1]]), np.concatenate([[0], cut + 1])
        if not len(hits):
            top = low = np.zeros(0, np.int64)
        rows = hits[low, 0]
        start, stop = anchor[rows] - hits[top, 1], anchor[rows] - hits[low, 1] + SPAN
        return pa.RecordBatch.from_arrays(
            [*[pa.array(table.column(c).to_numpy()[rows]) for c in ("id", "text_key")], pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))],
            names=["id", "text_key", "start", "stop"],
        )

    def run(batches):
        import pyarrow as pa

        held, n = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            n += b.num_rows
            if n < ROWS:
                continue
            # All whole groups; the last group may go on in the next batch.
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column("key").to_numpy()
            whole = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
            if whole:
                yield find(table.slice(0, whole).combine_chunks(), pa)
            rest = table.slice(whole)
            held, n = rest.to_batches(), rest.num_rows
        if held:
            yield find(pa.Table.from_batches(held).combine_chunks(), pa)

    return cases.sortWithinPartitions("key").mapInArrow(run, f"{KEY}, start int, stop int")


def pieces(cases: DataFrame, width: int) -> DataFrame:
    """The runs of `cases` in pieces of up to `width` stretches, dealt to new groups by the bytes their stretches share.

    Stretches at the same distance from equal anchors are in pieces of the same bounds, so all that are equal are in one
    new group. A piece has its last possible stretch as its anchor. Groups with equal keys by chance do no harm, as
    whoever reads a group compares bytes.
    """

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            wanted = ("id", "text_key", "first", "last", "anchor", "key", "copies", "bytes")
            for i, t, first, last, anchor, key, copies, raw in zip(*[b.column(c).to_pylist() for c in wanted], strict=True):
                for part in range((anchor - last) // width, (anchor - first) // width + 1):
                    at = anchor - part * width  # of the piece's last possible stretch
                    lo, hi = max(first, at - width + 1), min(last, at)
                    shared = raw[at - first : at - width + 1 - first + SPAN]
                    group = hashlib.blake2b(shared, digest_size=8, salt=(key & 2**64 - 1).to_bytes(8, "little"), person=part.to_bytes(8, "little"))
                    out.append((i, t, lo, hi, at, int.from_bytes(group.digest(), "little", signed=True), copies, raw[lo - first : hi - first + SPAN]))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(wanted))

    return cases.mapInArrow(run, f"{KEY}, first int, last int, anchor int, key long, copies long, bytes binary")


def _different(distinct: DataFrame) -> DataFrame:
    """Rows of groups that have several, with their number as `different`."""
    sizes = stage(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("different")).where("different > 1"), "different")
    return distinct.join(sizes, "key")


def divided_repeats(cases: DataFrame) -> list[DataFrame]:
    """Repeats among the runs of anchors that have too many for one task, as tables of (id, text_key, start, stop)."""
    found = []
    for width in (PIECE, 1):
        if cases.isEmpty():
            break
        each = stage(pieces(cases, width), "pieces")
        place = F.struct("id", "text_key", "first", "last", "anchor")
        distinct = each.groupBy("key", "bytes").agg(F.sum("copies").alias("copies"), F.min(place).alias("at"))
        distinct = stage(distinct.select("key", "bytes", "copies", "at.*"), "distinct-pieces")
        twice = distinct.where("copies > 1").select("key", "bytes")
        equal = each.where("copies = 1").join(twice, ["key", "bytes"])
        found.append(stage(equal.select("id", "text_key", F.col("first").alias("start"), (F.col("last") + SPAN).alias("stop")), "equal-pieces"))
        drop(each)
        if width > 1:
            open_groups = _different(distinct)
            found.append(stage(sorted_repeats(open_groups.where(F.col("different") <= GROUP).repartition("key")), "sorted-pieces"))
            cases = stage(open_groups.where(F.col("different") > GROUP), "large-groups")
        drop(distinct)
    return found


def repeat_spans(bodies: DataFrame) -> DataFrame:
    """(id, text_key, start, stop): stretches of bytes to remove; they may overlap."""
    ship_package(bodies.sparkSession)
    every = stage(runs(bodies), "runs")
    # Tables that are joined on a key that may be hot are written first: only then can the join split that key.
    often = stage(every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "often")
    repeated = stage(every.join(often, "key"), "repeated-runs")
    drop(every)
    place = F.struct("id", "text_key", "first", "last", "anchor")
    distinct = stage(repeated.groupBy("key", "whole").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("at")), "distinct-runs")
    whole = repeated.join(distinct.where("copies > 1").select("key", "whole"), ["key", "whole"])
    whole = stage(whole.select("id", "text_key", F.col("first").alias("start"), (F.col("last") + SPAN).alias("stop")), "equal-runs")
    drop(repeated)
    cases = _different(distinct).select("key", "copies", "different", "at.*")
    wanted = cases.groupBy("id", "text_key").agg(F.collect_list(F.struct("key", "copies", "different", "first", "last", "anchor")).alias("cases"))
    cut = wanted.join(bodies, ["id", "text_key"]).dropDuplicates(["id", "text_key"]).select("id", "text_key", "raw", F.explode("cases").alias("c"))
    cut = cut.select("id", "text_key", "c.*", F.substring("raw", F.col("c.first") + 1, F.col("c.last") - F.col("c.first") + SPAN).alias("bytes"))
    cut = stage(cut, "run-bytes")
    drop(distinct)
    some = stage(sorted_repeats(cut.where(F.col("different") <= GROUP).repartition("key")), "sorted-repeats")
    more = divided_repeats(cut.where(F.col("different") > GROUP))
    drop(cut)
    return reduce(DataFrame.union, [whole, some, *more])


def remove_repeats(docs: DataFrame, replace: bool = True) -> tuple[DataFrame, str]:
    """All rows of `docs` with one more struct column, and its name: n_bytes, n_removed, n_spans, kept_sha256.

    With `replace`, text becomes what is left, without code points that lost some of their bytes, and n_chars, if there
    is such a column, its length. Texts below SPAN bytes, empty and null texts stay as they are (null as null). A
    repeated row counts as a second place of each of its strings, so rows of SPAN bytes or more that occur twice lose
    everything. Strings that overlap themselves count as two places.
    """
    named, key_id, key = keyed(docs)
    spans = repeat_spans(_bodies(named, key_id, key))
    found_spans, name = free_name(docs, "_spans"), free_name(docs, "_removed")
    lists = spans.groupBy(F.col("id").alias(key_id), F.col("text_key").alias(key)).agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias(found_spans)
    )
    joined = named.join(lists, [key_id, key], "left").select(*docs.columns, found_spans)
    added = StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    out = StructType([*docs.schema.fields, StructField(name, added)])
    sized = replace and "n_chars" in docs.columns

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

        for b in batches:
            texts, infos = [], []
            for text, spans in zip(b.column("text").to_pylist(), b.column(found_spans).to_pylist(), strict=True):
                raw, at, kept = (text or "").encode(), 0, []
                found = _merge([s["start"] for s in spans], [s["stop"] for s in spans]) if spans else []
                for start, stop in found:
                    kept.append(raw[at:start])
                    at = stop
                left = b"".join(kept) + raw[at:]
                infos.append((len(raw), len(raw) - len(left), len(found), hashlib.sha256(left).hexdigest()))
                texts.append(text if not found else left.decode(errors="ignore"))
            columns = {c: b.column(c) for c in docs_columns}
            if replace:
                columns["text"] = pa.array(texts, columns["text"].type)
            if sized:
                fresh = pa.array([None if t is None else len(t) for t in texts]).cast(columns["n_chars"].type)
                columns["n_chars"] = fresh
            struct = pa.StructArray.from_arrays(
                [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(zip(*infos, strict=True), added.fields, strict=True)]
                if infos else [pa.array([], to_arrow_type(f.dataType)) for f in added.fields],
                names=added.fieldNames(),
            )
            yield pa.RecordBatch.from_arrays([*columns.values(), struct], schema=to_arrow_schema(out))

    docs_columns = docs.columns
    return joined.mapInArrow(run, out), name
