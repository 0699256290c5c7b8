"""Repair of conversation structure: the cheapest edits that make the turns of every conversation legal.

Rows are range-sorted by conversation and turn and cut into chunks of at most CHUNK rows, so that one conversation may
be spread over many tasks. A chunk is summed up as a function on the cost vectors of `fourrussians`, found by table
look-ups per block of rows. The functions of a conversation's chunks, small rows, are then applied from its last chunk
to its first; the edits of each chunk are traced from every state it may be entered in, all chunks at once; and one
pass in order picks the trace that fits, rebuilds the turns and hashes them. That pass streams: of a conversation it
holds a chunk's edits, a row and running sums (and the audit, which is its result).
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tradelake.llm.common import ship_package
from tradelake.llm.fourrussians import AFTER, INITIALS, NEEDED, ROLES, START, tables
from tradelake.session import materialize

CHUNK_BITS = 12
# White space that does not count as text, and the marks a sentence may end with.
WHITE, ENDS = " \t\n\x0b\x0c\r", "[.!?]"
TRACE = "symbols string, blank long, duplicate long, truncated long, cost long, last boolean, exits string, edits array<string>"
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damage(rows: DataFrame) -> DataFrame:
    """Rows with faults put in, by a hash of conversation and turn; a null is one space.

    Of 20 hash values 0 drops the row, 1 empties its text, 2 removes its sentence marks, 3 repeats it, 4 makes it the
    user's. Rows that agree in conversation and turn share their fault.
    """
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.encode(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")), "UTF-8")) % 20
    text = or_space("text")
    return rows.where(fault != 0).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(or_space("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, ENDS, "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def _symbol(blank: Column, duplicate: Column, truncated: Column) -> Column:
    """A digit for what the tables know of a row."""
    kind = F.lit(len(INITIALS))
    for i, initial in enumerate(INITIALS):
        kind = F.when(F.col("initial") == initial, i).otherwise(kind)
    return F.when(blank | duplicate, "8").otherwise((kind * 2 + truncated.cast("int")).cast("string"))


def _chunks(rows: DataFrame) -> DataFrame:
    """conv_id, chunk, symbols of its rows in order, and how many rows have each fault.

    A row repeats another if its conversation has the same role and text earlier; the earliest are found by grouping and
    joined by position, which no two rows share, so that a text that very many rows have is nobody's burden.
    """
    text = F.rtrim(F.col("text"), F.lit(WHITE))
    marked = rows.select(
        "conv_id", "pos", F.substring("role", 1, 1).alias("initial"), (text == "").alias("blank"),
        (~F.substring(text, -1, 1).rlike(ENDS)).alias("cut"), "role", F.sha2(F.col("text"), 256).alias("hash"),
    )
    firsts = marked.where(~F.col("blank")).groupBy("conv_id", "role", "hash").agg(F.min("pos").alias("first")).select("first")
    joined = marked.drop("role", "hash").join(firsts, F.col("pos") == F.col("first"), "left")
    blank = F.col("blank")
    duplicate = ~blank & F.col("first").isNull()
    truncated = ~blank & ~duplicate & F.col("cut")
    faults = {"blank": blank, "duplicate": duplicate, "truncated": truncated}
    digits = F.sort_array(F.collect_list(F.struct("pos", _symbol(blank, duplicate, truncated).alias("digit"))))
    return joined.groupBy("conv_id", F.shiftright("pos", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.transform(digits, lambda d: d.digit), "").alias("symbols"), *[F.count_if(c).alias(n) for n, c in faults.items()]
    )


def _digits(symbols: str) -> np.ndarray:
    return np.frombuffer(symbols.encode(), np.uint8).astype(np.int64) - ord("0")


def _traced(chunks: DataFrame) -> DataFrame:
    """Every chunk with the cost from its start on, and its edits and exit for each state it may be entered in."""
    ship_package(chunks.sparkSession)

    def folded(batches):
        import pyarrow as pa

        for b in batches:
            found = [tables().fold(_digits(s)) for s in b.column("symbols").to_pylist()]
            arrays = [pa.array([x[i].tolist() for x in found], pa.list_(pa.int64())) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*b.columns, *arrays], names=[*b.schema.names, "before", "off"])

    def carried(batches):
        """From the last chunk of a conversation to its first: the vector at each chunk's end, and the cost so far."""
        import pyarrow as pa

        conversation, vector, off = object(), 0, 0
        for b in batches:
            ends, costs, lasts = [], [], []
            for conv, to, taken in zip(*[b.column(c).to_pylist() for c in ("conv_id", "before", "off")], strict=True):
                lasts.append(conv != conversation)
                if conv != conversation:
                    conversation, vector, off = conv, 0, 0
                ends.append(vector)
                vector, off = to[vector], off + taken[vector]
                costs.append(off + tables().vectors[vector][START])
            kept = [c for c in b.schema.names if c not in ("before", "off")]
            arrays = [pa.array(ends, pa.int32()), pa.array(costs, pa.int64()), pa.array(lasts, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *arrays], names=[*kept, "end", "cost", "last"])

    def traced(batches):
        import pyarrow as pa

        for b in batches:
            rows = zip(*[b.column(c).to_pylist() for c in ("symbols", "end", "last")], strict=True)
            found = [[tables().trace(_digits(s), q, end, last) for q in range(4)] for s, end, last in rows]
            exits = pa.array(["".join(str(q) for q, _ in each) for each in found], pa.string())
            edits = pa.array([[e for _, e in each] for each in found], pa.list_(pa.string()))
            kept = [c for c in b.schema.names if c != "end"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], exits, edits], names=[*kept, "exits", "edits"])

    key = f"conv_id {chunks.schema['conv_id'].dataType.simpleString()}, chunk long"
    base = f"{key}, symbols string, blank long, duplicate long, truncated long"
    functions = chunks.mapInArrow(folded, f"{base}, before array<long>, off array<long>")
    backwards = functions.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk"))
    ended = backwards.mapInArrow(carried, f"{base}, end int, cost long, last boolean")
    return ended.repartition("conv_id", "chunk").mapInArrow(traced, f"{key}, {TRACE}")


class _Conversation:
    """Running sums of one conversation, fed in order: chunks, and each chunk's rows after it."""

    def __init__(self):
        self.hash, self.lines, self.audit, self.state = hashlib.sha256(), 0, [], START
        self.cost, self.faults, self.illegal, self.before = None, [0, 0, 0], 0, None
        self.least = self.most = self.turn = None
        self.turns, self.edits, self.at = 0, "", 0

    def _say(self, role: str, text: str) -> None:
        self.hash.update(f"\n{role}:{text}".encode() if self.lines else f"{role}:{text}".encode())
        self.lines += 1

    def _inserts(self) -> None:
        while self.edits[self.at : self.at + 1] == "I":
            needed = NEEDED[self.state]
            self._say(ROLES[needed], "")
            self.state, self.at = AFTER[self.state][needed], self.at + 1

    def chunk(self, cost: int, faults: tuple[int, int, int], edits: list[str]) -> None:
        self.cost = cost if self.cost is None else self.cost
        self.faults = [a + b for a, b in zip(self.faults, faults, strict=True)]
        self.edits, self.at = edits[self.state], 0
        self.audit.append(self.edits)

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.turn:
            self.least, self.most = turn if self.least is None else self.least, turn
            self.turn, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self._inserts()
        edit, self.at = self.edits[self.at], self.at + 1
        if edit != "D":
            initial, role = (initial, role) if edit == "K" else (NEEDED[self.state], ROLES[NEEDED[self.state]])
            self._say(role, text)
            self.state = AFTER[self.state][initial]

    def result(self) -> tuple:
        self._inserts()
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return (gaps, *self.faults, self.illegal, self.cost or 0, "".join(self.audit), self.hash.hexdigest())


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id and the figures of RESULT for every conv_id of `conversations`, from its damaged `rows`.

    Rows are taken by turn, rows without a turn first; rows of one turn by role, then by the first letters and a hash of
    their text, so that a repeated row stays beside its original. A null role or text is one space, a null conv_id a
    conversation of its own. A conversation without rows has zeros, an empty audit and the hash of nothing; an empty
    table has no conversations. Roles count by their first letter. Other columns are left out.
    """
    known = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    begin, mixed = F.substring("text", 1, 64), F.xxhash64("text")
    by = ["conv_id", F.col("turn").asc_nulls_first(), "role", begin, mixed]
    placed = known.withColumn("_any", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*by, "_any")
    ordered = placed.sortWithinPartitions(*by, "text").drop("_any").withColumn("pos", F.monotonically_increasing_id())
    ordered = materialize(ordered, "conversation-rows")
    chunks = _traced(materialize(_chunks(ordered), "conversation-chunks"))
    listed = conversations.select("conv_id").union(rows.select("conv_id")).distinct().withColumn("tag", F.lit(0))
    chunks = chunks.withColumn("tag", F.lit(1))
    said = ordered.select("conv_id", F.shiftright("pos", CHUNK_BITS).alias("chunk"), "pos", "turn", "role", "text").withColumn("tag", F.lit(2))
    both = chunks.unionByName(said, allowMissingColumns=True).unionByName(listed, allowMissingColumns=True)
    stream = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("chunk").asc_nulls_first(), "tag", F.col("pos").asc_nulls_first())
    names = ("tag", "conv_id", "turn", "role", "text", "cost", "blank", "duplicate", "truncated", "edits")
    result = f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, {RESULT}"

    def rebuilt(batches):
        import pyarrow as pa

        current, conv, done = None, None, []

        def batch():
            columns = list(zip(*done, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=labels)

        for b in batches:
            for tag, key, turn, role, text, cost, blank, duplicate, truncated, edits in zip(*[b.column(c).to_pylist() for c in names], strict=True):
                if tag == 0:
                    if current:
                        done.append((conv, *current.result()))
                    current, conv = _Conversation(), key
                elif tag == 1:
                    current.chunk(cost, (blank, duplicate, truncated), edits)
                else:
                    current.row(turn, role, text)
            if done:
                yield batch()
                done = []
        if current:
            done.append((conv, *current.result()))
            yield batch()

    fields = StructType.fromDDL(result).fields
    labels, types = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]
    return stream.mapInArrow(rebuilt, result)
