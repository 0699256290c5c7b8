"""Conversation repair: the block tables against all edits, and the operator against plain loops."""

import collections
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tradelake.llm import fourrussians as fr
from tradelake.llm import repair

ROOT = "/root/testdata/sf0.001"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
LEGAL = re.compile(r"(s?(ua)+)?")


def cheapest(symbols):
    """Least cost, and the least audit of that cost, by trying all edits of every row in every state."""

    @functools.lru_cache(None)
    def go(i, state, inserted):
        found = [(0, "")] if i == len(symbols) and state in (fr.START, fr.DONE) else []
        needed = fr.AFTER[state][fr.NEEDED[state]]
        add = lambda cost, letter, rest: found.append((cost + rest[0], letter + rest[1]))
        if inserted < 2:
            add(3, "I", go(i, needed, inserted + 1))
        if i < len(symbols):
            x = symbols[i]
            add(4, "D", go(i + 1, state, 0))
            if x != fr.GONE:
                add(3 + 3 * (x % 2), "R", go(i + 1, needed, 0))
                if fr.initial_of(x) in fr.AFTER[state]:
                    add(3 * (x % 2), "K", go(i + 1, fr.AFTER[state][fr.initial_of(x)], 0))
        return min(found) if found else (10**6, "")

    return go(0, fr.START, 0)


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_tables_against_all_edits(length):
    tables, rng = fr.tables(length), random.Random(length)
    for _ in range(2500):
        rows = np.array([rng.choice([0, 1, 2, 2, 2, 3, 4, 4, 4, 5, 6, 7, 8]) for _ in range(rng.randint(0, 11))], np.int64)
        expected = cheapest(tuple(rows.tolist()))
        before, off = tables.fold(rows)
        cost = off[0] + tables.vectors[before[0]][fr.START]
        assert (cost, tables.trace(rows, fr.START, 0, True)[1]) == expected
        # In two chunks, the second folded before the first is.
        cut = rng.randint(0, len(rows))
        (before_2, off_2), (before_1, off_1) = tables.fold(rows[cut:]), tables.fold(rows[:cut])
        middle = int(before_2[0])
        assert off_2[0] + off_1[middle] + tables.vectors[before_1[middle]][fr.START] == expected[0]
        state, first = tables.trace(rows[:cut], fr.START, middle, False)
        assert first + tables.trace(rows[cut:], state, 0, True)[1] == expected[1]


def plain_damage(rows):
    space = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        out += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def plain_repair(listed, damaged):
    of = collections.defaultdict(list)
    for conv, *row in damaged:
        of[conv].append(row)
    out = []
    for conv in {*listed, *of}:
        rows = sorted(of[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], r[2]))
        turns, seen, counts, symbols = {r[0] for r in rows} - {None}, set(), [0, 0, 0], []
        for _, role, text in rows:
            white = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not white else 1 if (role, text) in seen else 2 if white[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            symbols.append(fr.GONE if fault in (0, 1) else fr.symbol(role[:1], fault == 2))
        cost, audit = cheapest(tuple(symbols))
        state, left, lines = fr.START, iter(rows), []
        for letter in audit:
            needed = fr.NEEDED[state]
            role, text = next(left)[1:] if letter != "I" else ("", "")
            if letter != "D":
                role = role if letter == "K" else fr.ROLES[needed]
                lines.append((role, text))
                state = fr.AFTER[state][role[0]]
        assert LEGAL.fullmatch("".join(r[0] for r, _ in lines))
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{ROOT}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries()["op11_four_russians"](spark, ROOT)) == plain_repair({r[0] for r in rows}, plain_damage(rows))


SCHEMA = "conv_id long, turn long, role string, text string"
ODD = [
    (None, 0, "user", "null conversation."), (None, None, "assistant", "null turn!"), (None, None, None, None), (1, None, "tool", "x."), (1, None, "tool", "x."),
    (1, 5, "system", " \t\n "), (1, 9, "system", "late system."), (2, 0, "user", "a\u0085"), (2, 1, "assistant", "b. "), (2, 1, "assistant", "c. \r\n"),
    (3, 0, "", "no role."), (3, 1, "\U0001f600", "face."), (3, 7, "assistant", "cut" * 40_000), (4, 2**40, "user", "far."), (4, 0, "user", "ok?"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(1) for c in ("pos", "chunk", "TAG", "copy", "fault", "text2")}).repartition(4)
    assert rows_of(repair.repair(docs, repair.damage(docs))) == plain_repair({r[0] for r in ODD}, plain_damage(ODD))
    assert rows_of(repair.repair(docs, docs)) == plain_repair(set(), [tuple(" " if i > 1 and x is None else x for i, x in enumerate(r)) for r in ODD])


def test_no_rows_left(spark):
    listed = spark.createDataFrame([(1, 0, "user", "a."), (2, 0, "user", "b.")], SCHEMA)
    found = repair.repair(listed, listed.where("conv_id = 2")).where("conv_id = 1").collect()
    assert [tuple(r) for r in found] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    empty = listed.where("false")
    assert repair.repair(empty, repair.damage(empty)).count() == 0


def test_a_large_conversation_over_many_chunks(spark):
    """20,000 rows of one conversation among small ones: the same as the plain dynamic program over all of them."""
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant", "assistant", "system", "x"]), rng.choice([f"{i}.", f"{i}", "same.", ""])) for i in range(20_000)]
    rows += [(c, 0, "user", "hello.") for c in range(100, 140)]
    found = {r.conv_id: r for r in repair.repair(*[spark.createDataFrame(rows, SCHEMA).repartition(6)] * 2).collect()}
    seen, symbols = set(), []
    for _, _, role, text in rows[:20_000]:
        gone = not text or (role, text) in seen
        seen.add((role, text))
        symbols.append(fr.GONE if gone else fr.symbol(role[0], not text.endswith(".")))
    costs = fr.END
    for x in reversed(symbols):
        costs = fr.before(costs, x)
    assert found[7].cost == costs[fr.START] and len(found[7].audit.replace("I", "")) == 20_000
    assert found[7].audit == fr.tables().trace(np.array(symbols), fr.START, 0, True)[1]
    assert found[120].audit == "KI" or found[120].audit == "D"
