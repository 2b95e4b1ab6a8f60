"""Conversation repair against all sequences of edits, and against its SQL on long conversations."""
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import conversations

WHITE = " \t\n\v\f\r"


def _ordered(rows):
    same = {r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest() for r in rows}
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, same[r]))


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(WHITE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else
                   "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _brute(rows):
    """Cheapest of all edits, at most two insertions in a gap; the least audit of equals."""
    faults, best = _faults(rows), None
    for inserts in itertools.product(range(3), repeat=len(rows) + 1):
        for edits in itertools.product("DKR", repeat=len(rows)):
            cost, audit, roles, lines = 0, "", "", []
            for n, edit, row, fault in zip(inserts, [*edits, ""], [*rows, None], [*faults, ""]):
                for _ in range(n):
                    cost, audit = cost + 3, audit + "I"
                    roles += "a" if roles[-1:] == "u" else "u"
                    lines.append(("assistant" if roles[-1] == "a" else "user") + ":")
                if not edit:
                    continue
                audit += edit
                if edit == "D":
                    cost += 4
                    continue
                if fault in ("blank", "duplicate"):
                    break
                role = row[1] if edit == "K" else "assistant" if roles[-1:] == "u" else "user"
                cost += 3 * (edit == "R") + 3 * (fault == "truncated")
                roles += role[:1] or "-"  # a role without an initial fits nowhere
                lines.append(f"{role}:{row[2]}")
            else:
                if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best[:2]):
                    best = cost, audit, "\n".join(lines)
    return best


def _digest(rows):
    rows = _ordered([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows])
    cost, audit, text = _brute(rows)
    turns = {t for t, _, _ in rows if t is not None}
    faults, initials = _faults(rows), [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(11)
    out = {None: [(None, "user", "Hi."), (3, None, None), (None, "user", "Hi."), (9, "assistant", "Yes!")]}
    for c in range(120):
        out[c] = [(draw.choice([None, *range(6)]), draw.choice(["user", "assistant", "system", "user", "tool", "", None]),
                   draw.choice(["One.", "two", "Three? \n", "", " \t", None, f"{draw.random()}!"])) for _ in range(draw.randint(1, 4))]
    return out


@pytest.mark.parametrize("chunk", [1, 3, 1 << 16])
def test_repair_against_all_edits(spark, talks, chunk):
    rows = [(c, *r) for c, talk in talks.items() for r in talk]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(6)
    df = df.withColumns({c: F.lit("x") for c in ("conv", "same", "order", "blank", "cost", "edit")})
    gone = spark.createDataFrame([(500,), (500,), (3,)], "conv_id long")
    got = {r[0]: tuple(r)[1:] for r in conversations.digest(df, gone, chunk=chunk).collect()}
    want = {c: _digest(talk) for c, talk in talks.items()}
    assert got == {**want, 500: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    repaired = conversations.repair(df, chunk=chunk).collect()
    for c in talks:
        own = sorted((r for r in repaired if r.conv_id == c), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(len(own)))
        text = "\n".join(f"{r.role}:{r.text}" for r in own)
        assert hashlib.sha256(text.encode()).hexdigest() == got[c][-1]
        assert "".join(r.edit for r in own) == got[c][-2].replace("D", "")


def test_repair_of_long_conversations_follows_the_sql(spark):
    draw = random.Random(2)
    rows = [(c, t, draw.choice(["user", "assistant", "assistant", "system", "user"]), draw.choice(["a.", "b", "c!", f"{t} é?", f"long {t} " * 50, ""]))
            for c, n in ((0, 300), (1, 1), (2, 40), (None, 25), (4, 2)) for t in range(n) if draw.random() < 0.9]
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64"})
    con = duckdb.connect()
    con.register("conversations", frame)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kept, dropped = conversations.damaged(df)
    got = sorted((tuple(r) for r in conversations.digest(kept, dropped, chunk=7).collect()), key=str)
    assert got == sorted((tuple(r) for r in con.execute(conversations.SQL).fetchall()), key=str)
    assert all(zlib.crc32(f"{' ' if c is None else c}:{t}".encode()) % 20 for c, t in kept.select("conv_id", "turn").collect())


def test_repair_of_nothing_and_of_one_row_many_times(spark):
    empty = spark.createDataFrame([], "conv_id string, turn long, role string, text string")
    assert conversations.repair(empty).count() == 0 and conversations.digest(empty).count() == 0
    often = spark.range(3000).select(F.lit("").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), F.lit("Same.").alias("text"))
    row = conversations.digest(often, chunk=100).collect()
    assert [(r.conv_id, r.duplicate, r.illegal, r.cost) for r in row] == [("", 2999, 2999, 2999 * 4 + 3)]
    # "ID..." would have to be followed by an assistant row, so the insertion stands as early as it can
    assert row[0].audit == "K" + "D" * 2999 + "I"
