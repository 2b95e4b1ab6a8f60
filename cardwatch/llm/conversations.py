"""Repair of conversations by a cheapest sequence of edits, streamed in two sorted passes.

The first pass sees no text: rows are reduced to (conversation, turn, hash of role and text, kind),
repartitioned by conversation and sorted backwards. mapInPandas carries the cost to the end from each
of the four states (nothing yet, after system, after user, after assistant) across rows and Arrow
batches, and spills a back pointer of one byte a row (two bits a state) in chunks, as rows of a table in
the shared folder. The second pass sorts texts and chunks forwards together, follows the pointers, and
hands out repaired rows or a digest as it goes. Neither pass holds more of a conversation than a batch,
a chunk and, for the digest, one letter an edit, however long the conversation is.

Pointers name the first of the cheapest edits in ASCII order (D, I, K, R), so that following them
forwards spells the least audit.
"""
from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import table
from cardwatch.session import saved

#: Fixed values of the query contract: costs of the edits, and of leaving a row truncated.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
EDITS = "DIKR"
WHITE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant. What insertion and rerole lead to.
NEXT = (2, 2, 3, 2)
#: Where a kept row leads, by the initial of its role.
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Cost to the end behind the last row: a dialogue is empty or ends after assistant.
END = (0, 2 * INSERT, INSERT, 0)
#: Pointers of a spilled chunk.
CHUNK = 1 << 16
ROLES = {2: "user", 3: "assistant"}


def step(after: tuple, initial: str, fault: str) -> tuple[tuple, int]:
    """Costs to the end in front of a row, from those behind it, and the row's pointers.

    ``fault`` is 'x' for a row that must go, 't' for a truncated one, else '-'.
    """
    ways = []
    for state in range(4):
        found = {0: DELETE + after[state]}
        if fault != "x":
            extra = TRUNCATED if fault == "t" else 0
            if initial in KEPT[state]:
                found[2] = extra + after[KEPT[state][initial]]
            found[3] = REROLE + extra + after[NEXT[state]]
        ways.append(found)
    least = [min(w.values()) for w in ways]
    here = tuple(min(least[s], INSERT + least[NEXT[s]], 2 * INSERT + least[NEXT[NEXT[s]]]) for s in range(4))
    pointers = 0
    for state, found in enumerate(ways):
        found[1] = INSERT + here[NEXT[state]]
        pointers |= min(e for e, cost in found.items() if cost == here[state]) << 2 * state
    return here, pointers


class Costs:
    """The steps, remembered: costs relative to the least take few values, so a row is a look-up."""

    def __init__(self):
        self.known: dict[tuple, tuple[tuple, int]] = {}

    def __call__(self, after: tuple, initial: str, fault: str) -> tuple[tuple, int]:
        key = (after, initial, fault)
        if key not in self.known:
            here, pointers = step(after, initial, fault)
            self.known[key] = tuple(c - min(here) for c in here), pointers
        return self.known[key]


def marked(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text, same (hash of role and text), initial, blank, cut; nulls are one space.

    ``conv`` is the conversation as text, empty for null and with a leading ``=`` else.
    """
    spaced = {c: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for c, name in (("role", role), ("text", text))}
    conv = F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    return rows.select(conv.alias("conv"), F.col(turn).cast("long").alias("turn"), *[c.alias(n) for n, c in spaced.items()]).withColumns({
        "same": F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")),
        "initial": F.substring("role", 1, 1), "blank": body == "", "cut": (body != "") & ~F.right(body, F.lit(1)).isin(".", "!", "?"),
    })


def pointers(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Chunks of back pointers: conv, turn, same (of the chunk's first row), part, pointers, and
    duplicates and truncated, the number of rows with these faults.

    ``rows`` are marked rows. Rows equal in turn, role and text combine to one with a count before the
    shuffle. Only a conversation's first row of a role and text is no duplicate.
    """
    slim = rows.groupBy("conv", "turn", "same", "initial", "blank", "cut").agg(F.count("*").alias("n"))
    seen = F.row_number().over(Window.partitionBy("conv", "same").orderBy(F.col("turn").asc_nulls_first()))
    kind = F.when(F.col("blank"), "x").when(F.col("cut"), "t").otherwise("-")
    kinds = slim.withColumns({"first": seen == 1, "kind": F.concat(kind, "initial")})
    kinds = kinds.repartition("conv").sortWithinPartitions("conv", F.desc_nulls_last("turn"), F.desc("same"))
    schema = "conv string, at string, same string, part long, pointers binary, duplicates long, truncated long"
    names = ["conv", "at", "same", "part", "pointers", "duplicates", "truncated"]

    def backwards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        costs, conv, made = Costs(), None, []
        after, part, held, duplicates, truncated, first = END, 0, bytearray(), 0, 0, None

        def spilled() -> tuple:
            return conv, *first, part, bytes(reversed(held)), duplicates, truncated

        for frame in frames:
            for c, at, same, kind, is_first, n in zip(*(frame[k] for k in ("conv", "at", "same", "kind", "first", "n"))):
                if c != conv:
                    if held:
                        made.append(spilled())
                    conv, after, part, held, duplicates, truncated = c, END, 0, bytearray(), 0, 0
                at = None if pd.isna(at) else at
                for i in reversed(range(n)):  # rows that are equal stand together, the first one last
                    repeat = i > 0 or not is_first
                    fault = "x" if repeat else kind[0]
                    duplicates += repeat and kind[0] != "x"
                    truncated += fault == "t"
                    after, pointer = costs(after, kind[1:], fault)
                    held.append(pointer)
                    first = (at, same)
                    if len(held) == chunk:
                        made.append(spilled())
                        part, held, duplicates, truncated = part + 1, bytearray(), 0, 0
            if made:
                yield pd.DataFrame(made, columns=names)
                made = []
        if held:
            yield pd.DataFrame([spilled()], columns=names)

    found = kinds.select("conv", F.col("turn").cast("string").alias("at"), "same", "kind", "first", "n").mapInPandas(backwards, schema)
    return found.withColumn("turn", F.col("at").cast("long")).drop("at")


class Follower:
    """One conversation, forwards: pointers come before the rows they are for."""

    def __init__(self, conv: str):
        self.conv, self.state, self.queue = conv, 0, deque()
        self.audit, self.sha, self.lines = bytearray(), hashlib.sha256(), 0
        self.least, self.most, self.turns, self.last = None, None, 0, None
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0

    def _write(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def insert(self) -> tuple:
        self.state = NEXT[self.state]
        self.cost += INSERT
        self.audit += b"I"
        self._write(ROLES[self.state], "")
        return None, ROLES[self.state], "", "I"

    def row(self, turn, role: str, text: str, initial: str, blank: bool, cut: bool) -> list[tuple]:
        """The repaired rows that come of one row: (turn, role, text, edit)."""
        if turn is not None and (self.most is None or turn != self.most):
            self.least, self.most, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        self.blank += blank
        pointer, out = self.queue.popleft(), []
        while (edit := pointer >> 2 * self.state & 3) == 1:
            out.append(self.insert())
        self.audit += EDITS[edit].encode()
        if edit == 0:
            self.cost += DELETE
        else:
            self.state = KEPT[self.state][initial] if edit == 2 else NEXT[self.state]
            self.cost += (REROLE if edit == 3 else 0) + (TRUNCATED if cut else 0)
            role = role if edit == 2 else ROLES[self.state]
            self._write(role, text)
            out.append((turn, role, text, EDITS[edit]))
        return out

    def end(self) -> list[tuple]:
        out = []
        while self.state in (1, 2):
            out.append(self.insert())
        return out

    def digest(self) -> tuple:
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                self.audit.decode(), self.sha.hexdigest())


def _forwards(rows: DataFrame, spilled: DataFrame, extra: DataFrame | None, schema: pa.Schema, handle, kind: str) -> DataFrame:
    """Stream rows behind their pointers, conversation by conversation."""
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("part", "long"), ("pointers", "binary"), ("duplicates", "long"), ("truncated", "long"))]
    texts = rows.select("conv", "turn", "same", F.lit(1).alias("order"), "role", "text", "initial", "blank", "cut", *empty)
    names = [F.lit(None).cast("string").alias(n) for n in ("role", "text", "initial")]
    flags = [F.lit(None).cast("boolean").alias(n) for n in ("blank", "cut")]
    both = texts.unionByName(spilled.select("conv", "turn", "same", F.lit(0).alias("order"), *names, *flags, "part", "pointers", "duplicates",
                                                 "truncated"))
    if extra is not None:
        both = both.unionByName(extra.select("conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("same"),
                                             F.lit(2).alias("order"), *names, *flags, *empty))
    both = both.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "same", "order", F.desc("part"))
    columns = ["conv", "turn", "role", "text", "initial", "blank", "cut", "pointers", "duplicates", "truncated"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            for conv, turn, role, text, initial, blank, cut, more, *counts in zip(*(batch.column(c).to_pylist() for c in columns)):
                if now is None or conv != now.conv:
                    if now is not None:
                        out += handle(now, now.end(), True)
                    now = Follower(conv)
                if more is not None:
                    now.queue.extend(more)
                    now.duplicate += counts[0]
                    now.truncated += counts[1]
                elif text is not None:
                    out += handle(now, now.row(turn, role, text, initial, blank, cut), False)
            if out:
                yield _batch(out, schema)
                out = []
        if now is not None and (out := handle(now, now.end(), True)):
            yield _batch(out, schema)

    return both.select(*columns).mapInArrow(stream, kind)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _original(conv: Column, kind: str) -> Column:
    return F.when(conv != "", F.substr(conv, F.lit(2))).cast(kind)


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           chunk: int = CHUNK) -> DataFrame:
    """The repaired conversations: conv_id, turn (null where inserted), role, text, place, edit.

    Rows stand by turn (nulls first), those of one turn by the hash of role and text; nulls in role
    and text are one space, a null conversation is one of its own. Blank and repeated rows go, roles come
    as (s?(ua)+)?, at the least cost and, of those, the least audit. Roles count by their initial; an empty role fits
    nowhere. Other columns of the input are not carried along, whatever their names. A row that repeats
    another one is a duplicate. An empty table gives an empty result.
    """
    schema = pa.schema([("conv", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                        ("place", pa.int64()), ("edit", pa.string())])

    def handle(now: Follower, made: list[tuple], ended: bool) -> list[tuple]:
        first = now.lines - len(made)
        return [(now.conv, t, r, x, first + i, e) for i, (t, r, x, e) in enumerate(made)]

    known = marked(rows, conv_id, turn, role, text)
    spilled = saved(pointers(known, chunk), "pointers")
    kind = "conv string, turn long, role string, text string, place long, edit string"
    return _forwards(known, spilled, None, schema, handle, kind).select(
        _original(F.col("conv"), rows.schema[conv_id].dataType.simpleString()).alias(conv_id), "turn", "role", "text", "place", "edit")


def digest(rows: DataFrame, everyone: DataFrame | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and a hash of the repaired text.

    ``everyone`` (a column conv_id, repeats allowed) names conversations that may have no row left:
    they come with zeros and an empty audit. Order, nulls and ties as in ``repair``.
    """
    schema = pa.schema([("conv", pa.string()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def handle(now: Follower, made: list[tuple], ended: bool) -> list[tuple]:
        return [now.digest()] if ended else []

    known = marked(rows, conv_id, turn, role, text)
    spilled = saved(pointers(known, chunk), "pointers")
    extra = None
    if everyone is not None:
        extra = everyone.select(F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit("")).alias("conv"))
    kind = "conv string, " + ", ".join(f"{n} long" for n in schema.names[1:7]) + ", audit string, repaired_sha256 string"
    found = _forwards(known, spilled, extra, schema, handle, kind)
    return found.select(_original(F.col("conv"), rows.schema[conv_id].dataType.simpleString()).alias(conv_id), *schema.names[1:])


def damaged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with planted faults, by a checksum of conversation and turn, and the rows dropped."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    rows = rows.withColumn("fault", fault)
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ".!?", "")).otherwise(text)
    kept = rows.filter("fault != 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(role).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy")).drop("copy")
    return kept, rows.filter("fault = 0").select("conv_id")


def op11_conversation_repair(spark, folder: str) -> DataFrame:
    kept, dropped = damaged(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
    return digest(kept, dropped)


SQL = r"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS name FROM conversations),
c AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(name, ''), lambda b: CAST(ascii(b) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS d FROM k),
r AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE d WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM c),
n AS (SELECT *, left(role, 1) AS ini, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS k,
    row_number() OVER turns AS i, left(lag(role) OVER turns, 1) || left(role, 1) AS two
  FROM r WINDOW turns AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat(length(role), ':', role, text)), copy)),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN k > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault FROM n),
-- cheapest way to each state so far: {cost, audit, lines}
w AS (SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]} AS e,
    NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS s, NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS u,
    NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]) AS v
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, CASE WHEN e.c IS NOT NULL THEN {'c': e.c + 4, 'a': e.a || 'D', 'o': e.o} END,
    list_min([CASE WHEN s.c IS NOT NULL THEN {'c': s.c + 4, 'a': s.a || 'D', 'o': s.o} END,
      CASE WHEN ok AND ini = 's' THEN {'c': e.c + t, 'a': e.a || 'K', 'o': list_append(e.o, line)} END]),
    list_min([CASE WHEN u2.c IS NOT NULL THEN {'c': u2.c + 4, 'a': u2.a || 'D', 'o': u2.o} END,
      CASE WHEN ok AND ini = 'u' THEN {'c': e.c + t, 'a': e.a || 'K', 'o': list_append(e.o, line)} END,
      CASE WHEN ok AND ini = 'u' AND s.c IS NOT NULL THEN {'c': s.c + t, 'a': s.a || 'K', 'o': list_append(s.o, line)} END,
      CASE WHEN ok AND ini = 'u' THEN {'c': v2.c + t, 'a': v2.a || 'K', 'o': list_append(v2.o, line)} END,
      CASE WHEN ok THEN {'c': e.c + t + 3, 'a': e.a || 'R', 'o': list_append(e.o, 'user:' || text)} END,
      CASE WHEN ok AND s.c IS NOT NULL THEN {'c': s.c + t + 3, 'a': s.a || 'R', 'o': list_append(s.o, 'user:' || text)} END,
      CASE WHEN ok THEN {'c': v2.c + t + 3, 'a': v2.a || 'R', 'o': list_append(v2.o, 'user:' || text)} END]),
    list_min([{'c': v2.c + 4, 'a': v2.a || 'D', 'o': v2.o},
      CASE WHEN ok AND ini = 'a' THEN {'c': u2.c + t, 'a': u2.a || 'K', 'o': list_append(u2.o, line)} END,
      CASE WHEN ok THEN {'c': u2.c + t + 3, 'a': u2.a || 'R', 'o': list_append(u2.o, 'assistant:' || text)} END])
  FROM (SELECT *, list_min([v, {'c': u2.c + 3, 'a': u2.a || 'I', 'o': list_append(u2.o, 'assistant:')}]) AS v2
    FROM (SELECT w.*  EXCLUDE (i), f.i, f.ini, f.text, f.role || ':' || f.text AS line, f.fault NOT IN ('b', 'd') AS ok,
        CASE f.fault WHEN 't' THEN 3 ELSE 0 END AS t,
        list_min([u, {'c': e.c + 3, 'a': e.a || 'I', 'o': list_append(e.o, 'user:')},
          CASE WHEN s.c IS NOT NULL THEN {'c': s.c + 3, 'a': s.a || 'I', 'o': list_append(s.o, 'user:')} END,
          CASE WHEN v.c IS NOT NULL THEN {'c': v.c + 3, 'a': v.a || 'I', 'o': list_append(v.o, 'user:')} END]) AS u2
      FROM w JOIN f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1))),
b AS (SELECT conv_id, list_min([e, v, CASE WHEN u.c IS NOT NULL THEN {'c': u.c + 3, 'a': u.a || 'I', 'o': list_append(u.o, 'assistant:')} END,
    CASE WHEN s.c IS NOT NULL THEN {'c': s.c + 6, 'a': s.a || 'II', 'o': list_concat(s.o, ['user:', 'assistant:'])} END]) AS x
  FROM (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
    count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
    count(*) FILTER (WHERE i > 1 AND two NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, x.c AS cost, x.a AS audit,
  sha256(array_to_string(x.o, chr(10))) AS repaired_sha256
FROM b LEFT JOIN g ON b.conv_id IS NOT DISTINCT FROM g.conv_id"""
