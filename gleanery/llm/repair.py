"""Conversation structure repair by secondary-sorted streaming.

Rows are repartitioned by conversation and sorted by turn; a task streams them through a shortest-path search over
(rows read, last role kept), carried across Arrow batches. For each of the four states (nothing, system, user,
assistant) it carries the least cost, the order of the states' edits so far, and a running hash of the repaired
text; each row adds one small number that says which step every state came by. Past ``SPILL_ROWS`` of a
conversation these go to an unnamed temporary file of the task (a task that runs anew writes its own), so memory
doesn't follow the conversation; texts are hashed as they pass and never kept.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of one conversation whose steps a task holds in memory.
SPILL_ROWS = 1 << 20
SPACES = " \t\n\x0b\f\r"

# Faults, costs of edits, and the adjacent role initials that are legal.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
DELETE, REROLE, INSERT, LATE = 3, 2, 2, 1
LEGAL = {"su", "ua", "au"}

START, SYSTEM, USER, ASSISTANT = range(4)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_FAR = 1 << 60


def _next(state: int) -> int:
    """The state that an inserted or reroled turn leads to: user and assistant take turns, the user first."""
    return ASSISTANT if state == USER else USER


def options(state: int, initial: str, fault: int) -> list[tuple[int, str, int]]:
    """(cost, edits, state after) of the ways to deal with a row: delete it, or up to two insertions and then keep or rerole it.

    Insertions before a deletion are left out: after it they cost the same and D comes before I. A third
    insertion leads where one does.
    """
    found = [(DELETE, "D", state)]
    if fault in (BLANK, DUPLICATE):
        return found
    late = LATE if fault == TRUNCATED else 0
    for n in range(3):
        to, before = _next(state), "I" * n
        if initial == "s" and state == START:
            found.append((n * INSERT + late, before + "K", SYSTEM))
        if initial == _ROLE[to][0]:
            found.append((n * INSERT + late, before + "K", to))
        found.append((n * INSERT + late + REROLE, before + "R", to))
        state = to
    return found


class _Steps:
    """What a row does to the states' costs and order, remembered by number. Few are ever different: costs count from the least."""

    def __init__(self):
        self.of: dict = {}
        self.back: list = []

    def take(self, costs: tuple, order: tuple, initial: str, fault: int) -> tuple:
        """(costs less the least, the least, order, number) after a row. ``order[state]`` ranks the states' edits in ASCII order.

        Edits that end with a row are never the beginning of others that end with it, so ranks settle all ties.
        """
        key = (costs, order, initial, fault)
        if key not in self.of:
            best: dict[int, tuple] = {}
            for state in range(4):
                if costs[state] < _FAR:
                    for cost, edits, to in options(state, initial, fault):
                        way = (costs[state] + cost, order[state], edits, state)
                        best[to] = min(best.get(to, way), way)
            least = min(w[0] for w in best.values())
            ranked = sorted(best, key=lambda to: best[to][1:3])
            after = tuple(best[to][0] - least if to in best else _FAR for to in range(4))
            ranks = tuple(ranked.index(to) if to in best else 4 for to in range(4))
            self.back.append(tuple((best[to][3], best[to][2]) if to in best else None for to in range(4)))
            self.of[key] = after, least, ranks, len(self.back) - 1
        return self.of[key]


class Conversation:
    """One conversation's rows in order; ``finish`` gives its row of the result."""

    def __init__(self, steps: _Steps, spill_rows: int = SPILL_ROWS):
        self.steps, self.spill_rows = steps, spill_rows
        self.costs, self.base, self.order = (0, _FAR, _FAR, _FAR), 0, (0, 4, 4, 4)
        self.texts = [(hashlib.sha256(), False), None, None, None]
        self.taken, self.file, self.spilled = array("I"), None, 0
        self.faults, self.illegal, self.last = [0, 0, 0, 0], 0, None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        self.faults[fault] += 1
        self.illegal += self.last is not None and self.last + initial not in LEGAL
        self.last = initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        self.costs, least, self.order, number = self.steps.take(self.costs, self.order, initial if initial in ("s", "u", "a") else "", fault)
        self.base += least
        own, body = f"{role}:".encode(), text.encode()
        self.texts = [None if came is None else self._written(*came, own, body) for came in self.steps.back[number]]
        self.taken.append(number)
        if len(self.taken) >= self.spill_rows:
            self.file = self.file or tempfile.TemporaryFile()
            self.taken.tofile(self.file)
            self.spilled += len(self.taken)
            self.taken = array("I")

    def _written(self, state: int, edits: str, own: bytes, body: bytes):
        text, some = self.texts[state]
        if edits == "D":
            return text, some
        text = text.copy()
        for edit in edits:
            text.update(b"\n" if some else b"")
            if edit == "K":
                text.update(own + body)
            else:
                state = _next(state)
                text.update(f"{_ROLE[state]}:".encode() + (body if edit == "R" else b""))
            some = True
        return text, some

    def _numbers(self):
        """The rows' step numbers from the last to the first, a block at a time."""
        yield self.taken[::-1]
        for at in range(self.spilled - self.spill_rows, -1, -self.spill_rows):
            block = array("I")
            self.file.seek(at * block.itemsize)
            block.fromfile(self.file, self.spill_rows)
            yield block[::-1]

    def finish(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)"""
        ends = [(self.costs[s] + INSERT * len(tail), self.order[s], tail, s) for s, tail in ((START, ""), (SYSTEM, "II"), (USER, "I"), (ASSISTANT, "")) if self.costs[s] < _FAR]
        cost, _, tail, state = min(ends)
        whole, _ = self._written(state, tail, b"", b"") if tail else self.texts[state]
        parts = [tail]
        for block in self._numbers():
            edits = []
            for number in block:
                state, edit = self.steps.back[number][state]
                edits.append(edit)
            parts.append("".join(reversed(edits)))
        if self.file:
            self.file.close()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, *self.faults[1:], self.illegal, self.base + cost, "".join(reversed(parts)), whole.hexdigest()


_OUT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_COLUMNS = [c.split()[0] for c in _OUT.split(", ")]


def _stream(spill_rows: int):
    def run(frames):
        steps, own, current = _Steps(), None, None
        for frame in frames:
            done = []
            for conv, turn, role, text, here, fault in zip(*(frame[c].tolist() for c in ("conv", "turn", "role", "text", "here", "fault"))):
                if own is None or conv != current:
                    if own is not None:
                        done.append((current, *own.finish()))
                    own, current = Conversation(steps, spill_rows), conv
                if here:
                    own.add(None if turn is None else int(turn), role, text, fault)
            if done:
                yield pd.DataFrame(done, columns=["conv", *_COLUMNS])
        if own is not None:
            yield pd.DataFrame([(current, *own.finish())], columns=["conv", *_COLUMNS])

    return run


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None, spill_rows: int = SPILL_ROWS) -> DataFrame:
    """A row per conversation: its faults and the cheapest edits that make it system?, then user and assistant in turn.

    Rows go by turn, nulls first, then role and text. A row's first fault counts: blank (nothing but white space),
    duplicate (role and text stood earlier in the conversation), truncated (its last sign that is no white space
    is none of ``.!?``). Keeping a row costs 0, giving it the role user or assistant 2, deleting it 3 (a must for
    blank and duplicate ones), inserting an empty user or assistant turn 2; a truncated row that stays adds 1.
    Returns the conversation's id, gaps (turns missing between the least and the greatest), blank, duplicate, truncated,
    illegal (neighbours whose role initials are not su, ua or au), cost, audit (the edits' initials; of equally cheap ones
    the ASCII-least) and repaired_sha256 (of the lines role:text).

    A null role or text is one space, and a role that starts with none of s, u and a can't be kept. Null ids are one
    conversation. Rows where ``present`` is false only name their conversation: one without other rows has zeros,
    an empty audit and the hash of nothing. Repeated rows are duplicates. An empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    here = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    kind = dict(turns.dtypes)[conv]
    rows = turns.select(F.col(conv).cast("string").alias("conv"), F.col(turn).cast("long").alias("at"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"), here.alias("here"))
    # Equal rows meet by conversation, role and text, so that a giant conversation is spread here.
    same = W.partitionBy("conv", "here", "role", F.sha2("text", 256)).orderBy(F.asc_nulls_first("at"))
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = F.when(end == "", BLANK).when(F.row_number().over(same) > 1, DUPLICATE).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    judged = rows.withColumn("fault", fault)
    sorted_ = judged.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("at"), "role", "text", F.col("fault") == DUPLICATE)
    found = sorted_.select("conv", F.col("at").cast("string").alias("turn"), "role", "text", "here", "fault").mapInPandas(_stream(spill_rows), f"conv string, {_OUT}")
    return found.select(F.col("conv").cast(kind).alias(conv), *_COLUMNS)


def damage(turns: DataFrame) -> DataFrame:
    """Rows of conversations with faults put in by crc32 of 'conv_id:turn' modulo 20 (nulls: one space), and ``present``.

    0 drops the row (present is false), 1 empties its text, 2 removes ``.!?``, 3 repeats it in the same turn, 4 makes its role user.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), k.alias("_k"))
    text = F.when(F.col("_k") < 2, "").when(F.col("_k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("_k") != 0).alias("present"), copies.alias("_copy")).drop("_copy")


def oracle_sql() -> str:
    """DuckDB SQL for the rows of the query over ``conversations``: edits in a recursion over the rows, four states each."""
    crc = (
        "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)), lambda r, b: "
        "list_reduce(list_concat([xor(r, b)], [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"
    )
    return f"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
x AS (SELECT *, {crc} % 20 AS m FROM o),
y AS (
  SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN m = 1 THEN '' WHEN m = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN m = 3 THEN 2 ELSE 1 END)) AS copy
  FROM x WHERE m <> 0),
g AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
z AS (SELECT g.g, y.*, row_number() OVER (PARTITION BY g.g ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM y JOIN g ON y.conv_id IS NOT DISTINCT FROM g.conv_id),
q AS (SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) AS nth, regexp_extract(text, '([^ \\t-\\r])[ \\t-\\r]*\\z', 1) AS ends FROM z),
r AS (
  SELECT *, CASE WHEN ends = '' THEN 1 WHEN nth > 1 THEN 2 WHEN ends NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    substring(role, 1, 1) AS ini, lag(substring(role, 1, 1)) OVER (PARTITION BY g ORDER BY i) AS prev FROM q),
turns(st, ini, role, dest) AS (VALUES (0, 'u', 'user', 2), (1, 'u', 'user', 2), (2, 'a', 'assistant', 3), (3, 'u', 'user', 2)),
ins AS (
  SELECT st, 0 AS n, st AS upto, []::VARCHAR[] AS lines FROM turns
  UNION ALL SELECT st, 1, dest, [role || ':'] FROM turns
  UNION ALL SELECT a.st, 2, b.dest, [a.role || ':', b.role || ':'] FROM turns a JOIN turns b ON b.st = a.dest),
ways AS (
  SELECT st, NULL::VARCHAR AS ini, 'D' AS edits, 3 AS cost, st AS dest, []::VARCHAR[] AS lines, NULL::VARCHAR AS role FROM turns
  UNION ALL SELECT ins.st, t.ini, repeat('I', n) || 'K', 2 * n, t.dest, lines, NULL FROM ins JOIN turns t ON t.st = upto
  UNION ALL SELECT st, 's', repeat('I', n) || 'K', 2 * n, 1, lines, NULL FROM ins WHERE upto = 0
  UNION ALL SELECT ins.st, NULL, repeat('I', n) || 'R', 2 * n + 2, t.dest, lines, t.role FROM ins JOIN turns t ON t.st = upto),
p AS (
  SELECT g, 0::BIGINT AS i, 0 AS st, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM g
  UNION ALL
  SELECT g, i, dest, cost, audit, lines FROM (
    SELECT p.g, r.i, w.dest, p.cost + w.cost + CASE WHEN w.edits <> 'D' AND r.fault = 3 THEN 1 ELSE 0 END AS cost, p.audit || w.edits AS audit,
      CASE WHEN w.edits = 'D' THEN p.lines ELSE list_concat(p.lines, w.lines, [coalesce(w.role, r.role) || ':' || r.text]) END AS lines
    FROM p JOIN r ON r.g = p.g AND r.i = p.i + 1 JOIN ways w ON w.st = p.st AND (w.ini IS NULL OR w.ini = r.ini) AND (w.edits = 'D' OR r.fault IN (0, 3)))
  QUALIFY row_number() OVER (PARTITION BY g, dest ORDER BY cost, audit) = 1),
s AS (
  SELECT g, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY g),
e AS (
  SELECT p.g, p.cost + v.cost AS cost, p.audit || v.tail AS audit, list_concat(p.lines, v.lines) AS lines
  FROM p JOIN s ON s.g = p.g AND s.n = p.i
  JOIN (VALUES (0, 0, '', []::VARCHAR[]), (1, 4, 'II', ['user:', 'assistant:']), (2, 2, 'I', ['assistant:']), (3, 0, '', [])) v(st, cost, tail, lines) ON v.st = p.st
  QUALIFY row_number() OVER (PARTITION BY p.g ORDER BY p.cost + v.cost, p.audit || v.tail) = 1)
SELECT g.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank, coalesce(s.duplicate, 0)::BIGINT AS duplicate,
  coalesce(s.truncated, 0)::BIGINT AS truncated, coalesce(s.illegal, 0)::BIGINT AS illegal, coalesce(e.cost, 0)::BIGINT AS cost, coalesce(e.audit, '') AS audit,
  sha256(coalesce(array_to_string(e.lines, chr(10)), '')) AS repaired_sha256
FROM g LEFT JOIN s ON s.g = g.g LEFT JOIN e ON e.g = g.g
"""
