"""Repair of conversation structure by weighted interval parsing.

The role initials of a repaired conversation match ``(s?(ua)+)?``. Its grammar is in
Chomsky normal form, with a nonterminal ``pq`` for every pair of places in that
pattern: ``pr -> pq qr`` for every place q between, ``pq -> row`` for every edit of
one row that leads from p to q, and the insertion closure: what insertions alone
derive, on both sides of every row. A cell holds, for a span of rows and a
nonterminal, the least (cost, audit): the edits' initials in order, ties to the
ASCII-least. Cells of a span are made from those of two adjacent spans, bottom-up by
span length. Every derivation of ``pr`` passes a place q at every boundary inside its
span, so the minimum over one split is the minimum over all splits, and spans are
halved: n rows take n - 1 combinations. (Equally cheap audits of one cell are never
prefixes of each other, as one could only go on with insertions, which cost more; so
least audits of two spans make the least audit of both.)

The same combination goes on across tasks: rows are sorted by conversation and turn
over all tasks, runs of at most ``SEGMENT`` rows of one conversation become one span
each, and spans of a conversation are combined ``FAN`` at a time, level by level, so
that a conversation with a third of all rows is no one task's group. Texts take no
part in this; they are joined to the rows that stay and hashed in order, streaming.
A SHA-256 is one chain, so the texts of one conversation pass one task, row by row.

Defined cases: null ids, turns, roles and texts count as one space in the checksum
and the text; rows of a null conversation are one conversation; turns sort with null
first, rows of one turn by role, then text (by its first 64 characters, then its
MD5); repeated rows are rows; roles may be any text, their initial is the first
character; an empty table gives no rows; extra columns do not matter; texts may be
of any length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import materialise, parts_for

# Fixed values of the contract.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
ROLE = {"u": "user", "a": "assistant"}
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}  # places of (s?(ua)+)?
ENDS = (0, 3)
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"

SEGMENT = 4096      # rows of a span that one task makes
FAN = 16            # spans combined at a time
ROWS = 200_000      # rows of a sorted task
OUT_ROWS = 20_000   # rows a task sends back at a time

# Nonterminals: pairs of places with a way between them, and their splits.
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
SPLITS = [[(PAIRS.index((p, q)), PAIRS.index((q, r))) for q in range(4) if (p, q) in PAIRS and (q, r) in PAIRS] for p, r in PAIRS]

Cell = tuple[int, str] | None


def least(options) -> Cell:
    return min((x for x in options if x is not None), default=None)


def combine(a: list[Cell], b: list[Cell]) -> list[Cell]:
    """Cells of a span from those of its two parts: pr -> pq qr."""
    out = []
    for splits in SPLITS:
        best = None
        for i, j in splits:
            x, y = a[i], b[j]
            if x is None or y is None:
                continue
            cost = x[0] + y[0]
            if best is None or cost < best[0]:
                best = cost, x[1] + y[1]
            elif cost == best[0] and (audit := x[1] + y[1]) < best[1]:
                best = cost, audit
        out.append(best)
    return out


def insertions() -> list[Cell]:
    """The insertion closure: what an empty span derives."""
    one = [least([(0, "") if p == q else None, (INSERT, "I") if any(NEXT.get((p, x)) == q for x in ROLE) else None]) for p, q in PAIRS]
    while (more := combine(one, one)) != one:
        one = more
    return one


def row_cells(initial: str, fault: str) -> list[Cell]:
    """Cells of one row: an edit, with insertions around it."""
    def edit(p, q):
        options = [(DELETE, "D") if p == q else None]
        if fault not in ("blank", "duplicate"):
            extra = TRUNCATED if fault == "truncated" else 0
            options.append((extra, "K") if NEXT.get((p, initial)) == q else None)
            options += [(REROLE + extra, "R") if NEXT.get((p, x)) == q else None for x in ROLE]
        return least(options)

    around = insertions()
    return combine(combine(around, [edit(p, q) for p, q in PAIRS]), around)


def parse(cells: list[list[Cell]]) -> list[Cell]:
    """Cells of the whole span, bottom-up by span length."""
    while len(cells) > 1:
        cells = [combine(cells[i], cells[i + 1]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def chosen(cells: list[Cell]) -> Cell:
    return least(cells[PAIRS.index((0, q))] for q in ENDS)


# ---- rows -----------------------------------------------------------------------
def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, turn, role, text, times)`` after the contract's damage: conv as text."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = rows.select(F.col(conv).cast("string").alias("conv"), F.col(turn).cast("long").alias("turn"), told(role).alias("role"),
                    told(text).alias("text"), (F.crc32(F.concat(told(conv), F.lit(":"), told(turn))) % 20).cast("int").alias("h"))
    changed = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return d.where("h <> 0").select("conv", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
                                    changed.alias("text"), F.when(F.col("h") == 3, 2).otherwise(1).alias("times"))


def _bare(text: str) -> Column:
    return F.rtrim(F.col(text), F.lit(BLANKS))


def flagged(rows: DataFrame) -> DataFrame:
    """Rows in which a text is its first characters and its digest, with the first
    fault of each. Copies are found by the least place per (conv, role, text)."""
    bare = _bare("text")
    feat = materialise(rows.select(
        "conv", "turn", "role", F.substring("text", 1, 64).alias("head"), F.unhex(F.md5("text")).alias("digest"), (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"), F.explode(F.sequence(F.lit(1), "times")).alias("copy"))
        .drop("copy").withColumn("salt", F.monotonically_increasing_id()), "repair-rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "salt")
    first = feat.groupBy("conv", "role", "digest").agg(F.min(place).alias("first")).select(
        F.col("conv").alias("__c"), F.col("role").alias("__r"), F.col("digest").alias("__d"), F.col("first.salt").alias("__s"))
    j = feat.join(first, feat["conv"].eqNullSafe(F.col("__c")) & (feat["role"] == F.col("__r")) & (feat["digest"] == F.col("__d")))
    fault = (F.when(F.col("blank"), "blank").when(F.col("salt") != F.col("__s"), "duplicate").when(F.col("cut"), "truncated").otherwise(""))
    return materialise(j.select("conv", "turn", "role", "head", "digest", "salt", fault.alias("fault")), "repair-flagged")


SPAN = ("conv string, {place}, n long, first string, last string, illegal long, blank long, duplicate long, truncated long, "
        "cost array<long>, audit array<string>")
OWN = ", turns array<string>, roles array<string>, digests array<binary>"


class Span:
    """A run of rows of one conversation, or several adjacent ones."""

    def __init__(self, n, first, last, illegal, blank, duplicate, truncated, cells):
        self.fields, self.cells = (n, first, last, illegal, blank, duplicate, truncated), cells

    @classmethod
    def of_rows(cls, initials: list[str], faults: list[str], memo: dict) -> "Span":
        cells = []
        for x in zip(initials, faults):
            if x not in memo:
                memo[x] = row_cells(*x)
            cells.append(memo[x])
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        return cls(len(initials), initials[0], initials[-1], illegal, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), parse(cells))

    @classmethod
    def of_row(cls, r) -> "Span":
        cells = [None if c is None or c < 0 else (int(c), a) for c, a in zip(r.cost, r.audit)]
        return cls(r.n, r.first, r.last, r.illegal, r.blank, r.duplicate, r.truncated, cells)

    def __add__(self, b: "Span") -> "Span":
        x, y = self.fields, b.fields
        seam = x[2] + y[1] not in LEGAL
        return Span(x[0] + y[0], x[1], y[2], x[3] + y[3] + seam, x[4] + y[4], x[5] + y[5], x[6] + y[6], combine(self.cells, b.cells))

    def row(self) -> dict:
        names = ("n", "first", "last", "illegal", "blank", "duplicate", "truncated")
        return {**dict(zip(names, self.fields)), "cost": [-1 if c is None else c[0] for c in self.cells],
                "audit": ["" if c is None else c[1] for c in self.cells]}


def _segments(frames, most: int):
    """Spans of at most ``most`` rows, from rows that come sorted."""
    part, seq, memo, held = TaskContext.get().partitionId(), 0, {}, []  # held: (conv, turn, role, digest, fault)
    def flush():
        nonlocal seq
        span = Span.of_rows([h[2][:1] for h in held], [h[4] for h in held], memo)
        seq += 1
        return {"conv": held[0][0], "part": part, "seq": seq, **span.row(), "turns": [h[1] for h in held],
                "roles": [h[2] for h in held], "digests": [h[3] for h in held]}

    out, size = [], 0
    for f in frames:
        for row in zip(f["conv"], f["turn"], f["role"], f["digest"], f["fault"]):
            if held and (held[0][0] != row[0] or len(held) == most):
                out.append(flush())
                size += len(held)
                held = []
                if size > OUT_ROWS:
                    yield pd.DataFrame(out)
                    out, size = [], 0
            held.append(row)
    if held:
        out.append(flush())
    if out:
        yield pd.DataFrame(out)


def _same(a: str, b: str = "conv") -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def spans(rows: DataFrame, segment: int = SEGMENT, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(segments with their index, one span per conversation)."""
    order = ["conv", "turn", "role", "head", "digest", "salt"]
    n = parts_for(rows.count(), ROWS, rows.sparkSession.sparkContext.defaultParallelism)
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = dealt.select("conv", F.col("turn").cast("string").alias("turn"), "role", "digest", "fault")
    found = materialise(dealt.mapInPandas(lambda frames: _segments(frames, segment), SPAN.format(place="part int, seq int") + OWN), "repair-segments")
    at = Window.partitionBy("conv").orderBy("part", "seq")  # one row of keys per segment
    keys = found.select("conv", "part", "seq").withColumn("idx", F.row_number().over(at) - 1).withColumn(
        "parts", F.count("*").over(Window.partitionBy("conv")))
    keys = keys.select(F.col("conv").alias("__c"), F.col("part").alias("__p"), F.col("seq").alias("__s"), "idx", "parts")
    # (part, seq) is a key of its own
    segments = materialise(found.join(keys, (F.col("part") == F.col("__p")) & (F.col("seq") == F.col("__s"))).drop("__c", "__p", "__s", "part", "seq"),
                           "repair-indexed")
    names = ["conv", "idx", "n", "first", "last", "illegal", "blank", "duplicate", "truncated", "cost", "audit"]
    whole = segments.where("parts = 1").select(names)
    now = segments.where("parts > 1").select(names)
    schema = SPAN.format(place="idx int")

    def join_spans(key, f: pd.DataFrame) -> pd.DataFrame:
        total = None
        for r in f.sort_values("idx").itertuples():
            total = Span.of_row(r) if total is None else total + Span.of_row(r)
        return pd.DataFrame([{"conv": key[0], "idx": int(key[1]), **total.row()}])

    while (now.agg(F.max("idx")).first()[0] or 0) > 0:
        now = materialise(now.groupBy("conv", F.floor(F.col("idx") / fan).cast("int").alias("idx")).applyInPandas(join_spans, schema), "repair-level")
    return segments, whole.union(now)


# ---- what stays -----------------------------------------------------------------
def role_at(place: int, total: int) -> str:
    """Initial of the row at ``place`` of a repaired conversation of ``total`` rows."""
    if total % 2:
        return "s" if not place else "ua"[(place - 1) % 2]
    return "ua"[place % 2]


def _pieces(frames):
    """Cuts each conversation's audit into those of its segments."""
    for f in frames:
        out = []
        for conv, audit, sizes in zip(f["conv"], f["audit"], f["sizes"]):
            symbols = np.frombuffer(audit.encode(), dtype="S1")
            seen, kept = np.cumsum(symbols != b"I"), np.concatenate(([0], np.cumsum(symbols != b"D"))).tolist()
            starts = np.cumsum([0, *(s["n"] for s in sizes)])[:-1]
            cuts = [0 if not s else int(np.searchsorted(seen, s)) + 1 for s in starts] + [len(audit)]
            out += [(conv, s["idx"], audit[a:b], kept[a], kept[-1]) for s, a, b in zip(sizes, cuts, cuts[1:])]
        yield pd.DataFrame(out, columns=["conv", "idx", "piece", "start", "total"])


def _stays(frames):
    """The rows that a repaired conversation has, in order."""
    columns, out = ["conv", "idx", "k", "turn", "was", "digest", "role"], []
    for f in frames:
        for r in f.itertuples():
            row, place = 0, r.start
            for k, x in enumerate(r.piece):
                if x == "I":
                    out.append((r.conv, r.idx, k, None, None, None, ROLE[role_at(place, r.total)]))
                elif x != "D":
                    role = r.roles[row] if x == "K" else ROLE[role_at(place, r.total)]
                    out.append((r.conv, r.idx, k, r.turns[row], r.roles[row], r.digests[row], role))
                row, place = row + (x != "I"), place + (x != "D")
            if len(out) > OUT_ROWS:
                yield pd.DataFrame(out, columns=columns)
                out = []
    if out:
        yield pd.DataFrame(out, columns=columns)


def _hashes(frames):
    """SHA-256 per conversation of lines that come sorted."""
    now, at, digest = None, None, None
    for f in frames:
        done = []
        for conv, idx, k, line in zip(f["conv"], f["idx"], f["k"], f["line"]):
            if digest is None or now != conv:
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                now, at, digest = conv, (idx, k), hashlib.sha256(line.encode())
            elif at != (idx, k):
                at = idx, k
                digest.update(b"\n" + line.encode())
        if done:
            yield pd.DataFrame(done, columns=["conv", "repaired_sha256"])
    if digest is not None:
        yield pd.DataFrame([(now, digest.hexdigest())], columns=["conv", "repaired_sha256"])


def repaired_rows(broken: DataFrame, segments: DataFrame, told: DataFrame) -> DataFrame:
    """``(conv, idx, k, role, text)``: the rows of every repaired conversation, in
    the order of (idx, k). A text that stays is there once per conversation and role."""
    sizes = segments.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("idx", "n"))).alias("sizes"))
    cut = (sizes.select(F.col("conv").alias("__c"), "sizes").join(told.select("conv", "audit"), _same("__c"))
           .select("conv", "audit", "sizes").mapInPandas(_pieces, "conv string, idx int, piece string, start long, total long"))
    cut = cut.select(F.col("conv").alias("__c"), F.col("idx").alias("__i"), "piece", "start", "total")
    both = segments.select("conv", "idx", "turns", "roles", "digests").join(cut, _same("__c") & (F.col("idx") == F.col("__i"))).drop("__c", "__i")
    stays = materialise(both.mapInPandas(_stays, "conv string, idx int, k int, turn string, was string, digest binary, role string"), "repair-stays")
    key = ["conv", "turn", "role", "digest"]
    texts = (broken.where(_bare("text") != "").select("conv", F.col("turn").cast("string").alias("turn"), "role", F.unhex(F.md5("text")).alias("digest"), "text")
             .groupBy(*key).agg(F.first("text").alias("text")).select(*[F.col(c).alias(f"__{c}") for c in key], "text"))
    kept = stays.where("digest IS NOT NULL").join(
        texts, _same("__conv") & _same("__turn", "turn") & (F.col("was") == F.col("__role")) & (F.col("digest") == F.col("__digest")))
    made = stays.where("digest IS NULL").withColumn("text", F.lit(""))
    out = ["conv", "idx", "k", "role", "text"]
    return kept.select(*out).union(made.select(*out))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           segment: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256)`` of every conversation of ``rows`` after damage."""
    kind = dict(rows.dtypes)[conv]
    broken = damaged(rows, conv, turn, role, text)
    marked = flagged(broken)
    segments, whole = spans(marked, segment, fan)

    def decide(frames):
        for f in frames:
            best = [chosen(Span.of_row(r).cells) for r in f.itertuples()]
            yield f[["conv", "illegal", "blank", "duplicate", "truncated"]].assign(total=[b[0] for b in best], best=[b[1] for b in best])

    told = materialise(whole.mapInPandas(decide, "conv string, illegal long, blank long, duplicate long, truncated long, total long, best string")
                       .withColumnsRenamed({"total": "cost", "best": "audit"}), "repair-told")
    lines = repaired_rows(broken, segments, told).select("conv", "idx", "k", F.concat("role", F.lit(":"), "text").alias("line"))
    sha = (lines.repartition("conv").sortWithinPartitions("conv", "idx", "k").mapInPandas(_hashes, "conv string, repaired_sha256 string"))
    turns = marked.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1).alias("span"), F.countDistinct("turn").alias("n"))
    gaps = turns.select(F.col("conv").alias("__g"), F.coalesce(F.col("span") - F.col("n"), F.lit(0)).alias("gaps"))
    every = rows.select(F.col(conv).cast("string").alias("id")).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (every.join(told, _same("id"), "left").join(sha.select(F.col("conv").alias("__s"), "repaired_sha256"), _same("id", "__s"), "left")
            .join(gaps, _same("id", "__g"), "left")
            .select(F.col("id").cast(kind).alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                    F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def _repair_sql() -> str:
    from corvid.llm.spelling import CRC_TABLE_SQL, crc_sql  # the checksum in SQL, as there

    white = r"[\x20\x09-\x0D]"
    moves = ", ".join(f"({p}, '{x}', {q})" for (p, x), q in NEXT.items())
    closure = ", ".join(f"({p}, {q}, {c[0]}, '{c[1]}')" for (p, q), c in zip(PAIRS, insertions()) if c)
    return f"""
WITH RECURSIVE t AS {CRC_TABLE_SQL},
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS h FROM conversations, t),
dmg AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM src),
num AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
        left(role, 1) AS x, regexp_replace(text, '{white}+$', '') AS bare FROM dmg WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
r AS MATERIALIZED (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
      lag(x) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM num),
move(p, x, q) AS (VALUES {moves}), ins(p, q, c, a) AS (VALUES {closure}),
edit AS MATERIALIZED (SELECT conv_id, i, p, q, min({{'c': c, 'a': a}}) AS e FROM (
    SELECT conv_id, i, s.p, s.p AS q, {DELETE} AS c, 'D' AS a FROM r, range(4) s(p)
    UNION ALL SELECT conv_id, i, p, q, CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END, 'K' FROM r JOIN move USING (x) WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL SELECT conv_id, i, p, q, {REROLE} + CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END, 'R' FROM r, move WHERE move.x IN ('u', 'a') AND fault NOT IN ('blank', 'duplicate'))
    GROUP BY ALL),
walk(conv_id, i, p, c, a) AS (
    SELECT d.conv_id, CAST(0 AS BIGINT), ins.q, CAST(ins.c AS BIGINT), ins.a FROM (SELECT DISTINCT conv_id FROM r) d, ins WHERE ins.p = 0
    UNION ALL
    SELECT conv_id, i, q, b.c, b.a FROM (
        SELECT w.conv_id, w.i + 1 AS i, ins.q, min({{'c': w.c + e.e.c + ins.c, 'a': w.a || e.e.a || ins.a}}) AS b
        FROM walk w JOIN edit e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.p = w.p JOIN ins ON ins.p = e.q
        GROUP BY w.conv_id, w.i, ins.q)),
stat AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n, count_if(fault = 'blank') AS blank,
         count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
         count_if(before IS NOT NULL AND before || x NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
told AS MATERIALIZED (SELECT stat.conv_id, min({{'c': c, 'a': a}}) AS best FROM stat JOIN walk ON walk.conv_id IS NOT DISTINCT FROM stat.conv_id AND walk.i = stat.n
         WHERE p IN (0, 3) GROUP BY stat.conv_id),
sym AS (SELECT conv_id, best.a AS audit, k, substr(best.a, k, 1) AS e FROM (SELECT conv_id, best, unnest(range(1, length(best.a) + 1)) AS k FROM told)),
put AS (SELECT conv_id, k, e, count_if(e <> 'I') OVER w AS i, count_if(e <> 'D') OVER w AS o, count_if(e <> 'D') OVER (PARTITION BY conv_id) AS total
        FROM sym WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
outs AS (SELECT put.conv_id, put.k, CASE WHEN e = 'K' THEN r.role WHEN (o + total) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE r.text END AS line
         FROM put LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM put.conv_id AND r.i = put.i AND e <> 'I' WHERE e <> 'D'),
sha AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY k)) AS h FROM outs GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(told.best.c, 0) AS cost, coalesce(told.best.a, '') AS audit, coalesce(sha.h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN stat ON stat.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN sha ON sha.conv_id IS NOT DISTINCT FROM d.conv_id"""


REPAIR_SQL = _repair_sql()
