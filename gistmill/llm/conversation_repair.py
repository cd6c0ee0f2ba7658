"""Repair of conversation structure at least cost, with an audit of the edits.

A conversation's rows, by turn, are edited until the initials of the roles read
``(s?(ua)+)?``.  Keeping a row costs 0, a new role 2, deleting 3, inserting an
empty turn 2, and 1 more for each truncated row that stays; blank and repeated
rows must go.  Of the cheapest edits the least audit in ASCII order is taken.

Method: a shortest path over (row, last initial) whose weights are plain
integers.  The high digits of a weight are the cost.  The low digits, of 3 bits,
spell the audit: every row has a field of two, an insertion before the row and
the row's own letter, moved to the left and filled with zeros, and a last digit
belongs to an insertion at the end.  No field's letters begin another's, so
comparing numbers compares (cost, audit), and the DP takes integer minima only.
One insertion a gap is enough: two in a row can be taken out together, or, behind
a lone system turn, cost more than deleting that turn.

Scale: weights of rows far apart add up without carries, so a run of rows is a
4 by 4 matrix of weights and runs are combined by (min, +) products.  Rows without
texts are range partitioned by conversation and turn; a long conversation lies in
many partitions and is cut into runs of ``RUN`` rows.  Only audits, one letter a
row, meet per conversation.  Repeats are found by grouping on digests of texts.
The digest of the repaired text is one pass over the conversation's texts in order,
streamed, as a running digest cannot be split.

Defined results: a null in any column is read as one space, so it takes part in
repeats and in digests, while null turns sort first and count for no gap; rows of
one turn are ordered by role and digest of the text, equal rows are repeats of the
first; a null conv_id is a conversation of its own; a conversation without rows has
zeros, an empty audit and the digest of nothing; an empty table gives no rows; other
columns are ignored, and very long texts pass one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stages import written

RUN = 512
COST = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED = 1
LETTERS = "0DIKR"  # in ASCII order; digit 0 ends a field
DIGIT = {c: i for i, c in enumerate(LETTERS)}
FIELD = 6  # bits: two digits of three
#: What stands last: nothing, a system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
MAY_FOLLOW = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
SPACES = " \t\n\x0b\x0c\r"
HEADER = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
RUNS = ("conv_id bigint, part bigint, n bigint, first_turn bigint, last_turn bigint, turns bigint, first_role string, last_role string, "
        "blank bigint, duplicate bigint, truncated bigint, illegal bigint, weights array<string>")

Matrix = list[list[int | None]]


def _steps(initial: str, must_go: bool, truncated: bool) -> list[tuple[int, int, int, int]]:
    """The edges of a row: from, to, cost, field; of those with equal ends the least."""
    best: dict[tuple[int, int], tuple[int, int]] = {}

    def edge(a: int, b: int, cost: int, letter: str, inserted: bool) -> None:
        field = DIGIT["I"] << 3 | DIGIT[letter] if inserted else DIGIT[letter] << 3
        value = (cost + COST["I"] * inserted, field)
        best[a, b] = min(best.get((a, b), value), value)

    def edits(a: int, inserted_at: int | None) -> None:
        here = a if inserted_at is None else inserted_at
        after = inserted_at is not None
        edge(a, here, COST["D"], "D", after)
        if must_go:
            return
        late = TRUNCATED * truncated
        for role, place in INITIALS.items():
            if here in MAY_FOLLOW[place]:
                if role == initial:
                    edge(a, place, COST["K"] + late, "K", after)
                if place != SYSTEM:
                    edge(a, place, COST["R"] + late, "R", after)

    for a in range(4):
        edits(a, None)
    for b in (USER, ASSISTANT):
        for a in MAY_FOLLOW[b]:
            edits(a, b)
    return [(a, b, cost, field) for (a, b), (cost, field) in best.items()]


_edges: dict[tuple[str, bool, bool], list[tuple[int, int, int, int]]] = {}


def run_matrix(rows: list[tuple[str, bool, bool]]) -> Matrix:
    """Least weight from every state before the rows (initial, must go, truncated) to every state behind them."""
    n = len(rows)
    unit = FIELD * n
    table: Matrix = [[0 if a == b else None for b in range(4)] for a in range(4)]
    for i, row in enumerate(rows):
        if row not in _edges:
            _edges[row] = _steps(*row)
        place = FIELD * (n - 1 - i)
        edges = [(a, b, (cost << unit) + (field << place)) for a, b, cost, field in _edges[row]]
        for s in range(4):
            old, new = table[s], [None] * 4
            for a, b, weight in edges:
                if old[a] is not None and (new[b] is None or old[a] + weight < new[b]):
                    new[b] = old[a] + weight
            table[s] = new
    return table


def joined(left: Matrix, n: int, right: Matrix, m: int) -> Matrix:
    """(min, +) product of the matrices of ``n`` rows and of the ``m`` rows behind them."""
    both, low_n, low_m = FIELD * (n + m), (1 << FIELD * n) - 1, (1 << FIELD * m) - 1

    def ahead(w: int) -> int:
        return ((w >> FIELD * n) << both) | ((w & low_n) << FIELD * m)

    def behind(w: int) -> int:
        return ((w >> FIELD * m) << both) | (w & low_m)

    a = [[None if w is None else ahead(w) for w in row] for row in left]
    b = [[None if w is None else behind(w) for w in row] for row in right]
    return [[min((a[s][k] + b[k][t] for k in range(4) if a[s][k] is not None and b[k][t] is not None), default=None)
             for t in range(4)] for s in range(4)]


def cheapest(runs: list[tuple[Matrix, int]]) -> tuple[int, str]:
    """Cost and audit of a conversation whose consecutive runs have these matrices and numbers of rows."""
    while len(runs) > 1:
        paired = [(joined(*runs[i], *runs[i + 1]), runs[i][1] + runs[i + 1][1]) for i in range(0, len(runs) - 1, 2)]
        runs = paired + runs[len(runs) - len(runs) % 2:]
    if not runs:
        return 0, ""
    matrix, n = runs[0]
    unit, ends = FIELD * n, []
    for state, weight in enumerate(matrix[START]):
        if weight is None:
            continue
        cost, digits = weight >> unit, weight & ((1 << unit) - 1)
        if state in (START, ASSISTANT):
            ends.append((cost << unit + 3) + (digits << 3))
        elif state == USER:
            ends.append((cost + COST["I"] << unit + 3) + (digits << 3) + DIGIT["I"])
    least = min(ends)
    digits = f"{least & ((1 << unit + 3) - 1):0{2 * n + 1}o}"
    return least >> unit + 3, digits.translate({ord("0"): None} | {ord(str(d)): c for c, d in DIGIT.items() if d})


def _filled(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the planted damage; a repeated row has copy 1, others 0."""
    code = F.crc32(F.concat_ws(":", _filled(F.col("conv_id")), _filled(F.col("turn")))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), _filled(F.col("role")).alias("role"),
        _filled(F.col("text")).alias("text"), code.alias("code")).where("code != 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(
            F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(0), (F.col("code") == 3).cast("int"))).alias("copy"))


ORDER = ["turn", "role", "digest", "copy"]


def _judged(rows: DataFrame) -> DataFrame:
    """Rows without texts: order columns, blank, truncated, and ``again`` where an earlier turn has the same role and text."""
    shown = F.rtrim(F.translate("text", SPACES[1:], " " * 5))
    slim = rows.select(
        "conv_id", *ORDER, (shown == "").alias("blank"),
        (~F.substring(shown, -1, 1).isin(".", "!", "?") & (shown != "")).alias("truncated"))
    keys = ["conv_id", "role", "digest"]
    order = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("at"))
    first = slim.groupBy(*keys).agg(F.min(order).alias("first"), F.max(order).alias("last")).where("first != last")
    # most texts stand once, so the few with a repeat are what the rows are joined with
    first = first.select(*[F.col(k).alias(f"first_{k}") for k in keys], "first")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"first_{k}"))
    return slim.join(first, same, "left").select(
        "conv_id", *ORDER, "blank", "truncated",
        (F.col("first").isNotNull() & ~order.eqNullSafe(F.col("first"))).alias("again"))


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to one row per run: figures of the run and its matrix, weights in hexadecimal."""
    rows: list[tuple] = []
    part, before = 0, None
    out: list[dict] = []

    def closed() -> dict:
        weights = run_matrix([(r[2][:1], r[4] or r[5], r[6]) for r in rows])
        turns = [r[1] for r in rows if r[1] is not None]
        initials = [r[2][:1] for r in rows]
        return {
            "conv_id": rows[0][0], "part": part, "n": len(rows), "first_turn": turns[0] if turns else None,
            "last_turn": turns[-1] if turns else None, "turns": len(set(turns)),
            "first_role": initials[0], "last_role": initials[-1],
            "blank": sum(r[4] for r in rows), "duplicate": sum(r[5] and not r[4] for r in rows),
            "truncated": sum(r[6] and not r[5] for r in rows),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "weights": [None if w is None else f"{w:x}" for line in weights for w in line],
        }

    for batch in batches:
        names = ["conv_id", "turn", "role", "digest", "blank", "again", "truncated", "place"]
        for row in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
            if rows and (row[0] != rows[0][0] or len(rows) == RUN):
                out.append(closed())
                rows = []
            if not rows:
                part = row[7]
            key = row[:4]
            rows.append((*row[:5], row[5] or key == before, row[6]))
            before = key
        if len(out) >= 256:
            yield pa.RecordBatch.from_pylist(out, RUN_ROWS)
            out = []
    if rows:
        out.append(closed())
    yield pa.RecordBatch.from_pylist(out, RUN_ROWS)


RUN_ROWS = pa.schema(
    [(n, pa.int64()) for n in ("conv_id", "part", "n", "first_turn", "last_turn", "turns")]
    + [("first_role", pa.string()), ("last_role", pa.string())]
    + [(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")] + [("weights", pa.list_(pa.string()))])


def _summary(runs: list[dict]) -> dict:
    """The figures of a conversation from its runs in order."""
    runs = [r for r in runs if r["n"]]
    matrices = []
    for r in runs:
        w = [None if x is None else int(x, 16) for x in r["weights"]]
        matrices.append(([w[i:i + 4] for i in range(0, 16, 4)], r["n"]))
    cost, audit = cheapest(matrices)
    dated = [r for r in runs if r["turns"]]
    turns = sum(r["turns"] for r in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
    return {
        "gaps": dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - turns if dated else 0,
        **{k: sum(r[k] for r in runs) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(r["illegal"] for r in runs)
        + sum(a["last_role"] + b["first_role"] not in ("su", "ua", "au") for a, b in zip(runs, runs[1:])),
        "cost": cost, "audit": audit,
    }


HEADER_ROWS = pa.schema(
    [(n, pa.int64()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by conversation and part to one row per conversation."""
    runs: list[dict] = []
    out: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if runs and row["conv_id"] != runs[0]["conv_id"]:
                out.append({"conv_id": runs[0]["conv_id"], **_summary(runs)})
                runs = []
            runs.append(row)
        if len(out) >= 1024:
            yield pa.RecordBatch.from_pylist(out, HEADER_ROWS)
            out = []
    if runs:
        out.append({"conv_id": runs[0]["conv_id"], **_summary(runs)})
    yield pa.RecordBatch.from_pylist(out, HEADER_ROWS)


def plans(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost and audit.  ``rows`` are its rows with a digest of the text."""
    ordered = (
        _judged(rows).repartitionByRange("conv_id", *ORDER[:-1]).sortWithinPartitions("conv_id", *ORDER)
        .withColumn("place", F.monotonically_increasing_id())
    )
    runs = written(ordered.mapInArrow(_runs, RUNS), "runs")
    every = conversations.select(F.col("conv_id").cast("bigint")).distinct().selectExpr(
        "conv_id", "-1L AS part", "0L AS n", *[f"CAST(NULL AS {t}) AS {n}" for n, t in (
            x.split(" ") for x in RUNS.split(", ")[3:])])
    together = every.unionByName(runs).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return written(together.mapInArrow(_summaries, HEADER), "plans")


TURN_ROWS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
TURNS = "conv_id bigint, position bigint, edit string, role string, text string"


class _Editor:
    """Applies an audit, letter by letter, to the rows of one conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, START

    def _turn(self, letter: str, role: str, text: str) -> tuple[str, str, str]:
        if letter == "K":
            self.last = INITIALS[role[:1]]
        else:
            self.last = ASSISTANT if self.last == USER else USER
            role = "user" if self.last == USER else "assistant"
        return letter, role, text

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._turn("I", "", "")

    def edited(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            yield self._turn(letter, role, text)


def _streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict | None, Iterator[tuple[str, str, str]]]]:
    """For every header and row in order: the header if it opens a conversation, and the repaired turns known by now."""
    editor = None
    for batch in batches:
        columns = batch.to_pydict()
        for i, is_row in enumerate(columns["is_row"]):
            if is_row:
                yield None, editor.edited(columns["role"][i], columns["text"][i])
            else:
                if editor:
                    yield None, editor.inserted()
                editor = _Editor(columns["audit"][i])
                yield {k: v[i] for k, v in columns.items()}, iter(())
    if editor:
        yield None, editor.inserted()


REPORT = HEADER + ", repaired_sha256 string"
REPORT_ROWS = HEADER_ROWS.append(pa.field("repaired_sha256", pa.string()))


def _reports(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[dict] = []
    head, digest, some = None, hashlib.sha256(), False

    def closed() -> dict:
        return {n: head[n] for n in HEADER_ROWS.names} | {"repaired_sha256": digest.hexdigest()}

    for header, turns in _streamed(batches):
        if header:
            if head:
                out.append(closed())
            head, digest, some = header, hashlib.sha256(), False
            if len(out) >= 1024:
                yield pa.RecordBatch.from_pylist(out, REPORT_ROWS)
                out = []
        for _, role, text in turns:
            digest.update(("\n" * some + role + ":" + text).encode())
            some = True
    if head:
        out.append(closed())
    yield pa.RecordBatch.from_pylist(out, REPORT_ROWS)


def _turns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    conv_id, position = None, 0
    for header, turns in _streamed(batches):
        if header:
            conv_id, position = header["conv_id"], 0
        for edit, role, text in turns:
            out.append((conv_id, position, edit, role, text))
            position += 1
        if len(out) >= 1024:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), TURN_ROWS)], schema=TURN_ROWS)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), TURN_ROWS)], schema=TURN_ROWS)


def _with_plans(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Every conversation's plan, and behind it its rows in order, in one task a conversation."""
    rows = rows.withColumn("digest", F.sha2("text", 256))
    found = plans(conversations, rows)
    heads = found.selectExpr("*", "false AS is_row", "CAST(NULL AS bigint) AS turn", "CAST(NULL AS string) AS role",
                             "CAST(NULL AS string) AS text", "CAST(NULL AS string) AS digest", "CAST(NULL AS int) AS copy")
    bodies = rows.withColumn("is_row", F.lit(True))
    return heads.unionByName(bodies, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(
        "conv_id", "is_row", *ORDER)


def repair_report(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``conversations``: its faults, cost, audit and the digest of the repaired text.

    ``rows`` (conv_id, turn, role, text, copy) is what is repaired, by default ``conversations`` as it is.
    """
    rows = as_rows(conversations) if rows is None else rows
    return _with_plans(conversations, rows).mapInArrow(_reports, REPORT)


def repaired_turns(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """The repaired conversations: conv_id, position from 0, edit (K, R or I), role and text."""
    rows = as_rows(conversations) if rows is None else rows
    return _with_plans(conversations, rows).mapInArrow(_turns, TURNS)


def as_rows(conversations: DataFrame) -> DataFrame:
    """The rows as they are, nulls read as one space."""
    return conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), _filled(F.col("role")).alias("role"),
        _filled(F.col("text")).alias("text"), F.lit(0).alias("copy"))
