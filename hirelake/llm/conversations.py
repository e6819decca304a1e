r"""Operator 12: repair a conversation's structure at the least cost.

A conversation is its rows by turn (null turns first; of one turn by role, then by
the text's md5). The first fault of a row counts: ``blank`` (no ``[^\x20\x09-\x0D]``),
``duplicate`` (role and text seen earlier in the conversation), ``truncated`` (the
last such character is not ``[.!?]``). Edits make the initials of the roles match
``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (2), Delete (3; the only edit of
blank and duplicate rows), Insert an empty user or assistant row anywhere (2); a
truncated row that stays adds 1. The audit is the edits' initials; of equally cheap
ones the ASCII-least is taken.

Method: Hirschberg's divide and conquer over four states (nothing yet, after s, u,
a). What stands before a cut gives a forward vector of costs by state, what follows a
backward one; where their sum is least they meet, the audit-least of such crossings
is taken, and both halves go on with their ends fixed, in space linear in the rows.
The vectors are rows and columns of min-plus products: a run of rows is a 4 x 4
matrix of costs from state to state with, for each state before it, the order of the
states after it by their least audits. The states after a run differ in that run
already, never in what follows (each audit of a run ends with the edit of its last
row, so none is the start of another); so (cost, order) is closed under products and
decides ties exactly without a string. All runs of a batch advance together in numpy.

Defined cases: a null role or text counts as one space; null ids are one conversation;
rows that repeat id, turn, role and text stand side by side; all turns null: no gap;
a conversation without rows has zeros, an empty audit and the empty text's hash; an
empty table gives an empty result; extra columns are not read.

Plan: rows without their texts (an md5 stands for it) are folded, marked and sorted
over all conversations by range, so a conversation with a third of all rows lies in
many tasks; chunks of ``CHUNK`` sorted rows are solved alone. A conversation that
crosses chunks sends one matrix a chunk, meets over these first and then inside each
chunk. Texts are shuffled twice: to meet their rows and, with them, by conversation
for the one hash over the whole of it, which has to be taken in order; there a task
streams and holds a batch of rows and the audit, however long the conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import CRC_TABLE, crc_sql, read, ship, stored

CHUNK = 1 << 15           # sorted rows solved together
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NEVER = 1 << 40           # cost of what cannot be
_NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_WANTED = "uuau"          # the role that an insert or a rerole gives after each state
_TAIL = ["", "II", "I", ""]                     # inserts that end a conversation
_TAIL_COST = np.array([INSERT * len(t) for t in _TAIL])
_DROPPED = 8              # row type of blank and duplicate rows; else 2 * role + truncated
ROLE_OF = {"u": "user", "a": "assistant"}


def _row_table():
    """For each row type, state before and state after: cost, least audit, and the
    order of the states after by their audits."""
    cost = np.full((9, 4, 4), NEVER, dtype=np.int64)
    audit = [[[""] * 4 for _ in range(4)] for _ in range(9)]
    order = np.zeros((9, 4, 4), dtype=np.int64)
    for kind, start, inserts in product(range(9), range(4), range(4)):
        state = start
        for _ in range(inserts):
            state = _NEXT[_WANTED[state]][state]
        edits = [("D", DELETE, state)]
        if kind != _DROPPED:
            role, late = "sua-"[kind // 2], TRUNCATED * (kind % 2)
            edits.append(("R", REROLE + late, _NEXT[_WANTED[state]][state]))
            if role in _NEXT and _NEXT[role][state] is not None:
                edits.append(("K", KEEP + late, _NEXT[role][state]))
        for letter, price, after in edits:
            found = (INSERT * inserts + price, "I" * inserts + letter)
            if found < (cost[kind, start, after], audit[kind][start][after]):
                cost[kind, start, after], audit[kind][start][after] = found
    for kind, start in product(range(9), range(4)):
        order[kind, start] = np.argsort(np.argsort([
            audit[kind][start][x] or "~" for x in range(4)], kind="stable"))
    return cost, order, audit


_COST, _ORDER, _AUDIT = _row_table()


def _joined(left: tuple, right: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Costs and orders of two runs, the right one after the left one."""
    (a, p), (b, q) = left, right
    through = a[:, :, :, None] + b[:, None, :, :]             # before, crossing, after
    best = through.min(axis=2)
    met = np.where(through == best[:, :, None, :], p[:, :, :, None], 4).argmin(axis=2)
    cost = np.minimum(best, NEVER)
    n, e, x = np.ogrid[:len(a), :4, :4]
    key = p[n, e, met] * 4 + q[n, met, x] + 16 * (cost == NEVER)
    return cost, np.argsort(np.argsort(key, axis=2, kind="stable"), axis=2)


class Runs:
    """Segments of rows (or of chunks), each a product tree of (cost, order)."""

    def __init__(self, cost: np.ndarray, order: np.ndarray, lengths: np.ndarray):
        self.levels, self.lengths = [(cost, order)], [lengths]
        while len(lengths) and lengths.max() > 1:
            cost, order = self.levels[-1]
            first, second, up = self._pairs(lengths)
            cost, order = cost[first], order[first].copy()
            has = second >= 0
            if has.any():
                c, o = self.levels[-1]
                cost = cost.copy()
                cost[has], order[has] = _joined((cost[has], order[has]),
                                                (c[second[has]], o[second[has]]))
            lengths = up
            self.levels.append((cost, order))
            self.lengths.append(lengths)

    @staticmethod
    def _pairs(lengths: np.ndarray):
        """Children of the nodes above: first, second (-1: none); segments' new lengths."""
        up = (lengths + 1) // 2
        start, start_up = np.cumsum(lengths) - lengths, np.cumsum(up) - up
        segment = np.repeat(np.arange(len(up)), up)
        place = np.arange(up.sum()) - start_up[segment]
        first = start[segment] + 2 * place
        second = np.where(2 * place + 1 < lengths[segment], first + 1, -1)
        return first, second, up

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """Each segment's own (cost, order)."""
        return self.levels[-1]

    def states(self, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states before and after every row, given those of its segment."""
        for (cost, order), lengths in zip(self.levels[-2::-1], self.lengths[-2::-1]):
            first, second, _ = self._pairs(lengths)
            has = np.flatnonzero(second >= 0)
            one, two = first[has], second[has]
            total = cost[one, before[has]] + cost[two, :, after[has]]   # forward + backward
            tied = total == total.min(axis=1, keepdims=True)
            met = np.where(tied, order[one, before[has]], 4).argmin(axis=1)
            n = int(lengths.sum())
            low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
            low[first], high[first] = before, after
            low[two], high[two], high[one] = met, after[has], met
            before, after = low, high
        return before, after


def best_ends(cost: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The state in which whole conversations end, for (cost, order) from the start."""
    total = cost[:, 0] + _TAIL_COST
    tied = total == total.min(axis=1, keepdims=True)
    return np.where(tied, order[:, 0], 4).argmin(axis=1)


# --- rows -------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with a twentieth of its rows each dropped, emptied, cut,
    repeated and given to the user, by the CRC-32 of ``conv_id:turn``."""
    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = F.when(fate == 1, "").when(
        fate == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    return conversations.filter(fate != 0).select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(known("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def _read(rows: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    return rows.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text")).withColumn("digest", F.md5("text"))


def _placed(rows: DataFrame) -> DataFrame:
    """Rows in order without texts, written: ``conv_id, turn, role, digest, m`` (how
    often it stands there), ``blank``, ``again`` (seen earlier), ``late``, ``pos``."""
    folded = rows.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count("*").alias("m"), F.max(~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        F.max(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("late"))
    folded = stored(folded, "op12-folded")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = stored(folded.groupBy("conv_id", "role", "digest").agg(
        F.min(turn).alias("first"), F.count("*").alias("n")).filter("n > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"),
        "op12-firsts")
    same = (F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
            & (F.col("digest") == F.col("d")))
    marked = folded.join(firsts, same, "left").withColumn(
        "again", F.col("first").isNotNull() & ~turn.eqNullSafe(F.col("first")))
    order = ["conv_id", "turn", "role", "digest"]
    ranged = marked.select(*order, "m", "blank", "again", "late").repartitionByRange(
        *order).sortWithinPartitions(*order)
    return stored(ranged.withColumn("pos", F.monotonically_increasing_id()), "op12-rows").withColumn(
        "chunk", F.expr(f"pos div {CHUNK}"))


def _kinds(batch: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Each row's type, and how many deletions follow it."""
    initial = [r[:1] for r in batch.column("role").to_pylist()]
    role = np.array(["sua".find(i) if i else -1 for i in initial], dtype=np.int64)
    role[role < 0] = 3
    flags = [batch.column(c).to_numpy(zero_copy_only=False).astype(bool)
             for c in ("blank", "again", "late")]
    kind = np.where(flags[0] | flags[1], _DROPPED, 2 * role + flags[2])
    return kind, batch.column("m").to_numpy() - 1


def _runs(rows: pa.Table) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of a chunk's sorted rows: a conversation each."""
    kind, more = _kinds(rows)
    ids = rows.column("conv_id").combine_chunks()
    new = np.ones(len(rows), dtype=bool)
    codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
    new[1:] = codes[1:] != codes[:-1]
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(rows)))
    cost = _COST[kind] + (DELETE * more)[:, None, None]
    return Runs(np.minimum(cost, NEVER), _ORDER[kind], lengths), starts, kind, more


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole chunks of rows that arrive sorted by position."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        chunk = table.column("chunk").to_numpy()
        cuts = np.flatnonzero(np.diff(chunk)) + 1
        for part in np.split(np.arange(len(chunk)), cuts):
            if not len(part):
                continue
            piece = table.slice(part[0], len(part))
            if held and held[0].column("chunk")[0] != piece.column("chunk")[0]:
                yield pa.concat_tables(held)
                held = []
            held.append(piece)
    if held:
        yield pa.concat_tables(held)


def _edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The matrices of the first and last conversation of each chunk: only these
    can go on in another chunk."""
    for rows in _chunks(batches):
        runs, starts, _, _ = _runs(rows)
        cost, order = runs.whole()
        ends = sorted({0, len(starts) - 1})
        yield pa.RecordBatch.from_arrays(
            [rows.column("conv_id").combine_chunks().take(pa.array(starts[ends])),
             pa.array([rows.column("chunk")[0].as_py()] * len(ends), pa.int64()),
             pa.array(cost[ends].reshape(-1, 16).tolist(), pa.list_(pa.int64())),
             pa.array(order[ends].reshape(-1, 16).tolist(), pa.list_(pa.int64()))],
            names=["conv_id", "chunk", "cost", "ranks"])


def _meet(rows: pa.Table) -> pa.Table:
    """A conversation over its chunks: the states before and after each."""
    rows = rows.sort_by("chunk")
    square = [np.array(rows.column(c).to_pylist(), dtype=np.int64).reshape(-1, 4, 4)
              for c in ("cost", "ranks")]
    runs = Runs(*square, np.array([len(rows)]))
    before, after = runs.states(np.zeros(1, np.int64), best_ends(*runs.whole()))
    return pa.table({"conv_id": rows.column("conv_id"), "chunk": rows.column("chunk"),
                     "before": pa.array(before, pa.int64()), "after": pa.array(after, pa.int64()),
                     "last": pa.array([False] * (len(rows) - 1) + [True])})


def _edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their edits: ``edits`` (inserts, then the row's own), ``roles`` (the
    initials that these give), ``tail`` inserts after a conversation's last row."""
    for rows in _chunks(batches):
        runs, starts, kind, more = _runs(rows)
        cost, order = runs.whole()
        given = [np.array(rows.column(c).take(pa.array(starts)).to_pylist(), dtype=object)
                 for c in ("before", "after", "last")]
        alone = np.array([g is None for g in given[0]])
        before = np.where(alone, 0, given[0]).astype(np.int64)
        after = np.where(alone, best_ends(cost, order), given[1]).astype(np.int64)
        low, high = runs.states(before, after)
        edits = [_AUDIT[k][a][b] for k, a, b in zip(kind.tolist(), low.tolist(), high.tolist())]
        lasts = np.append(starts[1:], len(rows)) - 1
        tails = [""] * len(rows)
        for end, state, single, flag in zip(lasts, after, alone, given[2]):
            if single or flag:
                tails[end] = _TAIL[state]
        names = ["conv_id", "turn", "role", "digest", "m", "blank", "again", "late", "pos"]
        yield pa.RecordBatch.from_arrays(
            [*(rows.column(c).combine_chunks() for c in names), pa.array(edits), pa.array(tails),
             pa.array(low, pa.int64())], names=[*names, "edits", "tail", "state"])


def _solved(rows: DataFrame) -> DataFrame:
    """``_placed`` rows with ``edits``, ``tail`` and the ``state`` before them."""
    spark = rows.sparkSession
    ship(spark)
    placed = _placed(rows)
    kind = placed.schema["conv_id"].dataType.simpleString()
    by_chunk = placed.repartition("chunk").sortWithinPartitions("pos")
    edges = stored(by_chunk.mapInArrow(
        _edge_rows, f"conv_id {kind}, chunk long, cost array<long>, ranks array<long>"),
        "op12-edges")
    crossing = edges.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.col("conv_id").alias("c"))
    met = edges.join(crossing, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi").groupBy(
        "conv_id").applyInArrow(_meet, f"conv_id {kind}, chunk long, before long, after long, "
                                       "last boolean")
    met = stored(met, "op12-crossings").select(
        F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "before", "after", "last")
    known = placed.join(met, F.col("conv_id").eqNullSafe(F.col("c"))
                        & (F.col("chunk") == F.col("k")), "left").drop("c", "k")
    turn = placed.schema["turn"].dataType.simpleString()
    return known.repartition("chunk").sortWithinPartitions("pos").mapInArrow(
        _edit_rows, f"conv_id {kind}, turn {turn}, role string, digest string, m long, "
                    "blank boolean, again boolean, late boolean, pos long, edits string, "
                    "tail string, state long")


def _with_texts(rows: DataFrame) -> DataFrame:
    """Solved rows with the texts of those that stay."""
    texts = rows.groupBy("conv_id", "turn", "role", "digest").agg(F.first("text").alias("text"))
    solved = stored(_solved(rows), "op12-solved")
    a, b = solved.alias("a"), texts.alias("b")
    return a.join(b, F.expr("a.conv_id <=> b.conv_id AND a.turn <=> b.turn AND a.role = b.role "
                            "AND a.digest = b.digest"), "left").select(
        "a.*", F.when(~F.col("a.edits").endswith("D"), F.col("b.text")).alias("text"))


def _outputs(edits: str, state: int, role: str) -> list[str]:
    """The roles that a row's edits give, for a kept row its own."""
    out = []
    for e in edits:
        if e in "IR":
            letter = _WANTED[state]
            out.append(ROLE_OF[letter])
        elif e == "K":
            letter = role[:1]
            out.append(role)
        if e != "D":
            state = _NEXT[letter][state]
    return out


class _Report:
    """What streams by of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.hash, self.some = conv_id, hashlib.sha256(), False
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.turns, self.low, self.high, self.role, self.audit = 0, None, None, None, []

    def say(self, role: str, text: str) -> None:
        self.hash.update(("\n" if self.some else "").encode())
        self.hash.update(f"{role}:{text}".encode())
        self.some = True

    def add(self, turn, role, m, blank, again, late, edits, tail, state, text) -> None:
        if turn is not None and turn != self.high:      # turns ascend
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        if blank:
            self.blank += m
        else:
            self.duplicate += m if again else m - 1
            self.truncated += late and not again
        initial = role[:1]
        if self.role is not None:
            self.illegal += self.role + initial not in ("su", "ua", "au")
        self.illegal += m - 1
        self.role = initial
        self.cost += sum({"I": INSERT, "R": REROLE, "D": DELETE}.get(e, KEEP) for e in edits + tail)
        self.cost += DELETE * (m - 1) + TRUNCATED * (late and not edits.endswith("D"))
        self.audit.append(edits + "D" * (m - 1) + tail)
        roles = _outputs(edits, state, role)
        for i, r in enumerate(roles):
            own = edits[-1] != "D" and i == len(roles) - 1
            self.say(r, text if own else "")
        for r in (["user", "assistant"] if tail == "II" else ["assistant"] if tail else []):
            self.say(r, "")

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv_id, int(gaps), self.blank, self.duplicate, self.truncated, self.illegal,
                self.cost, "".join(self.audit), self.hash.hexdigest())


_COLUMNS = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string")
_STREAM = ["turn", "role", "m", "blank", "again", "late", "edits", "tail", "state", "text"]


def _reports(kind: pa.DataType):
    names = ["conv_id", *(c.split()[0] for c in _COLUMNS.split(", "))]
    types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Report | None = None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", *_STREAM)]
            for conv_id, *rest in zip(*columns):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Report(conv_id)
                now.add(*rest)
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
        if now is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], t) for c, t in zip(now.row(), types)], names=names)
    return run


def repair_report(conversations: DataFrame) -> DataFrame:
    """A row a conversation (``conv_id, turn, role, text`` rows): faults, cost, audit
    and the hash of its repaired rows."""
    rows = _read(conversations)
    kind = rows.schema["conv_id"].dataType
    arrow = pa.string() if kind.simpleString() == "string" else pa.int64() \
        if kind.simpleString() == "bigint" else pa.int32()
    solved = _with_texts(rows)
    return solved.select("conv_id", "pos", *_STREAM).repartition("conv_id").sortWithinPartitions(
        "conv_id", "pos").drop("pos").mapInArrow(
        _reports(arrow), f"conv_id {kind.simpleString()}, {_COLUMNS}")


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired rows: ``conv_id, place`` (ascending in a conversation), ``edit``
    (K, R or I), ``turn`` (null where inserted), ``role, text``."""
    solved = _with_texts(_read(conversations))
    inserted = F.expr("length(edits) - 1")
    # i: the inserts before the row, the row itself, then the tail's inserts
    each = solved.withColumn("i", F.explode(F.sequence(
        F.lit(0), inserted + F.length("tail")))).withColumn("at_row", F.col("i") == inserted)
    assistant = F.when(F.col("i") <= inserted, (F.col("state") == 2) == (F.col("i") % 2 == 0)
                       ).otherwise(F.col("i") == inserted + F.length("tail"))
    wants = F.when(assistant, "assistant").otherwise("user")
    own = F.expr("right(edits, 1)")
    each = each.withColumn("edit", F.when(F.col("at_row"), own).otherwise("I")).filter("edit <> 'D'")
    return each.select(
        "conv_id", F.struct("pos", "i").alias("place"), "edit",
        F.when(F.col("at_row"), F.col("turn")).alias("turn"),
        F.when(F.col("edit") == "K", F.col("role")).otherwise(wants).alias("role"),
        F.when(F.col("at_row"), F.col("text")).otherwise("").alias("text"))


def run(spark, sf_dir) -> DataFrame:
    """The report of every conversation after ``damage``."""
    table = read(spark, sf_dir, "conversations")
    report = repair_report(damage(table)).withColumnRenamed("conv_id", "c")
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return table.select("conv_id").distinct().join(
        report, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *[F.coalesce(F.col(n), F.lit(nothing[n]) if n in nothing
                                else F.lit(0).cast("long")).alias(n) for n in names])


def _sql() -> str:
    """Faults by windows, and the repair as a recursion over the rows: for each state
    the least (cost, audit) with the rows it gives."""
    def then(s: str, letter: str, price: str, row: str) -> str:
        text = f"|| CASE WHEN {s}.a SIMILAR TO 'D*' THEN '' ELSE chr(10) END || {row}" if row else ""
        return f"{{'c': {s}.c + {price}, 'a': {s}.a || '{letter}', 'o': {s}.o {text}}}"

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def insert(s: str, letter: str) -> str:
        return then(s, "I", str(INSERT), f"'{ROLE_OF[letter]}:'")

    def own(s: str, letter: str) -> str:
        role = f"'{ROLE_OF[letter]}'" if letter in ROLE_OF else "r.role"
        keep = then(s, "K", "r.late", "r.role || ':' || r.text")
        change = then(s, "R", f"{REROLE} + r.late", f"{role} || ':' || r.text")
        no = f"{{'c': {NEVER}, 'a': {s}.a, 'o': {s}.o}}"
        return (f"CASE WHEN r.fault IN ('blank', 'duplicate') THEN {no} WHEN r.initial = '{letter}' THEN {keep} "
                f"ELSE {change if letter in ROLE_OF else no} END")
    gone = [then(f"t{i}", "D", str(DELETE), "") for i in range(4)]
    nothing = f"{{'c': {NEVER}, 'a': '', 'o': ''}}"
    return f"""WITH RECURSIVE {CRC_TABLE}k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations),
f AS (SELECT k.*, {crc_sql('place')} % 20 AS fate FROM k, crc),
g AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
       CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
       unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE fate <> 0),
o AS (SELECT *, left(role, 1) AS initial, row_number() OVER (
       PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM g),
h AS (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before,
       CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
rows_ AS (SELECT *, CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS late FROM h),
walk AS (SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'o': ''}} AS s0, {nothing} AS s1, {nothing} AS s2, {nothing} AS s3
         FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {gone[0]}, {least(gone[1], own('t0', 's'))},
         {least(gone[2], own('t0', 'u'), own('t1', 'u'), own('t3', 'u'))}, {least(gone[3], own('t2', 'a'))}
  FROM (SELECT r.conv_id, r.i, r, s0 AS t0, s1 AS t1, t2, s3 AS t3_, {least('s3', insert('t2', 'a'))} AS t3
        FROM (SELECT walk.*, {least('s2', insert('s0', 'u'), insert('s1', 'u'), insert('s3', 'u'))} AS t2 FROM walk) walk
        JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM walk.conv_id AND r.i = walk.i + 1)),
done AS (SELECT conv_id, i, {least('s0', insert('q1', 'a'), insert('s2', 'a'), 's3')} AS best
         FROM (SELECT *, {insert('s1', 'u')} AS q1 FROM walk)),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(i) AS n,
       count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
       count(*) FILTER (fault = 'truncated') AS truncated,
       count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
       FROM rows_ GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit, sha256(best.o) AS repaired_sha256
FROM done d LEFT JOIN facts f ON d.conv_id IS NOT DISTINCT FROM f.conv_id
WHERE d.i = coalesce(f.n, 0)"""


SQL = _sql()
