r"""Repairing the structure of conversations by alignment to a grammar.

The role initials of a well-formed conversation are empty, or an optional
``s`` and then ``ua`` once or more. Each row is kept (K, 0), given role user or
assistant (R, 1) or deleted (D, 2; the only way for blank rows and
duplicates), and empty user or assistant rows are inserted (I, 5); a truncated
row that isn't deleted adds 5. The audit is the string of edits.

The strings of the grammar have one shape for each length: ``(ua)*`` of even
lengths and ``s(ua)*`` of odd ones, whose ``s`` must be a kept row. Rows are
aligned to the string of each feasible length by Wagner-Fischer. What remains
of such a string after some of its symbols depends only on how many remain, so
all lengths read one table: the cost of aligning the rows from i on to the
last r symbols, filled from the last row backwards. A greedy repair gives an
incumbent cost C; since every row more than symbols costs a deletion and every
symbol more than rows an insertion, only cells with ``-C/2 <= r - rows left <=
C/5`` can lie on a repair that is as good (Ukkonen's band). The audits of all
lengths with the least cost are traced back in step and compared letter by
letter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import SEPARATORS

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
D, I, K, R = 1, 2, 4, 8                        # bits of the edits that go on to a cheapest repair
FAR = np.int64(1 << 40)
SPACES = "".join(map(chr, SEPARATORS))
LEGAL = ("su", "ua", "au")


def _symbol(r: int) -> str:
    """The first of the last r symbols of the grammar's strings."""
    return "a" if r % 2 else "u"


def _greedy(initials: list[str], truncated: list[bool]) -> int:
    """The cost of a simple repair: keep what fits and is whole, delete the
    rest, and answer a last user row by an insertion."""
    cost, want = 0, "u"
    for i, (c, cut) in enumerate(zip(initials, truncated)):
        if c == want and not cut:
            want = "a" if want == "u" else "u"
        else:
            cost += DELETE
    return min(cost + (INSERT if want == "a" else 0), DELETE * len(initials))


class Alignment:
    """Costs and edits of aligning some rows (initials, truncated) to the last
    r symbols, for all r inside the band.

    Only every step-th row of costs is kept, about the square root of their
    number; the rows between are filled again when the trace gets to them."""

    def __init__(self, initials: list[str], truncated: list[bool]):
        self.n = len(initials)
        self.extra = np.array(truncated, np.int64) * TRUNCATED
        self.miss = {c: np.array([x != c for x in initials], np.int64) for c in "ua"}
        self.incumbent = _greedy(initials, truncated)
        self.down, self.up = self.incumbent // DELETE, self.incumbent // INSERT
        self.width = self.down + self.up + 1       # cell k of row i holds r = (rows left) - down + k
        self.step = max(64, math.isqrt(self.n) + 1)
        self.kept = {self.n: self._last()}
        self.best_s, self.held = None, (-1, {})
        row, costs_s = self.kept[self.n], []
        for i in range(self.n - 1, -1, -1):
            if initials[i] == "s":                 # a string of odd length that keeps this row first
                r, cost = self._even(i + 1, row, 2)
                costs_s.append((int(cost.min(initial=FAR)) + DELETE * i + int(self.extra[i]), i, r[cost == cost.min(initial=FAR)]))
            row = self._fill(i, row)[0]
            if i % self.step == 0:
                self.kept[i] = row
        r, cost = self._even(0, row, 0)
        self.cost = int(cost.min(initial=FAR))
        self.even = r[cost == self.cost]
        for total, i, r in costs_s:                # later rows first: of equal cost the one after most deletions is ASCII-least
            if total <= self.cost and (self.best_s is None or total < self.best_s[0]):
                self.best_s = (total, i, r)
        if self.best_s and self.best_s[0] < self.cost:
            self.cost, self.even = self.best_s[0], np.zeros(0, np.int64)

    def _cells(self, i: int) -> np.ndarray:
        return np.arange(self.width) + (self.n - i - self.down)

    def _last(self) -> np.ndarray:
        r = self._cells(self.n)
        return np.where(r >= 0, r * INSERT, FAR)

    def _even(self, i: int, row: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        r = self._cells(i)
        on = (r >= least) & (r % 2 == 0)
        return r[on], row[on]

    def _fill(self, i: int, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs of row i from those of row i + 1, and the edits by cell. With
        one row less left, the cell of the same r lies one further on."""
        r = self._cells(i)
        delete = np.append(after[1:], FAR) + DELETE
        change = np.where(r % 2 == 1, self.miss["a"][i], self.miss["u"][i])
        move = np.where(r >= 1, after + change * REROLE + self.extra[i], FAR)
        best = np.where(r >= 0, np.minimum(delete, move), FAR)
        # insertions: the least over smaller r of cost + 5 per symbol, a running minimum
        slope = np.arange(self.width) * INSERT
        cost = np.minimum(np.minimum.accumulate(best - slope) + slope, FAR)
        insert = np.append(FAR, cost[:-1]) + INSERT
        edits = (delete == cost) * D + (insert == cost) * I + (move == cost) * np.where(change == 0, K, R)
        return cost, np.where(cost < FAR, edits, 0).astype(np.uint8)

    def _edits(self, i: int) -> np.ndarray:
        """The edits of row i, from its block of rows filled again."""
        block = i // self.step
        if self.held[0] != block:
            low, high = block * self.step, min(self.n, (block + 1) * self.step)
            row, edits = self.kept[high], {}
            for j in range(high - 1, low - 1, -1):
                row, edits[j] = self._fill(j, row)
            self.held = (block, edits)
        return self.held[1][i]

    def _trace(self, i: int, r: np.ndarray, forced: np.ndarray, place: int) -> str:
        """The least of the audits that go on from row i with any of the r
        symbols left; ``forced``: which of all rows must go, ``place``: of all rows."""
        out = []
        while True:
            if place < len(forced) and forced[place]:
                out.append("D")
                place += 1
            elif i == self.n:
                out.append("I" * int(r.min()))          # the shortest is a prefix of the others
                return "".join(out)
            else:
                edits = self._edits(i)[r - (self.n - i - self.down)]
                for letter, bit in (("D", D), ("I", I), ("K", K), ("R", R)):
                    on = (edits & bit) > 0
                    if on.any():
                        break
                out.append(letter)
                r = r[on] - (letter != "D")
                if letter != "I":
                    i, place = i + 1, place + 1

    def audit(self, forced: np.ndarray) -> str:
        found = []
        if len(self.even):
            found.append(self._trace(0, self.even, forced, 0))
        if self.best_s:
            _, i, r = self.best_s
            place = int(np.flatnonzero(~forced)[i])
            found.append("D" * place + "K" + self._trace(i + 1, r, forced, place + 1))
        return min(found)


def cheapest(initials: list[str], forced: list[bool], truncated: list[bool]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of some rows, ASCII-least of equals."""
    gone = np.array(forced, bool)
    free = np.flatnonzero(~gone).tolist()
    alignment = Alignment([initials[i] for i in free], [truncated[i] for i in free])
    return alignment.cost + DELETE * int(gone.sum()), alignment.audit(gone)


class _Conversation:
    """One conversation: first its rows without texts (role initials, faults,
    the texts seen as 16-byte digests), then, once repaired, its edits in turn."""

    def __init__(self, name):
        self.name, self.initials, self.faults, self.seen = name, [], [], set()
        self.first = self.last = self.audit = None
        self.distinct = self.at = 0

    def add(self, turn, initial: str, digest: bytes, blank: bool, truncated: bool) -> None:
        self.faults.append("blank" if blank else "duplicate" if digest in self.seen else "truncated" if truncated else None)
        self.seen.add(digest)
        self.initials.append(initial)
        if turn is not None:
            self.distinct += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn

    def solve(self) -> dict:
        """The row of the audit."""
        cost, self.audit = cheapest(self.initials, [f in ("blank", "duplicate") for f in self.faults], [f == "truncated" for f in self.faults])
        out = {f: self.faults.count(f) for f in ("blank", "duplicate", "truncated")}
        out |= {"conv_id": self.name, "step": 0, "gaps": 0 if self.first is None else self.last - self.first + 1 - self.distinct, "cost": cost, "audit": self.audit,
                "illegal": sum(a + b not in LEGAL for a, b in zip(self.initials, self.initials[1:]))}
        self.initials, self.faults, self.seen, self.symbols = [], [], set(), sum(e != "D" for e in self.audit)
        return out

    def _edit(self, **row) -> dict:
        """The next edit; ``symbols`` counts down to the end of the grammar's string."""
        letter, self.at = self.audit[self.at], self.at + 1
        if letter != "D":
            row["role"] = {"u": "user", "a": "assistant"}[_symbol(self.symbols)] if letter in "IR" else row["role"]
            self.symbols -= 1
        return {"conv_id": self.name, "step": self.at, "edit": letter} | row

    def inserted(self) -> Iterator[dict]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield self._edit(turn=None, role=None, text="")

    def row(self, turn, role: str, text: str) -> Iterator[dict]:
        yield from self.inserted()
        yield self._edit(turn=turn, role=role, text=text)


AUDIT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
BATCH_ROWS, BATCH_CHARS = 4096, 1 << 22


def _schema(conv: str, turn: str) -> str:
    return f"conv_id {conv}, step long, edit string, turn {turn}, role string, text string, " + ", ".join(f"{c} long" for c in AUDIT[:-1]) + ", audit string"


def _arrow(kind: str) -> pa.DataType:
    return {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}.get(kind, pa.string())


def _repair(conv: str, turn: str):
    fields = [("conv_id", _arrow(conv)), ("step", pa.int64()), ("edit", pa.string()), ("turn", _arrow(turn)), ("role", pa.string()), ("text", pa.string()),
              *((c, pa.int64()) for c in AUDIT[:-1]), ("audit", pa.string())]
    schema = pa.schema(fields)

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now = None
        for batch in batches:
            for name, kind, turn, role, digest, blank, truncated, gone, text in zip(*(batch.column(i).to_pylist() for i in range(9))):
                if now is None or now.name != name:
                    if now is not None:
                        if now.audit is None:
                            yield now.solve()
                        yield from now.inserted()
                    now = _Conversation(name)
                if gone:
                    continue
                if kind == 0:
                    now.add(turn, role[:1], digest, blank, truncated)
                else:
                    if now.audit is None:
                        yield now.solve()
                    yield from now.row(turn, role, text)
        if now is not None:
            if now.audit is None:
                yield now.solve()
            yield from now.inserted()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = [], 0
        for row in edits(batches):
            held.append(row)
            chars += len(row.get("text") or "") + len(row.get("audit") or "")
            if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
                yield pa.RecordBatch.from_pylist(held, schema)
                held, chars = [], 0
        yield pa.RecordBatch.from_pylist(held, schema)
    return run


def _edited(turns: DataFrame, dropped: str | None) -> DataFrame:
    """All edits (step 1, 2, ...) of each conversation behind its audit (step
    0), in order inside a partition."""
    kinds = dict(turns.dtypes)
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    gone = F.coalesce(F.col(dropped), F.lit(False)) if dropped else F.lit(False)
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), gone.alias("gone"))
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    rows = rows.select(
        "conv_id", "turn", "role", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("digest"),
        (last == "").alias("blank"), (~last.isin("", ".", "!", "?")).alias("truncated"), "gone", "text",
        F.explode(F.when(F.col("gone"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("kind"))
    rows = rows.select("conv_id", "kind", "turn", "role", "digest", "blank", "truncated", "gone", F.when(F.col("kind") == 1, F.col("text")).alias("text"))
    lined = rows.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return lined.mapInArrow(_repair(kinds["conv_id"], kinds["turn"]), _schema(kinds["conv_id"], kinds["turn"]))


def repair(turns: DataFrame, dropped: str | None = None) -> DataFrame:
    """The edits that repair the conversations of ``turns`` (conv_id, turn,
    role, text): conv_id, step (1, 2, ...), edit (K, R, D or I), turn (null for
    insertions), role and text. Rows with another edit than D, in order of step,
    are the repaired conversation.

    Rows are taken by turn, nulls first (ties: by role, then a hash of the
    text, so equal rows are neighbours). A null role or text is one space. A
    blank row has no character but 0x20 and 0x09-0x0D, a duplicate a role and
    text seen earlier in its conversation (by 128-bit digest), a truncated
    one's last character other than these isn't ``.``, ``!`` or ``?``; the first
    of these faults counts. Rows without conv_id are one conversation (null).
    Rows whose boolean column ``dropped`` is true aren't turns, but their
    conversation appears in ``audits``. Other columns are ignored; an empty
    table gives an empty result.

    Conversations are read in order from a sorted shuffle, first without texts
    and then with them, so no conversation's texts are held whole; what is held
    of the one being repaired is some 100 bytes a row and the square root of
    its rows times the band of its costs."""
    return _edited(turns, dropped).where("step > 0").select("conv_id", "step", "edit", "turn", "role", "text")


def audits(turns: DataFrame, dropped: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps (turn numbers missing between
    the least and the largest), blank, duplicate, truncated (rows by first
    fault), illegal (neighbours whose role initials aren't su, ua or au), cost
    and audit. See ``repair``."""
    return _edited(turns, dropped).where("step = 0").select("conv_id", *AUDIT)


def _digest(conv: str):
    names = ["conv_id", *AUDIT, "repaired_sha256"]
    types = [_arrow(conv), *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, lines = None, None, 0
        for batch in batches:
            out = []
            steps, roles, texts, letters = (batch.column(c).to_pylist() for c in ("step", "role", "text", "edit"))
            for i, step in enumerate(steps):
                if step == 0:
                    if now is not None:
                        out.append([*now, sha.hexdigest()])
                    now, sha, lines = [batch.column(c)[i].as_py() for c in names[:-1]], hashlib.sha256(), 0
                elif letters[i] != "D":
                    sha.update(f"{chr(10) if lines else ''}{roles[i]}:{texts[i]}".encode())
                    lines += 1
            yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate(types)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([*now, sha.hexdigest()], types)], names)
    return run


def digests(turns: DataFrame, dropped: str | None = None) -> DataFrame:
    """``audits`` with repaired_sha256: the SHA-256 of the repaired rows as
    ``role:text``, joined by newlines, read from the edits as they come."""
    conv = dict(turns.dtypes)["conv_id"]
    return _edited(turns, dropped).mapInArrow(_digest(conv), f"conv_id {conv}, " + ", ".join(f"{c} long" for c in AUDIT[:-1]) + ", audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """Planted damage, by crc32 of ``conv_id:turn`` modulo 20: 0 marks a row as
    dropped, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats
    it, 4 gives it role user. Nulls are one space."""
    space = F.lit(" ")
    code = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("code") == 0).alias("dropped"), copies.alias("_")).drop("_")
