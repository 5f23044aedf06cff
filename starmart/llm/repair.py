"""Conversation structure repair: the cheapest edits that give a conversation the shape `(s?(ua)+)?`, by IDA*.

Rows of a conversation are taken by turn (nulls first, then by role and text). Each has at most one fault, the first of: blank
(nothing but white space), duplicate (role and text seen earlier), truncated (its last character that is no white space
is none of `.!?`). Edits: Keep 0, Rerole to the role that is due 1, Delete 2 (the only one for blank and duplicate rows),
Insert an empty row of the role that is due 5; a truncated row that stays adds 5. Which role is due follows from the
edits before, so a string of edits says all.

The search is iterative-deepening A*: depth first, edits in ASCII order, under a cost bound that rises to the least cost
that exceeded it. States (row, shape, inserts just made) that failed keep the cost they are known to need, which prunes
later visits and is the lower bound of the next round; before that, the bound is 2 for every faulty row ahead. Short searches from
the last rows fill that table before those from the first row. The first path that arrives
is the cheapest, and of equally cheap ones the ASCII-least. More than two inserts in a row lead to no new shape and are not tried.

Conversations may be of any length: rows are ordered by range over all tasks and cut into pieces of at most PIECE rows. A
piece is searched once for each shape before and after it (4 by 4; one, if it is a whole conversation). A table of 16 costs, and of the order of the
16 strings, is all that is chained over a whole conversation; inserts stand before a row or at the end of the
conversation, so no two strings of one piece are each other's beginning, and comparing them piece by piece compares
the whole. The digest is one running hash over all rows of a conversation, so these pass through
one task as a sorted stream, a piece at a time.

Null role or text: one space. Null conv_id: a conversation of its own. Null turns come first and do not count for gaps. Roles
of any name are taken by their first letter; an empty role has none and fits nowhere. Repeated rows are duplicates.
A conversation without rows has zeros, an empty audit and the hash of the empty string; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import inf

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from starmart.session import materialize

PIECE = 64                   # rows of a piece
STRIDE = 6                   # rows between the starts of the short searches
PIECE_BYTES = 1 << 20        # of text, unless one row has more
WHITE = " \t\n\x0b\x0c\r"

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
# Shapes: 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row.
FITS = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
DUE = [("user", 2), ("user", 2), ("assistant", 3), ("user", 2)]
ENDING = ["", "II", "I", ""]                       # inserts that complete each shape at the end
END = 4                                            # as a goal: the conversation ends, completed
LEGAL = {"su", "ua", "au"}


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of `conv_id:turn` modulo 20; nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(times).alias("time")).drop("time")


@lru_cache(maxsize=4096)
def _moves(initial: str, fault: int) -> tuple[list, list]:
    """For each shape the moves from a row, in ASCII order of their edits: (edit, cost, rows taken, shape after); with and
    without insertion."""
    more = 5 if fault == TRUNCATED else 0
    full, bare = [], []
    for shape in range(4):
        due = DUE[shape][1]
        moves = [("D", 2, 1, shape), ("I", 5, 0, due)]
        if fault not in (BLANK, DUPLICATE):
            if initial in FITS[shape]:
                moves.append(("K", more, 1, FITS[shape][initial]))
            moves.append(("R", 1 + more, 1, due))
        full.append(moves)
        bare.append([m for m in moves if m[0] != "I"])
    return full, bare


class Search:
    """All searches for one shape after the rows, (initial, fault) each. What failed is known to need more from there on, whatever
    came before, so the searches share one table."""

    def __init__(self, rows: list[tuple[str, int]], goal: int):
        self.goal, self.n = goal, len(rows)
        self.moves = [_moves(*row) for row in rows]
        self.least = [0] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            self.least[i] = self.least[i + 1] + (2 if rows[i][1] else 0)
        self.needs: dict[tuple[int, int, int], float] = {}
        # short searches from rows near the end first, so that those from the start meet few surprises
        for start in range((self.n - 1) // STRIDE * STRIDE, 0, -STRIDE):
            for shape in range(4):
                self.best(shape, start)

    def best(self, shape: int, start: int = 0) -> tuple[int, str] | None:
        """Cost and edits of the best way from `shape` before row `start`; None if there is none."""
        bound = self.needs.get((start, shape, 0), self.least[start])
        while bound < inf:
            path, low = self._descend(start, shape, 0, bound)
            if path is not None:
                self.needs[start, shape, 0] = bound
                return int(bound), "".join(reversed(path))
            bound = low
        return None

    def _descend(self, i: int, shape: int, inserts: int, left: float):
        """The edits in reverse if `left` is enough, else None and a lower bound of what is needed."""
        state = (i, shape, inserts)
        need = self.needs.get(state)
        if need is None:
            need = self.least[i]
        if need > left:
            return None, need
        if i == self.n:
            if self.goal == END:
                need = 5 * len(ENDING[shape])
                return (list(ENDING[shape]), 0) if need <= left else (None, need)
            return ([], 0) if shape == self.goal else (None, inf)
        need = inf
        for edit, cost, step, after in self.moves[i][inserts == 2][shape]:
            path, low = self._descend(i + step, after, 0 if step else inserts + 1, left - cost)
            if path is not None:
                path.append(edit)
                return path, 0
            if cost + low < need:
                need = cost + low
        self.needs[state] = need
        return None, need


def search(rows: list[tuple[str, int]], entry: int, goal: int) -> tuple[int, str] | None:
    """Cost and edits of the best way from shape `entry` to shape `goal`, None if there is none."""
    return Search(rows, goal).best(entry)


def table_of(rows: list[tuple[str, int]], entries, ends: bool = False) -> tuple[list[int], list[int], list[str]]:
    """For entry * 4 + exit: cost (-1: impossible), the string's place among those of the same entry, the string. If the
    conversation ends here, the only exit is 3, complete, with the inserts that this takes."""
    costs, places, edits = [-1] * 16, [0] * 16, [""] * 16
    searches = {3: Search(rows, END)} if ends else {goal: Search(rows, goal) for goal in range(4)}
    for entry in entries:
        found = {goal: f for goal, s in searches.items() if (f := s.best(entry))}
        for place, goal in enumerate(sorted(found, key=lambda g: found[g][1])):
            at = entry * 4 + goal
            (costs[at], edits[at]), places[at] = found[goal], place
    return costs, places, edits


def chain(tables: list[tuple[list[int], list[int]]]) -> tuple[int, list[int], str]:
    """Tables of consecutive pieces: total cost, for each piece which of its 16 strings, and the inserts at the end."""
    rest = [[5 * len(x) for x in ENDING]]
    for costs, _ in reversed(tables):
        rest.append([min((costs[x * 4 + y] + rest[-1][y] for y in range(4) if costs[x * 4 + y] >= 0), default=inf) for x in range(4)])
    rest.reverse()
    shape, chosen = 0, []
    for k, (costs, places) in enumerate(tables):
        ways = [y for y in range(4) if costs[shape * 4 + y] >= 0 and costs[shape * 4 + y] + rest[k + 1][y] == rest[k][shape]]
        goal = min(ways, key=lambda y: places[shape * 4 + y])
        chosen.append(shape * 4 + goal)
        shape = goal
    return int(rest[0][0]), chosen, ENDING[shape]


def repaired(roles: list[str], texts: list[str], edits: str, shape: int):
    """The rows that a piece's edits leave, as `role:text`; `shape` is the one before the piece."""
    at = 0
    for edit in edits:
        due, after = DUE[shape]
        if edit == "I":
            yield f"{due}:"
        elif edit == "R":
            yield f"{due}:{texts[at]}"
        elif edit == "K":
            yield f"{roles[at]}:{texts[at]}"
            after = FITS[shape][roles[at][0]]
        shape = after if edit != "D" else shape
        at += edit != "I"


def _annotated(rows: DataFrame) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = rows.select("conv_id", "turn", space("role"), space("text"))
    bare = F.rtrim("text", F.lit(WHITE))
    rows = rows.select("*", F.md5("text").alias("digest"), (bare == "").alias("blank"),
                       (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    # what stands at several turns; repeats at one turn follow each other in the order and are seen there
    at = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    again = rows.groupBy("conv_id", "role", "digest").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last")
    a, b = rows.alias("a"), again.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest"))
    later = F.struct(F.col("a.turn").isNotNull().alias("given"), F.col("a.turn").alias("turn")) > F.col("b.first")
    return a.join(b, same, "left").select("a.*", F.coalesce(later, F.lit(False)).alias("later")).drop("digest")


def _piece_schema(conv: str) -> str:
    return (f"conv_id {conv}, piece bigint, roles array<string>, texts array<string>, costs array<int>, places array<int>, edits array<string>, "
            "faults array<bigint>, turns array<bigint>, ends array<string>")


def pieces(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """All conversations in order, cut into pieces, each with its table and counts.

    faults: blank, duplicate, truncated, illegal pairs inside, distinct turns; turns: the first and the last that is not null;
    ends: the initials of the first and the last row.
    """
    keys = ["conv_id", "turn", "role", "text"]
    ordered = _annotated(rows).repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = _piece_schema(rows.schema["conv_id"].dataType.simpleString())

    def cut(batches):
        number = TaskContext.get().partitionId() << 40
        piece, previous, before = [], None, None            # before: (conv_id,) of the piece before, in this task

        def close(ends=False):
            marked = [(r["role"][:1], r["fault"]) for r in piece]
            initials = [m[0] for m in marked]
            given = [r["turn"] for r in piece if r["turn"] is not None]
            kinds = [m[1] for m in marked]
            # what follows another conversation begins its own; the first piece of a task may go on with one
            costs, places, edits = table_of(marked, [0] if before and before[0] != piece[0]["conv_id"] else range(4), ends)
            illegal = sum(x + y not in LEGAL for x, y in zip(initials, initials[1:]))
            return {"conv_id": piece[0]["conv_id"], "piece": number, "roles": [r["role"] for r in piece], "texts": [r["text"] for r in piece],
                    "costs": costs, "places": places, "edits": edits,
                    "faults": [kinds.count(BLANK), kinds.count(DUPLICATE), kinds.count(TRUNCATED), illegal, len(set(given))],
                    "turns": given[:1] + given[-1:], "ends": [initials[0], initials[-1]]}

        used = 0
        for batch in batches:
            out = []
            conv_type = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                conv = row["conv_id"]
                if piece and (conv != piece[0]["conv_id"] or len(piece) == size or used > PIECE_BYTES):
                    out.append(close(conv != piece[0]["conv_id"]))
                    before = (piece[0]["conv_id"],)
                    number, piece, used = number + 1, [], 0
                row["fault"] = BLANK if row["blank"] else DUPLICATE if row["later"] or key == previous else TRUNCATED if row["cut"] else 0
                piece.append(row)
                used += len(row["text"])
                previous = key
            if out:
                yield _batch(out, conv_type)
        if piece:
            yield _batch([close()], conv_type)

    return ordered.mapInArrow(cut, schema)


def _batch(rows: list[dict], conv) -> pa.RecordBatch:
    listed = pa.list_
    return pa.RecordBatch.from_pylist(rows, pa.schema([
        ("conv_id", conv), ("piece", pa.int64()), ("roles", listed(pa.string())), ("texts", listed(pa.string())), ("costs", listed(pa.int32())),
        ("places", listed(pa.int32())), ("edits", listed(pa.string())), ("faults", listed(pa.int64())), ("turns", listed(pa.int64())),
        ("ends", listed(pa.string()))]))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _summary(heads: list[dict]) -> tuple[dict, list[int], str]:
    cost, chosen, ending = chain([(h["costs"], h["places"]) for h in heads])
    blank, duplicate, truncated, illegal, distinct = (sum(h["faults"][k] for h in heads) for k in range(5))
    illegal += sum(a["ends"][1] + b["ends"][0] not in LEGAL for a, b in zip(heads, heads[1:]))
    turns = [h["turns"] for h in heads if h["turns"]]
    distinct -= sum(a[-1] == b[0] for a, b in zip(turns, turns[1:]))
    gaps = turns[-1][-1] - turns[0][0] + 1 - distinct if turns else 0
    return dict(zip(COUNTS, (gaps, blank, duplicate, truncated, illegal, cost))), chosen, ending


def finish(cut: DataFrame) -> DataFrame:
    """One row per conversation with rows. Tables of all its pieces come before the first piece with text, so the
    choice is known when the texts stream by."""
    conv = cut.schema["conv_id"].dataType.simpleString()
    heads = cut.select("conv_id", F.lit(0).alias("body"), "piece", "costs", "places", "faults", "turns", "ends",
                       *[F.lit(None).cast("array<string>").alias(c) for c in ("roles", "texts", "edits")])
    bodies = cut.select("conv_id", F.lit(1).alias("body"), "piece",
                        *[F.lit(None).cast(t).alias(c) for c, t in (("costs", "array<int>"), ("places", "array<int>"), ("faults", "array<bigint>"),
                                                                    ("turns", "array<bigint>"), ("ends", "array<string>"))],
                        "roles", "texts", "edits")
    stream = heads.unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "body", "piece")

    def run(batches):
        heads, told, conv_type = [], None, pa.int64()

        def result():
            counts, _, ending, shape, audit, digest, _ = told
            for line in repaired([], [], ending, shape):
                digest.update(line)
            return {"conv_id": heads[0]["conv_id"], **counts, "audit": "".join(audit) + ending, "repaired_sha256": digest.hexdigest()}

        for batch in batches:
            out = []
            conv_type = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if row["body"] == 0:
                    if told:
                        out.append(result())
                        heads, told = [], None
                    heads.append(row)
                    continue
                if told is None:
                    counts, chosen, ending = _summary(heads)
                    told = [counts, iter(chosen), ending, 0, [], Lines(), None]
                pick = next(told[1])
                told[4].append(row["edits"][pick])
                for line in repaired(row["roles"], row["texts"], row["edits"][pick], pick // 4):
                    told[5].update(line)
                told[3] = pick % 4
            if out:
                yield _results(out, conv_type)
        if told:
            yield _results([result()], conv_type)

    return stream.mapInArrow(run, f"conv_id {conv}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string")


class Lines:
    """SHA-256 of lines joined by newlines."""

    def __init__(self):
        self.hash, self.any = hashlib.sha256(), False

    def update(self, line: str) -> None:
        self.hash.update((f"\n{line}" if self.any else line).encode())
        self.any = True

    def hexdigest(self) -> str:
        return self.hash.hexdigest()


def _results(rows: list[dict], conv) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([("conv_id", conv), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()),
                                                       ("repaired_sha256", pa.string())]))


def repair(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """conv_id, turn, role, text -> conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    return finish(materialize(pieces(rows, size), "conversation-pieces"))


def report(conversations: DataFrame, size: int = PIECE) -> DataFrame:
    """Every conversation of the table after damage, also those of which no row is left."""
    found = repair(damage(conversations), size).alias("f")
    every = conversations.select("conv_id").distinct().alias("e")
    zero = lambda c: F.coalesce(F.col(f"f.{c}"), F.lit(0)).alias(c)
    return every.join(found, F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")), "left").select(
        "e.conv_id", *[zero(c) for c in COUNTS], F.coalesce("f.audit", F.lit("")).alias("audit"),
        F.coalesce("f.repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
