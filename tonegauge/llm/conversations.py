"""Repairs the structure of conversations at least cost.

A conversation is well formed if the first letters of its roles read ``(s?(ua)+)?``. Each row is kept
(K, cost 0), given another role (R, 3) or deleted (D, 4, which blank rows and duplicates must be), and
rows without text may be inserted (I, 3); an undeleted truncated row adds 3. Depth-first branch and
bound finds the cheapest edits and, among them, the letters least in ASCII: an explicit stack, lower
bounds of what the remaining rows cost, an incumbent, and the best prefix met at every (row, state).

Rows are sorted over all tasks by conversation and turn, so one large conversation lies in many tasks.
Conversations that begin and end inside a task are repaired there. Those at the edge of a task, or of
more than LONG rows, are cut into segments of at most SEGMENT rows: each segment is searched for every
state it may begin and end in, which is exact as equally cheap edits of the same rows never continue
each other, and segments are then joined. What joins segments holds their edits only; the hash of a
repaired conversation is by its definition a single stream and is fed row by row.

Defined cases: null roles and texts, and null ids and turns in the damage's hash, are one space. Null
turns come first; rows of one turn go by role and text, and equal rows count each time. A null id is a
conversation of its own. An empty role has no initial and can't be kept. A conversation without rows
gets zeros, an empty audit and the hash of an empty string. An empty table gives no rows. Columns
besides the four are ignored.
"""

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tonegauge.llm.common import SPACE, written

LONG = 4096
SEGMENT = 128
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a; and the roles' initials that lead on from them.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
COMPLETE = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
ROW = "turn long, role string, text string, times int"


class Turn(NamedTuple):
    role: str
    text: str
    fault: str

    @property
    def initial(self) -> str:
        return self.role[:1]


def fault_of(text: str, seen: bool) -> str:
    """A row's first fault, or nothing."""
    end = text.rstrip(SPACE)
    if not end:
        return "blank"
    if seen:
        return "duplicate"
    return "" if end[-1] in ".!?" else "truncated"


def least_cost(turn: Turn) -> int:
    """What a row costs at least, whatever stands around it."""
    if turn.fault in ("blank", "duplicate"):
        return DELETE
    added = TRUNCATED if turn.fault == "truncated" else 0
    return min(DELETE, added + (0 if turn.initial in ("s", "u", "a") else REROLE))


def wanted(state: int) -> str:
    """The initial that an inserted row, or one with a new role, has to have."""
    return "a" if state == USER else "u"


def edits(turn: Turn | None, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the possible edits in ASCII order; without a row only insertion."""
    after = NEXT[state, wanted(state)]
    found = [("I", INSERT, after)]
    if turn is None:
        return found
    found.insert(0, ("D", DELETE, state))
    if turn.fault not in ("blank", "duplicate"):
        added = TRUNCATED if turn.fault == "truncated" else 0
        if (state, turn.initial) in NEXT:
            found.append(("K", added, NEXT[state, turn.initial]))
        found.append(("R", REROLE + added, after))
    return found


#: Cost of the insertions that lead from one state to another before a row.
SHIFT = {(START, USER): INSERT, (START, ASSISTANT): 2 * INSERT, (SYSTEM, USER): INSERT,
         (SYSTEM, ASSISTANT): 2 * INSERT, (USER, ASSISTANT): INSERT, (ASSISTANT, USER): INSERT}


def first_guess(turns: list[Turn], entry: int, tail: bool) -> tuple[list[dict[int, int]], int]:
    """Edits that take the cheapest at each row: what they need to reach each (row, state), insertions
    included, and their complete cost."""
    state, cost, reached = entry, 0, []
    for turn in turns:
        reached.append({state: cost, **{t: cost + more for (s, t), more in SHIFT.items() if s == state}})
        _, more, state = min((e for e in edits(turn, state) if e[0] != "I"), key=lambda e: (e[1], e[0]))
        cost += more
    reached.append({state: cost})
    if tail:
        reached[-1] |= {t: cost + more for (s, t), more in SHIFT.items() if s == state}
    return reached, min((c for t, c in reached[-1].items() if t in COMPLETE), default=cost)


def search(turns: list[Turn], entry: int, tail: bool) -> dict[int, tuple[int, str]]:
    """The least (cost, audit) by final state. With ``tail``, rows may be inserted behind the last and only
    the best complete result counts; without, every final state has its own."""
    n = len(turns)
    rest = [0] * (n + 1)
    for at in range(n - 1, -1, -1):
        rest[at] = rest[at + 1] + least_cost(turns[at])
    reached, most = first_guess(turns, entry, tail)
    incumbent = (most, "~")  # a cost that can be had; any real audit is less
    best: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        if tail and (cost + rest[at], audit) > (incumbent[0], incumbent[1][:len(audit)]):
            continue
        known = best.get((at, state))
        if (known is not None and known <= (cost, audit)) or cost > reached[at].get(state, cost):
            continue
        best[at, state] = cost, audit
        if at < n:
            for (s, t), more in SHIFT.items():
                if s == state and cost + more < reached[at].get(t, cost + more + 1):
                    reached[at][t] = cost + more
        elif not tail:
            continue
        elif state in COMPLETE:
            incumbent = min(incumbent, (cost, audit))
        # The last pushed comes first: letters in ASCII order, so equal costs meet their least audit first.
        for letter, more, after in reversed(edits(turns[at] if at < n else None, state)):
            stack.append((at + (letter != "I"), after, cost + more, audit + letter))
    if tail:
        return {ASSISTANT: incumbent}
    return {state: best[n, state] for state in range(4) if (n, state) in best}


def crossings(turns: list[Turn], entries: Iterable[int] = range(4)) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of a segment for every pair of states that edits connect."""
    return [(entry, leave, *found) for entry in entries for leave, found in search(turns, entry, False).items()]


def joined(segments: Iterable[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Least cost over all segments in order, and each segment's (entry, edits); the last holds what is
    inserted behind all rows."""
    front = {START: (0, "", None)}
    for cross in segments:
        new: dict[int, tuple] = {}
        for entry, leave, cost, audit in cross:
            if entry in front:
                held = front[entry]
                option = (held[0] + cost, held[1] + audit, (held[2], entry, audit))
                if leave not in new or option[:2] < new[leave][:2]:
                    new[leave] = option
        front = new
    ends = []
    for state, (cost, audit, path) in front.items():
        closing = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}[state]
        ends.append((cost + INSERT * len(closing), audit + closing, (path, state, closing)))
    cost, _, path = min(ends, key=lambda e: e[:2])
    steps = []
    while path is not None:
        path, entry, audit = path
        steps.append((entry, audit))
    return cost, steps[::-1]


def lines(turns: list[Turn], entry: int, audit: str) -> Iterator[str]:
    """The repaired rows as ``role:text``."""
    state, at = entry, 0
    for letter in audit:
        if letter == "I":
            yield NAMES[wanted(state)] + ":"
            state = NEXT[state, wanted(state)]
            continue
        turn = turns[at]
        at += 1
        if letter == "K":
            yield f"{turn.role}:{turn.text}"
            state = NEXT[state, turn.initial]
        elif letter == "R":
            yield f"{NAMES[wanted(state)]}:{turn.text}"
            state = NEXT[state, wanted(state)]


def count_illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def repair(rows: list[tuple]) -> tuple:
    """The result columns of one whole conversation of (turn, role, text, times)."""
    turns, seen, numbers = [], set(), set()
    for turn, role, text, times in rows:
        if times and turn is not None:
            numbers.add(turn)
        for _ in range(times):
            turns.append(Turn(role, text, fault_of(text, (role, text) in seen)))
            seen.add((role, text))
    if len(turns) <= SEGMENT:
        cost, audit = search(turns, START, True)[ASSISTANT]
        steps = [(START, audit)]
        parts = [turns]
    else:
        parts = [turns[i:i + SEGMENT] for i in range(0, len(turns), SEGMENT)]
        cost, steps = joined(crossings(p, range(4) if i else (START,)) for i, p in enumerate(parts))
        parts.append([])
    text = "\n".join(x for p, (entry, audit) in zip(parts, steps) for x in lines(p, entry, audit))
    faults = [t.fault for t in turns]
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            count_illegal([t.initial for t in turns]), cost, "".join(a for _, a in steps),
            hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every row with its damage; a dropped one has times = 0, a repeated one times = 2."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), part(role).alias("role"),
                     part(text).alias("text"),
                     (F.crc32(F.concat(part(conv), F.lit(":"), part(turn)).cast("binary")) % 20).alias("h"))
    body = (F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    times = F.when(F.col("h") == 0, 0).when(F.col("h") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
                       body.alias("text"), times.cast("int").alias("times"))


def ordered(rows: DataFrame) -> DataFrame:
    """Sorted over all tasks; a conversation may lie in several. Range bounds hold beginnings of texts only."""
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role"]
    return rows.repartitionByRange(*keys, F.substring("text", 1, 32)).sortWithinPartitions(*keys, "text")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple], bool]]:
    """(id, rows, ends) of consecutive rows of an id, cut where they get LONG; ``ends`` with the id."""
    held, rows = None, []
    for batch in batches:
        for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and (key != held or len(rows) == LONG):
                yield held, rows, key != held
                rows = []
            held = key
            rows.append(tuple(row))
    if rows:
        yield held, rows, True


def _inside(kind: str, sorted_rows: DataFrame) -> DataFrame:
    """Results of conversations inside a task, and the rows of all others (open)."""
    schema = f"conv_id {kind}, open boolean, {RESULT}, {ROW}"
    fields = _arrow(schema)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, before, first = [], 0, None, True
        whole = True  # whether the run before the current one ended its id
        for key, rows, ends in _runs(batches):
            if before is not None:
                done = _finished(*before)
                size += sum(len(r[-2] or "") + 64 for r in done)
                out += done
                if size > 4_000_000:
                    yield batch(out)
                    out, size = [], 0
            before = key, rows, first or not whole or not ends
            first, whole = False, ends
        if before is not None:
            out += _finished(before[0], before[1], True)  # the next task may go on
        if out:
            yield batch(out)

    return sorted_rows.mapInArrow(run, schema)


def _finished(key: object, rows: list[tuple], is_open: bool) -> list[tuple]:
    if is_open:
        return [(key, True, *[None] * 8, *r) for r in rows]
    return [(key, False, *repair(rows), *[None] * 4)]


def _segments(kind: str, rows: DataFrame) -> DataFrame:
    """Rows of open conversations as one row per segment, named by task and place."""
    schema = (f"conv_id {kind}, part int, segment long, turns array<long>, roles array<string>, "
              "texts array<string>, times array<int>")
    fields = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for key, rows, _ in _runs(batches):
            # A repeated row is two rows from here on, a dropped one tells of its conversation only.
            flat = [(t, r, x, 1) for t, r, x, n in rows for _ in range(n)] or [(None, "", "", 0)]
            for at in range(0, len(flat), SEGMENT):
                columns = zip(*flat[at:at + SEGMENT])
                yield pa.RecordBatch.from_pylist([{
                    "conv_id": key, "part": part, "segment": number,
                    **dict(zip(("turns", "roles", "texts", "times"), map(list, columns)))}], fields)
                number += 1

    return ordered(rows).select("conv_id", "turn", "role", "text", "times").mapInArrow(run, schema)


def _arrow(ddl: str) -> pa.Schema:
    """Arrow's form of a schema; on the driver, which alone reads such strings."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def _turns(row: dict) -> list[Turn]:
    """Rows of a segment; those not listed as the first with their role and text are duplicates."""
    first = set(row["firsts"] or ())
    return [Turn(role, text, fault_of(text, i not in first))
            for i, (role, text, n) in enumerate(zip(row["roles"], row["texts"], row["times"])) if n]


def _long(kind: str, rows: DataFrame) -> DataFrame:
    """Results of open conversations, each step on bounded pieces of them."""
    segments = written(_segments(kind, rows).withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(""))),
                       "segments")
    place = ["conv", "part", "segment"]
    each = segments.select(*place, F.posexplode(F.arrays_zip("turns", "roles", "texts", "times")).alias("i", "r")).where(
        "r.times > 0")
    # Where a role and text stand first; counts before they are shuffled, so a frequent row is no hot key.
    firsts = each.groupBy("conv", "r.roles", F.sha2("r.texts", 256).alias("digest")).agg(
        F.min(F.struct("part", "segment", "i")).alias("first"))
    firsts = firsts.groupBy("conv", "first.part", "first.segment").agg(F.collect_list("first.i").alias("firsts"))
    spans = each.groupBy("conv", F.col("r.turns").alias("turn")).agg(F.lit(1).alias("one")).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    marked = written(segments.join(firsts, place, "left"), "marked")
    solved = written(marked.mapInArrow(_solve(kind), f"conv_id {kind}, {_SOLVED}"), "solved")
    chosen = written(solved.repartition("conv").sortWithinPartitions(*place).mapInArrow(
        _choose(kind), f"conv_id {kind}, {_CHOSEN}"), "chosen")
    steps = chosen.where("part IS NOT NULL").select(*place, "entry", "edits")
    hashed = marked.join(steps, place).repartition("conv").sortWithinPartitions(*place).select(
        *place, "roles", "texts", "times", "firsts", "entry", "edits")
    totals = chosen.where("part IS NULL")
    hashes = hashed.mapInArrow(_hash, "conv string, repaired_sha256 string")
    return totals.join(spans, "conv", "left").join(hashes, "conv", "left").select(
        "conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
        "audit", "repaired_sha256")


_SOLVED = ("conv string, part int, segment long, blank long, duplicate long, truncated long, illegal long, "
           "first string, last string, crossings array<struct<entry int, leave int, cost long, audit string>>")
_CHOSEN = ("conv string, part int, segment long, entry int, edits string, blank long, duplicate long, truncated long, "
           "illegal long, cost long, audit string")


def _solve(kind: str):
    schema = _arrow(f"conv_id {kind}, {_SOLVED}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, = batch.slice(i, 1).to_pylist()
                turns = _turns(row)
                faults = [t.fault for t in turns]
                yield pa.RecordBatch.from_pylist([{
                    **{c: row[c] for c in ("conv_id", "conv", "part", "segment")},
                    **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
                    "illegal": count_illegal([t.initial for t in turns]),
                    "first": turns[0].initial if turns else None, "last": turns[-1].initial if turns else None,
                    "crossings": [dict(zip(("entry", "leave", "cost", "audit"), c)) for c in crossings(turns)]}], schema)

    return run


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[dict]]]:
    """Rows of consecutive equal conversations, one at a time."""
    each = (row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
    return groupby(each, key=lambda row: row["conv"])


def _choose(kind: str):
    """Each segment's edits, and a row of totals (no part) for each conversation."""
    schema = _arrow(f"conv_id {kind}, {_CHOSEN}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, rows in _by_conversation(batches):
            names, counts, last = [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0), None

            def crossed():
                nonlocal last
                for row in rows:
                    names.append((row["conv_id"], row["part"], row["segment"]))
                    for name in counts:
                        counts[name] += row[name]
                    if row["first"] is not None:
                        counts["illegal"] += last is not None and last + row["first"] not in LEGAL
                        last = row["last"]
                    yield [(c["entry"], c["leave"], c["cost"], c["audit"]) for c in row["crossings"]]

            cost, steps = joined(crossed())
            # What is inserted behind all rows belongs to the last segment.
            *steps, (entry, audit), (_, closing) = steps
            steps.append((entry, audit + closing))
            yield pa.RecordBatch.from_pylist([
                *({"conv_id": c, "conv": conv, "part": part, "segment": segment, "entry": entry, "edits": audit}
                  for (c, part, segment), (entry, audit) in zip(names, steps)),
                {"conv_id": names[0][0], "conv": conv, "cost": cost, "audit": "".join(a for _, a in steps), **counts}], schema)

    return run


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash for each conversation, fed segment by segment."""
    for conv, rows in _by_conversation(batches):
        digest, started = hashlib.sha256(), False
        for row in rows:
            for line in lines(_turns(row), row["entry"], row["edits"]):
                digest.update((("\n" if started else "") + line).encode("utf-8", "surrogatepass"))
                started = True
        yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": digest.hexdigest()}])


def damage_and_repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                      text: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    kind = df.schema[conv].dataType.simpleString()
    rows = ordered(damaged(df, conv, turn, role, text)).select("conv_id", "turn", "role", "text", "times")
    found = written(_inside(kind, rows), "conversations")
    names = [f.split()[0] for f in RESULT.split(", ")]
    done = found.where("NOT open").select("conv_id", *names)
    return done.unionByName(_long(kind, found.where("open").select("conv_id", "turn", "role", "text", "times")))
