"""Structure of conversations after damage, and the cheapest edits that repair it: iterative-deepening A*."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import batch_rows, cut
from tidemark.plans.compose import composed, then

#: States of the accepted form (s?(ua)+)?: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NAME_OF = {USER: "user", ASSISTANT: "assistant"}
#: Which kept row may follow which state; the state after a row that is inserted or gets a new role.
FOLLOWS = ((False, True, True, False), (False, False, True, False), (False, False, False, True), (False, False, True, False))
NEXT = (USER, USER, ASSISTANT, USER)
LEGAL_PAIRS = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
INF = 1 << 40
#: Cost and edits still to be made when all rows are done: rows inserted at the end.
END_COST = (0, 4, 2, 0)
END_EDITS = ("", "II", "I", "")

WHITE = " \t\n\v\f\r"


class EditSearch:
    """Cheapest edits that take the accepted form from one state to an end, by iterative-deepening A*.

    ``states`` are those that the rows' roles lead to (START: none), ``faults`` the rows' faults, ``final`` the
    cost of ending in each state. A depth-first search tries edits in the order of their letters (Delete, Insert,
    Keep, Rerole) under a cost bound; the first path that it finds is the first in the order of letters among the
    cheapest. The transposition table holds for each (row, state) a cost that is certainly needed from there: the
    estimate at first, more after each failure, so that a failed state is not entered again with as little left. It is
    kept over all bounds and all states to begin from.

    The estimate: a required deletion costs 3 and a truncated row 1 in any case; two neighbours (required
    deletions aside) that may not follow each other need an edit between them or of one of them, which
    costs 2 or more besides that and serves two such places at most, if they share a row.
    """

    def __init__(self, states: Sequence[int], faults: Sequence[int], final: Sequence[int] = END_COST) -> None:
        self.states, self.final, self.n = states, final, len(states)
        n = self.n
        self.required = [f in (BLANK, DUPLICATE) for f in faults]
        self.extra = [int(f == TRUNCATED) for f in faults]
        #: In any case from a row on; next row that may stay; illegal neighbours in a row from there, edits after those.
        self.base, self.next, self.run, self.rest = [0] * (n + 1), [n] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        self.systems = [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            self.base[i] = self.base[i + 1] + (3 if self.required[i] else self.extra[i])
            self.next[i] = self.next[i + 1] if self.required[i] else i
            self.systems[i] = self.systems[i + 1] + (not self.required[i] and states[i] == SYSTEM)
            k = self.next[i + 1]
            fits = FOLLOWS[states[i]][states[k]] if k < n else states[i] != START and final[states[i]] == 0
            self.run[i] = 0 if fits else 1 + self.run[k]
            self.rest[i] = self.rest[k] + (self.run[k] + 1) // 2 if fits else self.rest[k]
        self.known: list[int | None] = [None] * (4 * (n + 1))
        #: Ends that only the empty form or a single system row has.
        self.only = next((s for s in (START, SYSTEM) if final[s] == 0 and all(c >= INF for t, c in enumerate(final) if t != s)), None)

    def least(self, i: int, state: int) -> int:
        """A cost that any way from row ``i`` in ``state`` to the end needs."""
        found = self.known[4 * i + state]
        if found is None:
            found = self.known[4 * i + state] = self._estimate(i, state)
        return found

    def _estimate(self, i: int, state: int) -> int:
        left, j = self.n - i, self.next[i]
        if self.only is not None:
            if state == self.only:
                return 3 * left
            return 3 * (left - 1) if self.only == SYSTEM and state == START and self.systems[i] else INF
        if j == self.n:
            return self.base[i] + (self.final[state] if i == self.n else 0)
        run = self.run[j] + (not FOLLOWS[state][self.states[j]])
        return self.base[i] + 2 * ((run + 1) // 2 + self.rest[j])

    def _edit(self, i: int, state: int, move: int) -> tuple[str, int, int, int] | None:
        """(letter, row, state, cost) after the edit number ``move`` in the order of letters."""
        if move == 0:
            return "D", i + 1, state, 3
        if move == 1:
            return "I", i, NEXT[state], 2
        if self.required[i]:
            return None
        if move == 2:
            kept = self.states[i]
            return ("K", i + 1, kept, self.extra[i]) if FOLLOWS[state][kept] else None
        return "R", i + 1, NEXT[state], 2 + self.extra[i]

    def _dive(self, entry: int, bound: int) -> str | None:
        """The first path of at most that cost."""
        # row, state, cost left, next edit, least cost seen to be needed, cost of the edit that led here
        trail = [[0, entry, bound, 0, INF, 0]]
        letters: list[str] = []
        while trail:
            here = trail[-1]
            i, state, left, move = here[:4]
            if i == self.n:
                return "".join(letters)
            if move == 4:
                trail.pop()
                node = 4 * i + state
                self.known[node] = max(self.known[node], here[4])
                if trail:
                    letters.pop()
                    trail[-1][4] = min(trail[-1][4], here[5] + self.known[node])
                continue
            here[3] += 1
            edit = self._edit(i, state, move)
            if edit is None:
                continue
            letter, row, after, cost = edit
            needed = cost + self.least(row, after)
            if needed > left:
                here[4] = min(here[4], needed)
                continue
            trail.append([row, after, left - cost, 0, INF, cost])
            letters.append(letter)
        return None

    def best(self, entry: int = START) -> tuple[int, str] | None:
        """(cost, letters) without what ``final`` stands for; None if there is no way."""
        while (bound := self.least(0, entry)) < INF:
            found = self._dive(entry, bound)
            if found is not None:
                return bound, found
        return None


def repaired_rows(roles: Sequence[str], texts: Sequence[str], edits: str, state: int = START) -> tuple[list[str], int]:
    """``role:text`` of the rows after the edits, and the state after them."""
    out, i = [], 0
    for letter in edits:
        if letter == "K":
            out.append(f"{roles[i]}:{texts[i]}")
            state = STATE_OF[roles[i][:1]]
        elif letter == "R":
            state = NEXT[state]
            out.append(f"{NAME_OF[state]}:{texts[i]}")
        elif letter == "I":
            state = NEXT[state]
            out.append(f"{NAME_OF[state]}:")
        i += letter != "I"
    return out, state


def fault_of(text: str, seen: bool) -> int:
    last = text.rstrip(WHITE)[-1:]
    return BLANK if not last else DUPLICATE if seen else TRUNCATED if last not in ".!?" else SOUND


def damaged(rows: DataFrame) -> DataFrame:
    """The columns conv_id, turn, role, text and n of ``rows`` after damage; n is the number of times that a row stands, 0 if it is dropped.

    crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4
    makes its role user. Nulls of any column count as one space there and in role and text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fate = F.col("fate")
    placed = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.pmod(F.crc32(name), F.lit(20)).alias("fate"))
    return placed.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fate <= 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("n"),
    )


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
COUNTS = ["rows", "turns", "low", "high", "blank", "duplicate", "truncated", "illegal"]


def with_conversation(kind: T.DataType, columns: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(columns).fields])


class Tally:
    """Turns, faults and neighbours of the rows of a stretch, in order."""

    def __init__(self, before_turn: int | None = None, before_state: int | None = None) -> None:
        self.turn, self.state = before_turn, before_state
        self.rows = self.turns = self.illegal = 0
        self.low = self.high = None
        self.faults = [0, 0, 0, 0]

    def add(self, turn: int | None, state: int, fault: int) -> None:
        if turn is not None:
            self.turns += turn != self.turn
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        if self.state is not None:
            self.illegal += (self.state, state) not in LEGAL_PAIRS
        self.state = state
        self.rows += 1
        self.faults[fault] += 1

    def counts(self) -> tuple:
        return self.rows, self.turns, self.low, self.high, *self.faults[1:], self.illegal


def gap_count(turns: int, low: int | None, high: int | None) -> int:
    return 0 if low is None else high - low + 1 - turns


class Stretch:
    """Rows of one conversation, held until they are enough for a segment."""

    def __init__(self, conv, number: int, opens: bool) -> None:
        self.conv, self.number, self.opens = conv, number, opens
        self.turns: list[int | None] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.size = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text) + len(role)

    def whole(self) -> tuple:
        """The result of a conversation that is all here."""
        seen, tally, states, faults = set(), Tally(), [], []
        for turn, role, text in zip(self.turns, self.roles, self.texts, strict=True):
            state, fault = STATE_OF.get(role[:1], START), fault_of(text, (role, text) in seen)
            seen.add((role, text))
            tally.add(turn, state, fault)
            states.append(state)
            faults.append(fault)
        cost, edits = EditSearch(states, faults).best()
        lines, state = repaired_rows(self.roles, self.texts, edits)
        edits += END_EDITS[state]
        lines += repaired_rows((), (), END_EDITS[state], state)[0]
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        _, turns, low, high, *kinds = tally.counts()
        return gap_count(turns, low, high), *kinds, cost, edits, sha


def segments_of(rows: DataFrame, segment_rows: int, segment_bytes: int) -> DataFrame:
    """Results of the conversations that one task has met from end to end in one segment, segments of all others; cut.

    Rows are dealt by ranges of (conversation, turn, role, text), so a conversation of any size goes to as many tasks as its
    rows need; each walks its rows in order and holds one segment.
    """
    kind = rows.schema["conv_id"].dataType
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "spread")]
    placed = rows.withColumns({"digest": F.md5("text"), "spread": F.monotonically_increasing_id()})
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = with_conversation(kind, f"part int, number int, whole boolean, {RESULT}, turns array<long>, roles array<string>, texts array<string>")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held, out, names = TaskContext.get().partitionId(), None, [], schema.names
        first, any_row = True, False

        def segment(s: Stretch) -> tuple:
            return s.conv, part, s.number, False, *[None] * 8, s.turns, s.roles, s.texts

        def given(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [conv_type, pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 6, pa.string(), pa.string()]
            kinds += [pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        size = 0
        conv_type = pa.int64()
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for conv, turn, role, text, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "n")), strict=True):
                if not any_row or conv != held.conv:
                    if any_row:
                        # The first conversation of a task may have begun in the one before.
                        if first or held.number:
                            out.append(segment(held))
                        else:
                            out.append((held.conv, part, 0, True, *held.whole(), None, None, None))
                        size += held.size
                        first = False
                    held, any_row = Stretch(conv, 0, first), True
                for _ in range(n):
                    if len(held.texts) >= segment_rows or held.size and held.size + len(text) > segment_bytes:
                        out.append(segment(held))
                        size += held.size
                        held = Stretch(conv, held.number + 1, first)
                    held.add(turn, role, text)
                if len(out) >= 2_000 or size > segment_bytes:
                    if out:
                        yield given(out, conv_type)
                    out, size = [], 0
        if any_row:
            out.append(segment(held))
            yield given(out, conv_type)

    return cut(dealt.select("conv_id", "turn", "role", "text", "n").mapInArrow(walk, schema))


ENTRIES = [(e, x) for e in range(4) for x in range(4)]


def cost_product(a: Column, b: Column) -> Column:
    """Costs between states along two stretches, as arrays of 16 in the order of ENTRIES: the cheapest over the state between."""
    middle = F.sequence(F.lit(0), F.lit(3))

    def cell(i: Column) -> Column:
        row, column = F.floor(i / 4).cast("int") * 4, F.pmod(i, F.lit(4)).cast("int")
        through = F.transform(middle, lambda m: F.get(a, row + m) + F.get(b, m * 4 + column))
        return F.least(F.array_min(through), F.lit(INF))

    return F.transform(F.sequence(F.lit(0), F.lit(15)), cell)


def same(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join in which a null conversation is one like any other."""
    named = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(named, condition, how).drop(*[f"__r_{c}" for c in on])


def long_results(parts: DataFrame, fan: int) -> DataFrame:
    """Results of the conversations that ``parts`` (cut) holds in segments.

    What a segment needs from others is little: which of its texts stood earlier, its neighbour's last turn and role, the
    costs of all segments after it and the state that those before lead to. Each segment is searched from every
    state to every state; the costs are composed from the last segment backwards, then each segment knows its best end
    for each beginning, and these maps are composed from the first one on. Edits of a segment end with one of
    its rows, so no segment's letters are the beginning of another choice's, and the first letters overall
    are those of the first choice that differs.
    """
    on = ["conv_id", "at"]
    here = parts.groupBy("conv_id", "part").agg(F.count("*").alias("segments"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = here.select("conv_id", "part", F.coalesce(F.sum("segments").over(before), F.lit(0)).alias("offset"))
    numbered = cut(
        same(parts, offsets, ["conv_id", "part"]).select(
            "conv_id", (F.col("offset") + F.col("number")).cast("long").alias("at"), "turns", "roles", "texts"
        ),
        rows=50,
    )
    most = (numbered.agg(F.max("at")).first()[0] or 0) + 1

    # Where each role and text of a conversation stands first; each segment sends its own first places only.
    texts = numbered.select(*on, F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row"))
    own = texts.groupBy(*on, F.col("row.roles").alias("role"), F.md5("row.texts").alias("digest")).agg(F.min("place").alias("place"))
    firsts = own.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("at", "place")).alias("first"))
    places = firsts.groupBy("conv_id", F.col("first.at").alias("at")).agg(F.collect_list("first.place").alias("firsts"))
    # What the segment before ends with; segments without rows pass on what came before them.
    known = F.filter("turns", lambda t: t.isNotNull())
    ends = numbered.select(
        *on,
        F.array(
            F.when(F.size(known) > 0, F.array_max(known)),
            F.when(F.size("roles") > 0, F.instr(F.lit("sua"), F.substring(F.element_at("roles", -1), 1, 1)).cast("long") * F.when(F.element_at("roles", -1) == "", 0).otherwise(1)),
        ).alias("end"),
    )
    newer = lambda so_far, x: F.array(*[F.coalesce(F.get(x, i), F.get(so_far, i)) for i in (0, 1)])
    nothing = F.array(F.lit(None).cast("long"), F.lit(None).cast("long"))
    entering = composed(cut(ends), ["conv_id"], "at", "end", newer, nothing, most, fan=fan).withColumnRenamed("__before", "end")

    conv = numbered.schema["conv_id"].dataType
    tables = with_conversation(conv, "at long, costs array<long>, edits array<string>, " + ", ".join(f"{c} long" for c in COUNTS))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                first = set(r["firsts"] or ())
                tally = Tally(*(r["end"] or (None, None)))
                states, faults = [], []
                for i, (turn, role, text) in enumerate(zip(r["turns"], r["roles"], r["texts"], strict=True)):
                    states.append(STATE_OF.get(role[:1], START))
                    faults.append(fault_of(text, i not in first))
                    tally.add(turn, states[-1], faults[-1])
                costs, edits = [INF] * 16, [""] * 16
                for leave in range(4):
                    searched = EditSearch(states, faults, [0 if s == leave else INF for s in range(4)])
                    for enter in range(4):
                        found = searched.best(enter)
                        if found is not None:
                            costs[4 * enter + leave], edits[4 * enter + leave] = found
                out.append((r["conv_id"], r["at"], costs, edits, *tally.counts()))
            if out:
                columns = list(zip(*out, strict=True))
                kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.int64()] * len(COUNTS)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=tables.names)

    asked = same(same(numbered, places, on, "left"), entering, on)
    with batch_rows(parts.sparkSession, 50):
        searched = cut(asked.mapInArrow(search, tables))
    none = F.array(*[F.lit(0 if e == x else INF).cast("long") for e, x in ENTRIES])
    after = composed(
        searched.select(*on, "costs"), ["conv_id"], "at", "costs", lambda so_far, x: cost_product(x, so_far), none, most, reverse=True, fan=fan
    )
    # The cheapest end for each beginning; of equal ones the first in the order of letters.
    ended = F.array(*[F.lit(c).cast("long") for c in END_COST])
    to_end = F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda s: F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda x: F.get("__before", s * 4 + x) + F.get(ended, x))),
    )

    def choice(enter: Column) -> Column:
        options = F.transform(
            F.sequence(F.lit(0), F.lit(3)),
            lambda x: F.struct(
                F.least(F.get("costs", enter * 4 + x) + F.get("rest", x), F.lit(INF)).alias("cost"),
                F.get("edits", enter * 4 + x).alias("edits"),
                x.cast("long").alias("leave"),
            ),
        )
        return F.array_min(options)

    chosen = cut(
        same(searched, after, on)
        .withColumn("rest", to_end)
        .select(*on, *COUNTS, F.transform(F.sequence(F.lit(0), F.lit(3)), choice).alias("choices"))
        .withColumn("leaves", F.transform("choices", lambda c: c["leave"]))
    )
    every = F.array(*[F.lit(s).cast("long") for s in range(4)])
    enters = composed(chosen.select(*on, "leaves"), ["conv_id"], "at", "leaves", then, every, most, fan=fan)
    entry = F.get("__before", 0).cast("int")
    decided = same(chosen, enters, on).select(
        *on, *COUNTS, entry.alias("enter"), F.get("choices", entry)["edits"].alias("edits"), F.get("choices", entry)["cost"].alias("cost")
    )
    result = with_conversation(conv, RESULT)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments in order: each conversation's digest and sums, one segment at a time."""
        held, state, conv_type = None, START, pa.int64()

        def close() -> pa.RecordBatch:
            name, sha, some, edits, cost, sums, low, high = held
            rest, _ = repaired_rows((), (), END_EDITS[state], state)
            for line in rest:
                sha.update((b"\n" if some else b"") + line.encode())
                some = True
            row = (name, gap_count(sums[0], low, high), *sums[1:], cost, "".join([*edits, END_EDITS[state]]), sha.hexdigest())
            kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=result.names)

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for r in batch.to_pylist():
                if held is None or r["at"] == 0:
                    if held is not None:
                        yield close()
                    held, state = [r["conv_id"], hashlib.sha256(), False, [], r["cost"], [0] * 5, None, None], START
                lines, state = repaired_rows(r["roles"], r["texts"], r["edits"], state)
                if lines:
                    held[1].update((b"\n" if held[2] else b"") + "\n".join(lines).encode())
                    held[2] = True
                held[3].append(r["edits"])
                held[5] = [a + r[c] for a, c in zip(held[5], ("turns", "blank", "duplicate", "truncated", "illegal"), strict=True)]
                held[6] = r["low"] if held[6] is None else held[6]
                held[7] = r["high"] if r["high"] is not None else held[7]
        if held is not None:
            yield close()

    with_texts = same(decided, numbered.select(*on, "roles", "texts"), on)
    ordered = with_texts.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "at")
    with batch_rows(parts.sparkSession, 50):
        return cut(ordered.mapInArrow(told, result))


def repair_conversations(
    rows: DataFrame, conv_col: str = "conv_id", segment_rows: int = 128, segment_bytes: int = 4_000_000, fan: int = 256
) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): what is wrong with it after damage, and the cheapest repair.

    Damage: see damaged. Rows of a conversation stand by turn, null turns first; rows of one turn by role, then by the
    MD5 of their text. The first fault of a row counts: blank; duplicate, if role and text stood earlier; truncated, if its
    last character that is not white is none of ``.!?``. ``gaps`` counts the turns missing between the lowest and the
    highest, ``illegal`` the neighbours whose role initials are not su, ua or au.

    Edits: Keep a row (0), Rerole it to user or assistant (2), Delete it (3; blank and duplicate rows must be), Insert
    an empty user or assistant row (2); a truncated row that is not deleted adds 1. ``audit`` holds the letters of
    the cheapest edits after which role initials read ``(s?(ua)+)?``, the first in ASCII order of several.
    An empty role has no initial, so such a row cannot be kept.

    A null conv_id is a conversation of its own; a null turn has no part in gaps; null role and text are one space.
    Repeated rows are duplicates. A conversation without rows after damage has zeros, an empty audit and the digest of
    nothing. No rows give no rows; other columns are ignored. A conversation with more rows than ``segment_rows`` is
    repaired in segments, with the same result; only its digest, which is sequential, and its audit are put together in one task, which
    holds one segment at a time besides the audit. Texts may have any length; one longer than ``segment_bytes`` is a segment alone.
    """
    source = damaged(rows.select(F.col(conv_col).alias("conv_id"), "turn", "role", "text"))
    with batch_rows(rows.sparkSession, 1_000):
        found = segments_of(source, segment_rows, segment_bytes)
    result = with_conversation(T.LongType(), RESULT).names
    short = found.filter("whole").select(*result)
    parts = found.filter("not whole").select("conv_id", "part", "number", "turns", "roles", "texts")
    if parts.isEmpty():
        return short
    return short.unionByName(long_results(parts, fan))
