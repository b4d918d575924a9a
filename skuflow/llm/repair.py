"""Conversation structure repair by a run-length dynamic programme.

A conversation's rows, by turn (null turns first; rows of one turn by a digest of
role and text), become the cheapest sequence whose role initials read
``(s?(ua)+)?``. Edits and costs: Keep 0, Rerole to user or assistant 3, Delete 4,
Insert an empty user or assistant row 3; a truncated row that stays adds 3; blank
and duplicate rows must go. Ties fall to the ASCII-least string of edit initials.

1. Every row is one of nine symbols: its role's initial (s, u, a, other), small
   or capital if truncated, or x if it must go. Equal consecutive symbols are
   collapsed to runs.
2. A symbol is a min-plus matrix over four states (nothing yet, after system,
   after user, after assistant). A run advances by the binary powers of its
   matrix, cached per worker. A segment (at most ``SEGMENT`` rows of a
   conversation) is the product of its runs.
3. Over each conversation's segments, last first, the costs to the end are
   carried as one vector of four. With it every segment unrolls its choices by
   itself, for each state it may start in.
4. In one ordered stream per conversation the start states follow from segment to
   segment and the edits meet the texts.

Defined cases: a null role or text counts as one space; a null conversation id is
a conversation of its own; null turns come first and open no gap. Identical rows
follow one another, the first of them may stay. A role with another initial can
only be reroled or deleted; an empty role has no initial. Very long texts pass
through as they are. An empty table gives no rows. Other columns are not read.

Scale: texts are shuffled once. Rows are counted before they move (identical rows
as one), dealt by ranges of (conversation, turn), so a conversation of any length
is spread over tasks; a conversation's own stream holds one vector, one state and
its audit string (which the result needs as one value). SHA-256 has to see a
conversation's text in order, so that last stream runs in one task a conversation,
with bounded memory.
"""

from __future__ import annotations

import hashlib

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm.common import partitions_for, table, worker_store
from skuflow.session import materialize

SEGMENT = 4096
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)                 # the role an insert or rerole gives
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
END = (0, 2 * INSERT, INSERT, 0)                     # cheapest inserts to an accepted end
ROLE = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 50


# -- the min-plus transitions ------------------------------------------------------------------------------------


def _cached(kind: str, key: tuple, make, most: int = 1 << 16):
    """``make(*key)``, kept by the worker over all its tasks (at most ``most`` values of a kind)."""
    known = worker_store().setdefault("repair-" + kind, {})
    if key not in known:
        if len(known) >= most:
            known.clear()
        known[key] = make(*key)
    return known[key]


def _choices(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state after) of a row of this symbol, by edit initial."""
    out = [("D", DELETE, state)]
    if symbol != "x":
        late = TRUNCATED if symbol.isupper() else 0
        if state in KEPT[symbol.lower()]:
            out.append(("K", KEEP + late, KEPT[symbol.lower()][state]))
        out.append(("R", REROLE + late, NEXT[state]))
    return out


def _times(a: tuple, b: tuple) -> tuple:
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)) for row in a)


def _on(m: tuple, v: tuple) -> tuple:
    return tuple(min(x + v[k] for k, x in enumerate(row)) for row in m)


def _inserts() -> tuple:
    """Cost of the inserts that lead from one state to another."""
    out = [[0 if s == t else NEVER for t in range(4)] for s in range(4)]
    for s in range(4):
        at, cost = s, 0
        for _ in range(3):
            at, cost = NEXT[at], cost + INSERT
            out[s][at] = min(out[s][at], cost)
    return tuple(map(tuple, out))


def power(symbol: str, bit: int) -> tuple:
    """Transition of 2**bit rows of one symbol, inserts before each row included."""
    return _cached("power", (symbol, bit), _power)


def _power(symbol: str, bit: int) -> tuple:
    if bit:
        half = power(symbol, bit - 1)
        return _times(half, half)
    row = [[NEVER] * 4 for _ in range(4)]
    for s in range(4):
        for _, cost, t in _choices(symbol, s):
            row[s][t] = min(row[s][t], cost)
    return _times(_inserts(), tuple(map(tuple, row)))


def advance(symbol: str, count: int, v: tuple) -> tuple:
    """Costs to the end before a run, from those after it."""
    for bit in range(count.bit_length()):
        if count >> bit & 1:
            v = _on(power(symbol, bit), v)
    return v


def _run(symbol: str, count: int) -> tuple:
    out = None
    for bit in range(count.bit_length()):
        if count >> bit & 1:
            out = power(symbol, bit) if out is None else _times(out, power(symbol, bit))
    return out


def product(runs: list[tuple[str, int]]) -> tuple:
    out = None
    for r in runs:
        m = _cached("run", r, _run)
        out = m if out is None else _times(out, m)
    return out


def _row_choices(symbol: str, v: tuple) -> tuple:
    """For each state: the edits up to and with one row that the ASCII-least cheapest way takes, and the state after."""
    before, out = _on(power(symbol, 0), v), []
    for s in range(4):
        edits = ""
        while True:
            took = [(e, t) for e, cost, t in _choices(symbol, s) if cost + v[t] == before[s]]
            inserts = INSERT + before[NEXT[s]] == before[s]
            if inserts and (not took or took[0][0] > "I"):
                edits, s = edits + "I", NEXT[s]
                continue
            out.append((edits + took[0][0], took[0][1]))
            break
    return tuple(out)


def _level(v: tuple) -> tuple:
    """The vector less its least cost: choices depend on differences only."""
    low = min(v)
    return tuple(x - low for x in v)


def unroll(runs: list[tuple[str, int]], end: tuple, starts=range(4)) -> tuple[list[str], list[int]]:
    """The edits of a segment from each start state, and the state after it."""
    after = [_level(end)]
    for symbol, count in reversed(runs[1:]):
        after.append(_level(advance(symbol, count, after[-1])))
    states, edits = list(starts), [[] for _ in starts]
    for (symbol, count), v in zip(runs, reversed(after)):
        while count:
            part = min(count, SEGMENT)
            count -= part
            row = _level(advance(symbol, count, v))
            ends = [row]
            for _ in range(part - 1):
                row = _level(_on(power(symbol, 0), row))
                ends.append(row)
            for row in reversed(ends):
                choices = _cached("choices", (symbol, row), _row_choices)
                for i, s in enumerate(states):
                    e, states[i] = choices[s]
                    edits[i].append(e)
    return ["".join(e) for e in edits], states


# -- the columns -------------------------------------------------------------------------------------------------


def _prepared(rows: DataFrame) -> DataFrame:
    """g (conversation), turn, role, text, digest, initial, blank, truncated."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    return (rows.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")).alias("g"),
                        F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
            .select("*", F.substring(F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), 1, 16).alias("digest"),
                    F.substring("role", 1, 1).alias("initial"), (last == "").alias("blank"), (~last.isin("", ".", "!", "?")).alias("truncated")))


def _counted(prepared: DataFrame) -> DataFrame:
    """Identical rows as one with their number n; fresh: the first of its role and text in the conversation."""
    turns = prepared.groupBy("g", "turn", "digest").agg(
        F.first("initial").alias("initial"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"), F.count(F.lit(1)).alias("n"))
    turns = materialize(turns, "repair-turns")
    firsts = turns.groupBy("g", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))).alias("first"))
    return (turns.join(firsts, ["g", "digest"])
            .withColumn("fresh", ~F.col("blank") & F.col("turn").eqNullSafe(F.col("first.turn"))).drop("first"))


def _segments(segment: int):
    """Rows sorted by (g, turn, digest) -> segments: runs and, of more than one row, their product."""
    def run(batches):
        import pyarrow as pa
        part, serial, g, symbols, counts, held = TaskContext.get().partitionId(), 0, None, [], [], 0
        out = []

        def close():
            m = product(list(zip(symbols, counts)))
            out.append((g, part, serial, "".join(symbols), list(counts), [x for row in m for x in row]))

        def rows():
            types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)],
                                              names=["g", "part", "serial", "symbols", "counts", "matrix"])

        def add(symbol, n):
            if symbols and symbols[-1] == symbol:
                counts[-1] += n
            else:
                symbols.append(symbol), counts.append(n)
        for batch in batches:
            for h, initial, truncated, n, fresh in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held and (h != g or held >= segment):
                    close()
                    symbols, counts, held, serial = [], [], 0, serial + 1
                g, held = h, held + 1
                if fresh:
                    symbol = initial if initial in KEPT and initial != "o" else "o"
                    add(symbol.upper() if truncated else symbol, 1)
                if n > fresh:
                    add("x", n - int(fresh))
            if len(out) >= 1024:
                yield rows()
                out = []
        if held:
            close()
        if out:
            yield rows()
    return run


def _ends(batches):
    """Segments of a conversation, last first -> the costs to the end after each."""
    import pyarrow as pa
    g, v = None, END
    for batch in batches:
        ends = []
        for h, m in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            if h != g:
                g, v = h, END
            ends.append(list(v))
            v = _level(_on(tuple(tuple(m[4 * i:4 * i + 4]) for i in range(4)), v))
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(ends, pa.list_(pa.int64()))], names=["part", "serial", "end"])


def _unrolled(batches):
    import pyarrow as pa
    for batch in batches:
        g, part, serial, symbols, counts, end = (batch.column(i).to_pylist() for i in range(6))
        made = [unroll(list(zip(s, c)), tuple(e)) for s, c, e in zip(symbols, counts, end)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(g, pa.string()), pa.array(part, pa.int64()), pa.array(serial, pa.int64()),
             pa.array([m[0] for m in made], pa.list_(pa.string())), pa.array([m[1] for m in made], pa.list_(pa.int32()))],
            names=["g", "part", "serial", "edits", "states"])


def _applied(batches):
    """One stream per conversation: its segments' edits, then its rows -> a row for every edit."""
    import pyarrow as pa
    g, audit, state, at, now, step, out, held = None, [], START, 0, START, 0, [], 0

    def put(edit, role, text, original, truncated):
        nonlocal step, held
        out.append((g, step, edit, role, text, original, truncated))
        step, held = step + 1, held + 64 + len(text)

    def insert():
        nonlocal now
        now = NEXT[now]
        put("I", ROLE[now], "", None, False)

    def tail():
        while END[now]:
            insert()

    def rows():
        types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)],
                                          names=["g", "step", "edit", "role", "text", "initial", "truncated"])
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(6)]
        for h, edits, states, role, initial, truncated, text in zip(*cols, batch.column(6)):
            if h != g:
                if g is not None:
                    tail()
                g, audit, state, at, now, step = h, [], START, 0, START, 0
            if edits is not None:
                audit.append(edits[state])
                state = states[state]
                continue
            if isinstance(audit, list):
                audit = "".join(audit)
            while audit[at] == "I":
                insert()
                at += 1
            edit, at, text = audit[at], at + 1, text.as_py()
            if edit == "K":
                now = KEPT[initial][now]
            elif edit == "R":
                now = NEXT[now]
                role = ROLE[now]
            put(edit, role, text, initial, truncated)
            if held > 4 << 20:
                yield rows()
                out, held = [], 0
    if g is not None:
        tail()
    if out:
        yield rows()


def repair(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) -> one row for every edit, conversations laid out one after
    the other and their edits in order: g (conversation key, see `conversation_id`), step, edit
    (K, R, D, I), role and text (as repaired; of a deleted row as it was), initial (of the
    original role; null for inserts), truncated."""
    return _edits(_prepared(rows), None, segment)


def _edits(prepared: DataFrame, counted: DataFrame | None, segment: int) -> DataFrame:
    parts = partitions_for(prepared)
    order = ["g", F.col("turn").asc_nulls_first(), "digest"]
    counted = _counted(prepared) if counted is None else counted
    segments = materialize(counted.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                           .select("g", "initial", "truncated", "n", "fresh")
                           .mapInArrow(_segments(segment), "g string, part long, serial long, symbols string, counts array<long>, matrix array<long>"), "repair-segments")
    ends = (segments.select("g", "part", "serial", "matrix").repartition("g").sortWithinPartitions("g", F.desc("part"), F.desc("serial"))
            .mapInArrow(_ends, "part long, serial long, end array<long>"))
    unrolled = (segments.join(ends, ["part", "serial"]).select("g", "part", "serial", "symbols", "counts", "end")
                .mapInArrow(_unrolled, "g string, part long, serial long, edits array<string>, states array<int>"))
    none = lambda kind: F.lit(None).cast(kind)
    plan = unrolled.select("g", "part", "serial", none("long").alias("turn"), none("binary").alias("digest"), "edits", "states",
                           none("string").alias("role"), none("string").alias("initial"), none("boolean").alias("truncated"), none("string").alias("text"))
    texts = prepared.select("g", none("long").alias("part"), none("long").alias("serial"), "turn", "digest", none("array<string>").alias("edits"),
                            none("array<int>").alias("states"), "role", "initial", "truncated", "text")
    laid = (plan.unionByName(texts).repartition(parts, "g")
            .sortWithinPartitions("g", F.col("part").asc_nulls_last(), F.col("serial").asc_nulls_last(), F.col("turn").asc_nulls_first(), "digest"))
    return laid.select("g", "edits", "states", "role", "initial", "truncated", "text").mapInArrow(
        _applied, "g string, step long, edit string, role string, text string, initial string, truncated boolean")


def conversation_id(kind: str) -> Column:
    """The conversation id of the key ``g``."""
    return F.when(F.col("g") != "-", F.expr("substring(g, 2)")).cast(kind)


def _digested(batches):
    """Edits of a conversation in order -> its audit, cost, illegal neighbours and the digest of what stays."""
    import pyarrow as pa
    g, edits, cost, illegal, last, sha, first, out = None, [], 0, 0, None, hashlib.sha256(), True, []
    cost_of = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}

    def rows():
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(
            (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["g", "illegal", "cost", "audit", "repaired_sha256"])
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in (0, 2, 3, 5, 6)]
        for h, edit, role, initial, truncated, text in zip(*cols, batch.column(4)):
            if h != g:
                if g is not None:
                    out.append((g, illegal, cost, "".join(edits), sha.hexdigest()))
                g, edits, cost, illegal, last, sha, first = h, [], 0, 0, None, hashlib.sha256(), True
            edits.append(edit)
            cost += cost_of[edit] + (TRUNCATED if truncated and edit != "D" else 0)
            if initial is not None:
                illegal += last is not None and last + initial not in ("su", "ua", "au")
                last = initial
            if edit != "D":
                sha.update((("" if first else "\n") + role + ":" + text.as_py()).encode("utf-8", "surrogatepass"))
                first = False
        if len(out) >= 4096:
            yield rows()
            out = []
    if g is not None:
        out.append((g, illegal, cost, "".join(edits), sha.hexdigest()))
    if out:
        yield rows()


def repair_report(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row a conversation of ``rows`` that has any: g, the faults counted, the cost, the audit and the repaired text's digest."""
    prepared = materialize(_prepared(rows), "repair-rows")
    counted = materialize(_counted(prepared), "repair-counted")
    n, fresh = F.col("n"), F.col("fresh").cast("long")
    faults = counted.groupBy("g").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(n - fresh)).alias("duplicate"),
        F.sum(F.when(F.col("truncated"), fresh).otherwise(0)).alias("truncated")).withColumn("gaps", F.coalesce("gaps", F.lit(0)))
    digests = _edits(prepared, counted, segment).mapInArrow(_digested, "g string, illegal long, cost long, audit string, repaired_sha256 string")
    return faults.join(digests, "g")


def damage(rows: DataFrame) -> DataFrame:
    """Damage by crc32 of ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops the row, 1 empties its text,
    2 removes its closing marks, 3 repeats it, 4 makes it the user's."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    return (rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), kind.alias("kind")).where("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    report = repair_report(damage(conversations))
    every = conversations.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")).alias("g")).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return every.join(report, "g", "left").select(
        conversation_id(dict(conversations.dtypes)["conv_id"]).alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
