"""Conversation structure repair by iterative-deepening A*.

Turns of a conversation are kept (K, free), given another role (R, 3), deleted (D, 4)
or preceded by an inserted empty turn (I, 3); a truncated turn that stays adds 3, blank
and duplicate turns must go.  Accepted are role initials ``(s?(ua)+)?``.  The search goes
depth first through the edits in ASCII order (D, I, K, R) under a cost bound that rises
to the least cost found beyond it, so the first accepting path is the cheapest one and of
those the ASCII-least.  A transposition table keeps for every failed state (turn, state of
the accepting automaton) the cost that is now known to be left from there.  What is left
is first estimated from below: required deletions, truncated turns, and disjoint pairs of
neighbouring turns whose roles can't follow each other.

Rows are dealt by ranges of (conversation, turn, role, text), so a conversation of any
length spreads over tasks.  A task cuts each conversation into pieces of at most
``PIECE`` turns.  One that lies whole in a piece is searched at once.  Of the others each
piece first gives its least costs between automaton states (a 4 x 4 matrix), from which
the cost left behind every piece follows; then each piece is searched, with that cost at
its end, from every state it may begin in, and the ways are chained.  Only matrices and
states of a long conversation meet in one task, less than its audit string holds.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sortproof.llm.frames import arrow_schema, map_arrow, store

PIECE = 128
INF = 1 << 40
_SPACE = " \t\n\x0b\x0c\r"
#: state 0: nothing yet, 1: system, 2: user, 3: assistant last; (role inserted or given, next state)
_NEXT = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: cost left behind the last turn, by state
DONE = (0, INF, INF, 0)


def _estimate(turns: list[tuple[str, str]]) -> list[int]:
    """A lower bound of the cost of every suffix of (fault, role initial) turns."""
    n = len(turns)
    own, pair = [0] * (n + 1), [0] * (n + 1)
    live = n                                    # the next turn that need not go
    for i in range(n - 1, -1, -1):
        fault, ini = turns[i]
        must_go = fault in "bd"
        own[i] = own[i + 1] + (4 if must_go else 3 if fault == "t" else 0)
        pair[i] = pair[i + 1]
        if not must_go:
            if live < n and ini == turns[live][1] and ini in "ua":
                extra = 1 if "t" in fault + turns[live][0] else 3
                pair[i] = max(pair[i], extra + pair[live + 1])
            live = i
    return [a + b for a, b in zip(own, pair)]


def search(turns: list[tuple[str, str]], state: int = 0, end=None) -> tuple[int, str, int]:
    """(cost, edits, last state) of the cheapest and then ASCII-least edits.

    ``turns`` are (fault, role initial): fault b(lank), d(uplicate), t(runcated) or '-'.
    ``end`` is the cost left behind the last turn by state, the insertions there included;
    without it the conversation ends here, and there always is an answer.
    """
    closed, end = end is None, end or DONE
    n, last = len(turns), min(end)
    left = [x + last for x in _estimate(turns)]
    known: dict[tuple[int, int], int] = {}      # failed states -> cost known to be left

    def estimate(i: int, s: int) -> int:
        return known.get((i, s), left[i])

    def moves(i: int, s: int):
        role, to = _NEXT[s]
        if i == n:
            return ((3, "I", i, to),) if closed else ()
        fault, ini = turns[i]
        out = [(4, "D", i + 1, s), (3, "I", i, to)]
        if fault not in "bd":
            cut = 3 if fault == "t" else 0
            if (s, ini) in _KEEP:
                out.append((cut, "K", i + 1, _KEEP[s, ini]))
            out.append((cut + 3, "R", i + 1, to))
        return out

    bound = estimate(0, state)
    path: list[str] = []
    while bound < INF:
        # frames of the depth-first search: [turn, state, cost so far, moves, least cost left]
        stack = [[0, state, 0, None, INF]]
        while stack:
            top = stack[-1]
            i, s, cost, todo, least = top
            if todo is None:
                if i == n and cost + end[s] <= bound:
                    return cost + end[s], "".join(path), s
                top[4] = least = end[s] if i == n else INF
                top[3] = todo = iter(moves(i, s))
            for step, letter, j, t in todo:
                rest = step + estimate(j, t)
                if cost + rest <= bound:
                    path.append(letter)
                    stack.append([j, t, cost + step, None, INF])
                    break
                top[4] = min(top[4], rest)
            else:
                stack.pop()
                known[i, s] = max(estimate(i, s), top[4])
                if stack:
                    path.pop()
                    above = stack[-1]
                    above[4] = min(above[4], cost - above[2] + known[i, s])
        bound = max(bound + 1, estimate(0, state))
    raise ValueError("no accepting path")


def least_costs(turns: list[tuple[str, str]]) -> list[int]:
    """Least cost from every state before ``turns`` to every state right behind the
    last of them, as 16 numbers; ``INF`` where there is no way."""
    out = []
    for start in range(4):
        at = [INF] * 4
        at[start] = 0
        for fault, ini in turns:
            for _ in range(3):                  # insertions before the turn
                for s in range(4):
                    t = _NEXT[s][1]
                    at[t] = min(at[t], at[s] + 3)
            to = [x + 4 for x in at]
            if fault not in "bd":
                cut = 3 if fault == "t" else 0
                for s in range(4):
                    t = _NEXT[s][1]
                    to[t] = min(to[t], at[s] + cut + 3)
                    if (s, ini) in _KEEP:
                        t = _KEEP[s, ini]
                        to[t] = min(to[t], at[s] + cut)
            at = [min(x, INF) for x in to]
        out += at
    return out


def apply_edits(edits: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts of the repaired turns."""
    out_roles, out_texts, i = [], [], 0
    for e in edits:
        role, to = _NEXT[state]
        if e == "D":
            i += 1
            continue
        if e == "I":
            out_roles.append(role)
            out_texts.append("")
        else:
            if e == "K":
                role, to = roles[i], _KEEP[state, roles[i][:1]]
            out_roles.append(role)
            out_texts.append(texts[i])
            i += 1
        state = to
    return out_roles, out_texts


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, n): rows with faults put in by crc32(conv:turn) % 20.

    0 drops a row (n = 0, so that its conversation is still known), 1 empties its text,
    2 takes ``.!?`` out, 3 doubles it (n = 2), 4 makes its role user.  A null reads as one
    space, but for the turn and conversation themselves, which stay null.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat_ws(":", blank(conv_col), blank(turn_col)).cast("binary")) % 20
    d = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                    blank(role_col).alias("role"), blank(text_col).alias("text"), k.alias("k"))
    there = lambda c: F.when(F.col("k") != 0, c)
    return d.select(
        "conv", there(F.col("turn")).alias("turn"),
        there(F.when(F.col("k") == 4, "user").otherwise(F.col("role"))).alias("role"),
        there(F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", ""))
              .otherwise(F.col("text"))).alias("text"),
        F.when(F.col("k") == 0, 0).when(F.col("k") == 3, 2).otherwise(1).cast("long").alias("n"))


def _faults(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, n), equal ones once, with the fault of the first of them."""
    one = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    one = one.withColumn("h", F.sha2("text", 256))
    order = F.struct(F.col("turn").isNotNull(), "turn")
    first = one.where("n > 0").groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("h").alias("h2")).agg(
        F.min(order).alias("first"))
    d = one.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                 & (F.col("h") == F.col("h2")), "left")
    body = F.rtrim(F.col("text"), F.lit(_SPACE))
    fault = F.when(body == "", "b").when(~order.eqNullSafe(F.col("first")), "d") \
        .when(~F.substring(body, -1, 1).isin(".", "!", "?"), "t").otherwise("-")
    gone = fault.isin("b", "d")
    return d.select("conv", "turn", "role", "text", "n", fault.alias("fault"),
                    F.when(gone, "").otherwise(F.col("text")).alias("kept_text"))


_PIECE = ("conv {kind}, part int, no int, whole boolean, n_turns long, blank long, duplicate long, truncated long, "
          "illegal long, first_ini string, last_ini string, least_turn long, greatest_turn long, "
          "distinct_turns long, first_turn long, last_turn long, turns string, initials array<string>, "
          "roles array<string>, texts array<string>, edits string, cost long, costs array<long>")


class _Piece:
    """Turns of one conversation in order, up to ``most``."""

    def __init__(self, conv, no: int):
        self.conv, self.no = conv, no
        self.faults, self.initials, self.roles, self.texts = [], [], [], []
        self.illegal, self.seen, self.bytes = 0, [], 0

    def add(self, turn, role: str, text: str, fault: str) -> None:
        ini = role[:1]
        if self.initials and self.initials[-1] + ini not in ("su", "ua", "au"):
            self.illegal += 1
        self.initials.append(ini)
        self.faults.append(fault)
        gone = fault in "bd"
        self.roles.append("" if gone else role)
        self.texts.append("" if gone else text)
        self.bytes += 0 if gone else len(text)
        if not self.seen or self.seen[-1] != turn:
            self.seen.append(turn)

    def row(self, part: int, whole: bool) -> tuple:
        turns = list(zip(self.faults, self.initials))
        roles, texts, edits, cost, costs = self.roles, self.texts, None, None, None
        if whole:
            cost, edits, _ = search(turns)
            roles, texts = apply_edits(edits, 0, roles, texts)
        else:
            costs = least_costs(turns)
        known = [t for t in self.seen if t is not None]
        count = self.faults.count
        ends = lambda x: (x[0], x[-1]) if x else (None, None)
        return (self.conv, part, self.no, whole, len(turns), count("b"), count("d"), count("t"), self.illegal,
                *ends(self.initials), *ends(known), len(known), *ends(self.seen), "".join(self.faults),
                self.initials, roles, texts, edits, cost, costs)


def _pieces(rows: DataFrame, most: int) -> DataFrame:
    """Sorted rows cut into pieces; those that are whole conversations are repaired."""
    kind = rows.schema["conv"].dataType.simpleString()
    schema = _PIECE.format(kind=kind)
    names = arrow_schema(schema)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        out, size, now, first = [], 0, None, True

        def flush():
            nonlocal out, size
            cols = list(zip(*out))
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(cols, names)], schema=names)
            out, size = [], 0
            return batch

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("conv", "turn", "role", "kept_text", "n", "fault")]
            for conv, turn, role, text, n, fault in zip(*cols):
                if now is None or now.conv != conv:
                    if now is not None:
                        # a conversation at a task's edge may go on in the next task
                        out.append(now.row(part, now.no == 0 and not first))
                        size, first = size + now.bytes, False
                    now = _Piece(conv, 0)
                for k in range(n):
                    if len(now.faults) >= most or now.bytes > 4 << 20:
                        out.append(now.row(part, False))
                        size += now.bytes
                        now = _Piece(conv, now.no + 1)
                    now.add(turn, role, text, fault if k == 0 or fault == "b" else "d")
                    if size > 8 << 20 or len(out) >= 2000:
                        yield flush()
        if now is not None:
            out.append(now.row(part, False))
        if out:
            yield flush()

    return map_arrow(rows, run, schema)


def _ends(pieces: DataFrame) -> DataFrame:
    """(conv, part, no, end): the cost left behind each piece by state; null behind the last."""
    kind = pieces.schema["conv"].dataType.simpleString()

    def run(table):
        import pyarrow as pa
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["no"]))
        # cost left before the turns behind a piece, insertions there included
        tail = list(DONE)
        for _ in range(3):
            tail = [min(tail[s], tail[_NEXT[s][1]] + 3) for s in range(4)]
        out, left = [], None
        for r in reversed(rows):
            out.append((r["conv"], r["part"], r["no"], left))
            behind, m = left or tail, r["costs"]
            left = [min(INF, min(m[4 * s + t] + behind[t] for t in range(4))) for s in range(4)]
        cols = list(zip(*out))
        return pa.table([pa.array(cols[0], table.schema.field("conv").type), pa.array(cols[1], pa.int32()),
                         pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.list_(pa.int64()))],
                        names=["conv", "part", "no", "end"])

    return pieces.select("conv", "part", "no", "costs").groupBy("conv").applyInArrow(
        run, f"conv {kind}, part int, no int, end array<long>")


def _starts(ways: DataFrame) -> DataFrame:
    """(conv, part, no, start): the state each piece begins in, from the last states of its four ways."""
    kind = ways.schema["conv"].dataType.simpleString()

    def run(table):
        import pyarrow as pa
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["no"]))
        out, state = [], 0
        for r in rows:
            out.append((r["conv"], r["part"], r["no"], state))
            state = r["last"][state]
        cols = list(zip(*out))
        return pa.table([pa.array(cols[0], table.schema.field("conv").type),
                         *[pa.array(c, pa.int32()) for c in cols[1:]]], names=["conv", "part", "no", "start"])

    return ways.select("conv", "part", "no", "last").groupBy("conv").applyInArrow(
        run, f"conv {kind}, part int, no int, start int")


def _with(pieces: DataFrame, more: DataFrame, *columns: str) -> DataFrame:
    """``pieces`` with columns of another table that has one row for each of them."""
    m = more.select(F.col("conv").alias("c"), F.col("part").alias("p"), F.col("no").alias("o"), *columns)
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("no") == F.col("o"))
    return pieces.join(m, same).drop("c", "p", "o")


def _in_order(pieces: DataFrame) -> DataFrame:
    """Pieces of conversations that have several.  Each is searched from all four states,
    in any order; which way is taken follows from the states the ways end in."""
    fields = [f for f in pieces.columns if f != "costs"]
    ddl = (f"conv {pieces.schema['conv'].dataType.simpleString()}, part int, no int, way_edits array<string>, "
           "way_cost array<long>, last array<int>")
    schema = arrow_schema(ddl)

    def ways(batches):
        import pyarrow as pa
        for b in batches:
            out = []
            for r in b.to_pylist():
                end = r["end"] or DONE
                got = [search(list(zip(r["turns"], r["initials"])), s, r["end"]) for s in range(4)]
                out.append({"conv": r["conv"], "part": r["part"], "no": r["no"],
                            "way_edits": [g[1] for g in got], "way_cost": [g[0] - end[g[2]] for g in got],
                            "last": [g[2] for g in got]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    d = _with(pieces.select("conv", "part", "no", "turns", "initials"), _ends(pieces), "end")
    found = store(map_arrow(d, ways, ddl))
    taken = _with(found, _starts(found), "start").select(
        "conv", "part", "no", "start", F.col("way_edits")[F.col("start")].alias("edits"),
        F.col("way_cost")[F.col("start")].alias("cost"))

    def change(batches):
        import pyarrow as pa
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                r["roles"], r["texts"] = apply_edits(r["edits"], r["start"], r["roles"], r["texts"])
            schema = b.schema.remove(b.schema.get_field_index("start"))
            yield pa.RecordBatch.from_pylist([{f: r[f] for f in schema.names} for r in rows], schema=schema)

    d = _with(pieces.select([f for f in fields if f not in ("edits", "cost")]), taken, "edits", "cost", "start")
    return map_arrow(d, change, d.drop("start").schema)


def repair(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """Repaired pieces of the conversations of ``rows`` (conv, turn, role, text, n).

    A row stands for n equal turns; n = 0 makes its conversation known only.  Turns go by
    turn (nulls first), role, text.  A conversation comes as one row or, if it is longer
    than ``piece`` turns or lies at a task's edge, as several in the order of (part, no):
    counts of its faults, ``edits``, their ``cost``, and ``roles`` and ``texts`` of the
    repaired turns.  Nulls in conv and turn are values of their own; role and text may
    not be null.  Equal rows are duplicates but for the first; a conversation without
    turns gives one row without edits; an empty table gives none.
    """
    # of a text, the ranges' samples carry its head only to the driver
    d = _faults(rows).withColumn("head", F.substring("text", 1, 64))
    d = d.repartitionByRange("conv", "turn", "role", "head").sortWithinPartitions("conv", "turn", "role", "text")
    pieces = store(_pieces(d.select("conv", "turn", "role", "kept_text", "n", "fault"), piece))
    return pieces.where("whole").drop("costs").unionByName(_in_order(pieces.where("not whole")))


def _digest(pieces: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of pieces (conv, part, no, lines), one conversation after
    the other and piece by piece, so that no conversation is held whole."""
    kind = pieces.schema["conv"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        now = sha = None
        begun = False

        def result(done):
            cols = list(zip(*done)) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], conv_type), pa.array(cols[1], pa.string())],
                                              names=["conv", "repaired_sha256"])
        for b in batches:
            conv_type, done = b.schema.field("conv").type, []
            for conv, lines in zip(b.column("conv").to_pylist(), b.column("lines").to_pylist()):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append((now[0], sha.hexdigest()))
                    now, sha, begun = (conv,), hashlib.sha256(), False
                for line in lines:
                    sha.update((b"\n" if begun else b"") + line.encode())
                    begun = True
            yield result(done)
        if now is not None:
            yield result([(now[0], sha.hexdigest())])

    d = pieces.select("conv", "part", "no", "lines").repartition("conv").sortWithinPartitions("conv", "part", "no")
    return map_arrow(d.select("conv", "lines"), run, f"conv {kind}, repaired_sha256 string")


def summary(pieces: DataFrame) -> DataFrame:
    """One row a conversation from the pieces of ``repair``: (conv, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256), the digest over the repaired
    ``role:text`` joined by newlines."""
    d = pieces.withColumn("lines", F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)))
    one = d.where("whole").withColumn("repaired_sha256", F.sha2(F.array_join("lines", "\n"), 256)).select(
        "conv", "n_turns", "blank", "duplicate", "truncated", "illegal", "least_turn", "greatest_turn",
        "distinct_turns", "cost", F.col("edits").alias("audit"), "repaired_sha256")
    many = d.where("not whole")
    none = lambda c: F.coalesce(c, F.lit(0))
    # neighbours across two pieces; pieces without turns have none
    order = Window.partitionBy("conv").orderBy("part", "no")
    before = lambda c: F.lag(c).over(order)
    joint = F.concat(before("last_ini"), "first_ini")
    steps = many.where("n_turns > 0").select(
        "conv", F.when(joint.isNotNull() & ~joint.isin("su", "ua", "au"), 1).otherwise(0).alias("more_illegal"),
        F.when(before("last_turn") == F.col("first_turn"), 1).otherwise(0).alias("same_turn")).groupBy(
        F.col("conv").alias("c")).agg(F.sum("more_illegal").alias("more_illegal"), F.sum("same_turn").alias("same_turn"))
    sums = many.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("n_turns", "blank", "duplicate", "truncated", "illegal", "distinct_turns", "cost")],
        F.min("least_turn").alias("least_turn"), F.max("greatest_turn").alias("greatest_turn"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "no", "edits"))),
                                 lambda x: x["edits"]), "").alias("audit"))
    sums = sums.join(steps, F.col("conv").eqNullSafe(F.col("c")), "left").drop("c").withColumn(
        "illegal", F.col("illegal") + none(F.col("more_illegal"))).withColumn(
        "distinct_turns", F.col("distinct_turns") - none(F.col("same_turn"))).drop("more_illegal", "same_turn")
    digest = _digest(many).withColumnRenamed("conv", "c")
    sums = sums.join(digest, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    gaps = none(F.col("greatest_turn") - F.col("least_turn") + 1 - F.col("distinct_turns"))
    return one.unionByName(sums).select("conv", gaps.cast("long").alias("gaps"), "blank", "duplicate",
                                        "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _sql() -> str:
    """DuckDB: from the last turn back, the least (cost, edits) left from every state."""
    from sortproof.plans.oracle import crc32_hex

    def step(v: str, cost: str, letter: str, line: str) -> str:
        return (f"{{'k': lpad((substr({v}.k, 1, 9)::INT + {cost})::VARCHAR, 9, '0') || '{letter}' || substr({v}.k, 10), "
                f"'t': {line} || {v}.t}}")

    def least(*x: str) -> str:
        return f"list_sort([{', '.join(x)}])[1]"

    w = []
    for s, (role, to) in enumerate(_NEXT):
        kept = {ini: t for (a, ini), t in _KEEP.items() if a == s}
        stay = least(step(f"v{s}", "4", "D", "''"), step(f"v{to}", "cut + 3", "R", f"chr(10) || '{role}:' || text"),
                     "CASE left(role, 1) " + " ".join(
                         f"WHEN '{ini}' THEN " + step(f"v{t}", "cut", "K", "chr(10) || role || ':' || text")
                         for ini, t in kept.items()) + " ELSE {'k': '999999999', 't': ''} END")
        w.append(f"CASE WHEN fault IN ('b', 'd') THEN {step(f'v{s}', '4', 'D', chr(39) * 2)} ELSE {stay} END AS w{s}")
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    one = lambda to, line: step(f"w{to}", "3", "I", line)
    two = ("{'k': lpad((substr(w3.k, 1, 9)::INT + 6)::VARCHAR, 9, '0') || 'II' || substr(w3.k, 10), "
           f"'t': {user} || {assistant} || w3.t}}")
    u = [least("w0", one(2, user), two), least("w1", one(2, user), two),
         least("w2", one(3, assistant)), least("w3", one(2, user))]
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    crc = crc32_hex("hex(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")
    return f"""
WITH RECURSIVE x AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc} % 20 AS k FROM conversations),
ids AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS c FROM (SELECT DISTINCT conv_id FROM x)),
y AS (SELECT c, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
  CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT * FROM x WHERE k <> 0 UNION ALL SELECT * FROM x WHERE k = 3) z
  JOIN ids ON z.conv_id IS NOT DISTINCT FROM ids.conv_id),
o AS (SELECT *, row_number() OVER w AS i, lag(left(role, 1)) OVER w AS before,
  rtrim(text, {space}) AS body FROM y WINDOW w AS (PARTITION BY c ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT *, CASE WHEN body = '' THEN 'b' WHEN i > min(i) OVER (PARTITION BY c, role, text) THEN 'd'
  WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault FROM o),
g AS (SELECT *, CASE fault WHEN 't' THEN 3 ELSE 0 END AS cut FROM f),
facts AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
  count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY c),
back AS (SELECT c, n + 1 AS i, {{'k': '000000000', 't': ''}} AS v0,
    {{'k': '000000006II', 't': {user} || {assistant}}} AS v1,
    {{'k': '000000003I', 't': {assistant}}} AS v2, {{'k': '000000000', 't': ''}} AS v3 FROM facts
  UNION ALL SELECT c, i, {', '.join(u)} FROM (
    SELECT g.c, g.i, {', '.join(w)} FROM back JOIN g ON g.c = back.c AND g.i = back.i - 1))
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(substr(v0.k, 1, 9)::BIGINT, 0) AS cost,
  coalesce(substr(v0.k, 10), '') AS audit, sha256(substr(coalesce(v0.t, ''), 2)) AS repaired_sha256
FROM ids LEFT JOIN facts USING (c) LEFT JOIN (SELECT * FROM back WHERE i = 1) USING (c)"""


SQL = _sql()
