import hashlib
import itertools
import random
import re
import zlib

import pytest

from sortproof.llm import convrepair as R

DDL = "conv_id long, turn long, role string, text string, conv string, n string, h string"
SHAPE = re.compile(r"(s?(ua)+)?\Z")


def brute(turns):
    """(cost, edits) by trying every sequence of edits, up to two insertions a place."""
    best = None
    inserted = ["", "I", "II"]
    for gaps in itertools.product(inserted, repeat=len(turns) + 1):
        for ops in itertools.product("DKR", repeat=len(turns)):
            edits = "".join(g + o for g, o in zip(gaps, ops)) + gaps[-1]
            for roles in itertools.product("ua", repeat=sum(e in "IR" for e in edits)):
                cost, i, out, given = 0, 0, "", iter(roles)
                for e in edits:
                    if e == "I":
                        cost, out = cost + 3, out + next(given)
                        continue
                    fault, ini = turns[i]
                    i += 1
                    if e == "D":
                        cost += 4
                        continue
                    if fault in "bd":
                        cost = 10**6
                    cost += (3 if e == "R" else 0) + (3 if fault == "t" else 0)
                    out += next(given) if e == "R" else ini or "?"
                if SHAPE.match(out) and (best is None or (cost, edits) < best):
                    best = (cost, edits)
    return best


def exact(turns):
    """(cost, edits, last state) by going back from the last turn."""
    shut = lambda w: [min(w[s], step(w[R._NEXT[s][1]], 3, "I"),
                          step(w[R._NEXT[R._NEXT[s][1]][1]], 6, "II")) for s in range(4)]
    step = lambda v, c, e: (v[0] + c, e + v[1])
    v = shut([(0, ""), (R.INF, ""), (R.INF, ""), (0, "")])
    for fault, ini in reversed(turns):
        w = []
        for s in range(4):
            ways = [step(v[s], 4, "D")]
            if fault not in "bd":
                cut = 3 * (fault == "t")
                ways.append(step(v[R._NEXT[s][1]], cut + 3, "R"))
                if (s, ini) in R._KEEP:
                    ways.append(step(v[R._KEEP[s, ini]], cut, "K"))
            w.append(min(ways))
        v = shut(w)
    return v[0]


def test_search_against_every_sequence():
    rng = random.Random(1)
    cases = [[]] + [[(f, i)] for f in "bdt-" for i in ("s", "u", "a", "x", "")]
    cases += [[(rng.choice("bdt--"), rng.choice("suax")) for _ in range(2)] for _ in range(25)]
    cases += [[(rng.choice("bt---"), rng.choice("sua")) for _ in range(3)] for _ in range(6)]
    for turns in cases:
        cost, edits, _ = R.search(turns)
        assert (cost, edits) == brute(turns), turns


def test_search_against_exact_and_estimates():
    rng = random.Random(2)
    for _ in range(1500):
        turns = [(rng.choice("bdttt------"), rng.choice("suuaaax")) for _ in range(rng.randint(0, 14))]
        assert R.search(turns)[:2] == exact(turns), turns
        assert R._estimate(turns)[0] <= exact(turns)[0]
    turns = [(rng.choice("bdt------"), rng.choice("suuuaaa")) for _ in range(R.PIECE)]
    assert R.search(turns)[:2] == exact(turns)
    long = [("t", "u")] * R.PIECE                       # the costliest kind of piece
    assert R.search(long)[:2] == exact(long)


def expected(rows):
    """The contract on plain rows: damage, faults, edits and digest of every conversation."""
    conv, order = {}, lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())
    for c, turn, role, text, *_ in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        mine = conv.setdefault(c, [])
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        mine += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = []
    for c, mine in conv.items():
        mine.sort(key=order)
        seen, turns = set(), []
        for _, role, text in mine:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-"
            seen.add((role, text))
            turns.append((fault, role[:1]))
        cost, edits = exact(turns)
        roles, texts = R.apply_edits(edits, 0, [m[1] for m in mine], [m[2] for m in mine])
        got = [m[0] for m in mine if m[0] is not None]
        gaps = max(got) - min(got) + 1 - len(set(got)) if got else 0
        inis = [t[1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(inis, inis[1:]))
        count = [t[0] for t in turns].count
        body = "\n".join(f"{r}:{t}" for r, t in zip(roles, texts))
        out.append((c, gaps, count("b"), count("d"), count("t"), illegal, cost, edits,
                    hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


def made_rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "and then", "", " ", None, "\t\n", "Ä.", "ok. ", "x" * 200]
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, t, t + 1, None, 3 * t])
            role = rng.choice(["user", "assistant"][t % 2:t % 2 + 1] * 6 + ["system", "user", "assistant", "tool", "", None])
            text = rng.choice(texts) if rng.random() < 0.4 else f"turn {t} of {c}" + rng.choice([".", ".", "!", ""])
            rows.append((c if c else None, turn, role, text, "a", "b", "c"))
    return rows + rows[::17]


def run(spark, rows, piece=R.PIECE, parts=5):
    df = spark.createDataFrame(rows, DDL).repartition(parts)
    return sorted(map(tuple, R.summary(R.repair(R.damage(df), piece)).collect()), key=str)


def test_contract(spark):
    rows = made_rows(3, 60, 9)
    assert run(spark, rows) == expected(rows)


def test_long_conversations_in_pieces(spark):
    rng = random.Random(5)
    rows = made_rows(4, 4, 60)
    rows += [(7, t, "user" if t % 2 == 0 else "assistant", f"line {t}.", "", "", "") for t in range(700)]
    rows += [(8, 1, "user", "the same.", "", "", "")] * 300          # equal rows: one stays
    rows += [(9, None, "tool", rng.choice(["p.", "q"]), "", "", "") for _ in range(90)]
    want = expected(rows)
    assert run(spark, rows, piece=7) == want
    assert run(spark, rows) == want


def test_pieces_hold_the_repaired_turns(spark):
    rows = [(1, t, r, x, "", "", "") for t, (r, x) in enumerate(
        [("user", "a."), ("user", "b."), ("assistant", "c."), ("assistant", "")])]
    d = spark.createDataFrame(rows, DDL).selectExpr("conv_id conv", "turn", "role", "text", "1L n")
    got = R.repair(d).orderBy("part", "no").collect()
    edits = "".join(r.edits for r in got)
    assert (sum(r.cost for r in got), edits) == exact([("-", "u"), ("-", "u"), ("-", "a"), ("b", "a")])
    assert [x for r in got for x in zip(r.roles, r.texts)] == list(
        zip(*R.apply_edits(edits, 0, [r[2] for r in rows], [r[3] for r in rows])))


def test_all_rows_dropped_empty_table_and_long_text(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "x.", "", "", "")]
    assert run(spark, rows) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert run(spark, []) == []
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "long text. " * 500_000, "", "", "")
            for c in (1, 2) for t in range(4)]
    assert run(spark, rows) == expected(rows)


def test_string_ids(spark):
    df = spark.createDataFrame([("x", 0, "user", "a."), ("x", 1, "assistant", "b.")],
                               "conv_id string, turn int, role string, text string")
    got = R.summary(R.repair(R.damage(df))).collect()
    assert [r.conv for r in got] == ["x"]


@pytest.mark.parametrize("start", range(4))
def test_matrix(start):
    rng = random.Random(start)
    for _ in range(40):
        turns = [(rng.choice("bdt---"), rng.choice("suax")) for _ in range(rng.randint(0, 6))]
        m = R.least_costs(turns)[4 * start:4 * start + 4]
        for t in range(4):
            end = tuple(0 if s == t else R.INF for s in range(4))
            if m[t] < R.INF:
                assert R.search(turns, start, end)[0] == m[t]
