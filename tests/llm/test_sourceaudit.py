import random
import re
from collections import Counter, defaultdict

from sortproof.llm import sourceaudit

DDL = "doc_id long, lang string, source string, text string, term string, n string, z string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, min_df, top):
    docs = [(lang or "", source or "", Counter(terms(text))) for _, lang, source, text, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df, total, by = Counter(), Counter(), defaultdict(Counter)
        for _, source, c in mine:
            df.update(c.keys())
            total.update(c)
            by[source].update(c)
        vocab = [t for t in df if df[t] >= min_df]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in vocab) + 2 * len(vocab))
                           for t in vocab}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        q, p = share(total), {s: share(by[s]) for s in by}
        for s in by:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in vocab), o.encode()) for o in by if o != s)
            term = sorted((-f(p[s][t], q[t]), t.encode()) for t in vocab if by[s][t] and p[s][t] > q[t])[:top]
            for part, ranked in (("pair", pair), ("term", term)):
                out += [(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(ranked, 1)]
    return sorted(out)


def rows_of(seed, n):
    rng = random.Random(seed)
    stock = ["the", "The", "ant", "été", "É", "x1y", "ab-c", "漢字", "don't", "a\x00b", "zz", "ſ", "K"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None, ""])
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", "é", None, ""])
        k = rng.choice([0, 1, 3, 8, 30])
        part = stock[:rng.randint(1, len(stock))] if source != "s2" else stock
        text = rng.choice([" ", "\n", "."]).join(rng.choice(part) for _ in range(k))
        rows.append((i, lang, source, rng.choice([text, text, text, None]), "x", "y", "z"))
    return rows


def test_brute_force(spark):
    for seed, n, min_df in ((1, 150, 10), (2, 40, 3), (3, 12, 1)):
        rows = rows_of(seed, n)
        rows += rows[:5]                                     # repeated rows
        rows.append((None, "de", "only", "ein Wort", "", "", ""))
        rows += [(900 + i, "xx", f"q{i % 3}", "", "", "", "") for i in range(4)]  # no terms: V = 0
        df = spark.createDataFrame(rows, DDL).repartition(5)
        got = sorted(map(tuple, sourceaudit.audit(df, min_df=min_df, top=4).collect()))
        assert got == brute(rows, min_df, 4)


def test_vectors_and_sums(spark):
    rows = rows_of(4, 60)
    df = spark.createDataFrame(rows, DDL)
    got = {r.id: dict(zip(r.terms, r.counts)) for r in sourceaudit.document_vectors(df).collect()}
    assert got == {i: dict(Counter(terms(text))) for i, _, _, text, *_ in rows}
    n, held, docs = Counter(), Counter(), Counter()
    for _, lang, source, text, *_ in rows:
        c = Counter(terms(text))
        g = (lang or "", source or "")
        docs[g] += 1
        for t in c:
            n[g, t] += c[t]
            held[g, t] += 1
    sums = sourceaudit.group_sums(df).collect()
    assert {((r.lang, r.source), r.term): (r.n, r.df) for r in sums if r.term is not None} == {
        k: (n[k], held[k]) for k in n}
    assert {(r.lang, r.source): r.df for r in sums if r.term is None} == dict(docs)


def test_long_text_empty_table_and_types(spark):
    long = "Alpha beta " * 600_000 + "w" * 1_000_000
    df = spark.createDataFrame([(i, "en", "a", long, "", "", "") for i in range(2)], DDL)
    sums = {r.term: (r.n, r.df) for r in sourceaudit.group_sums(df).collect()}
    assert sums["alpha"] == (1_200_000, 2) and sums["w" * 1_000_000] == (2, 2) and len(sums) == 4
    none = sourceaudit.audit(spark.createDataFrame([], DDL))
    assert none.count() == 0
    assert none.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                           ("value", "bigint"), ("rank", "int")]


def test_pairs_beyond_shared_terms_are_not_joined(spark):
    """Sources without a common term meet in the closed form only."""
    rows = [(i, "en", f"s{i % 6}", f"{'abcdef'[i % 6] * 3} " * (1 + i % 4), "", "", "") for i in range(120)]
    df = spark.createDataFrame(rows, DDL)
    assert sorted(map(tuple, sourceaudit.audit(df, min_df=10).collect())) == brute(rows, 10, 10)
