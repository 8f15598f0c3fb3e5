"""How far the sources of a language diverge: term by term, and source against source.

A count vectoriser per language: every document becomes an exact sparse vector (terms
and their counts), the vocabulary keeps the terms in at least ``min_df`` documents of
the language, however many they are.  Vectors are summed by (language, source) as a
summariser does, first within a batch and then by Spark.  Summing is linear, so the
sums are taken before terms outside the vocabulary go, and no document is joined with
the vocabulary.  The vocabulary is a table, never a list on the driver.

Smoothed shares p = 1 + floor(10^9 (count + 2) / (N + 2 V)) are compared by
f = floor((p - q)^2 / (p + q)), all in integers.  Pairs of sources are evaluated
sparsely: every kept term counts as absent from both, terms of one source correct that
by a histogram of their counts, and only terms that both hold are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortproof.llm.frames import map_arrow, slices, store, words

SCALE = 1_000_000_000
#: ASCII letters lower-cased, every other ASCII byte a space; bytes of other characters stay.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def _terms(text):
    """Terms of Arrow texts without nulls: (flat terms, row offsets)."""
    import numpy as np
    import pyarrow as pa
    size = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1]
    data = (text.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[size[0]:size[-1]].translate(_LETTERS)
    clean = pa.StringArray.from_buffers(len(text), pa.py_buffer((size - size[0]).tobytes()), pa.py_buffer(data))
    return words(clean, lower=False)


def _sparse(batch):
    """Sparse vectors of a batch: (vocabulary, row of each entry, its term, its count)."""
    import numpy as np
    flat, ends = _terms(batch.column("text"))
    codes = flat.dictionary_encode()
    n = max(len(codes.dictionary), 1)
    row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
    at, count = np.unique(row * n + np.asarray(codes.indices, np.int64), return_counts=True)
    return codes.dictionary, at // n, at % n, count


def _prepared(docs: DataFrame, text_col: str, lang_col: str, source_col: str, *more) -> DataFrame:
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(plain(lang_col).alias("lang"), plain(source_col).alias("source"),
                       plain(text_col).alias("text"), *more)


def document_vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id, lang, source, terms, counts) of every document, whole texts.

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased; each
    comes once a document.  Null texts, languages and sources read as ''.
    """
    import pyarrow as pa

    def run(batches):
        import numpy as np
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                vocab, row, term, count = _sparse(b)
                ends = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("lang"), b.column("source"),
                     pa.ListArray.from_arrays(ends, vocab.take(pa.array(term))),
                     pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int64)))],
                    names=["id", "lang", "source", "terms", "counts"])

    d = _prepared(docs, text_col, lang_col, source_col, F.col(id_col).alias("id"))
    kind = d.schema["id"].dataType.simpleString()
    return map_arrow(d, run, f"id {kind}, lang string, source string, terms array<string>, counts array<long>")


def group_sums(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, df): occurrences of every term in a group of documents,
    and the documents that hold it.  Each group also has one row without a term, whose
    df is its number of documents."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for whole in batches:
            for b in slices(whole, "text", 8 << 20):
                vocab, row, term, count = _sparse(b)
                lang, source = (np.asarray(b.column(c).dictionary_encode().indices, np.int64)
                                for c in ("lang", "source"))
                names, first, group = np.unique(lang * (source.max(initial=0) + 1) + source,
                                                return_index=True, return_inverse=True)
                n = max(len(vocab), 1)
                at, entry = np.unique(group[row] * n + term, return_inverse=True)
                total = np.bincount(entry, count, len(at)).astype(np.int64)
                held = np.bincount(entry, minlength=len(at))
                who = pa.array(np.concatenate([first, first[at // n]]))
                terms = pa.concat_arrays([pa.nulls(len(names), pa.string()), vocab.take(pa.array(at % n))])
                yield pa.RecordBatch.from_arrays(
                    [pc.take(b.column("lang"), who), pc.take(b.column("source"), who), terms,
                     pa.array(np.concatenate([np.zeros(len(names), np.int64), total])),
                     pa.array(np.concatenate([np.bincount(group), held]).astype(np.int64))],
                    names=["lang", "source", "term", "n", "df"])

    d = _prepared(docs, text_col, lang_col, source_col)
    parts = map_arrow(d, run, "lang string, source string, term string, n long, df long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def vocabulary(sums: DataFrame, min_df: int = 10) -> DataFrame:
    """(lang, term, total, df): the terms in at least ``min_df`` documents of a language."""
    return sums.where("term is not null").groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("df").alias("df")).where(F.col("df") >= min_df)


def _share(count: str, n: str, v: str) -> Column:
    """1 + floor(10^9 (count + 2) / (n + 2 v)); null where the language keeps no term."""
    return F.expr(f"1 + (cast({count} + 2 as decimal(28,0)) * {SCALE}) "
                  f"div nullif(cast({n} as decimal(28,0)) + 2 * {v}, 0)")


def _f(p: str, q: str) -> str:
    return f"((({p} - {q}) * ({p} - {q})) div ({p} + {q}))"


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_df: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group that occurs.

    Part ``pair``: every other source of the language and the sum of f over all kept
    terms (0 if the language keeps none), all ranks.  Part ``term``: kept terms that are
    commoner in the group than in the language, by f, ranks to ``top``.  Ranks count
    from 1 by value downwards, then item in UTF-8 order, so no two are equal.

    Null texts, languages and sources read as '' and join the rows that hold ''; a
    group without terms has pairs only; repeated rows count each time; other columns
    are ignored, whatever their names; an empty table gives an empty one.
    """
    sums = store(group_sums(docs, text_col, lang_col, source_col))
    vocab = vocabulary(sums, min_df)
    kept = store(sums.select("lang", "source", "term", "n").join(
        vocab.select("lang", "term", "total"), ["lang", "term"]))
    langs = kept.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang").agg(
        F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    groups = sums.where("term is null").select("lang", "source").join(
        kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left").join(
        langs, "lang", "left").select(
        "lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"),
        F.coalesce("group_n", F.lit(0)).alias("group_n")).withColumn("z", _share("0L", "group_n", "v"))
    groups = store(groups)
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", _share("n", "group_n", "v"))

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms = shares.withColumn("q", _share("total", "lang_n", "v")).where("p > q").select(
        "lang", "source", F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    # of unordered pairs (a, b): what the terms that both hold add to the sums of each alone
    left = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("z").alias("za"))
    right = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("z").alias("zb"))
    both = left.join(right, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b").agg(
        F.sum(F.expr(f"{_f('pa', 'pb')} - {_f('pa', 'zb')} - {_f('za', 'pb')} + {_f('za', 'zb')}")).alias("both"))
    # of ordered pairs: the terms of a as if b had none, by the counts that occur in a
    other = groups.select("lang", F.col("source").alias("b"), F.col("z").alias("zb"))
    counts = shares.groupBy("lang", F.col("source").alias("a"), "p", F.col("z").alias("za")).agg(
        F.count("*").alias("m"))
    alone = counts.join(other, "lang").where("a <> b").groupBy("lang", "a", "b").agg(
        F.sum(F.expr(f"m * ({_f('p', 'zb')} - {_f('za', 'zb')})")).alias("alone"))
    pairs = groups.select("lang", F.col("source").alias("a"), "v", F.col("z").alias("za")).join(
        other, "lang").where("a <> b").withColumn("none", F.expr(f"v * {_f('za', 'zb')}"))
    mirrored = both.unionAll(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "both"))
    back = alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("alone").alias("back"))
    none = F.lit(0).cast("long")
    pairs = pairs.join(mirrored, ["lang", "a", "b"], "left").join(alone, ["lang", "a", "b"], "left").join(
        back, ["lang", "a", "b"], "left").select(
        "lang", F.col("a").alias("source"), F.col("b").alias("item"),
        (F.coalesce("none", none) + F.coalesce("both", none) + F.coalesce("alone", none)
         + F.coalesce("back", none)).alias("value")).withColumn("rank", F.row_number().over(by_value))
    columns = lambda df, part: df.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pairs, "pair").unionAll(columns(terms, "term"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
vocab AS (SELECT lang, term, count(*)::HUGEINT AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS ln FROM vocab GROUP BY lang),
n AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM w JOIN vocab USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS gn FROM g LEFT JOIN n USING (lang, source) GROUP BY ALL),
p AS (SELECT lang, source, term, coalesce(c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c, 0) + 2)) // (gn + 2 * v) AS p,
    1 + (1000000000::HUGEINT * (total + 2)) // (ln + 2 * v) AS q
  FROM gn JOIN langs USING (lang) JOIN vocab USING (lang) LEFT JOIN n USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""
