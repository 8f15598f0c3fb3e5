"""Line-first cleaning: rules per line, then a verdict on what is left.

Every line (text between ``\\n``) with a word meets three rules:

* punctuation: it holds a sentence mark (``. ! ?`` or one of their CJK kin), its
  words end in ``!`` or ``?`` in at most ``max_shout`` of a hundred cases, and at
  most ``max_symbols`` of a hundred of its characters other than white space are
  symbols ``#*$%&|<>{}[]\\^~=_``;
* navigation: fewer than three separators ``| > » · • ::`` standing as words, or
  under a tenth of its words;
* boilerplate: a line of at most ``boilerplate_words`` words holds none of the
  phrases of web and licence boilerplate.

Lines that fail go.  A document is rejected if less than ``min_left`` of a hundred
of its words are in the lines that stay.  The base figures and limits stand
before that.  DataFrame functions only, in one pass over the rows, no shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortproof.llm.frames import WORD

_WS = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"                    # fixed by the query's contract
LINE_SYMBOLS = "#*$%&|<>{}[]\\^~=_"
SENTENCE = r"[.!?。！？…؟।]"
SEPARATORS = ("|", ">", "»", "·", "•", "::")
PHRASES = ("all rights reserved", "released under the", "licensed under", "permission is hereby granted",
           "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
           "enable javascript", "lorem ipsum", "sign up for our newsletter", "click here",
           "copyright (c)", "spdx-license-identifier")

DEFAULTS = dict(max_shout=30, max_symbols=10, boilerplate_words=40, min_left=50)


def words(text: str | Column) -> Column:
    """Words of a text, as an array; none for null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(c, F.lit("")), _WS + "+"), lambda w: w != "")


def _count(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def line_ok(line: Column, max_shout: int, max_symbols: int, boilerplate_words: int, **_) -> Column:
    """Does a line with a word pass the punctuation, navigation and boilerplate rules?"""
    n = F.regexp_count(line, F.lit(WORD))
    solid = F.char_length(F.translate(line, " \t\n\x0b\f\r", ""))
    shout = F.regexp_count(line, F.lit(r"[!?](?=" + _WS + r"|$)"))
    marks = "|".join("\\" + s if s in "|" else s for s in SEPARATORS)
    separators = F.regexp_count(line, F.lit(r"(?<![^\x20\x09-\x0D])(?:" + marks + r")(?![^\x20\x09-\x0D])"))
    phrase = F.lower(line).rlike("|".join(re.escape(p) for p in PHRASES))
    return (line.rlike(SENTENCE)
            & (shout * 100 <= n * max_shout)
            & (_count(line, LINE_SYMBOLS) * 100 <= solid * max_symbols)
            & ((separators < 3) | (separators * 10 < n))
            & ~((n <= boilerplate_words) & phrase))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per input row: (id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_lines, n_lines_removed, words_left, text).

    text is what the lines that stay give, null if the document is rejected.  A
    null text has no words, is base_failed and so rejected, as are empty ones.
    Lines without a word stay and never count; null ids stay null; repeated rows
    repeat; other columns are ignored.  n_repeat_words compares three-word windows
    by 64-bit hash within one text.
    """
    o = DEFAULTS | limits
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    d = d.select("id", "t", words("t").alias("w"), F.split("t", "\n", -1).alias("lines"))
    d = d.withColumn("wordy", F.filter("lines", lambda x: x.rlike(WORD)))
    d = d.withColumn("n", F.size("w"))
    d = d.select(
        "id", "t", "n", "lines", "wordy",
        F.when(F.col("n") >= 3, F.transform(
            F.slice("w", 1, F.col("n") - 2),
            lambda x, i: F.struct(F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)).alias("h"),
                                  i.alias("i")))).alias("win"))
    d = d.withColumn("win", F.sort_array("win"))
    # places of windows that stand next to an equal one in hash order
    h = lambda i: F.get(F.col("win"), i)["h"]
    same = F.transform("win", lambda x, i: F.when(
        (F.when(i > 0, h(i - 1)) == x["h"]) | (h(i + 1) == x["h"]), x["i"]))
    d = d.withColumn("at", F.sort_array(F.array_compact(same)))
    covered = F.aggregate(
        F.transform("at", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("at", i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    d = d.withColumn("ok", F.filter("lines", lambda x: ~x.rlike(WORD) | line_ok(x, **o)))
    d = d.select(
        "id", F.col("n").cast("long").alias("n_words"),
        F.char_length(F.translate("t", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("wordy") - F.size(F.array_distinct("wordy"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("ok")).cast("long").alias("n_lines_removed"),
        F.array_join("ok", "\n").alias("text"))
    d = d.withColumn("words_left", F.when(F.col("n_lines_removed") == 0, F.col("n_words")).otherwise(
        F.regexp_count("text", F.lit(WORD))).cast("long"))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    kept = ~failed & (F.col("words_left") * 100 >= F.col("n_words") * o["min_left"])
    return d.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), kept.alias("kept"), "n_lines", "n_lines_removed",
                    "words_left", F.when(kept, F.col("text")).alias("text"))


_PHRASE_SQL = " OR ".join(f"contains(lower(l), '{p}')" for p in PHRASES)

SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT rn, no, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n FROM (
    SELECT rn, unnest(ls) AS l, generate_subscripts(ls, 1) AS no
    FROM (SELECT rn, string_split(t, chr(10)) AS ls FROM d))),
l2 AS (
  SELECT rn, n, l, n = 0 OR (
    regexp_matches(l, '[.!?\x{{3002}}\x{{FF01}}\x{{FF1F}}\x{{2026}}\x{{061F}}\x{{0964}}]')
    AND len(regexp_extract_all(l || ' ', '[!?][\x20\x09-\x0D]')) * 100 <= n * 30
    AND (length(l) - length(regexp_replace(l, '[#*$%&|<>{{}}\[\]\\^~=_]', '', 'g'))) * 100
      <= length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g')) * 10
    AND (sep < 3 OR sep * 10 < n)
    AND NOT (n <= 40 AND ({_PHRASE_SQL}))) AS ok,
    row_number() OVER (PARTITION BY rn, l ORDER BY no) AS again
  FROM (SELECT *, len(list_filter(regexp_extract_all(l, '[^\x20\x09-\x0D]+'),
      lambda x: x IN ('|', '>', '»', '·', '•', '::'))) AS sep FROM l)),
per AS (
  SELECT rn, count(*) AS n_lines, count(*) FILTER (NOT ok) AS n_lines_removed,
    coalesce(sum(n) FILTER (ok), 0) AS words_left, count(*) FILTER (n > 0 AND again > 1) AS n_dup_lines
  FROM l2 GROUP BY rn),
win AS (
  SELECT rn, i, count(*) OVER (PARTITION BY rn, g) AS c FROM (
    SELECT rn, i, [w[i], w[i + 1], w[i + 2]] AS g
    FROM (SELECT rn, w, unnest(range(1, len(w) - 1)) AS i FROM d))),
rep AS (
  SELECT rn, sum(least(3, coalesce(nxt - i, 3))) AS n_repeat_words
  FROM (SELECT rn, i, lead(i) OVER (PARTITION BY rn ORDER BY i) AS nxt FROM win WHERE c > 1) GROUP BY rn),
b AS (
  SELECT d.doc_id, len(d.w)::BIGINT AS n_words,
    length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    per.n_dup_lines::BIGINT AS n_dup_lines, coalesce(rep.n_repeat_words, 0)::BIGINT AS n_repeat_words,
    per.n_lines_removed::BIGINT AS n_lines_removed, per.words_left::BIGINT AS words_left
  FROM d JOIN per USING (rn) LEFT JOIN rep USING (rn))
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND words_left * 100 >= n_words * 50 AS kept
FROM b
"""
