"""URL filter with dated lists: a temporal as-of join.

A list is a log of entries (list, pattern, action, day): pattern is a host or a
parent domain, or one of these with a path prefix of whole segments
(``example.com/a/b``); action ``add`` puts it on the list from that day's start on,
``remove`` takes it off; days start at midnight UTC.  The log becomes validity intervals: an entry holds from
an ``add`` until the pattern's next event.  A capture (url, time) is judged by the
entries active at its time: of all active ones the longest pattern decides, and
at one pattern ``allow`` goes before ``block``.

Every capture is exploded into the patterns that could name it (parent domains and
path prefixes) and joined with the intervals on equality of the pattern and time
within the interval.  Intervals of one list and pattern never overlap, so a
capture meets at most one per list and pattern.  A host with a third of all
captures is a skewed key of that join, which Spark splits; when the list's part is
small Spark broadcasts it after measuring it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*/([^?#]*)"


def host(url: str | Column) -> Column:
    """Lower-case host of an absolute URL; '' if it has none."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def _named(pattern: str) -> Column:
    """The pattern with its host, not its path, in lower case."""
    p = F.col(pattern).cast("string")
    h = F.substring_index(p, "/", 1)
    return F.concat(F.lower(h), F.substr(p, F.length(h) + 1))


def intervals(log: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) of entries (list, pattern, action, day).

    valid_to is null while the entry stands.  Repeated entries count once; on one
    day ``remove`` comes after ``add``.  Rows with a null or an unknown action,
    list or day are ignored; hosts are lower-cased, paths are not.
    """
    e = log.select(F.col("list").cast("string").alias("list"),
                   _named("pattern").alias("pattern"),
                   F.col("action").cast("string").alias("action"), F.col("day").cast("date").alias("day"))
    e = e.where("list in ('block', 'allow') and action in ('add', 'remove') and pattern <> '' and day is not null")
    # the last action of a day counts ('remove' > 'add')
    e = e.groupBy("list", "pattern", "day").agg(F.max("action").alias("action"))
    nxt = Window.partitionBy("list", "pattern").orderBy("day")
    # a day starts at midnight UTC, whatever the session's time zone
    start = lambda day: F.timestamp_seconds(F.unix_date(day).cast("long") * 86400)
    return e.withColumn("next", F.lead("day").over(nxt)).where("action = 'add'").select(
        "list", "pattern", start("day").alias("valid_from"), start("next").alias("valid_to"))


def patterns(url: str | Column, depth: int | None = None) -> Column:
    """All patterns that name a URL: its host and parent domains of two labels or
    more (the bare host if it has one label), each also with every path prefix, up to
    ``depth`` segments if given."""
    h, path = host(url), F.regexp_extract(url, _PATH, 1)
    labels = F.split(h, r"\.")
    n = F.size(labels)
    domains = F.when(n < 2, F.array(h)).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, n), ".")))
    steps = F.filter(F.split(path, "/"), lambda s: s != "")
    deepest = F.size(steps) if depth is None else F.least(F.size(steps), F.lit(depth))
    prefixes = F.transform(F.sequence(F.lit(0), deepest),
                           lambda i: F.concat_ws("/", F.lit(""), F.slice(steps, 1, i)))
    return F.when(h == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.flatten(
        F.transform(domains, lambda d: F.transform(prefixes, lambda p: F.concat(d, p))))))


def judge(captures: DataFrame, log: DataFrame, id_col: str = "page_id", url_col: str = "url",
          time_col: str = "fetched") -> DataFrame:
    """One row per capture: (id, fetched, blocked, list, pattern, valid_from, valid_to, n_active).

    The last five tell the entry that decides (null without one) and how many are
    active.  A null or unusable URL and a null time match nothing.  Captures that
    repeat are judged each on its own; other columns are ignored.
    """
    c = captures.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"), F.col(time_col).cast("timestamp").alias("fetched"))
    v = intervals(log).withColumnRenamed("pattern", "p")
    # no pattern has more segments than the deepest of the log, so longer prefixes match nothing
    depth = v.agg(F.max(F.length("p") - F.length(F.replace("p", F.lit("/"), F.lit(""))))).first()[0] or 0
    c = c.select("row", "id", "fetched", F.explode_outer(patterns("url", depth)).alias("pattern"))
    j = c.join(v, on=[
        c.pattern == v.p, c.fetched >= v.valid_from,
        F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to"))], how="left")
    best = F.max(F.when(F.col("p").isNotNull(), F.struct(
        F.length("p").alias("n"), (F.col("list") == "allow").alias("a"), "list", "p",
        "valid_from", "valid_to"))).alias("best")
    out = j.groupBy("row", "id", "fetched").agg(best, F.count("p").alias("n_active"))
    return out.select("id", "fetched", F.coalesce(F.col("best.list") == "block", F.lit(False)).alias("blocked"),
                      "best.list", F.col("best.p").alias("pattern"), "best.valid_from", "best.valid_to",
                      "n_active")


# the query's captures and lists, derived from ``pages`` -------------------------------

def _digits(text: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), at, 7), 16, 10).cast("int")


def page_captures(pages: DataFrame) -> DataFrame:
    """pages with a fetch time in 2023 or 2024 that depends on the page's id."""
    seconds = F.pmod(F.col("page_id") * F.lit(7919 * 3607), F.lit(731 * 86400).cast("long"))
    return pages.select("page_id", "url", F.timestamp_seconds(
        F.lit(1672531200).cast("long") + seconds).alias("fetched"))


def page_lists(pages: DataFrame) -> DataFrame:
    """A dated log over the hosts of ``pages``: a part of the hosts is blocked, some of
    these are taken off and put back; some parent domains and first path segments are
    listed too, some allowed."""
    h = pages.select(host("url").alias("h"), F.regexp_extract("url", _PATH, 1).alias("path")).where("h <> ''")
    first = F.regexp_extract("path", r"^/*([^/]+)", 1)
    names = h.select(F.explode(F.array(
        "h", F.regexp_extract("h", r"([^.]+\.[^.]+)$", 1),
        F.when(first != "", F.concat(F.col("h"), F.lit("/"), first)))).alias("pattern")) \
        .where("pattern <> ''").distinct()
    e = names.select("pattern", _digits(F.col("pattern"), 1).alias("a"),
                     _digits(F.col("pattern"), 9).alias("b")).where("a % 3 = 0")
    start = F.date_add(F.lit("2022-10-01").cast("date"), F.pmod("b", F.lit(700)))
    kind = F.when(F.expr("a % 5 = 0"), "allow").otherwise("block")
    step = lambda n, action, days: e.where(f"b % {n} = 0").select(
        kind.alias("list"), "pattern", F.lit(action).alias("action"), F.date_add(start, days).alias("day"))
    return step(1, "add", 0).unionAll(step(2, "remove", 120)).unionAll(step(4, "add", 200)) \
        .unionAll(step(8, "remove", 200))


SQL = r"""
WITH c AS (
  SELECT row_number() OVER () AS rn, page_id, url,
    make_timestamp((1672531200 + (page_id * 28563833) % 63158400) * 1000000) AS fetched,
    lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS h,
    regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*/([^?#]*)', 1) AS path
  FROM pages),
names AS (
  SELECT DISTINCT pattern FROM (
    SELECT h AS pattern FROM c WHERE h <> '' UNION ALL
    SELECT regexp_extract(h, '([^.]+\.[^.]+)$', 1) FROM c WHERE h <> '' UNION ALL
    SELECT CASE WHEN regexp_extract(path, '^/*([^/]+)', 1) <> ''
      THEN h || '/' || regexp_extract(path, '^/*([^/]+)', 1) END FROM c WHERE h <> '')
  WHERE pattern <> ''),
e AS (
  SELECT *, CAST('0x' || substr(md5(pattern), 1, 7) AS INT) AS a,
    CAST('0x' || substr(md5(pattern), 9, 7) AS INT) AS b FROM names),
e2 AS (
  SELECT pattern, b, CASE WHEN a % 5 = 0 THEN 'allow' ELSE 'block' END AS list,
    DATE '2022-10-01' + (b % 700)::INT AS start FROM e WHERE a % 3 = 0),
log AS (
  SELECT list, pattern, 'add' AS action, start AS day FROM e2 UNION ALL
  SELECT list, pattern, 'remove', start + 120 FROM e2 WHERE b % 2 = 0 UNION ALL
  SELECT list, pattern, 'add', start + 200 FROM e2 WHERE b % 4 = 0 UNION ALL
  SELECT list, pattern, 'remove', start + 200 FROM e2 WHERE b % 8 = 0),
days AS (
  SELECT list, pattern, day, max(action) AS action FROM log GROUP BY ALL),
v AS (
  SELECT list, pattern, day::TIMESTAMP AS valid_from, nxt::TIMESTAMP AS valid_to FROM (
    SELECT *, lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS nxt FROM days) WHERE action = 'add'),
keys AS (
  SELECT DISTINCT rn, d || CASE WHEN k = 0 THEN '' ELSE '/' || array_to_string(steps[1:k], '/') END AS pattern
  FROM (SELECT rn, steps, unnest(range(0, len(steps) + 1)) AS k, d FROM (
    SELECT rn, list_filter(string_split(path, '/'), lambda s: s <> '') AS steps,
      unnest(CASE WHEN len(string_split(h, '.')) < 2 THEN [h] ELSE
        list_transform(range(1, len(string_split(h, '.'))),
          lambda i: array_to_string(string_split(h, '.')[i:], '.')) END) AS d
    FROM c WHERE h <> ''))),
hit AS (
  SELECT c.rn, v.*, row_number() OVER (PARTITION BY c.rn ORDER BY length(v.pattern) DESC, v.list = 'allow' DESC) AS k,
    count(*) OVER (PARTITION BY c.rn) AS n
  FROM c JOIN keys USING (rn) JOIN v ON v.pattern = keys.pattern
    AND c.fetched >= v.valid_from AND (v.valid_to IS NULL OR c.fetched < v.valid_to))
SELECT c.page_id, epoch_us(c.fetched) // 1000000 AS fetched_s, coalesce(hit.list = 'block', false) AS blocked,
  hit.list, hit.pattern, epoch_us(hit.valid_from) // 1000000 AS valid_from_s,
  epoch_us(hit.valid_to) // 1000000 AS valid_to_s, coalesce(hit.n, 0) AS n_active
FROM c LEFT JOIN hit ON c.rn = hit.rn AND hit.k = 1
"""
