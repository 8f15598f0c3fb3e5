"""Embedding near-duplicates: product quantisation over coarse inverted lists.

Vectors are normalised; a cosine of ``threshold`` or more is a distance of
``r = sqrt(2 - 2 threshold)`` or less.  A coarse quantiser (k-means on a bounded
sample, lists in proportion to the vectors up to ``max_lists``) puts every vector
in the inverted list of its nearest centroid, with a product-quantised code of its
residual: ``subspaces`` parts, each the nearest of at most 256 centroids, and the
exact error of the reconstruction.

Sufficient probes: if y lies in the list of c, x is at most the length of y - x
along c - c0 beyond the plane half-way between its own centroid c0 and c.  x probes
every list for which that is possible for a step in that direction of at most ``r``,
which no linked pair exceeds.  How much of r a difference takes in a direction u is
measured: ``QUERIES`` vectors, drawn by hash, are compared with all others, and their
linked differences, each at length 1 and each query counting once, give the mean square M
of their parts in every direction; the step is ``r * min(1, spread * sqrt(u' M u))``.
Where differences lie along few directions it is r in these, and where no query has a
link it is r throughout.  ``spread=None`` takes r in all directions: no pair is lost, at
the price of nearly all lists probed.
(With ``sigmas`` the step is ``r * min(1, sigmas / sqrt(dim))``, ``dim`` the length of x.)
A pair is met once, in the list of the later centroid.  In a list, the
asymmetric distance from x to the code of y (table look-ups per subspace) less the
error of y is a lower bound of |x - y|; pairs above r are dropped, which loses
nothing, and the others are reranked by exact cosine in double
precision.  Equal vectors are one entry with a count.

A list is cut into blocks of ``block`` vectors (its visitors too) and every pair of blocks is a group
of its own, so a list that holds a third of all vectors spreads over many tasks.
Groups return sums of links per vector and a spanning forest of their links, never
the pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortproof.llm.components import connected_components
from sortproof.llm.frames import cut, map_arrow

#: Vectors that the quantisers are fitted on, and that links are measured on, at most.
SAMPLE, QUERIES = 16_384, 512
#: Links of a query in one batch whose differences are taken; the others count by weight.
TAKEN = 8


def _kmeans(x, k, rounds=8, seed=7):
    import numpy as np
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = _nearest(x, c)
        n = np.bincount(at, minlength=k)
        some = n > 0
        first = (np.cumsum(n) - n)[some]
        c[some] = np.add.reduceat(x[np.argsort(at, kind="stable")], first, axis=0) / n[some, None]
    return c


def _nearest(x, c, step=4096):
    import numpy as np
    half = (c * c).sum(1) / 2
    return np.concatenate([np.zeros(0, np.int64)] + [
        (half - x[i:i + step] @ c.T).argmin(1) for i in range(0, len(x), step)])


class Index:
    """Fitted quantisers: coarse centroids and, per subspace, centroids of residuals."""

    def __init__(self, sample, lists: int, subspaces: int, codes: int = 256):
        import numpy as np
        self.dim = sample.shape[1]
        self.spread = None          # mean square parts of linked differences times spread^2
        self.coarse = _kmeans(sample, min(lists, len(sample)))
        rest = sample - self.coarse[_nearest(sample, self.coarse)]
        edges = np.linspace(0, self.dim, min(subspaces, self.dim) + 1).astype(int)
        self.parts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        self.books = [_kmeans(np.ascontiguousarray(rest[:, a:z]), min(codes, len(sample)), 6, 11)
                      for a, z in self.parts]

    def encode(self, x):
        """(list, codes, reconstruction error) of normalised vectors."""
        import numpy as np
        at = _nearest(x, self.coarse)
        rest = x - self.coarse[at]
        codes = np.empty((len(x), len(self.parts)), np.uint8)
        near = np.empty_like(rest)
        for m, (a, z) in enumerate(self.parts):
            codes[:, m] = _nearest(np.ascontiguousarray(rest[:, a:z]), self.books[m])
            near[:, a:z] = self.books[m][codes[:, m]]
        return at, codes, np.sqrt(((rest - near) ** 2).sum(1))

    def measured(self, m, spread: float) -> None:
        """Limit steps to ``spread`` times the root of u' m u in direction u."""
        self.spread = m * spread * spread
        self.spread_norm = ((self.coarse @ self.spread) * self.coarse).sum(1)

    def probes(self, x, at, r):
        """(row, list) for every later list that may hold a vector within r (one per row) of the row."""
        import numpy as np
        c = self.coarse
        norm = (c * c).sum(1)
        r = np.broadcast_to(r, len(x))
        rows, lists = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(0, len(x), 512):
            part, own = x[i:i + 512], at[i:i + 512]
            over = norm[None] - 2 * part @ c.T               # less |x|^2, which cancels
            over -= over[np.arange(len(part)), own][:, None]
            gap = np.sqrt(np.maximum(norm[own][:, None] + norm[None] - 2 * c[own] @ c.T, 0))
            reach = (r[i:i + 512, None] + 1e-9) * gap
            if self.spread is not None:
                # (c - c0)' M (c - c0), as the norms are from products
                mc = c[own] @ self.spread
                part_of = (mc * c[own]).sum(1)[:, None] + self.spread_norm[None] - 2 * mc @ c.T
                reach = np.minimum(reach, r[i:i + 512, None] * np.sqrt(np.maximum(part_of, 0)) + 1e-9)
            near = over <= 2 * reach + 1e-9
            near &= np.arange(len(c))[None] > own[:, None]
            a, b = np.nonzero(near)
            rows.append(a + i)
            lists.append(b)
        return np.concatenate(rows), np.concatenate(lists)

    def adc(self, x, list_no, codes):
        """Squared distances of rows x to the reconstructions of codes in one list."""
        import numpy as np
        rest = x - self.coarse[list_no]
        out = np.empty((len(codes), len(x)))
        for i in range(0, len(x), 128):             # tables of 128 rows stay in the cache
            part = np.zeros((len(codes), len(rest[i:i + 128])))
            for m, (a, z) in enumerate(self.parts):
                book = self.books[m]
                q = rest[i:i + 128, a:z]
                table = (book * book).sum(1)[:, None] + (q * q).sum(1)[None] - 2 * book @ q.T
                part += table[codes[:, m]]
            out[:, i:i + 128] = part
        return out.T


def _matrix(column, dim):
    """Arrow list<float> without nulls -> float64 rows, zero-padded to ``dim``."""
    import numpy as np
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    flat = np.asarray(column.flatten(), np.float64)
    n = np.diff(np.asarray(column.offsets, np.int64))
    out = np.zeros((len(n), dim))
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def _unit(column, dim):
    import numpy as np
    x = _matrix(column, dim)
    if not len(x):
        return x
    x = x / np.abs(x).max(1)[:, None]               # large components don't overflow
    return x / np.sqrt((x * x).sum(1))[:, None]


def _encoder(sent, r, sigmas):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        ix = sent.value
        for b in (w.slice(i, 1024) for w in batches for i in range(0, w.num_rows, 1024)):
            x = _unit(b.column("v"), ix.dim)
            at, codes, err = ix.encode(x)
            size = np.asarray(b.column("size"), np.float64)
            step = r if sigmas is None else r * np.minimum(1.0, sigmas / np.sqrt(size))
            row, probe = ix.probes(x, at, step)
            every = np.concatenate([np.arange(len(x)), row])
            take = pa.array(every)
            lists = np.concatenate([at, probe])
            member = np.arange(len(every)) < len(x)
            yield pa.RecordBatch.from_arrays([
                b.column("id").take(take), b.column("n").take(take), b.column("size").take(take),
                b.column("v").take(take), pa.array(lists), pa.array(member),
                pa.array([codes[i].tobytes() if m else None for i, m in zip(every, member)], pa.binary()),
                pa.array(np.where(member, err[every], np.nan))],
                names=["id", "n", "size", "v", "list", "member", "code", "err"])
    return run


def _forest(left, right, linked):
    """Spanning edges of a boolean link matrix, as (left id, right id)."""
    import numpy as np
    i, j = np.nonzero(linked)
    if not len(i):
        return i, j
    # smallest label spreads over the links; the link that brings a label is kept
    lab_l, lab_r = left.copy(), right.copy()
    while True:
        new_r = lab_r.copy()
        np.minimum.at(new_r, j, lab_l[i])
        new_l = lab_l.copy()
        np.minimum.at(new_l, i, new_r[j])
        if (new_l == lab_l).all() and (new_r == lab_r).all():
            break
        lab_l, lab_r = new_l, new_r
    rows, cols = np.unique(i), np.unique(j)
    a = np.concatenate([left[rows], right[cols]])
    b = np.concatenate([lab_l[rows], lab_r[cols]])
    return a[a != b], b[a != b]


def _grouper(sent, threshold, r):
    def run(key, table):
        import numpy as np
        import pyarrow as pa
        ix = sent.value
        list_no = key[0].as_py()
        same = key[1].as_py() == key[2].as_py()
        side = np.asarray(table.column("side").combine_chunks())
        ids = np.asarray(table.column("id").combine_chunks(), np.int64)
        n = np.asarray(table.column("n").combine_chunks(), np.int64)
        size = np.asarray(table.column("size").combine_chunks(), np.int64)
        x = _unit(table.column("v"), ix.dim)
        err = np.asarray(table.column("err").combine_chunks(), np.float64)
        mine = np.flatnonzero(side >= 1)                # the block whose codes are searched
        seek = mine if same else np.flatnonzero(side == 0)
        out = [[], [], []]
        if not len(mine):
            seek = mine
        code = np.frombuffer(b"".join(table.column("code").take(pa.array(mine)).to_pylist()),
                             np.uint8).reshape(len(mine), len(ix.parts))
        step = 1024
        for s in range(0, len(seek), step):
            q = seek[s:s + step]
            far = (err[mine] + (r + 1e-6)) ** 2
            near = (ix.adc(x[q], list_no, code) <= far[None]) & (size[q][:, None] == size[mine][None])
            if same:                                    # each pair of the block once
                near &= np.arange(s, s + len(q))[:, None] < np.arange(len(mine))[None]
            if not near.any():
                continue
            rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            i, j = np.nonzero(near)
            if len(i) * 8 > len(rows) * len(cols):
                link = (x[q[rows]] @ x[mine[cols]].T >= threshold) & near[np.ix_(rows, cols)]
            else:                                       # few pairs: only their cosines
                good = np.concatenate([np.zeros(0, bool)] + [
                    (x[q[i[k:k + 65536]]] * x[mine[j[k:k + 65536]]]).sum(1) >= threshold
                    for k in range(0, len(i), 65536)])
                link = np.zeros((len(rows), len(cols)), bool)
                link[np.searchsorted(rows, i[good]), np.searchsorted(cols, j[good])] = True
            a, b = _forest(ids[q[rows]], ids[mine[cols]], link)
            out[0].append(np.concatenate([a, ids[q[rows]], ids[mine[cols]]]))
            out[1].append(np.concatenate([b, np.full(len(rows) + len(cols), -1)]))
            out[2].append(np.concatenate([np.zeros(len(a), np.int64), link @ n[mine[cols]],
                                          n[q[rows]] @ link]))
        a, b, c = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)
        keep = (b >= 0) | (c > 0)
        return pa.table({"a": a[keep], "b": pa.array(b[keep], mask=b[keep] < 0), "links": c[keep]})
    return run


def _linked(b, ask, dim, threshold):
    """(unit rows of a batch, which of them link with each query but itself)."""
    import numpy as np
    x = _unit(b.column("v"), dim)
    cos = x @ ask["x"].T
    same = np.asarray(b.column("size"), np.int64)[:, None] == ask["size"][None]
    own = np.asarray(b.column("id"), np.int64)[:, None] == ask["id"][None]
    return x, (cos >= threshold) & same & ~own


def _directions(entries: DataFrame, dim: int, threshold: float):
    """Mean square parts of linked differences (dim x dim), None if no query has a link.

    The queries are compared with all vectors in two passes: links are counted, then the
    differences summed, a query's by one over its links.  Sums meet in 16 tasks, then one.
    """
    import numpy as np
    spark = entries.sparkSession
    got = entries.orderBy(F.xxhash64(F.lit(5), "id")).limit(QUERIES).toArrow()
    ask = {"x": _unit(got.column("v"), dim), "id": np.asarray(got.column("id"), np.int64),
           "size": np.asarray(got.column("size"), np.int64)}
    sent = spark.sparkContext.broadcast(ask)

    def batches_of(batches):
        return (w.slice(i, 1024) for w in batches for i in range(0, w.num_rows, 1024))

    def count(batches):
        import pyarrow as pa
        n = np.zeros(len(sent.value["id"]), np.int64)
        for b in batches_of(batches):
            n += _linked(b, sent.value, dim, threshold)[1].sum(0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["q", "n"])
    links = np.zeros(len(ask["id"]))
    for r in map_arrow(entries, count, "q long, n long").groupBy("q").agg(F.sum("n").alias("n")).collect():
        links[r.q] = r.n
    if not links.any():
        return None
    weight = spark.sparkContext.broadcast(np.divide(1.0, links, out=np.zeros(len(links)), where=links > 0))

    def squares(batches):
        import pyarrow as pa
        total = np.zeros((dim, dim))
        for b in batches_of(batches):
            x, link = _linked(b, sent.value, dim, threshold)
            n = link.sum(0)
            i, j = np.nonzero(link & (np.cumsum(link, axis=0) <= TAKEN))
            d = x[i] - sent.value["x"][j]
            size = (d * d).sum(1)
            w = weight.value[j] * n[j] / np.minimum(n[j], TAKEN) / np.where(size > 1e-18, size, np.inf)
            total += (d * w[:, None]).T @ d
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    def add(batches):
        import pyarrow as pa
        total = sum((np.frombuffer(m, np.float64) for b in batches for m in b.column("m").to_pylist()),
                    np.zeros(dim * dim))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])
    sums = map_arrow(map_arrow(entries, squares, "m binary").repartition(16), add, "m binary")
    total = map_arrow(sums.repartition(1), add, "m binary").first()["m"]
    return np.frombuffer(bytes(total), np.float64).reshape(dim, dim) / (links > 0).sum()


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.9, per_list: int = 1024, max_lists: int = 8192,
                    subspaces: int = 8, block: int = 2048, sigmas: float | None = None,
                    spread: float | None = 4.0) -> DataFrame:
    """One row per input row: (id, n_links, component_id).

    n_links: other vectors with a cosine of ``threshold`` or more; component_id: the
    smallest id reachable by links, itself included.  A vector that is null, empty or
    zero or holds a null, NaN or infinite component links with nothing and is its own
    component; vectors of different lengths don't link.  Rows that repeat an id and a
    vector are other vectors to each other; a null id gets its group's smallest id,
    null if there is none.  Other columns are ignored; an empty table gives none.
    """
    spark = vectors.sparkSession
    r = math.sqrt(max(0.0, 2 - 2 * threshold))
    kind = "float" if dict(vectors.dtypes)[vector_col] == "array<float>" else "double"
    v = F.col(vector_col).cast(f"array<{kind}>")
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                          v.alias("v"))
    good = F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) & \
        F.exists("v", lambda x: x != 0)
    rows = cut(rows.withColumn("good", good))
    # -0.0 and 0.0 are one value
    usable = rows.where("good").withColumn("v", F.transform("v", lambda x: (x + F.lit(0.0)).cast(kind)))
    classes = cut(usable.groupBy("v").agg(F.min("row").alias("rep"), F.min("id").alias("least"),
                                          F.count("*").alias("n")))
    total, dim = classes.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if total:
        share = min(1.0, 1.2 * SAMPLE / total)
        sample = classes.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1) \
            .select("v").limit(SAMPLE).toArrow()
        x = _unit(sample.column("v"), dim)
        index = Index(x, max(1, min(max_lists, len(x), round(total / per_list))), subspaces)
        entries = classes.select(F.col("rep").alias("id"), "n", F.size("v").alias("size"), "v")
        if spread is not None and sigmas is None and len(index.coarse) > 1:
            squares = _directions(entries, dim, threshold)
            if squares is not None:
                index.measured(squares, spread)
        sent = spark.sparkContext.broadcast(index)
        coded = cut(map_arrow(entries, _encoder(sent, r, sigmas),
                              f"id long, n long, size int, v array<{kind}>, list long, member boolean, "
                              "code binary, err double"))
        # members and visitors of a list in blocks by hash of the id, as many as their number asks
        counts = coded.groupBy("list").agg(
            F.ceil(F.count_if("member") / block).cast("int").alias("blocks"),
            F.ceil(F.count_if(~F.col("member")) / block).cast("int").alias("visits"))
        b = coded.join(F.broadcast(counts), "list").where("blocks > 0").withColumn(   # <= max_lists rows
            "own", F.pmod(F.xxhash64("id"), F.when(F.col("member"), F.col("blocks"))
                          .otherwise(F.col("visits"))).cast("int"))
        last = F.col("blocks") - 1

        def meet(p, q, side):
            return F.struct(p.cast("int").alias("p"), q.cast("int").alias("q"), F.lit(side).alias("side"))

        def upto(n, f):
            none = F.array().cast("array<struct<p:int,q:int,side:int>>")
            return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), f)).otherwise(none)
        # group (p, q): block p searches the codes of block q; p < 0 are blocks of visitors.
        # side 1: both, 0: searches, 2: is searched
        own = F.col("own")
        pairs = F.when(F.col("member"), F.concat(
            F.array(meet(own, own, 1)),
            upto(last - own, lambda k: meet(own, own + 1 + k, 0)),
            upto(own, lambda k: meet(k, own, 2)),
            upto(F.col("visits"), lambda k: meet(-1 - k, own, 2)))).otherwise(
            upto(F.col("blocks"), lambda k: meet(-1 - own, k, 0)))
        g = b.withColumn("x", F.explode(pairs)).select(
            "list", "x.p", "x.q", "x.side", "id", "n", "size", "v", "code", "err")
        found = cut(g.groupBy("list", "p", "q").applyInArrow(
            _grouper(sent, threshold, r), "a long, b long, links long"))
        counted = found.where("b is null").groupBy("a").agg(F.sum("links").alias("others"))
        comp = connected_components(found.where("b is not null").select("a", "b"))
        named = classes.join(counted.withColumnRenamed("a", "rep"), "rep", "left") \
            .join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left") \
            .select("v", "least", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                    F.coalesce("component", "rep").alias("root"))
        lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
        of = named.withColumn("k", F.bitwise_not("root")).join(
            lowest.select(F.bitwise_not("root").alias("k"), "component_id"), "k") \
            .select(F.col("v").alias("of"), "n_links", "component_id")
        linked = usable.join(of, F.col("v") == F.col("of")).select("id", "n_links", "component_id")
    else:
        linked = usable.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    alone = rows.where(~F.col("good")).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionAll(alone)
