"""Language-model scores by a probabilistic suffix tree, with a word-count base.

Text: lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+`` and one end.  The tree reads
the UTF-8 bytes of the words joined by spaces, then the end (byte 10, which no
word holds; it also pads the context before the first byte).

Training counts every run of ``depth`` context bytes and the next byte over all
training texts, exactly.  A context is a candidate if a next byte was met ``least``
times after it (an absolute count, so the candidates grow with the corpus), and is
retained if its counts diverge from what its longest retained suffix predicts:
the gain in log-likelihood must exceed half its number of next symbols times the
log of the corpus.  Next-symbol distributions are smoothed by Witten-Bell
interpolation with the longest retained suffix down to an add-one root; mass of
pairs rarer than ``least`` goes to the suffix too, so each distribution sums to 1.
A position is scored in the state of its longest retained suffix.

The tree is a table a level, one row per context; a level is pruned by joining it
with the one below.  The most frequent grams (1 / p_min of them at most) are
scored from a broadcast table, the others walk down the levels by joins, each
distinct gram once: ``p_min`` decides where a gram is looked up, not its score.  Texts are scored in slices of a task of about ``SLICE`` bytes: a
slice asks for each of its other grams once, and its texts meet the answers again: as
the codes of these grams, or as the text itself where that is shorter.

Base score: add-one word counts.  Words that make up ``p_min`` of the tokens (at
most 1 / p_min of them, up to 64 bytes long) are looked up in a broadcast table,
the tokens of all others meet the full counts in a join.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortproof.llm.frames import cut, map_arrow, slices, store, words

END = 10
#: Words longer than this never enter the broadcast table.
SHORT_WORD = 64
#: Bytes of text whose rare grams are asked for together (a longer text is one slice).
SLICE = 32 << 20
#: Grams a row of a slice's request.
REQUEST = 1 << 16
#: Counted grams a task holds before it merges them (16 bytes each, and as much again to merge).
GRAMS = 2_000_000


def _bytes(batch, column="text"):
    import pyarrow as pa
    return [b" ".join(t.lower().split()) if t else b""
            for t in batch.column(column).cast(pa.binary()).to_pylist()]


def _codes(docs, depth):
    """Codes of every symbol with ``depth`` bytes of context, and row offsets."""
    import numpy as np
    pad = bytes([END]) * depth
    buf = np.frombuffer(pad + (bytes([END]) + pad).join(docs) + bytes([END]), np.uint8)
    code, have = buf.astype(np.int64), 1
    while have <= depth:                    # bytes that two parts share are the same in both
        more = min(have, depth + 1 - have)
        code[more:] |= code[:-more] << (8 * more)
        have += more
    size = np.fromiter(map(len, docs), np.int64, len(docs)) + 1
    ends = np.cumsum(size)
    begin = depth + (ends - size) + depth * np.arange(len(docs))
    at = np.arange(int(ends[-1])) + np.repeat(begin - (ends - size), size)
    return code[at], ends - size


def _distinct(codes):
    """Sorted distinct codes: by sorting, as ``np.unique`` hashes them, which takes far longer."""
    import numpy as np
    c = np.sort(codes)
    return c[np.concatenate([[True], c[1:] != c[:-1]])] if len(c) else c


def _merge(codes, counts):
    import numpy as np
    c, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(c, kind="stable")
    c, n = c[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    return [c[first]], [np.add.reduceat(n, first)]


def _gram_counter(depth):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        codes, counts, held = [], [], 0

        def rows(c, n):
            return pa.RecordBatch.from_arrays([pa.array(c), pa.array(n)], names=["code", "n"])
        for whole in batches:
            for b in slices(whole, "text", 2 << 20):
                c, n = np.unique(_codes(_bytes(b), depth)[0], return_counts=True)
                codes.append(c)
                counts.append(n)
                held += len(c)
                if held > GRAMS:
                    codes, counts = _merge(codes, counts)
                    c, n = codes[0], counts[0]
                    if len(c) > GRAMS // 2:   # more than fit (16 bytes each): the rare ones go on first
                        often = n > max(1, np.partition(n, -(GRAMS // 2))[-(GRAMS // 2)])
                        yield rows(c[~often], n[~often])
                        codes, counts = [c[often]], [n[often]]
                    held = sum(map(len, codes))
        if codes:
            codes, counts = _merge(codes, counts)
            yield rows(codes[0], counts[0])
    return run


def _word_counter(batches):
    import pyarrow as pa
    for whole in batches:
        for b in slices(whole, "text", 32 << 20):
            flat, _ = words(b.column("text"))
            got = flat.value_counts()
            yield pa.RecordBatch.from_arrays(
                [got.field("values"), got.field("counts")], names=["word", "n"])


@dataclasses.dataclass
class Tree:
    """Retained states by depth: gram codes with log10 probabilities, context codes
    with the log10 weight of their suffix."""

    depth: int
    root: object                    # log10 probability of each byte
    grams: list                     # [depth 1..]: (codes, log10 p)
    states: list                    # [depth 1..]: (codes, log10 suffix weight)

    def score(self, codes, depth=None):
        """log10 probability of the last byte of each code, by its longest state."""
        import numpy as np
        d = self.depth if depth is None else depth
        out = np.zeros(len(codes))
        live, code = np.arange(len(codes)), np.asarray(codes)
        while d > 0 and len(live):
            code = code & ((1 << (8 * (d + 1))) - 1)
            gram, lp = self.grams[d - 1]
            state, weight = self.states[d - 1]
            i, hit = _find(gram, code)
            out[live[hit]] += lp[i[hit]]
            live, code = live[~hit], code[~hit]
            j, has = _find(state, code >> 8)
            out[live[has]] += weight[j[has]]
            d -= 1
        out[live] += self.root[code & 255]
        return out


def _find(keys, want):
    import numpy as np
    if not len(keys):
        return np.zeros(len(want), np.int64), np.zeros(len(want), bool)
    i = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
    return i, keys[i] == want


def _contexts(pairs: DataFrame) -> DataFrame:
    """(ctx, next): one row per context, with the counts of its next bytes.

    Dealt by context, of which none has more than 65,536 rows here per counting task.
    """
    return pairs.repartition("ctx").groupBy("ctx", "y").agg(F.sum("n").alias("n")) \
        .groupBy("ctx").agg(F.collect_list(F.struct("y", "n")).alias("next"))


def _flat(column):
    """Row numbers and values of an Arrow list column, and its offsets from 0."""
    import numpy as np
    offsets = np.asarray(column.offsets, np.int64)
    return np.repeat(np.arange(len(column)), np.diff(offsets)), np.asarray(column.flatten()), \
        offsets - offsets[0]


def _fitter(positions):
    """Distributions of contexts, given the finished ones of their suffixes."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            size = b.num_rows
            if not size:
                continue
            row, y, offs = _flat(b.column("y"))
            n = _flat(b.column("n"))[1].astype(float)
            below_row, below_y, _ = _flat(b.column("below_y"))
            below = _flat(b.column("below"))[1]
            key = below_row * 256 + below_y
            order = np.argsort(key)
            lower = below[order[np.searchsorted(key, row * 256 + y, sorter=order)]]
            q = 10.0 ** lower
            ctx_n = np.asarray(b.column("total"), np.float64)
            kinds = np.bincount(row, minlength=size).astype(float)
            rest = ctx_n - np.bincount(row, weights=n, minlength=size)
            weight = (kinds + rest) / (ctx_n + kinds)
            p = n / (ctx_n + kinds)[row] + weight[row] * q
            gain = np.bincount(row, weights=n * np.log(p / q), minlength=size) + rest * np.log(weight)
            held = gain > 0.5 * kinds * math.log(max(positions, 2))
            yield pa.RecordBatch.from_arrays([
                b.column("ctx"), pa.array(held), pa.array(np.where(held, np.log10(weight), 0.0)),
                *(pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(v)) for v in (
                    y, n.astype(np.int64), np.where(held[row], np.log10(p), lower)))],
                names=["ctx", "held", "weight", "y", "n", "lp"])
    return run


_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _slot(codes, k, bits):
    import numpy as np
    return ((codes.astype(np.uint64) * np.uint64(_MIX[k])) >> np.uint64(64 - bits)).astype(np.int64)


def _table(codes, values):
    """Two hash tables (bits, keys, values); what fits in neither is left to the joins.

    Each has 4 to 8 slots of 16 bytes for a code that is offered to it, 2^22 at most:
    72 MB for a million codes.
    """
    import numpy as np
    out, left = [], np.arange(len(codes))
    for k in range(2):
        bits = max(8, min(22, len(left).bit_length() + 2))
        keys, vals = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.float64)
        s = _slot(codes[left], k, bits)
        keys[s] = codes[left]
        won = keys[s] == codes[left]
        vals[s[won]] = values[left[won]]
        out.append((bits, keys, vals))
        left = left[~won]
    return out


def _look_up(top, codes):
    """Scores of the codes in the hash tables, 0 elsewhere, and which codes are in them."""
    import numpy as np
    out, known = np.zeros(len(codes)), np.zeros(len(codes), bool)
    todo, want = None, codes
    for k, (bits, keys, vals) in enumerate(top):
        s = _slot(want, k, bits)
        hit = keys.take(s) == want
        at = np.flatnonzero(hit) if todo is None else todo[hit]
        out[at], known[at] = vals.take(s[hit]), True
        todo = np.flatnonzero(~hit) if todo is None else todo[~hit]
        want = codes[todo]
    return out, known


def _answers(grams, lps, codes):
    """Scores of the codes, all of which are among the sorted grams: sought in order, which
    passes through memory once."""
    import numpy as np
    order = np.argsort(codes)
    out = np.empty(len(codes))
    out[order] = lps[np.searchsorted(grams, codes[order])]
    return out


@dataclasses.dataclass
class Model:
    depth: int
    root: object                    # log10 probability of each byte
    levels: list                    # [depth 1..]: tables (ctx, held, weight, y, n, lp)
    top: tuple                      # the frequent full-depth grams: codes, finished scores
    tokens: int                     # training tokens, ends included
    kinds: int                      # distinct training tokens
    texts: int                      # training texts: the count of the end token
    counts: DataFrame               # (word, n) of every training word
    frequent: tuple                 # broadcast table: words, counts
    least: int                      # words with this count are in it, if short

    @property
    def tree(self) -> Tree:
        """The retained states as arrays on the driver: to look into a small model."""
        import numpy as np
        tree = Tree(self.depth, self.root, [], [])
        for t in self.levels:
            held = t.where("held")
            for out, rows in ((tree.states, held.select("ctx", "weight")),
                              (tree.grams, held.select("ctx", F.explode(F.arrays_zip("y", "lp")).alias("x"))
                               .selectExpr("shiftleft(ctx, 8) | x.y", "x.lp"))):
                got = rows.toArrow()
                codes = np.asarray(got.column(0).combine_chunks(), np.int64)
                order = np.argsort(codes)
                out.append((codes[order], np.asarray(got.column(1).combine_chunks(), np.float64)[order]))
        return tree


def fit(train: DataFrame, text_col: str = "text", depth: int = 6, p_min: float = 1e-6,
        word_p_min: float = 1e-6, least: int = 2) -> Model:
    """Counts over all rows of ``train``; null texts count as empty ones."""
    import numpy as np
    if not 1 <= depth <= 6:
        raise ValueError("depth must be in 1..6")
    d = train.select(F.col(text_col).cast("string").alias("text"))
    counts = cut(map_arrow(d, _word_counter, "word string, n long", trim=True)
                 .groupBy("word").agg(F.sum("n").alias("n")))
    texts = d.count()
    n, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, kinds = int(n) + texts, int(kinds) + (texts > 0)
    often = max(1, math.ceil(word_p_min * tokens))
    top = counts.where((F.col("n") >= often) & (F.octet_length("word") <= SHORT_WORD)).toArrow()

    grams = map_arrow(d, _gram_counter(depth), "code long, n long", trim=True)
    met = {depth: store(_contexts(grams.selectExpr(
        "shiftright(code, 8) as ctx", "cast(code & 255L as int) as y", "n")))}
    for k in range(depth - 1, -1, -1):
        met[k] = store(_contexts(met[k + 1].selectExpr(
            f"ctx & {_mask(k)}L as ctx", "explode(next) as x").selectExpr("ctx", "x.y", "x.n")))
    by = np.zeros(256, np.int64)
    for r in met[0].selectExpr("explode(next) as x").select("x.*").collect():       # 256 rows at most
        by[r.y] = r.n
    positions = int(by.sum())
    root = np.log10((by + 1) / (positions + 256))

    levels = []
    below = train.sparkSession.createDataFrame(
        [(0, list(range(256)), root.tolist())], "ctx long, y array<int>, lp array<double>")
    for k in range(1, depth + 1):
        # the suffix of a pair met ``least`` times was met as often: it is in the level below
        seen = met[k].selectExpr("ctx", "aggregate(next, 0L, (a, x) -> a + x.n) as total",
                                 f"filter(next, x -> x.n >= {int(least)}) as kept").where("size(kept) > 0")
        both = seen.join(below.select(F.col("ctx").alias("suffix"), F.col("y").alias("below_y"),
                                      F.col("lp").alias("below")),
                         F.expr(f"ctx & {_mask(k - 1)}L = suffix"))
        levels.append(store(map_arrow(
            both.selectExpr("ctx", "total", "kept.y as y", "kept.n as n", "below_y", "below"),
            _fitter(positions), "ctx long, held boolean, weight double, y array<int>, n array<bigint>, "
                                "lp array<double>")))
        below = levels[-1]
    usual = below.select("ctx", F.explode(F.arrays_zip("y", "n", "lp")).alias("x")) \
        .selectExpr("shiftleft(ctx, 8) | x.y as code", "x.n as n", "x.lp as lp")
    usual = usual.where(F.col("n") >= _floor(usual, int(1 / p_min))).select("code", "lp").toArrow()
    top_grams = (np.asarray(usual.column("code").combine_chunks(), np.int64),
                 np.asarray(usual.column("lp").combine_chunks(), np.float64))
    return Model(depth, root, levels, top_grams, tokens, kinds, texts, counts,
                 (top.column("word").combine_chunks(), top.column("n").combine_chunks()), often)


def _floor(grams: DataFrame, most: int) -> int:
    """A count that at most ``most`` grams reach, by a histogram of 16 bins a power of 2."""
    bins = grams.groupBy(F.floor(F.log2("n") * 16).alias("bin")) \
        .agg(F.count("*").alias("size"), F.min("n").alias("n")).orderBy(F.desc("bin")).collect()
    floor = (1 << 63) - 1
    for b in bins:                                                  # 16 * 63 rows at most
        most -= b["size"]
        if most < 0:
            break
        floor = b.n
    return floor


def _mask(size):
    return (1 << (8 * size)) - 1


def _walk(model: Model, grams: DataFrame) -> DataFrame:
    """(gram, lp) of distinct full-depth grams: level by level, the found ones leave."""
    live, done = grams.select("gram", F.lit(0.0).alias("lp")), []
    for k in range(model.depth, 0, -1):
        held = model.levels[k - 1].where("held").select("ctx", "weight", "y", F.col("lp").alias("known"))
        at = "array_position(y, cast(gram & 255L as int))"
        got = store(live.join(F.broadcast(held) if k == 1 else held,        # 256 contexts at most
                              F.expr(f"shiftright(gram, 8) & {_mask(k)}L = ctx"), "left").selectExpr(
            "gram", f"coalesce({at}, 0) > 0 as found",
            f"lp + coalesce(case when {at} > 0 then element_at(known, cast({at} as int)) end, weight, 0D) as lp"))
        done.append(got.where("found").select("gram", "lp"))
        live = got.where("not found").select("gram", "lp")
    root = F.array(*map(F.lit, model.root.tolist()))
    out = live.select("gram", (F.col("lp") + root[F.expr("cast(gram & 255L as int)")]).alias("lp"))
    for t in done:
        out = out.unionAll(t)
    return out


def _requests(asked, first, kinds):
    """Rows that ask for the distinct codes of a slice, named by its first row's key."""
    import numpy as np
    import pyarrow as pa
    codes = _distinct(np.concatenate(asked)) if asked else np.zeros(0, np.int64)
    for at in range(0, len(codes), REQUEST):
        some = codes[at:at + REQUEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([first], pa.int64()),
             pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), pa.array(some)),
             *(pa.nulls(1, kind) for _, kind in kinds)],
            names=["slice", "grams", *(name for name, _ in kinds)])


def _scorer(model):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        m = model.value
        freq_words, freq_n = m["frequent"]
        freq = np.log10((np.asarray(freq_n, np.float64) + 1) / m["denominator"])
        end = math.log10((m["texts"] + 1) / m["denominator"])
        top = _table(*m["top"])
        first, held, asked, kinds = None, 0, [], []
        for whole in batches:
            for b in slices(whole, "text", 2 << 20):
                if first is None:
                    first = b.column("key")[0].as_py()
                flat, offs = words(b.column("text"))
                coded = flat.dictionary_encode()
                at = np.asarray(coded.indices, np.int64)
                found = pc.index_in(coded.dictionary, value_set=freq_words)
                hit = np.asarray(pc.is_valid(found))
                value = np.where(hit, freq[np.asarray(pc.fill_null(found, 0))], 0.0) \
                    if len(freq) else np.zeros(len(hit))
                known = np.concatenate([[0], np.cumsum(hit[at])])
                total = np.concatenate([[0.0], np.cumsum(value[at])])
                n = np.diff(offs)
                tail = ~hit[at]
                tail_offs = offs - known[offs]
                lists = pa.ListArray.from_arrays(
                    pa.array(tail_offs.astype(np.int32)), flat.filter(pa.array(tail)))
                docs = _bytes(b)
                codes, starts = _codes(docs, m["depth"])
                lp, seen = _look_up(top, codes)
                rest = codes[~seen]
                n_rest = np.add.reduceat((~seen).astype(np.int64), starts)
                # what the finisher needs of a text: its rare grams, or all bytes if these are fewer
                packed = 8 * n_rest <= np.fromiter(map(len, docs), np.int64, len(docs))
                ends = np.cumsum(n_rest).tolist()
                body = [None if not n else rest[z - n:z].tobytes() if p else d
                        for d, p, n, z in zip(docs, packed.tolist(), n_rest.tolist(), ends)]
                out = pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(starts), first)), pa.nulls(len(starts), pa.list_(pa.int64())),
                    b.column("key"), b.column("id"), pa.array(n + 1),
                    pa.array(known[offs[1:]] - known[offs[:-1]] + (m["texts"] > 0)),
                    pa.array(total[offs[1:]] - total[offs[:-1]] + end),
                    pa.array(np.add.reduceat(lp, starts)), pc.binary_join(lists, " "),
                    pa.array(body, pa.binary()), pa.array(packed)],
                    names=["slice", "grams", "key", "id", "n_tokens", "n_known", "base", "score", "rare", "body",
                           "packed"])
                yield out
                kinds = [(f.name, f.type) for f in out.schema][2:]
                if len(rest):
                    asked.append(_distinct(rest))
                held += len(codes)
                if held >= SLICE:
                    yield from _requests(asked, first, kinds)
                    first, held, asked = None, 0, []
        yield from _requests(asked, first, kinds)
    return run


def _finisher(model):
    """What the rare grams add to the texts of a slice, given their scores."""
    def run(texts, answers):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        m = model.value
        top = _table(*m["top"]) if pc.any(pc.invert(texts.column("packed"))).as_py() else None
        grams = np.asarray(answers.column("gram").combine_chunks(), np.int64)
        order = np.argsort(grams)
        grams, lps = grams[order], np.asarray(answers.column("lp").combine_chunks(), np.float64)[order]
        keys, deep = [np.zeros(0, np.int64)], [np.zeros(0)]
        packed = texts.column("packed")
        for b in texts.filter(packed).to_batches():
            codes = np.frombuffer(b"".join(b.column("body").to_pylist()), np.int64)
            n = np.asarray(pc.binary_length(b.column("body")), np.int64) // 8
            keys.append(np.asarray(b.column("key")))
            deep.append(np.add.reduceat(_answers(grams, lps, codes), np.cumsum(n) - n)
                        if len(n) else np.zeros(0))
        for whole in texts.filter(pc.invert(packed)).combine_chunks().to_batches():
            for b in slices(whole, "body", 2 << 20):
                codes, starts = _codes(b.column("body").to_pylist(), m["depth"])
                rest = np.flatnonzero(~_look_up(top, codes)[1])
                lp = np.zeros(len(codes))
                lp[rest] = _answers(grams, lps, codes[rest])
                keys.append(np.asarray(b.column("key")))
                deep.append(np.add.reduceat(lp, starts))
        return pa.table({"key": np.concatenate(keys), "deep": np.concatenate(deep)})
    return run


def score(model: Model, docs: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row.

    A null text is empty: its only token is the end.  Rows that repeat an id or a
    text are scored each on its own; null ids stay null; other columns are
    ignored.  Without training texts every token is unknown and all scores are
    those of the uniform distribution.
    """
    spark = docs.sparkSession
    denominator = model.tokens + 1 * (model.kinds + 1)
    sent = spark.sparkContext.broadcast({
        "depth": model.depth, "top": model.top, "frequent": model.frequent, "texts": model.texts,
        "denominator": float(denominator)})
    d = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"),
                    F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    both = store(map_arrow(d, _scorer(sent), f"slice long, grams array<bigint>, key long, id {kind}, "
                           "n_tokens long, n_known long, base double, score double, rare string, body binary, "
                           "packed boolean", trim=True))
    rows = both.where("key is not null")
    rare = rows.where("rare <> ''").select("key", F.explode(F.split("rare", " ")).alias("word"))
    less = model.counts.where(~((F.col("n") >= model.least)
                                & (F.octet_length("word") <= SHORT_WORD)))
    # stored one by one: the shuffle files of a step go before the next one writes its own
    found = store(rare.join(less, "word", "left").groupBy("key").agg(
        F.sum(F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(denominator)))).alias("more"),
        F.count("n").alias("also")))
    asked = both.where("key is null").select(F.col("slice").alias("asker"), F.explode("grams").alias("gram"))
    answers = store(asked.join(_walk(model, asked.select("gram").distinct()), "gram"))
    walked = store(rows.where("body is not null").select("slice", "key", "body", "packed")
                   .groupBy("slice").cogroup(answers.groupBy("asker"))
                   .applyInArrow(_finisher(sent), "key long, deep double"))
    return rows.join(found, "key", "left").join(walked, "key", "left").select(
        "id", "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("deep", F.lit(0.0))).alias("score"))
