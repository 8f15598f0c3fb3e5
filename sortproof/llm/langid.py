"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader.

Features: the text in lower case, runs of characters that are no letters folded to
one space, n-grams of 1 to 3 characters hashed into ``2**bits`` buckets; counts
over the text's n-grams times the inverse document frequency, to unit length.
Document frequencies are counted over all training rows.  Weights are fitted by
FTRL-proximal with L1 and L2 (elastic-net) penalties, so most stay exactly zero,
on a sample bounded by ``per_language`` rows a language; a fifth of the sample is
kept apart to fit the temperature that calibrates the probabilities.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortproof.llm.frames import map_arrow, slices, unit_hash

UNDETERMINED = "und"
NGRAMS = (1, 2, 3)


def grams(text: str, bits: int):
    """Hashed n-gram buckets of one text, repeats included; None without a letter."""
    import numpy as np
    if not text:
        return None
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters(code)
    if not letter.any():
        return None
    code = np.where(letter, code, 32).astype(np.uint64)
    keep = np.ones(len(code), bool)
    keep[1:] = letter[1:] | letter[:-1]             # one space for a run of others
    code = np.concatenate([[32], code[keep], [32]]).astype(np.uint64)
    out, h = [], np.zeros(len(code), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, max(NGRAMS) + 1):
            h = h[:len(code) - n + 1] * np.uint64(0x100000001B3) + code[n - 1:] + np.uint64(n)
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            if n in NGRAMS:
                out.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(out)


def _letters(code):
    """Which code points are letters (categories L*)."""
    import numpy as np
    global _TABLE
    if _TABLE is None:
        _TABLE = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _TABLE[code]


_TABLE = None


def _frequencies(bits):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        df, n = np.zeros(1 << bits, np.int64), 0
        for whole in batches:
            for b in slices(whole, "text", 32 << 20):
                for text in b.column("text").to_pylist():
                    g = grams(text, bits)
                    if g is not None:
                        seen = np.zeros(1 << bits, bool)
                        seen[g] = True
                        df += seen
                        n += 1
        if n:
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))],
                                             names=["bucket", "n"])
    return run


def _tfidf(text, idf, bits):
    import numpy as np
    g = grams(text, bits)
    if g is None:
        return None
    tf = np.bincount(g, minlength=1 << bits)
    at = np.flatnonzero(tf)
    v = tf[at] * idf[at]
    norm = np.sqrt((v * v).sum())
    return at, (v / norm if norm > 0 else v)


def ftrl(rows, labels, k, size, epochs=6, alpha=0.5, beta=1.0, l1=0.02, l2=0.01):
    """FTRL-proximal for softmax regression; rows are (indices, values).  (weights, bias)."""
    import numpy as np
    z, n = np.zeros((size + 1, k)), np.zeros((size + 1, k))

    def weight(i):
        return np.where(np.abs(z[i]) <= l1, 0.0,
                        (np.sign(z[i]) * l1 - z[i]) / ((beta + np.sqrt(n[i])) / alpha + l2))
    order = np.random.default_rng(5)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            at, v = rows[r]
            at, v = np.append(at, size), np.append(v, 1.0)
            w = weight(at)
            s = v @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[labels[r]] -= 1
            g = v[:, None] * p[None]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    w = weight(np.arange(size + 1))
    return w[:size], w[size]


def temperature(scores, labels):
    """The temperature with the least log loss on held-back rows."""
    import numpy as np
    if not len(scores):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(5), 120))

    def loss(t):
        s = scores / t
        m = s.max(1, keepdims=True)
        return (np.log(np.exp(s - m).sum(1)) + m[:, 0] - s[np.arange(len(s)), labels]).mean()
    return float(min(grid, key=loss))


@dataclasses.dataclass
class Model:
    languages: list
    idf: object
    weights: object                 # bucket x language
    bias: object
    temperature: float
    bits: int

    def probabilities(self, text):
        """Probabilities by language of one text; None without a letter."""
        import numpy as np
        x = _tfidf(text, self.idf, self.bits)
        if x is None:
            return None
        s = (x[1] @ self.weights[x[0]] + self.bias) / self.temperature
        p = np.exp(s - s.max())
        return p / p.sum()


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        bits: int = 14, per_language: int = 400, max_chars: int = 20_000, seed: int = 3) -> Model:
    """Fit on rows with a language (null ones are left out).

    Document frequencies cover all rows; the weights are fitted on about
    ``per_language`` rows of each language, drawn by hash among texts of up to
    ``max_chars`` characters (the bound on what reaches the driver); a language with
    fewer of them gives a window of that length of longer texts too.  Without
    usable rows the model knows no language and predicts ``und``.
    """
    import numpy as np
    d = train.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"))
    freq = map_arrow(d.select("text"), _frequencies(bits), "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()         # 2**bits + 1 rows at most
    df = np.zeros((1 << bits) + 1, np.int64)
    df[np.asarray(freq.column("bucket").combine_chunks(), np.int64)] = \
        np.asarray(freq.column("n").combine_chunks(), np.int64)
    total = int(df[-1])
    idf = np.log((1 + total) / (1 + df[:-1])) + 0.1
    idf[df[:-1] == 0] = 0.0
    size = F.char_length("text")
    by = {r.lang: (r.short, r.n) for r in d.where(size > 0).groupBy("lang").agg(
        F.count_if(size <= max_chars).alias("short"), F.count("*").alias("n")).collect()}
    langs = sorted(by)
    if not langs:
        return Model([], idf, np.zeros((1 << bits, 0)), np.zeros(0), 1.0, bits)
    # a language short of rows under the bound gives windows of its longer texts as well
    scarce = [k for k in langs if by[k][0] < per_language]
    place = F.floor(unit_hash("id", "text", seed=seed + 1) * (size - max_chars + 1)).cast("int") + 1
    usable = d.where((size > 0) & ((size <= max_chars) | F.col("lang").isin(scarce)))
    rate = F.create_map(*[F.lit(x) for k in langs
                          for x in (k, min(1.0, per_language / by[k][1 if k in scarce else 0]))])
    rows = usable.where(unit_hash("id", "text", seed=seed) < rate[F.col("lang")]) \
        .withColumn("text", F.when(size > max_chars, F.substring("text", place, F.lit(max_chars)))
                    .otherwise(F.col("text"))) \
        .limit(2 * per_language * len(langs) + 100).toPandas()
    rows = rows.sort_values(["lang", "text"]).reset_index(drop=True)
    feats = [(_tfidf(t, idf, bits), langs.index(lang)) for t, lang in zip(rows.text, rows.lang)]
    feats = [f for f in feats if f[0] is not None]
    mix = np.random.default_rng(1).permutation(len(feats))
    cut = len(feats) // 5
    held, fitted = [feats[i] for i in mix[:cut]], [feats[i] for i in mix[cut:]]
    w, b = ftrl([f[0] for f in fitted], [f[1] for f in fitted], len(langs), 1 << bits)
    scores = np.array([f[0][1] @ w[f[0][0]] + b for f in held]).reshape(len(held), len(langs))
    return Model(langs, idf, w, b, temperature(scores, [f[1] for f in held]), bits)


def predict(model: Model, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row: the likeliest language and its probability.

    ``und`` with score 0 for a null text, one without a letter, or a model that
    knows no language.  Other columns are ignored; repeated rows repeat.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        m = sent.value
        for b in batches:
            lang, score = [], []
            for text in b.column("text").to_pylist():
                p = m.probabilities(text) if m.languages else None
                k = None if p is None else int(np.argmax(p))
                lang.append(UNDETERMINED if p is None else m.languages[k])
                score.append(0.0 if p is None else float(p[k]))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["id", "lang_pred", "score"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    return map_arrow(d, run, f"id {kind}, lang_pred string, score double")
