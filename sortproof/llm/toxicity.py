"""Toxicity by a subsequence string kernel and a support vector machine on
Nyström features.

Kernel of two strings: common subsequences of ``order`` characters, gaps weighed
by ``decay`` (Lodhi et al.), raised to ``power``; an insult with characters put in
between or with an ending keeps most of its similarity.  The parts of a sentence
are its words between a start and an end mark, without outer punctuation, and runs
of three or more single characters read as one word (``i d i o t``).  A word with
punctuation inside is also read without it, one longer than ``WINDOW`` in
overlapping windows; the reading that scores highest counts.  A sentence ends at a
word's ``. ! ?``, at a line end or after ``SENTENCE`` words; its kernel is the sum
over its words.

Landmarks are drawn from the training words: first the words and substrings that tell
toxic from clean texts beyond chance, ranked by likelihood ratio, each taking the
words it explains out of the count; then rarer words of toxic texts that these don't
explain, as many as can be drawn with a tenth of them there by chance; and the clean
words most similar to the first.  Sentence features are the
kernel with the landmarks, scaled by a landmark's kernel with itself and whitened
by the landmarks' kernel matrix (Nyström).  Labels are those of whole texts: every
sentence of a clean text is clean, and of a toxic text the sentence that the
machine finds most toxic counts as toxic, in alternation with fitting a linear SVM
(squared hinge).  A text's score is the logistic calibration of its two most toxic
sentences.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortproof.llm.frames import cut, give_back, map_arrow, slices, unit_hash, words

WINDOW = 18
START, STOP = "\x02", "\x03"
SENTENCE = 40
TRIM = ".,;:!?\"'()[]{}<>#*$%&|~^_=+/\\-…«»„“”‘’¡¿"
#: Words whose scores a worker remembers.
WORD_MEMORY = 1_000_000


def kernel(s, t, order: int, decay: float):
    """Raw subsequence kernel of padded code rows s (W, L) and t (M, T): (W, M).

    Padding is -1 in s and -2 in t, so it equals nothing.
    """
    import numpy as np
    w, m, size = len(s), len(t), t.shape[1]
    lam = np.float32(decay)
    prime = [np.ones((size + 1, w, m), np.float32)] + [
        np.zeros((size + 1, w, m), np.float32) for _ in range(order - 1)]
    out = np.zeros((w, m), np.float32)
    tt = np.ascontiguousarray(t.T)[:, None, :]
    for a in range(s.shape[1]):
        x = s[:, a][:, None]
        if (x == -1).all():
            break
        eq = (x[None] == tt).astype(np.float32) * (lam * lam)
        out += np.einsum("jwm,jwm->wm", eq, prime[order - 1][:-1])
        for i in range(order - 1, 0, -1):
            src = eq * prime[i - 1][:-1]
            p = prime[i]
            p *= lam
            run = np.zeros((w, m), np.float32)
            for j in range(size):
                run *= lam
                run += src[j]
                p[j + 1] += run
    return out


def _codes(strings, pad, width=None):
    import numpy as np
    n = np.fromiter(map(len, strings), np.int64, len(strings))
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.int32)
    out = np.full((len(strings), width or max(1, int(n.max(initial=0)))), pad, np.int32)
    row = np.repeat(np.arange(len(strings)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


@dataclasses.dataclass
class Landmarks:
    strings: list
    order: int = 3
    decay: float = 0.75
    power: int = 4

    def __post_init__(self):
        import numpy as np
        order = sorted(range(len(self.strings)), key=lambda i: len(self.strings[i]))
        # alike in length, so that little of a kernel is padding
        self.groups = [(np.array(g), _codes([self.strings[i] for i in g], -2))
                       for g in (order[i:i + 48] for i in range(0, len(order), 48))]
        each = [kernel(_codes([x], -1), _codes([x], -2), self.order, self.decay)[0, 0] for x in self.strings]
        self.own = np.maximum(np.array(each, np.float32), 1e-12)

    def features(self, strings, weights=None, block=160):
        """Scaled kernel of strings (of up to WINDOW characters) with the landmarks: (n, M),
        or its product with ``weights``: (n,)."""
        import numpy as np
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        out = np.zeros((len(strings), len(self.strings)) if weights is None else len(strings), np.float32)
        live = np.flatnonzero(size >= self.order)       # shorter ones share no subsequence
        live = live[np.argsort(size[live], kind="stable")]
        for i in range(0, len(live), block):
            at = live[i:i + block]
            s = _codes([strings[k] for k in at.tolist()], -1)
            k = np.empty((len(at), len(self.strings)), np.float32)
            for g, codes in self.groups:
                k[:, g] = kernel(s, codes, self.order, self.decay)
            k /= self.own[None]
            k = np.minimum(k, np.float32(1.5)) ** self.power
            out[at] = k if weights is None else k @ weights.astype(np.float32)
        return out


def _windows(word: str) -> list[str]:
    """Readings of a word."""
    forms = [word]
    if not word.isalnum():
        solid = "".join(c for c in word if c not in TRIM)
        if solid != word:
            forms.append(solid)
    out = []
    for f in forms:
        f = START + f + STOP
        out += [f] if len(f) <= WINDOW else [
            f[i:i + WINDOW] for i in range(0, len(f) - WINDOW // 2, WINDOW // 2)]
    return out


def _read(text):
    """Arrow texts -> (distinct words, index per token, first token of each sentence,
    first sentence of each row); every row has at least one sentence and token."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    t = pc.binary_join_element_wise(
        pc.replace_substring(pc.fill_null(text, ""), "\n", " . "), ".", " ")
    flat, offs = words(t)                               # the last "." ends every row
    ends = np.asarray(pc.match_substring_regex(flat, "[.!?]$"))
    plain = pc.utf8_trim(flat, characters=TRIM)
    one = np.asarray(pc.utf8_length(plain)) == 1
    one[offs[1:] - 1] = False
    extra_at, extra = [], []
    edge = np.flatnonzero(np.diff(np.concatenate([[0], one.view(np.int8), [0]])))
    for a, z in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if z - a >= 3:                                  # replaces the run's first character
            extra_at.append(a)
            extra.append("".join(plain.slice(a, z - a).to_pylist()))
    if extra:
        mask = np.zeros(len(plain), bool)
        mask[extra_at] = True
        plain = pc.replace_with_mask(plain, pa.array(mask), pa.array(extra, pa.string()))
    coded = plain.dictionary_encode()
    start = np.zeros(len(flat), bool)
    start[1:] = ends[:-1]
    start[offs[:-1]] = True
    first = np.flatnonzero(start)
    if len(first):                                      # cut sentences of over SENTENCE words
        place = np.arange(len(flat)) - np.repeat(first, np.diff(np.append(first, len(flat))))
        start |= place % SENTENCE == 0
        first = np.flatnonzero(start)
    return coded.dictionary.to_pylist(), np.asarray(coded.indices, np.int64), first, \
        np.searchsorted(first, offs[:-1])


@dataclasses.dataclass
class Model:
    landmarks: Landmarks | None
    weights: object                 # one per landmark: whitening times SVM weights
    bias: float
    calibration: tuple              # of the two highest sentence scores, and 1

    def word_scores(self, strings):
        import numpy as np
        parts = [p for s in strings for p in _windows(s)]
        got = self.landmarks.features(parts, self.weights)
        if len(parts) == len(strings):
            return got
        n = np.fromiter((len(_windows(s)) for s in strings), np.int64, len(strings))
        return np.maximum.reduceat(got, np.cumsum(n) - n)

    def probability(self, top):
        import numpy as np
        a, b, c = self.calibration
        return 1 / (1 + np.exp(-np.clip(a * top[:, 0] + b * top[:, 1] + c, -500, 500)))


def _top_two(total, rows, none):
    """Highest and second highest sentence score of each row; ``none`` where it has one."""
    import numpy as np
    if not len(rows):
        return np.zeros((0, 2))
    best = np.maximum.reduceat(total, rows)
    row = np.repeat(np.arange(len(rows)), np.diff(np.append(rows, len(total))))
    at = np.flatnonzero(total == best[row])
    rest = total.copy()
    rest[at[np.unique(row[at], return_index=True)[1]]] = -np.inf
    return np.column_stack([best, np.maximum(np.maximum.reduceat(rest, rows), none)])


def _substrings(words):
    """(hash, word, start, length) of every word with its marks and of its substrings of
    4 to 7 characters, each once a word; words of up to WINDOW - 2 characters."""
    import numpy as np
    code = _codes([START + w + STOP for w in words], 0, WINDOW).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    out = []
    with np.errstate(over="ignore"):
        def fold(cols, live=None):
            h = np.zeros(cols.shape[:1], np.uint64)
            for j in range(cols.shape[1]):
                new = (h + cols[:, j] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                new ^= new >> np.uint64(29)
                h = new if live is None else np.where(j < live, new, h)
            return h
        every = np.arange(len(words))
        out.append((fold(code, size), every, np.zeros(len(words), np.int64), size))
        for n in (4, 5, 6, 7):
            for i in range(WINDOW - n + 1):
                at = np.flatnonzero((i + n <= size) & (n < size))
                out.append((fold(code[at, i:i + n]), at, np.full(len(at), i), np.full(len(at), n)))
    h, word, start, n = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((start, h, word))
    same = (h[order][1:] == h[order][:-1]) & (word[order][1:] == word[order][:-1])
    first = order[np.concatenate([[True], ~same])] if len(order) else order
    return h[first], word[first], start[first], n[first]


def _tail(a, n, p):
    """Probability of ``a`` or more of ``n`` by chance ``p`` each."""
    return math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                              + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(a, n + 1))


def choose_landmarks(toxic_df, clean_df, n_toxic, n_clean, most=256, chance=0.1):
    """(strings beyond chance, further words): up to ``most`` landmarks.

    Strings are ranked by likelihood ratio of their words' document frequencies,
    greedily; each takes the words that hold it out of the count.  Beyond chance is a
    ratio over twice the logarithm of the number of strings compared, so that one of
    them by chance is unlikely: few labels leave few strings, and a lower limit.  The
    further words are those of the smallest binomial tails that Benjamini and Hochberg's
    step-up keeps at a share of ``chance``: a long tail of rare insults lowers the limit.
    """
    import numpy as np
    usual = {w for w, b in clean_df.items() if b > 2 and b * n_toxic > 0.5 * toxic_df.get(w, 0) * n_clean}
    mine = sorted(w for w in toxic_df if 3 <= len(w) <= WINDOW - 2 and w not in usual)
    if not mine:
        return [], []
    h, word, start, size = _substrings(mine)
    count = np.array([toxic_df[w] for w in mine], np.float64)
    key, of = np.unique(h, return_inverse=True)
    tox, cln = np.bincount(of, weights=count[word]), np.zeros(len(key))
    theirs = [w for w in clean_df if len(w) <= WINDOW - 2]
    for i in range(0, len(theirs), 4_000):
        part = theirs[i:i + 4_000]
        g, w, _, _ = _substrings(part)
        at = np.minimum(np.searchsorted(key, g), len(key) - 1)
        hit = key[at] == g
        cln += np.bincount(at[hit], weights=np.array([clean_df[x] for x in part], float)[w[hit]],
                           minlength=len(key))
    order = np.argsort(of, kind="stable")               # the words of a string
    begin = np.searchsorted(of[order], np.arange(len(key) + 1))
    by_word = np.argsort(word, kind="stable")           # the strings of a word
    word_begin = np.searchsorted(word[by_word], np.arange(len(mine) + 1))
    sample = order[begin[:-1]]                          # one place of every string
    length = size[sample]

    def text(k):
        k = sample[k]
        return (START + mine[word[k]] + STOP)[start[k]:start[k] + size[k]]

    def ratio(a, b):
        a1 = np.maximum(a, 1e-9)
        ea = (a1 + b) * n_toxic / (n_toxic + n_clean)
        eb = a1 + b - ea
        out = 2 * (a1 * np.log(a1 / ea) + b * np.log(np.maximum(b, 1e-300) / eb))
        return np.where((a > 0) & (a / n_toxic >= 3 * b / max(1, n_clean)), out, 0.0)
    score = np.where(tox >= 3, ratio(tox, cln), 0.0)
    limit = 2 * math.log(max(2, int((tox >= 3).sum())))
    found, left = [], np.ones(len(mine), bool)
    while len(found) < most:
        top = np.flatnonzero(score == score.max())
        best = max(top.tolist(), key=lambda k: (length[k], text(k)))
        if score[best] < limit:
            break
        # the longest string that says nearly the same
        inside, t = word[order[begin[best]:begin[best + 1]]], text(best)
        near = np.unique(of[np.concatenate([by_word[word_begin[w]:word_begin[w + 1]] for w in inside])])
        near = near[(tox[near] >= 0.9 * tox[best]) & (score[near] >= limit)]
        best = max((k for k in near.tolist() if t in text(k)), key=lambda k: (length[k], score[k], text(k)))
        found.append(text(best))
        for w in word[order[begin[best]:begin[best + 1]]].tolist():
            if left[w]:
                left[w] = False
                tox[of[by_word[word_begin[w]:word_begin[w + 1]]]] -= count[w]
        score = np.where(tox >= 3, ratio(tox, cln), 0.0)
    tail = {}
    for w in np.flatnonzero(left).tolist():
        a, b = int(count[w]), clean_df.get(mine[w], 0)
        if a * n_clean >= 3 * b * n_toxic:
            tail.setdefault((a, b), []).append(w)
    share = n_toxic / (n_toxic + n_clean)
    ranked, more, seen = sorted((_tail(a, a + b, share), -a, b) for a, b in tail), [], []
    for p, a, b in ranked:
        seen += sorted(tail[-a, b], key=mine.__getitem__)
        if p <= chance * len(seen) / max(1, int(left.sum())):
            more = list(seen)
    more = more[:max(0, most - len(found))]
    return found, [START + mine[w] + STOP for w in more]


class _Sentences:
    """Sums of the words' features of each sentence, made when they are asked for.

    ``feat`` are the words' features, ``at`` the words in order, ``first`` where a sentence
    begins, ``turn`` a matrix that the sums are multiplied with.
    """

    def __init__(self, feat, at, first, turn):
        import numpy as np
        self.feat, self.at, self.turn = feat, at, turn
        self.ends = np.append(first, len(at))

    def rows(self, ids):
        import numpy as np
        n = self.ends[ids + 1] - self.ends[ids]
        stop = np.cumsum(n)
        words = np.arange(stop[-1]) + np.repeat(self.ends[ids] - (stop - n), n)
        return np.add.reduceat(self.feat[self.at[words]], stop - n, axis=0) @ self.turn

    def times(self, w):
        """All rows times w: a number a word, summed by sentence."""
        import numpy as np
        w = self.turn.astype(float) @ w
        each = np.concatenate([self.feat[i:i + 8192] @ w for i in range(0, len(self.feat), 8192)])
        return np.add.reduceat(each[self.at], self.ends[:-1])


def _svm(x, rows, y, cost, rounds=30, ridge=1.0):
    """Linear SVM with squared hinge and unpenalised bias on some sentences, by Newton steps."""
    import numpy as np
    w = np.zeros(x.turn.shape[1] + 1)
    reg = np.eye(len(w)) * ridge
    reg[-1, -1] = 1e-6
    for _ in range(rounds):
        live = np.flatnonzero(y * (x.times(w[:-1])[rows] + w[-1]) < 1)
        if not len(live):
            break
        left, right = reg.copy(), np.zeros(len(w))
        for i in range(0, len(live), 512):              # the sentences' rows are never held whole
            at = live[i:i + 512]
            a = np.column_stack([x.rows(rows[at]).astype(float), np.ones(len(at))])
            left += (a * cost[at, None]).T @ a
            right += (a * cost[at, None]).T @ y[at]
        new = np.linalg.solve(left, right)
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w[:-1], w[-1]


def _calibrate(x, y, cost):
    """Logistic regression on the two scores by Newton steps; no weight below zero."""
    import numpy as np
    live = [0, 1]
    while True:
        a = np.column_stack([x[:, live], np.ones(len(x))])
        w = np.zeros(a.shape[1])
        ridge = np.diag([1e-2] * len(live) + [1e-6])
        n1, n0 = (cost * y).sum(), (cost * (1 - y)).sum()
        t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            h = cost * p * (1 - p) + 1e-9
            step = np.linalg.solve((a * h[:, None]).T @ a + ridge, a.T @ (cost * (p - t)) + ridge @ w)
            step *= min(1.0, 2 / max(1e-12, np.abs(step).max()))
            w = w - step
            if np.abs(step).max() < 1e-8:
                break
        low = [k for k, v in zip(live, w) if v < 0]
        if not low or len(live) == 1:
            break
        live = [k for k in live if k not in low] or [0]
    out = [0.0, 0.0, float(w[-1])]
    for k, v in zip(live, w):
        out[k] = max(0.0, float(v))
    return tuple(out)


def fit_texts(texts, toxic, clean_weight: float = 1.0, landmarks: int = 256) -> Model:
    """Fit on texts and their labels (numpy on bounded lists)."""
    from collections import Counter

    import numpy as np
    import pyarrow as pa
    y = np.asarray(toxic, bool)
    if not y.any() or y.all():
        return Model(None, None, 0.0, (0.0, 0.0, 30.0 if len(y) and y.all() else -30.0))
    vocab, at, first, rows = _read(pa.array(texts, pa.string()))
    sent = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
    doc_of_sent = np.repeat(np.arange(len(rows)), np.diff(np.append(rows, len(first))))
    doc = doc_of_sent[sent]
    once = np.unique(doc * len(vocab) + at)
    d, w = once // len(vocab), once % len(vocab)
    df = {k: Counter(dict(zip((vocab[i] for i in u.tolist()), n.tolist())))
          for k in (False, True) for u, n in [np.unique(w[y[d] == k], return_counts=True)]}
    del sent, doc, once, d, w
    found, more = choose_landmarks(df[True], df[False], int(y.sum()), int((~y).sum()), landmarks)
    give_back()                     # what choosing took, before the features need it
    if not found and not more:
        return Model(None, None, 0.0, (0.0, 0.0, -30.0))
    # the clean words that look most like them
    seen = [START + v + STOP for v in vocab if df[False][v] > 0 and 3 <= len(v) <= WINDOW - 2]
    like = found or more
    near = Landmarks(like).features(seen).max(1) if seen else np.zeros(0)
    near[[x in like for x in seen]] = 0
    alike = [seen[i] for i in np.argsort(-near, kind="stable")[:16].tolist()]
    marks = Landmarks(list(dict.fromkeys(like + alike + more)))
    own = marks.features(marks.strings).astype(float)
    val, vec = np.linalg.eigh((own + own.T) / 2)
    white = vec / np.sqrt(np.maximum(val, 1e-3))[None] @ vec.T
    del df, seen, near
    # block by block: neither all windows' features nor the sentences' sums are held
    feat = np.empty((len(vocab), len(marks.strings)), np.float32)
    for i in range(0, len(vocab), 4096):
        forms = [_windows(v) for v in vocab[i:i + 4096]]
        n = np.fromiter(map(len, forms), np.int64, len(forms))
        feat[i:i + 4096] = np.maximum.reduceat(marks.features([p for f in forms for p in f]), np.cumsum(n) - n)
    x = _Sentences(feat, at, first, white.astype(np.float32))
    by_like = feat[:, :len(like)].sum(1)
    rank = np.add.reduceat(by_like[at], first)
    bad = y[doc_of_sent]
    for _ in range(4):
        # of every toxic text its most toxic sentence
        order = np.lexsort((-rank, doc_of_sent))
        top = order[np.searchsorted(doc_of_sent[order], np.flatnonzero(y))]
        use = np.concatenate([top, np.flatnonzero(~bad)])
        label = np.concatenate([np.ones(len(top)), -np.ones((~bad).sum())])
        cost = np.where(label > 0, min(50.0, (~bad).sum() / len(top)), 1.0)
        beta, bias = _svm(x, use, label, cost)
        rank = x.times(beta) + bias
    got = _calibrate(_top_two(rank, rows, bias), y.astype(float), np.where(y, 1.0, clean_weight))
    return Model(marks, white @ beta, float(bias), got)


def fit(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", per_label: int = 600, max_chars: int = 8000, seed: int = 4,
        landmarks: int = 256) -> Model:
    """Fit on documents and their labels (rows id, label; default: columns of ``docs``).

    About ``per_label`` toxic and twice as many clean documents are drawn by hash of
    the id from the labels, and of these the texts of up to ``max_chars`` characters
    are used, one text an id (the least): that bounds what is broadcast and reaches the
    driver.  ``landmarks`` strings at most are drawn from them (and 16 clean words): more
    tell more rare insults apart, and cost as much more time.  Null ids, texts
    and labels are left out; a document with both labels counts as toxic.  Without
    both labels the model gives every text the score of the only label, 0 without any.
    """
    y = (docs if labels is None else labels).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    y = y.where(F.col("y").isin(0, 1) & F.col("id").isNotNull()).groupBy("id").agg(F.max("y").alias("y"))
    y = cut(y)
    n = {r.y: r.n for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rate = {k: min(1.0, 1.3 * per_label * (2 - k) / n[k]) if n.get(k) else 0.0 for k in (0, 1)}
    drawn = y.where(unit_hash("id", seed=seed) < F.when(F.col("y") == 1, rate[1]).otherwise(rate[0])) \
        .limit(6 * per_label + 100)
    got = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(drawn), "id").where(F.char_length("text") <= max_chars) \
        .groupBy("id", "y").agg(F.min("text").alias("text")).toPandas().sort_values(["y", "id", "text"])
    took = int((got.y == 0).sum())
    texts, marked = got.text.tolist(), got.y.tolist()
    del got
    give_back()
    model = fit_texts(texts, marked, n.get(0, 0) / took if took else 1.0, landmarks)
    give_back()
    return model


def score(model: Model, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          keep_columns: bool = False) -> DataFrame:
    """(id, score, predicted) of every row: score in 0..1, predicted 1 from 0.5 on.

    Null and empty texts are scored as one empty sentence.  With ``keep_columns``
    the rows come back as they are with columns ``toxic_score`` and
    ``toxic_predicted`` added (or replaced), whatever their other columns are called.
    Repeated rows repeat; an empty table gives an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        m = sent.value
        known, value = pa.array([], pa.string()), np.zeros(0, np.float32)
        for whole in batches:
            for b in slices(whole, text, 8 << 20):
                if m.landmarks is None:
                    top = np.zeros((b.num_rows, 2))
                else:
                    vocab, at, first, rows = _read(b.column(text).cast(pa.string()))
                    vocab = pa.array(vocab, pa.string())
                    found = pc.index_in(vocab, value_set=known)
                    new = np.asarray(pc.is_null(found))
                    fresh = vocab.filter(pa.array(new))
                    got = m.word_scores(fresh.to_pylist()) if len(fresh) else np.zeros(0, np.float32)
                    f = np.empty(len(vocab), np.float32)
                    f[new] = got
                    f[~new] = value[np.asarray(found.filter(pa.array(~new)), np.int64)]
                    room = max(0, WORD_MEMORY - len(known))
                    known = pa.concat_arrays([known, fresh.slice(0, room)])
                    value = np.concatenate([value, got[:room]])
                    total = np.add.reduceat(f[at].astype(np.float64), first) + m.bias
                    top = _top_two(total, rows, m.bias)
                p = m.probability(top)
                cols = b.columns if keep_columns else [b.column("id")]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], names=names)

    if keep_columns:
        d, text = docs.drop("toxic_score", "toxic_predicted"), text_col
        if d.schema[text_col].dataType.simpleString() != "string":
            raise ValueError(f"{text_col} must be a string column to keep the others")
        names = [*d.columns, "toxic_score", "toxic_predicted"]
    else:
        d, text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "text"
        names = ["id", "score", "predicted"]
    kept = d if keep_columns else d.select("id")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return map_arrow(d, run, f"{fields}, `{names[-2]}` double, `{names[-1]}` int", trim=keep_columns)
