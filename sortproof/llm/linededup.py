"""Line dedup by an exact set-similarity join.

A line (text between ``\\n``) is the set of its lower-cased (A-Z) words
``[^\\x20\\x09-\\x0D]+``.  Two lines match at a Jaccard similarity of ``threshold``
or more.  A line is removed if a line before it, in the order (id, text, line
number) with null ids last, matches; lines without a word stay.  Every pair of
different word sets that matches is found; nothing is capped.

Equal sets are folded into one class first, so copies cost one row.  The tokens of
each class are ordered by rarity: a counter of hashed words over all lines (a
table of fixed size) gives the order, ties by hash; any fixed order leaves the
result exact.  A class of n words can match only a class that shares one of its
n - ceil(t n) + 1 first words, which are joined on equality; of the smaller class
n - ceil(2 t n / (1 + t)) + 1 words are enough.  Lengths, positions and a parity
sketch (whose bits that differ never outnumber the words that differ; of 64 bits, and
of 128 more between sets too large for 64 to tell apart) reject candidates in the join.  The candidates' lines are then read again: a 512-bit
sketch of the same kind rejects nearly all that do not match, and the Jaccard
similarity is verified on the words: of each class with its most similar earlier
candidate first, and where that is no match, with all its earlier ones.
Words are told apart by 64-bit hash.

A family of variants of one line would make pairs with the square of its size.
Whether a class goes needs one earlier match only, so the pass that reads the lines
already looks for one: among the sets of a batch with equal MinHashes, each is
verified against the earliest.  Then the same over all rows: each class is verified
against the earliest class of each of its pairs of MinHashes and the one just before it,
a fixed number of pairs a class.  A class that has a match there before its own first
line is settled; a pair is made only if the later of the two is not settled.

Words and MinHashes are joined in buckets, about as large as ``_BUCKET`` rows: a task
packs many rows into one value, so that Spark shuffles few, and a bucket's rows are
sorted and compared as arrays, ``_COMPARE`` pairs at a time.  Words that come more than
FREQUENT times are joined row by row instead, as a bucket could not hold them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortproof.llm.frames import arrow_schema, map_arrow, slices, store, words

#: log2 of the word counter's and the candidate filter's size.
COUNTER_BITS = 20
FILTER_BITS = 23
_CHUNK = 1 << 14
#: Bytes of text whose words a task holds as arrays of 8 bytes a word (some ten of them).
_TEXT = 2 << 20
#: Longer words, which XXH64 reads another way, are hashed one by one.
_SHORT = 31
#: Multipliers of a set's MinHashes, and how many pairs of them a batch looks at.
_MINS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
_LOCAL_MINS = 2
#: Words that come more often than this are joined row by row, all others a bucket of rows at a time:
#: a bucket is made for about _BUCKET rows, by a task that holds _GATHER of them, and its pairs are
#: compared _COMPARE at a time.
FREQUENT = 1 << 20
_BUCKET = 1 << 16
_GATHER = 1 << 18
_COMPARE = 1 << 19
#: Sets with more words have a second sketch of JOIN_WIDE 64-bit words in the join.
LARGE = 96
JOIN_WIDE = 2
_WIDER = [f"wide{i}" for i in range(JOIN_WIDE)]


def _lines(text):
    """Arrow texts -> (flat lines, row offsets); a null text reads as empty."""
    import numpy as np
    import pyarrow.compute as pc
    lists = pc.split_pattern(pc.fill_null(text, ""), "\n")
    offs = np.asarray(lists.offsets, np.int64)
    return lists.flatten(), offs - offs[0]


#: The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                           0x27D4EB2F165667C5)


def _turned(h, k):
    import numpy as np
    return (h << np.uint64(k)) | (h >> np.uint64(64 - k))


def _hashes(unique):
    """XXH64 of distinct Arrow words: of all short ones at once, of the others one by one."""
    import numpy as np
    from xxhash import xxh64_intdigest as xxh
    if not len(unique):
        return np.zeros(0, np.uint64)
    _, offsets, data = unique.buffers()
    offsets = np.frombuffer(offsets, np.int32)[unique.offset:unique.offset + len(unique) + 1].astype(np.int64)
    begin, end = int(offsets[0]), int(offsets[-1])
    buf = np.concatenate([np.frombuffer(data or b"", np.uint8)[begin:end], np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(buf[:8].view("<u8"), (len(buf) - 7,), (1,))
    at, left = offsets[:-1] - begin, np.diff(offsets)
    p1, p2, p3, p4, p5 = map(np.uint64, (_P1, _P2, _P3, _P4, _P5))
    short = np.flatnonzero(left <= _SHORT)
    with np.errstate(over="ignore"):
        out = left.astype(np.uint64) + p5
        for i in np.flatnonzero(left > _SHORT).tolist():
            out[i] = xxh(buf[at[i]:at[i] + left[i]])
        live = short
        while len(live := live[left[live] >= 8]):
            h = out[live] ^ (_turned(eight[at[live]] * p2, 31) * p1)
            out[live] = _turned(h, 27) * p1 + p4
            at[live] += 8
            left[live] -= 8
        live = short[left[short] >= 4]
        out[live] = _turned(out[live] ^ ((eight[at[live]] & np.uint64(0xFFFFFFFF)) * p1), 23) * p2 + p3
        at[live] += 4
        left[live] -= 4
        live = short
        while len(live := live[left[live] > 0]):
            out[live] = _turned(out[live] ^ (buf[at[live]].astype(np.uint64) * p5), 11) * p1
            at[live] += 1
            left[live] -= 1
        h = out[short]
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        out[short] = h ^ (h >> np.uint64(32))
    return out


def _coded(flat):
    """(hashes of distinct words, which of them each word is); a word of up to 7 bytes is told by its bytes
    and length as one number."""
    import numpy as np
    import pyarrow as pa
    n = len(flat)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    _, offsets, data = flat.buffers()
    offsets = np.frombuffer(offsets, np.int32)[flat.offset:flat.offset + n + 1].astype(np.int64)
    begin, end = int(offsets[0]), int(offsets[-1])
    buf = np.concatenate([np.frombuffer(data or b"", np.uint8)[begin:end], np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(buf[:8].view("<u8"), (len(buf) - 7,), (1,))
    size = np.diff(offsets)
    short = np.flatnonzero(size < 8)
    size = size[short].astype(np.uint64)
    whole = (eight[offsets[short] - begin] & ((np.uint64(1) << (size << np.uint64(3))) - np.uint64(1))) | (
        size << np.uint64(56))
    found = pa.array(whole).dictionary_encode()
    code = np.empty(n, np.int64)
    code[short] = np.asarray(found.indices)
    first = np.empty(len(found.dictionary), np.int64)
    first[code[short[::-1]]] = short[::-1]
    hashes = [_hashes(flat.take(pa.array(first)))]
    if len(short) < n:
        is_long = np.ones(n, bool)
        is_long[short] = False
        found = flat.filter(pa.array(is_long)).dictionary_encode()
        code[is_long] = np.asarray(found.indices, np.int64) + len(first)
        hashes.append(_hashes(found.dictionary))
    return np.concatenate(hashes), code


def _text_hashes(lines):
    """64-bit hashes of Arrow lines."""
    import numpy as np
    import pyarrow as pa
    from xxhash import xxh64_intdigest as xxh
    return np.concatenate([np.zeros(0, np.uint64), *(
        np.fromiter(map(xxh, part.cast(pa.binary()).to_pylist()), np.uint64, len(part)) for part in _parts(lines))])


def _counter(batches):
    import numpy as np
    import pyarrow as pa
    seen = np.zeros(1 << COUNTER_BITS, np.int64)
    for whole in batches:
        for b in slices(whole, "text", _TEXT):
            flat, _ = words(b.column("text"))
            h, code = _coded(flat)
            np.add.at(seen, (h >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), np.bincount(code, minlength=len(h)))
    if seen.any():
        parts = seen.reshape(-1, _CHUNK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(parts), dtype=np.int32)),
             pa.array([p.astype(np.int32 if p.max() < 1 << 31 else np.int64).tobytes()
                       for p in parts], pa.binary())],
            names=["chunk", "counts"])


def _sum_chunks(key, table):
    import numpy as np
    import pyarrow as pa
    total = np.zeros(_CHUNK, np.int64)
    for c in table.column("counts").to_pylist():
        total += np.frombuffer(c, np.int32 if len(c) == 4 * _CHUNK else np.int64)
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()),
                     "counts": pa.array([total.tobytes()], pa.binary())})


def rarity(docs: DataFrame, text_col: str = "text"):
    """(ranks, frequent): rank of each of 2**COUNTER_BITS word buckets by the count of its words, as an
    int32 array of fixed size, counted over all texts; below 0 if its only word comes once, from
    ``frequent`` on if its words come more than FREQUENT times."""
    import numpy as np
    d = docs.select(F.col(text_col).cast("string").alias("text"))
    parts = map_arrow(d, _counter, "chunk int, counts binary", trim=True)
    summed = parts.groupBy("chunk").applyInArrow(_sum_chunks, "chunk int, counts binary")
    total = np.zeros(((1 << COUNTER_BITS) // _CHUNK, _CHUNK), np.int64)
    for r in summed.toLocalIterator():                  # 64 rows of fixed size
        total[r.chunk] = np.frombuffer(r.counts, np.int64)
    total = total.ravel()
    rank = np.empty(len(total), np.int32)
    rank[np.argsort(total, kind="stable")] = np.arange(len(total), dtype=np.int32)
    once = int((total <= 1).sum())
    return rank - np.int32(once), int((total <= FREQUENT).sum()) - once


def _mix(h, k):
    import numpy as np
    h = (h ^ (h >> np.uint64(31))) * np.uint64(k)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _sets(lines, rank):
    """Word sets of Arrow lines: (hashes of distinct words, the words' places among them, line offsets),
    each set rarest first."""
    import numpy as np
    flat, offs = words(lines)
    h, code = _coded(flat)
    if not len(h):
        return h, code, np.zeros(len(offs), np.int64)
    order = np.lexsort((h, rank[(h >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]))
    place = np.empty(len(h), np.int64)
    place[order] = np.arange(len(h))
    bits = int(len(h)).bit_length()
    line = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    key = (line << bits) | place[code]
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    line = key >> bits
    return h[order], key & ((1 << bits) - 1), np.searchsorted(line, np.arange(len(offs)))


def _parts(lines):
    """Cut Arrow lines into runs of about ``_TEXT`` bytes."""
    import pyarrow as pa
    for b in slices(pa.RecordBatch.from_arrays([lines], names=["line"]), "line", _TEXT):
        yield b.column("line")


def _described(lines, rank):
    """Word sets of Arrow lines, part by part: (tokens, line offsets), signatures, pairs of
    MinHashes (of sets without words: 0) and the join's wide sketches."""
    import numpy as np
    tokens, offs = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    sigs, lows, wide = [np.zeros((3, 0), np.int64)], [np.zeros((len(_MINS), 0), np.uint64)], \
        [np.zeros((0, JOIN_WIDE), np.int64)]
    for part in _parts(lines):
        h, code, o = _sets(part, rank)
        some = np.flatnonzero(np.diff(o))
        low = np.zeros((len(_MINS), len(part)), np.uint64)
        low[:, some] = _min_hashes(h, code, o)
        sigs.append(_signatures(h, code, o))
        lows.append(low)
        wide.append(_wide_sketches(h, code, o, JOIN_WIDE, LARGE))
        tokens.append(h[code])
        offs.append(o[1:] + offs[-1][-1])
    return (np.concatenate(tokens), np.concatenate(offs), np.concatenate(sigs, axis=1),
            np.concatenate(lows, axis=1), np.concatenate(wide))


def _signatures(h, code, offs):
    """Per line: set signature (two 64-bit sums) and a 64-bit parity sketch."""
    import numpy as np
    n = np.diff(offs)
    some = np.flatnonzero(n)
    out = np.zeros((3, len(n)), np.uint64)
    if len(some):
        at = offs[:-1][some]
        with np.errstate(over="ignore"):
            a, b = _mix(h, 0x9E3779B97F4A7C15), _mix(h, 0xC2B2AE3D27D4EB4F)
            out[0, some] = np.add.reduceat(a[code], at)
            out[1, some] = np.add.reduceat(b[code], at)
            out[2, some] = np.bitwise_xor.reduceat((np.uint64(1) << (a & np.uint64(63)))[code], at)
    return out.view(np.int64)


def _min_hashes(h, code, offs):
    """(key, set) of the sets that have words: pairs of MinHashes.

    They are taken over the rarer half of a set's words and two at a time, as common
    words alone would bring unrelated sets together.
    """
    import numpy as np
    n = np.diff(offs)
    some = n > 0
    low = np.zeros((len(_MINS), int(some.sum())), np.uint64)
    if len(code):
        rare = code[np.arange(len(code)) - np.repeat(offs[:-1], n) < np.repeat((n + 1) // 2, n)]
        at = np.cumsum((n + 1) // 2)[some] - ((n + 1) // 2)[some]
        for i, k in enumerate(_MINS):
            with np.errstate(over="ignore"):
                low[i] = np.minimum.reduceat(_mix(_mix(h, k), 0xD6E8FEB86659FD93)[rare], at)
    with np.errstate(over="ignore"):
        return np.stack([_mix(low[i] ^ _mix(low[i - 1], _MINS[i]), _MINS[i - 1]) for i in range(len(_MINS))])


def _local_matches(tokens, offs, sketch, pick, least, lows, threshold):
    """Per set the id of an earlier line in the batch that matches it, or the largest long.

    Sets with equal MinHashes (two pairs of them in turn) are verified against the one with
    the least id; only a smaller id counts.
    """
    import numpy as np
    last = np.iinfo(np.int64).max
    match = np.full(len(pick), last)
    size = np.diff(offs)[pick]
    part = threshold / (1 + threshold)
    for key in lows[:_LOCAL_MINS]:
        if len(pick) < 2:
            break
        order = np.lexsort((least, key))
        start = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        head = np.empty(len(pick), np.int64)
        head[order] = order[np.flatnonzero(start)[np.cumsum(start) - 1]]
        both = size + size[head]
        need = np.ceil(both * part - 1e-9)
        apart = np.bitwise_count((sketch[pick] ^ sketch[pick[head]]).view(np.uint64))
        todo = (match == last) & (least[head] < least) & (apart + 2 * need <= both)
        for i in np.flatnonzero(todo).tolist():
            h = head[i]
            a, b = pick[i], pick[h]
            shared = len(np.intersect1d(tokens[offs[a]:offs[a + 1]], tokens[offs[b]:offs[b + 1]],
                                        assume_unique=True))
            if shared >= need[i]:
                match[i] = least[h]
    return match


def _packed(numbers, offs):
    """Runs of numbers -> an Arrow array of their bytes, which the JVM passes on as they are."""
    import numpy as np
    import pyarrow as pa
    ends = np.asarray(offs, np.int64) * numbers.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(numbers.tobytes())])


def _unpacked(column, kind):
    """(numbers, offsets) of what ``_packed`` made."""
    import numpy as np
    size = np.dtype(kind).itemsize
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) // size
    return np.frombuffer(data or b"", kind, int(offs[-1] - offs[0]), int(offs[0]) * size), offs - offs[0]


def _reader(rank, threshold, frequent=1 << COUNTER_BITS):
    """Rows of documents -> per row the lines' set signatures, and per new set its
    entry for the index (prefix, size, sketch, hash of the line's text)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for whole in batches:
            for b in slices(whole, "text", 16 << 20):
                lines, rows = _lines(b.column("text"))
                order = rank.value
                coded = lines.dictionary_encode()           # equal lines once
                tokens, offs, (sig, sig2, sketch), lows, wide = _described(coded.dictionary, order)
                n = np.diff(offs)
                at = np.asarray(coded.indices, np.int64)
                lists = lambda x, o, t: pa.ListArray.from_arrays(
                    pa.array(o.astype(np.int32)), pa.array(x, t))
                # one entry a set, with the least id that shows it
                _, pick, of = np.unique(sig, return_index=True, return_inverse=True)
                last = np.iinfo(np.int64).max
                ids_ = np.asarray(pc.fill_null(b.column("id"), last), np.int64)
                least = np.full(len(pick), last)
                np.minimum.at(least, of[at], np.repeat(ids_, np.diff(rows)))
                some = n[pick] > 0
                pick, least = pick[some], least[some]
                lows = lows[:, pick]
                match = _local_matches(tokens, offs, sketch, pick, least, lows, threshold)
                size = n[pick]
                prefix = size - np.ceil(threshold * size - 1e-9).astype(np.int64) + 1
                prefix[size * (1 - threshold) + 1e-9 < threshold] = 0   # only equal sets match
                ends = np.cumsum(prefix)
                src = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(
                    offs[:-1][pick] - (ends - prefix), prefix)
                line_hash = _text_hashes(coded.dictionary.take(pa.array(pick))).view(np.int64)
                del lines
                k = len(pick)
                del coded
                s1 = np.where(n[at] > 0, sig[at], 0)
                s2 = np.where(n[at] > 0, sig2[at], 0)
                none = pa.nulls
                ids, rk = b.column("id"), b.column("rk")
                yield pa.RecordBatch.from_arrays([
                    ids, rk,
                    pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)),
                                             pa.array(s1, pa.int64(), mask=n[at] == 0)),
                    lists(pa.array(s2), rows, pa.int64()),
                    *(none(b.num_rows, t) for t in _INDEX_TYPES())],
                    names=_NAMES)
                if k:
                    large = size > LARGE
                    token = (tokens[src] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    ranks = order[(tokens[src] >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
                    often = np.zeros(k, bool)
                    often[np.searchsorted(ends, np.flatnonzero(ranks >= frequent), "right")] = True
                    yield pa.RecordBatch.from_arrays([
                        none(k, ids.type), none(k, rk.type),
                        none(k, pa.list_(pa.int64())), none(k, pa.list_(pa.int64())),
                        pa.array(sig[pick]), pa.array(sig2[pick]), pa.array(size.astype(np.int32)),
                        pa.array(sketch[pick]), pa.array(line_hash), pa.array(least),
                        pa.array(match, mask=match == last),
                        _packed(lows.T.ravel(), np.arange(k + 1) * len(_MINS)),
                        *(pa.array(w, mask=~large) for w in wide[pick].T),
                        pa.array(often),
                        _packed(token, np.concatenate([[0], ends]))],
                        names=_NAMES)
                    del token, ranks, wide
                del tokens, offs, src
    return run


_NAMES = ["id", "rk", "sigs", "sigs2", "sig", "sig2", "size", "sketch", "line", "least",
          "match", "mins", *_WIDER, "often", "prefix"]


def _INDEX_TYPES():
    import pyarrow as pa
    i = pa.int64()
    return [i, i, pa.int32(), i, i, i, i, pa.binary(), *[i] * JOIN_WIDE, pa.bool_(), pa.binary()]


#: 64-bit words of the sketch that candidates are compared by before their words are.
WIDE = 8


def _wide_sketches(h, code, offs, wide=WIDE, above=0):
    """Per line of more than ``above`` words ``wide`` 64-bit words of parity bits, row by row; of others 0."""
    import numpy as np
    n = np.diff(offs)
    out = np.zeros((len(n), wide), np.uint64)
    some = np.flatnonzero(n > above)
    if len(some):
        with np.errstate(over="ignore"):
            m = _mix(h, 0xBF58476D1CE4E5B9)
        code = code[np.repeat(n > above, n)]
        bit = (np.uint64(1) << (m & np.uint64(63)))[code]
        word = ((m >> np.uint64(6)) % np.uint64(wide))[code]
        at = np.cumsum(n[some]) - n[some]
        for w in range(wide):
            out[some, w] = np.bitwise_xor.reduceat(np.where(word == w, bit, np.uint64(0)), at)
    return out.view(np.int64)


def _finder(rank, wanted):
    """Word sets and wide sketches of the lines whose text hash may be a candidate's."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        bits = np.frombuffer(wanted.value, np.uint8)
        for whole in batches:
            for b in slices(whole, "text", 16 << 20):
                lines, _ = _lines(b.column("text"))
                h, first = np.unique(_text_hashes(lines), return_index=True)
                slot = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                may = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                for picked in _parts(lines.take(pa.array(first[may]))):
                    h, code, offs = _sets(picked, rank.value)
                    sig = _signatures(h, code, offs)
                    wide = _wide_sketches(h, code, offs).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sig[0]), pa.array(sig[1]),
                         pa.ListArray.from_arrays(pa.array(np.arange(0, len(wide) + 1, WIDE, dtype=np.int32)),
                                                  pa.array(wide)),
                         pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)),
                                                  pa.array(h[code].view(np.int64)))],
                        names=["sig", "sig2", "wide", "tokens"])
    return run


def _filter_bits(lines: DataFrame) -> bytes:
    """Bitmap of the hashes in column ``line``: 2**FILTER_BITS bits, whatever their number."""
    import numpy as np
    slot = F.shiftrightunsigned("line", 64 - FILTER_BITS)
    got = lines.select(F.shiftright(slot, 6).alias("w"),
                       F.expr(f"shiftleft(1L, cast(shiftrightunsigned(line, {64 - FILTER_BITS})"
                              " & 63 as int))").alias("b")) \
        .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros((1 << FILTER_BITS) // 64, np.int64)
    out[np.asarray(got.column("w").combine_chunks(), np.int64)] = \
        np.asarray(got.column("b").combine_chunks(), np.int64)
    return out.tobytes()


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = 0.8) -> DataFrame:
    """(id, rk, n_lines, removed): per distinct (id, text) its lines and the numbers
    (from 0) of those that an earlier line matches.

    ``rk`` is the hash of the text: rows that repeat an id and a text count as one
    document and share the result; texts of one id are ordered by it.  A null or
    empty text has one line without words, which stays.  Null ids come last.  Other
    columns are ignored; an empty table gives an empty one.
    """
    if not 0.5 <= threshold <= 1:
        raise ValueError("threshold must be in 0.5..1")
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("rk"),
                    F.col(text_col).cast("string").alias("text"))
    ranks, frequent = rarity(d)
    order = spark.sparkContext.broadcast(ranks)
    read = store(map_arrow(d, _reader(order, threshold, frequent),
                           "id long, rk long, sigs array<long>, sigs2 array<long>, sig long, sig2 long,"
                           " size int, sketch long, line long, least long, match long, mins binary,"
                           + "".join(f" {c} long," for c in _WIDER) + " often boolean, prefix binary",
                           trim=True))
    rows = read.where("sigs is not null").select("id", "rk", "sigs", "sigs2")
    if not rows.groupBy("id", "rk").count().where("count > 1").isEmpty():
        rows = store(rows.dropDuplicates(["id", "rk"]))
    at = rows.select("id", "rk", F.posexplode(F.arrays_zip("sigs", "sigs2")).alias("no", "s")) \
        .where("s.sigs is not null").selectExpr("id", "rk", "no", "s.sigs as sig", "s.sigs2 as sig2")
    # place of a line: null ids last, then id, text, number
    place = F.struct(F.col("id").isNull().alias("z"), "id", "rk", "no")
    first = store(at.select("sig", "sig2", place.alias("place")).groupBy("sig", "sig2").agg(
        F.min("place").alias("first"), F.count("*").alias("n_lines")))
    later = _matches(d, read.where("sig is not null"), first, order, frequent, threshold)
    # a line that comes once and that none matches stays
    firsts = first.join(later, ["sig", "sig2"], "left").where("gone or n_lines > 1")
    # on ~sig, so that both sides are dealt for the join and a frequent line's part can be split
    marked = at.withColumn("k", F.bitwise_not("sig")).join(
        firsts.select(F.bitwise_not("sig").alias("k"), "sig2", "first", "gone"),
        ["k", "sig2"])
    gone = marked.where(F.coalesce("gone", F.lit(False)) | ~(
        F.col("first") == F.struct(F.col("id").isNull().alias("z"), "id", "rk", "no"))) \
        .groupBy("id", "rk").agg(F.sort_array(F.collect_list("no")).alias("removed"))
    gone = gone.select(F.col("id").alias("gid"), F.col("rk").alias("grk"), "removed")
    return rows.join(gone, (rows.id.eqNullSafe(gone.gid)) & (rows.rk == gone.grk), "left").select(
        "id", "rk", F.size("sigs").cast("long").alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def _gathered(batches, pack):
    """(kind, rows) of what ``pack`` makes of Arrow batches, about ``_GATHER`` rows at once."""
    import numpy as np
    held, n = {}, 0
    for b in batches:
        for kind, rows in enumerate(pack(b)):
            held.setdefault(kind, []).append(rows)
            n += len(rows)
        if n >= _GATHER:
            yield from ((kind, np.concatenate(parts)) for kind, parts in held.items())
            held, n = {}, 0
    yield from ((kind, np.concatenate(parts)) for kind, parts in held.items())


def _dealt(df, pack, join, schema, buckets):
    """``join`` over the rows of one bucket after the other: ``pack`` makes structured arrays of a batch
    of ``df``, one a kind of rows, whose rows go by their field ``key`` to one of ``buckets`` groups.

    Many rows travel as one value, so that the JVM neither sorts nor compares them.
    """
    form = arrow_schema(schema)

    def deal(batches):
        import numpy as np
        import pyarrow as pa
        for kind, rows in _gathered(batches, pack):
            to = (_mix(rows["key"].astype(np.uint64), _MINS[0]) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            some, start = np.unique(to[order], return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(np.full(len(some), kind, np.int32)),
                 _packed(rows[order], np.append(start, len(rows)))], names=["bucket", "kind", "rows"])

    def run(_, table):
        import pyarrow as pa
        by = {}
        for kind, rows in zip(table.column("kind").to_pylist(), table.column("rows").to_pylist()):
            by.setdefault(kind, []).append(rows)
        return pa.Table.from_batches(list(join({kind: b"".join(parts) for kind, parts in by.items()})), form)
    return map_arrow(df, deal, "bucket int, kind int, rows binary", trim=True).groupBy("bucket").applyInArrow(run, schema)


_LOW = [("key", "<u8"), ("sig", "<i8"), ("sig2", "<i8"), ("least", "<i8"), ("sketch", "<u8"), ("size", "<i4"),
        ("open", "?")]


def _low_order(rows):
    """Rows by key, of each the least id first, and the place of each row's first."""
    import numpy as np
    rows = rows[np.lexsort((rows["sig2"], rows["sig"], rows["least"], rows["key"]))]
    start = np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]])
    return rows, np.flatnonzero(start)[np.cumsum(start) - 1]


def _low_rows(b):
    """A batch of classes -> rows by MinHash; of equal MinHashes in the batch the class of the least id, and
    those that have no match yet."""
    import numpy as np
    lows, _ = _unpacked(b.column("mins"), "<u8")
    rows = np.empty(len(lows), _LOW)
    rows["key"] = lows
    for c in ("sig", "sig2", "least", "sketch", "size", "open"):
        rows[c] = np.repeat(np.asarray(b.column(c)), len(_MINS)).astype(rows.dtype[c], copy=False)
    if len(rows):
        rows, head = _low_order(rows)
        rows = rows[rows["open"] | (head == np.arange(len(rows)))]
    return [rows]


def _low_pairs(threshold):
    """Rows by MinHash -> each open class with the first of its key and with the one just before it."""
    part = threshold / (1 + threshold)

    def join(data):
        import numpy as np
        import pyarrow as pa
        rows, head = _low_order(np.frombuffer(data[0], _LOW))
        at = np.arange(len(rows))
        before = np.maximum(at - 1, head)
        for b, a in ((at, head), (at[before > head], before[before > head])):
            b, a = rows[b], rows[a]
            both = b["size"].astype(np.int64) + a["size"]
            apart = np.bitwise_count(b["sketch"] ^ a["sketch"])
            may = b["open"] & (a["least"] < b["least"]) & (a["sig"] != b["sig"]) & (
                apart + 2 * np.ceil(both * part - 1e-9) <= both)
            b, a = b[may], a[may]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(x)) for x in (b["sig"], b["sig2"], a["sig"], a["sig2"], a["least"])],
                names=["b_sig", "b_sig2", "a_sig", "a_sig2", "a_least"])
    return join


#: ``least`` is rounded, which keeps its order but for ties.
_WORD = [("key", "<i4"), ("sig", "<i8"), ("sketch", "<u8"), ("size", "<i4"), ("pos", "<i4"), ("least", "<f4"),
         ("settled", "?")]
_LARGE_WORD = [*_WORD, *((c, "<u8") for c in _WIDER)]


def _word_rows(rank, frequent):
    """A batch of classes -> their first words that are not frequent, of small sets and of large ones."""
    def pack(b):
        import numpy as np
        row, pos, token, ranks = _first_words(b, rank)
        few = ranks < frequent
        large = (np.asarray(b.column("size")) > LARGE)[row]
        for kind, take in ((_WORD, few & ~large), (_LARGE_WORD, few & large)):
            rows = np.empty(int(take.sum()), kind)
            rows["key"], rows["pos"] = token[take], pos[take]
            for c in rows.dtype.names:
                if c not in ("key", "pos"):
                    column = b.column(c).fill_null(0) if c in _WIDER else b.column(c)
                    rows[c] = np.asarray(column)[row[take]].astype(rows.dtype[c])
            yield rows
    return pack


def _frequent_words(rank, frequent):
    """The other first words, a row each."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            row, pos, token, ranks = _first_words(b, rank)
            many = ranks >= frequent
            at = pa.array(row[many])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(at) for c in _CLASS), pa.array(pos[many].astype(np.int32)), pa.array(token[many])],
                names=[*_CLASS, "pos", "token"])
    return run


_CLASS = ["sig", "size", "sketch", *_WIDER, "least", "settled"]


def _word_pairs(threshold):
    """Rows of some words -> pairs of classes with a first word in common that may match.

    The smaller of two sets shares one of fewer first words.  A pair is wanted if the later
    class, as far as ``least`` tells, is not settled."""
    part = threshold / (1 + threshold)

    def join(data):
        import numpy as np
        import pyarrow as pa
        kinds = [np.frombuffer(data.get(kind, b""), form) for kind, form in enumerate((_WORD, _LARGE_WORD))]
        key, sig, sketch, size, pos, least, settled = (
            np.concatenate([rows[c] for rows in kinds]) for c, _ in _WORD)
        wide = [np.concatenate([np.zeros(len(kinds[0]), np.uint64), kinds[1][c]]) for c in _WIDER]
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        pick = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        if not len(pick):
            return
        # one row a word and class, which more than one batch may have shown
        twin = _mix(sig[pick].view(np.uint64), _MINS[0]) ^ _mix(key[pick].astype(np.uint64), _MINS[1])
        order = np.argsort(twin)
        start = np.flatnonzero(np.concatenate([[True], twin[order][1:] != twin[order][:-1]]))
        least = np.minimum.reduceat(least[pick[order]], start)
        pick = pick[order[start]]
        place = (key[pick].astype(np.int64) << 32) | size[pick]
        order = np.argsort(place)
        place, least, pick = place[order], least[order], pick[order]
        sig, sketch, size, pos, settled = (c[pick] for c in (sig, sketch, size, pos, settled))
        wide = [w[pick] for w in wide]
        n = size.astype(np.int64)
        most = ((n + 1e-9) / threshold).astype(np.int64)
        end = np.searchsorted(place, (place - n) + np.minimum(most, (1 << 32) - 1), "right")
        early = pos <= n - np.ceil(n * (2 * part) - 1e-9)
        slack = np.arange(2 * int(n.max()) + 1)
        slack = (slack - 2 * np.ceil(slack * part - 1e-9)).astype(np.int32)      # words two sets may differ by
        opened = np.flatnonzero(~settled)
        left, at = size - pos, np.arange(len(size))
        for firsts, others in ((at[early & ~settled], at), (at[early & settled], opened)):
            low, high = np.searchsorted(others, firsts + 1), np.searchsorted(others, end[firsts])
            count = high - low
            total = np.concatenate([[0], np.cumsum(count)])
            cuts = np.searchsorted(total, np.arange(0, int(total[-1]) + _COMPARE, _COMPARE)).clip(max=len(count))
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                x = np.repeat(firsts[a:b], count[a:b])
                y = others[np.arange(total[a], total[b]) - np.repeat(total[a:b] - low[a:b], count[a:b])]
                allowed = slack[size[x] + size[y]]
                may = np.bitwise_count(sketch[x] ^ sketch[y]) <= allowed
                x, y, allowed = x[may], y[may], allowed[may]
                both = n[x] + n[y]
                may = (2 * np.minimum(left[x], left[y]).astype(np.int64) >= both - allowed) & (sig[x] != sig[y])
                may &= (n[x] <= LARGE) | (n[y] <= LARGE) | (
                    sum(np.bitwise_count(w[x] ^ w[y]).astype(np.int32) for w in wide) <= allowed)
                may &= np.where(least[x] < least[y], ~settled[y], np.where(least[x] > least[y], ~settled[x], True))
                x, y = x[may], y[may]
                turn = sig[x] > sig[y]
                x, y = np.where(turn, y, x), np.where(turn, x, y)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (sig[x], sig[y], settled[x], settled[y])],
                    names=["x_sig", "y_sig", "x_settled", "y_settled"])
    return join


def _first_words(b, rank):
    """(row, position, word, rank) of the words in a batch's column ``prefix``; one that comes once brings no
    two sets together and is left out."""
    import numpy as np
    token, offs = _unpacked(b.column("prefix"), "<i4")
    n = np.diff(offs)
    row = np.repeat(np.arange(len(n)), n)
    pos = np.arange(len(row)) - np.repeat(offs[:-1], n)
    ranks = rank.value[(token.view(np.uint32) >> np.uint32(32 - COUNTER_BITS)).astype(np.int64)]
    more = ranks >= 0
    return row[more], pos[more], token[more], ranks[more]


def _candidate_sets(d, read, ends, order):
    """(sig, sig2, wide, tokens) of the classes whose ``sig`` is in ``ends``, from the texts."""
    lines = read.join(ends, "sig", "left_semi").select("line")
    wanted = d.sparkSession.sparkContext.broadcast(_filter_bits(lines))
    found = map_arrow(d.select("text"), _finder(order, wanted),
                      "sig long, sig2 long, wide array<long>, tokens array<long>", trim=True)
    return store(found.join(ends, "sig", "left_semi").groupBy("sig", "sig2").agg(
        F.first("wide").alias("wide"), F.first("tokens").alias("tokens")))


def _side(k, of):
    return of.select(*(F.col(c).alias(f"{k}_{c}") for c in of.columns))


def _similar(threshold):
    """Do the words of a row's a_tokens and b_tokens match?"""
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return shared + 1e-9 >= (F.size("a_tokens") + F.size("b_tokens")) * F.lit(threshold / (1 + threshold))


def _settled(d, read, first, order, threshold):
    """(sig, sig2) of classes that one of a fixed number of classes before them matches.

    Candidates are, of the classes with the same MinHashes, that of the least id and the one
    just before in the order of ids; a class counts as before another if it has a line with an id below that of the other's first line.
    """
    own = read.groupBy("sig", "sig2").agg((F.min("match") < F.min("least")).alias("settled")) \
        .where("settled").select("sig", "sig2")
    rows = read.where("length(prefix) > 0").select(
        "sig", "sig2", "size", "sketch", "least", F.col("match").isNull().alias("open"), "mins")
    pairs = store(_dealt(rows, _low_rows, _low_pairs(threshold),
                         "b_sig long, b_sig2 long, a_sig long, a_sig2 long, a_least long",
                         1 + rows.count() * len(_MINS) // _BUCKET).distinct())
    ends = pairs.selectExpr("b_sig as sig").unionAll(pairs.selectExpr("a_sig")).distinct()
    full = _candidate_sets(d, read, ends, order).select("sig", "sig2", "tokens")
    good = pairs.join(_side("b", full), ["b_sig", "b_sig2"]).join(_side("a", full), ["a_sig", "a_sig2"]) \
        .where(_similar(threshold)).selectExpr("b_sig as sig", "b_sig2 as sig2", "a_least")
    far = good.join(first, ["sig", "sig2"]).where("first.z or a_least < first.id").select("sig", "sig2")
    return store(own.unionAll(far).distinct())


def _frequent_pairs(entries, order, frequent, r):
    """As ``_word_pairs``, of the words that come so often that a bucket could not hold one: a join,
    whose frequent keys are split."""
    probe = map_arrow(entries.where("often"), _frequent_words(order, frequent), "sig long, size int, sketch long,"
                      + "".join(f" {c} long," for c in _WIDER) + " least long, settled boolean, pos int, token int")
    x, y = _side("x", probe), _side("y", probe)
    both = F.col("x_size") + F.col("y_size")
    need = F.ceil(both * F.lit(r / (1 + r)) - 1e-9)         # words a matching pair shares
    ahead = F.least(F.col("x_size") - F.col("x_pos"), F.col("y_size") - F.col("y_pos"))
    differ = F.bit_count(F.col("x_sketch").bitwiseXOR(F.col("y_sketch")))
    # null unless both sets are large
    wider = sum((F.bit_count(F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}"))) for c in _WIDER), F.lit(0))

    def early(k):
        n = F.col(f"{k}_size")
        return F.col(f"{k}_pos") <= n - F.ceil(n * F.lit(2 * r / (1 + r)) - 1e-9)
    return x.join(y, on=[
        F.col("x_token") == F.col("y_token"), F.col("x_sig") < F.col("y_sig"),
        ~(F.col("x_settled") & F.col("y_settled")), differ + 2 * need <= both, ahead >= need,
        F.coalesce(wider + 2 * need <= both, F.lit(True)),
        F.when(F.col("x_size") <= F.col("y_size"), early("x")).otherwise(early("y")),
        F.least("x_size", "y_size") + 1e-9 >= r * F.greatest("x_size", "y_size")]) \
        .select("x_sig", "y_sig", "x_settled", "y_settled")


def _matches(d, read, first, order, frequent, threshold):
    """(sig, sig2, gone): classes that a class with an earlier first line matches."""
    r = threshold
    settled = _settled(d, read, first, order, threshold)
    entries = read.where("length(prefix) > 0").join(settled.withColumn("settled", F.lit(True)), ["sig", "sig2"], "left") \
        .select("sig", "size", "sketch", *_WIDER, "least", F.coalesce("settled", F.lit(False)).alias("settled"), "often", "prefix")
    n_words = read.agg(F.sum(1 + F.col("size") * (1 - r))).first()[0] or 0
    pairs = _dealt(entries, _word_rows(order, frequent), _word_pairs(r),
                   "x_sig long, y_sig long, x_settled boolean, y_settled boolean", 1 + int(n_words) // _BUCKET)
    if frequent <= int(order.value.max()):
        pairs = pairs.unionAll(_frequent_pairs(entries, order, frequent, r))
    pairs = store(pairs.distinct())
    ends = pairs.selectExpr("x_sig as sig").unionAll(pairs.selectExpr("y_sig")).distinct()
    del entries
    sets = _candidate_sets(d, read, ends, order)
    named = first.join(ends, "sig", "left_semi").select("sig", "sig2", F.col("first").alias("at"))

    side = _side
    key = lambda k: F.struct(F.col(f"{k}_sig").alias("sig"), F.col(f"{k}_sig2").alias("sig2"))
    late = F.col("x_at") > F.col("y_at")
    todo = pairs.join(side("x", named), "x_sig").join(side("y", named), "y_sig") \
        .where(~F.when(late, F.col("x_settled")).otherwise(F.col("y_settled"))).select(
        F.when(late, key("x")).otherwise(key("y")).alias("b"), F.when(late, key("y")).otherwise(key("x")).alias("a"))
    todo = store(todo.selectExpr("b.sig as b_sig", "b.sig2 as b_sig2", "a.sig as a_sig", "a.sig2 as a_sig2"))

    # the wide sketch first: 64 bytes a set instead of all its words
    sketches = sets.select("sig", "sig2", "wide", F.size("tokens").alias("n"))
    apart = sum((F.bit_count(F.col("a_wide")[i].bitwiseXOR(F.col("b_wide")[i])) for i in range(WIDE)), F.lit(0))
    both = F.col("a_n") + F.col("b_n")
    todo = todo.join(side("b", sketches), ["b_sig", "b_sig2"]).join(
        side("a", sketches), ["a_sig", "a_sig2"]).withColumn("apart", apart)
    todo = store(todo.where(F.col("apart") + 2 * F.ceil(both * F.lit(r / (1 + r)) - 1e-9) <= both)
               .select("b_sig", "b_sig2", "a_sig", "a_sig2", "apart"))

    def verified(p):
        full = sets.select("sig", "sig2", "tokens")
        t = p.join(side("b", full), ["b_sig", "b_sig2"]).join(side("a", full), ["a_sig", "a_sig2"])
        return t.where(_similar(r)).select("b_sig", "b_sig2").distinct()
    nearest = todo.groupBy("b_sig", "b_sig2").agg(F.min(F.struct("apart", "a_sig", "a_sig2")).alias("a")) \
        .selectExpr("b_sig", "b_sig2", "a.a_sig", "a.a_sig2")
    done = store(verified(nearest))
    more = verified(todo.join(done, ["b_sig", "b_sig2"], "left_anti").select(
        "b_sig", "b_sig2", "a_sig", "a_sig2"))
    return done.unionAll(more).toDF("sig", "sig2").unionAll(settled).withColumn("gone", F.lit(True))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.8, chars_col: str | None = None) -> DataFrame:
    """``docs`` with the removed lines cut out of the text; every row and column stays.

    A text that loses all its lines becomes empty, a null text stays null; rows with a
    null id, and rows that share an id, are told apart by their text.  Columns may have any
    name; an empty table stays one.  ``chars_col`` names a column to set to the new length.
    """
    gone = removed_lines(docs, id_col, text_col, threshold).select(
        F.col("id").alias("of"), F.col("rk").alias("of_text"), "removed").where(F.size("removed") > 0)
    named = lambda c: F.col(f"`{c}`")
    rows = docs.select(F.struct(*map(named, docs.columns)).alias("row"), named(id_col).cast("long").alias("id"),
                       F.xxhash64(named(text_col)).alias("rk"))
    out = rows.join(gone, F.col("id").eqNullSafe(F.col("of")) & (F.col("rk") == F.col("of_text")), "left")
    whole = F.col("row").getField(text_col)
    lines = F.split(whole, "\n", -1)
    # removed numbers are sorted: a line goes if a look-up finds its number
    kept = F.array_join(F.transform(F.array_except(
        F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed")),
        lambda i: F.get(lines, i)), "\n")
    out = out.select("row", F.when(F.col("removed").isNull(), whole).otherwise(kept).alias("left"),
                     F.col("removed").isNotNull().alias("cut"))

    def column(c):
        old = F.col("row").getField(c)
        if c == text_col:
            old = F.col("left")
        elif c == chars_col:
            old = F.when(F.col("cut"), F.char_length("left").cast(docs.schema[c].dataType)).otherwise(old)
        return old.alias(c)
    return out.select(*map(column, docs.columns))
