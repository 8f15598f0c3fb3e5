"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The vocabulary, merges and added tokens come from a ``tokenizers`` JSON file with a
byte-level BPE model.  A piece of the pre-tokenizer starts as its bytes; the leaf of
position i holds (rank, i) of the pair that starts there, so the root is the leftmost
pair of the lowest rank.  A merge changes three leaves, each in as many steps as the
tree is high, until the root is empty: n log n for a piece of n bytes, however long.

Texts are cut where one space stands between two other characters that are not white
space: the byte-level pattern opens a match at every such place.  A worker keeps the
ids of the units between (a bounded number of them), which never changes a result.
Added tokens inside a text are found first, as the library does.
"""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortproof.llm.frames import map_arrow, slices

#: Units (and pieces) a worker remembers at most, and the longest of them in characters.
UNITS, UNIT_CHARS = 500_000, 64

# White space of Python's re holds all that the byte-level pattern calls so.
_CUT = re.compile(r"(?<=\S)(?= \S)")
# Letters, then ASCII marks but the apostrophe: the pattern makes a piece of each.
_PLAIN = re.compile(r"( ?[A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\xFF]+)([!-&(-/:-@\[-`{-~]*)").fullmatch


def read_model(path: str) -> str:
    """The JSON text of a tokenizer file, after checking that it is of the known kind."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    j = json.loads(text)
    m, pre = j["model"], j["pre_tokenizer"] or {}
    plain = m["type"] == "BPE" and not any(
        m.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                           "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or j["normalizer"] or j["post_processor"] or pre.get("type") != "ByteLevel" \
            or pre.get("add_prefix_space") or not pre.get("use_regex", True) \
            or (j["decoder"] or {}).get("type") != "ByteLevel":
        raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
    if any(a[k] for a in j["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path}: added tokens with flags are not supported")
    return text


def merge(ids: list[int], ranks: dict, merged: list[int]) -> list[int]:
    """Ids of a piece: ``ranks[a][b]`` is the rank of the pair (a, b), ``merged`` maps a rank to the new id.

    ``node`` is the tree: its root is node[1], the leaf of position i node[size + i].
    """
    n = len(ids)
    if n < 2:
        return ids
    size, none, nothing = 1 << (n - 2).bit_length(), (len(merged) + 1) * n, {}
    of = ranks.get
    node = [none] * (2 * size)
    i = size
    for a, b in zip(ids, ids[1:]):
        r = of(a, nothing).get(b)
        if r is not None:
            node[i] = r * n + i - size
        i += 1
    for k in range(size - 1, 0, -1):
        a, b = node[2 * k], node[2 * k + 1]
        node[k] = a if a < b else b
    if node[1] == none:
        return ids
    ids = list(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (least := node[1]) != none:
        r, i = divmod(least, n)
        j = after[i]
        k = after[i] = after[j]
        ids[i], ids[j] = new, _ = merged[r], -1
        # the pair at j is gone, those at i and before it are others now
        leaves = [(j, none)] if k < n else []
        r = None
        if k < n:
            before[k] = i
            r = of(new, nothing).get(ids[k])
        leaves.append((i, none if r is None else r * n + i))
        h = before[i]
        if h >= 0:
            r = of(ids[h], nothing).get(new)
            leaves.append((h, none if r is None else r * n + h))
        for k, value in leaves:
            k += size
            if node[k] == value:
                continue
            node[k] = value
            while k > 1:
                other = node[k ^ 1]
                k >>= 1
                if other < value:
                    value = other
                if node[k] == value:
                    break
                node[k] = value
    return [x for x in ids if x >= 0]


class Codec(dict):
    """Unit -> its ids as little-endian bytes; encodes and decodes in one worker."""

    def __init__(self, model: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.cut = Tokenizer.from_str(model).pre_tokenizer.pre_tokenize_str
        j = json.loads(model)
        self.vocab = vocab = j["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in j["model"]["merges"]]
        self.ranks = {}
        for r, (a, b) in enumerate(pairs):
            self.ranks.setdefault(vocab[a], {})[vocab[b]] = r
        self.merged = [vocab[a + b] for a, b in pairs]
        self.added = {a["content"]: a["id"] for a in j["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        other = iter(range(256, 512))
        back = {chr(b if b in visible else next(other)): b for b in range(256)}
        self.first = [vocab[c] for c, _ in sorted(back.items(), key=lambda x: x[1])]
        self.pieces: dict = {}            # bytes, or their characters -> ids
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for t, i in {**vocab, **self.added}.items():
            self.bytes_of[i] = bytes(map(back.__getitem__, t)) if all(c in back for c in t) else t.encode()

    def _piece(self, piece, ids: list[int]) -> bytes:
        import numpy as np
        got = self.pieces.get(piece)
        if got is None:
            got = np.array(merge(ids, self.ranks, self.merged), "<u4").tobytes()
            if len(self.pieces) < UNITS and len(piece) <= UNIT_CHARS:
                self.pieces[piece] = got
        return got

    def _unit(self, unit: str):
        """The ids of a unit, piece by piece."""
        plain = _PLAIN(unit)
        if plain and not (self.special and self.special.search(unit)):
            for part in plain.groups():
                if part:
                    data = part.encode()
                    yield self._piece(data, [self.first[x] for x in data])
            return
        for part in self.special.split(unit) if self.special else [unit]:
            if part in self.added:
                yield self.added[part].to_bytes(4, "little")
            elif part:
                for piece, _ in self.cut(part):
                    yield self._piece(piece, [self.vocab[c] for c in piece])

    def __missing__(self, unit: str) -> bytes:
        got = b"".join(self._unit(unit))
        if len(self) < UNITS and len(unit) <= UNIT_CHARS:
            self[unit] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, _CUT.split(text))) if text else b""

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_CODEC: dict[str, Codec] = {}


def _codec(model: str) -> Codec:
    if model not in _CODEC:
        _CODEC.clear()
        _CODEC[model] = Codec(model)
    return _CODEC[model]


def broadcast_model(spark: SparkSession, path: str | None = None):
    """The tokenizer file, read on the driver: as large as the vocabulary, whatever the data."""
    import public_tokenizers
    return spark.sparkContext.broadcast(read_model(path or public_tokenizers.path("byte_bpe_50k.json")))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return d, d.schema["id"].dataType.simpleString()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           path: str | None = None) -> DataFrame:
    """(id, ids array<int>) of every whole text.

    A null or empty text has no ids; a null id stays null; repeated rows repeat, also
    those of one id with different texts; other columns are ignored, whatever their
    names; an empty table gives an empty one.
    """
    model = broadcast_model(docs.sparkSession, path)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        codec = _codec(model.value)
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                got = [codec.encode(t) for t in b.column("text").to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(g) // 4 for g in got])]).astype(np.int32)
                flat = np.frombuffer(b"".join(got), "<u4").astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([b.column("id"), lists], names=["id", "ids"])

    d, kind = _texts(docs, id_col, text_col)
    return map_arrow(d, run, f"id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(id, text) of rows (id, ids array<int>), added tokens as their text.

    Bytes that are no whole character read as U+FFFD; a null list is the empty text;
    an id outside the vocabulary, or a null one, raises.
    """
    model = broadcast_model(encoded.sparkSession, path)

    def run(batches):
        import pyarrow as pa
        codec = _codec(model.value)
        for b in batches:
            text = [codec.decode(x or []) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(text, pa.string())], names=["id", "text"])

    d = encoded.select("id", "ids")
    return map_arrow(d, run, f"id {d.schema['id'].dataType.simpleString()}, text string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): every whole text encoded, its ids
    decoded again, and the digests of both; nulls and repeats as in ``encode``."""
    model = broadcast_model(docs.sparkSession, path)

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        codec = _codec(model.value)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                n, enc, dec = [], [], []
                for text in b.column("text").to_pylist():
                    ids = codec.encode(text)
                    n.append(len(ids) // 4)
                    enc.append(sha(ids))
                    dec.append(sha(codec.decode(np.frombuffer(ids, "<u4").tolist()).encode()))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(n, pa.int64()), pa.array(enc, pa.string()), pa.array(dec, pa.string())],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    d, kind = _texts(docs, id_col, text_col)
    return map_arrow(d, run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
