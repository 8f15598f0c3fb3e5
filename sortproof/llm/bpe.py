"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

The model is built from a rank file: the two halves of every token are the last
pair its own bytes merge to under the lower ranks, and bytes stand for the
library's printable characters (the byte table).  Text is split by the pattern,
each match is encoded separately, special tokens are ordinary text.

Over Arrow batches, texts are first cut where a single space stands between two
other characters that are not white space.  The pattern never matches across such
a place (the space opens the next match), so the units between are encoded alone,
each distinct unit of a batch once, and every position looks its ids up; a
bounded per-worker memory keeps the units met before.  Offsets are character
positions in the text; a token that holds a part of a character's bytes has the
whole character's offsets.  Decoding reverses the byte table and joins bytes
before it reads characters, so split characters come back whole.
"""

from __future__ import annotations

import base64
import functools
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortproof.llm.frames import map_arrow, slices

#: Units a worker remembers, the first it meets; results never depend on it.
UNIT_MEMORY = 250_000
#: Bytes of text a worker encodes at a time: its arrays take about 25 times as much.
SLICE = 4 << 20


def byte_table() -> dict[int, str]:
    """Byte -> printable character: Latin-1's visible ones stand for themselves,
    the others follow from code point 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return {b: chr(b if b in visible else next(other)) for b in range(256)}


def _halves(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best, i = min((ranks.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1))
        if best >= rank:
            raise ValueError(f"rank {rank}: {token!r} can't be merged from lower ranks")
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


@functools.lru_cache(maxsize=4)
def model_json(rank_file: str, pattern: str) -> str:
    """The tokenizer of a rank file (base64 token and rank a line), as JSON."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    table = byte_table()
    name = lambda bs: "".join(table[b] for b in bs)
    merges = [tuple(map(name, _halves(t, r, ranks)))
              for t, r in sorted(ranks.items(), key=lambda x: x[1]) if len(t) > 1]
    tok = Tokenizer(models.BPE(vocab={name(t): r for t, r in ranks.items()}, merges=merges,
                               ignore_merges=True))
    tok.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tok.to_str()


def token_bytes(model: str) -> list[bytes]:
    """Bytes of every id, by the reversed byte table."""
    back = {c: b for b, c in byte_table().items()}
    vocab = json.loads(model)["model"]["vocab"]
    out = [b""] * (max(vocab.values()) + 1)
    for t, i in vocab.items():
        out[i] = bytes(back[c] for c in t)
    return out


# White space as Python sees it, which holds all that the pattern's \s does.
_SPACE = (r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
          r"\x{202F}\x{205F}\x{3000}")
_ODD = rf"(^|[{_SPACE}]) | ([{_SPACE}]|$)"


def _ranges(begin, n):
    """begin[0], begin[0] + 1, .. (n[0] of them), begin[1], .."""
    import numpy as np
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(n) else 0) + np.repeat(begin - (ends - n), n)


class Codec:
    """Encodes and decodes in one worker; ``model`` is the JSON of the tokenizer."""

    def __init__(self, model: str):
        import os

        import numpy as np
        import pyarrow as pa
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(model)
        self.known = pa.array([], pa.string())
        self.known_ids = np.zeros(0, np.int32)
        self.known_count = np.zeros(0, np.int64)
        self.bytes_of = token_bytes(model)
        self.length_of = np.array([len(b) for b in self.bytes_of], np.int64)

    def _units(self, texts):
        """Arrow texts without nulls -> (distinct units, index of each position, row ends).

        The first ``joint`` units open with one space and have no other white
        space at their ends, so the pattern cuts before and behind them wherever
        they stand; the units after those are encoded alone.
        """
        import re

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        odd = np.asarray(pc.match_substring_regex(texts, _ODD)) | \
            np.asarray(pc.equal(texts, ""))
        per_row = np.zeros(len(texts), np.int64)
        lists = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        offs = np.asarray(lists.offsets, np.int64)
        offs = offs - offs[0]
        codes = lists.flatten().dictionary_encode()
        at = np.asarray(codes.indices, np.int64)
        plain = codes.dictionary
        joint = len(plain)
        first = np.zeros(len(at), bool)
        first[offs[:-1]] = True
        # a row's first unit has no space before it, the others do
        heads = np.unique(at[first])
        head_at = np.full(joint, -1, np.int64)
        head_at[heads] = joint + np.arange(len(heads))
        at = np.where(first, head_at[at], at) if len(at) else at
        units = [pc.binary_join_element_wise(" ", plain, ""), plain.take(pa.array(heads))]
        per_row[~odd] = np.diff(offs)
        if odd.any():
            cut = re.compile(r"(?<=\S)(?= \S)")
            index: dict[str, int] = {}
            got = []
            sizes = []
            for text in texts.filter(pa.array(odd)).to_pylist():
                row = cut.split(text) if text else []
                got += [index.setdefault(u, len(index)) for u in row]
                sizes.append(len(row))
            per_row[odd] = sizes
            mine = np.repeat(odd, per_row)
            both = np.empty(len(mine), np.int64)
            both[~mine] = at
            both[mine] = np.array(got, np.int64) + joint + len(heads)
            at = both
            units.append(pa.array(list(index), pa.string()))
        return pa.concat_arrays(units), joint, at, np.concatenate([[0], np.cumsum(per_row)])

    def _encode_new(self, units, joint, offsets):
        """Flat ids, (flat offsets), number of ids of each unit."""
        import numpy as np
        import pyarrow.compute as pc
        units = units.combine_chunks() if hasattr(units, "combine_chunks") else units
        size = np.asarray(pc.binary_length(units), np.int64)
        ends = np.cumsum(size)
        data = "".join(units.slice(0, joint).to_pylist())
        chars = np.asarray(pc.utf8_length(units), np.int64)
        begin = np.concatenate([[0], np.cumsum(chars)])
        cuts = begin[[*range(0, joint, 2000), joint]].tolist() if joint else []
        runs = [data[a:z] for a, z in zip(cuts, cuts[1:])]
        firsts = cuts[:-1] + begin[joint:-1].tolist()
        runs += units.slice(joint).to_pylist()
        flat, spans = [], []
        batch = self.tok.encode_batch if offsets else self.tok.encode_batch_fast
        for i in range(0, len(runs), 64):
            for k, e in enumerate(batch(runs[i:i + 64], add_special_tokens=False), i):
                flat.append(np.array(e.ids, np.int32))
                if offsets:
                    spans.append(np.array(e.offsets, np.int64).reshape(-1, 2) + firsts[k])
        ids = np.concatenate([np.zeros(0, np.int32), *flat])
        # a unit's ids end where its bytes do
        got = np.searchsorted(np.cumsum(self.length_of[ids]), ends) + (size > 0) if len(ids) \
            else np.zeros(len(units), np.int64)
        count = np.diff(got, prepend=0)
        if not offsets:
            return ids, None, count
        spans = np.concatenate([np.zeros((0, 2), np.int64), *spans])
        return ids, spans - np.repeat(begin[:-1], count)[:, None], count

    def _encode_units(self, units, joint, offsets):
        """As ``_encode_new``, with the units that this worker met before looked up."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if offsets:
            return self._encode_new(units, joint, True)
        found = pc.index_in(units, value_set=self.known)
        new = np.asarray(pc.is_null(found))
        ids, _, count = self._encode_new(units.filter(pa.array(new)), int(new[:joint].sum()), False)
        all_ids = np.concatenate([self.known_ids, ids])
        at = np.asarray(pc.fill_null(found, 0), np.int64)
        at[new] = len(self.known) + np.arange(len(count))
        all_count = np.concatenate([self.known_count, count])
        begin = np.cumsum(all_count) - all_count
        n = all_count[at]
        flat = all_ids[_ranges(begin[at], n)]
        room = max(0, UNIT_MEMORY - len(self.known))
        if room and len(count):
            kept = int(count[:room].sum())
            self.known = pa.concat_arrays([self.known, units.filter(pa.array(new)).slice(0, room)])
            self.known_ids = np.concatenate([self.known_ids, ids[:kept]])
            self.known_count = np.concatenate([self.known_count, count[:room]])
        return flat, None, n

    def encode(self, texts, offsets: bool = False):
        """(flat ids, row ends, flat offsets or None) of Arrow texts without nulls."""
        import numpy as np
        import pyarrow.compute as pc
        units, joint, at, row_ends = self._units(texts)
        flat, spans, count = self._encode_units(units, joint, offsets)
        begin = np.cumsum(count) - count
        n = count[at]
        token_ends = np.concatenate([[0], np.cumsum(n)])
        src = _ranges(begin[at], n)
        ends = token_ends[row_ends]
        if not offsets:
            return flat[src], ends, None
        chars = np.asarray(pc.utf8_length(units), np.int64)[at]
        before = np.concatenate([[0], np.cumsum(chars)])
        base = before[:-1] - np.repeat(before[row_ends[:-1]], np.diff(row_ends))
        return flat[src], ends, (spans[src] + np.repeat(base, n)[:, None]).astype(np.int32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CODEC: dict[int, Codec] = {}


def _codec(model: str) -> Codec:
    k = hash(model)
    if k not in _CODEC:
        _CODEC.clear()
        _CODEC[k] = Codec(model)
    return _CODEC[k]


def broadcast_model(spark: SparkSession, rank_file: str | None = None,
                    pattern: str | None = None):
    """The tokenizer, read on the driver: its size is the vocabulary's, not the data's."""
    import public_tokenizers
    return spark.sparkContext.broadcast(model_json(
        rank_file or public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern or public_tokenizers.PATTERN))


def _texts(batch, column):
    import pyarrow as pa
    import pyarrow.compute as pc
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, ids array<int>, starts array<int>, ends array<int>) of every row.

    starts / ends are character offsets into the text.  A null text is empty and
    has no ids; a null id stays null; repeated rows repeat; other columns are
    ignored.
    """
    model = broadcast_model(docs.sparkSession, rank_file, pattern)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        codec = _codec(model.value)
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                ids, ends, spans = codec.encode(_texts(b, "text"), True)
                off = pa.array(ends.astype(np.int32))
                lists = [pa.ListArray.from_arrays(off, pa.array(np.ascontiguousarray(x)))
                         for x in (ids, spans[:, 0], spans[:, 1])]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), *lists], names=["id", "ids", "starts", "ends"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    return map_arrow(d, run, f"id {kind}, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, rank_file: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """(id, data binary, text string) of rows (id, ids array<int>).

    Bytes that are no whole character (ids cut inside one) read as U+FFFD in
    ``text``; ``data`` is exact.  Null ids lists are empty.  An id outside the
    vocabulary raises.
    """
    model = broadcast_model(encoded.sparkSession, rank_file, pattern)

    def run(batches):
        import pyarrow as pa
        codec = _codec(model.value)
        for b in batches:
            data = [codec.decode(x or []) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(data, pa.binary()),
                 pa.array([d.decode("utf-8", "replace") for d in data], pa.string())],
                names=["id", "data", "text"])

    d = encoded.select("id", "ids")
    kind = d.schema["id"].dataType.simpleString()
    return map_arrow(d, run, f"id {kind}, data binary, text string")


def _digester(model):
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        codec = _codec(model.value)
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                ids, ends, _ = codec.encode(_texts(b, "text"))
                ids = ids.astype("<u4")
                at = ends.tolist()
                n, enc, dec = [], [], []
                for a, z in zip(at, at[1:]):
                    one = ids[a:z]
                    n.append(z - a)
                    enc.append(hashlib.sha256(one.tobytes()).hexdigest())
                    dec.append(hashlib.sha256(codec.decode(one.tolist())).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(n, pa.int64()), pa.array(enc, pa.string()),
                     pa.array(dec, pa.string())],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes whole texts and decodes
    the ids again; digests of little-endian unsigned 32-bit ids and of the bytes.

    Null texts count as empty; other columns are ignored; repeated rows repeat.
    """
    model = broadcast_model(docs.sparkSession, rank_file, pattern)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    return map_arrow(d, _digester(model), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
                     trim=True)
