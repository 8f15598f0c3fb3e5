import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from sortproof.llm import bpe

DDL = "doc_id long, text string, ids string, n_tokens string"


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in
             map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    alpha = list("ab .'sT\n\t 1,é　\x1c\x85漢😀́'\x00") + ["'s", "'ll", "  ", " \n", "<|endoftext|>"]
    out = ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    return out + ["", " ", "x" * 40000, "the cat " * 9000, " \n" * 3000]


def test_same_ids_and_round_trip(spark, reference):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts())] + [(None, "a", "", ""), (5, None, None, None)]
    df = spark.createDataFrame(rows, DDL)
    got = bpe.digests(df).collect()
    want = sorted((str(i), len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t, *_ in rows for e in [reference.encode_ordinary(t or "")])
    assert sorted((str(r.id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_offsets_and_decoding(spark, reference):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts()[:400])]
    enc = bpe.encode(spark.createDataFrame(rows, DDL))
    by = {r.id: r for r in enc.collect()}
    for i, t, *_ in rows:
        r = by[i]
        assert r.ids == reference.encode_ordinary(t)
        for k, (a, z) in enumerate(zip(r.starts, r.ends)):
            piece = reference.decode_single_token_bytes(r.ids[k])
            assert piece in t[a:z].encode()         # a part of a character has all of it
    assert any(a < z for r in by.values() for a, z in zip(r.starts[1:], r.ends))
    dec = {r.id: r for r in bpe.decode(enc).collect()}
    assert all(dec[i].data == t.encode() and dec[i].text == t for i, t, *_ in rows)


def test_split_character_and_empty(spark):
    ids = spark.createDataFrame([(1, [i]) for i in (247,)] + [(2, None)], "id long, ids array<int>")
    got = {r.id: r for r in bpe.decode(ids).collect()}
    assert got[2].data == b"" and got[2].text == ""
    assert len(got[1].data) == 1 or got[1].text
    assert bpe.digests(spark.createDataFrame([], DDL)).count() == 0


def test_a_worker_encodes_small_slices_of_large_batches(monkeypatch):
    import pyarrow as pa
    model = type("", (), {"value": bpe.model_json(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)})
    codec, sizes = bpe._codec(model.value), []
    encode = codec.encode
    monkeypatch.setattr(codec, "encode", lambda t: sizes.append(sum(map(len, t.to_pylist()))) or encode(t))
    texts = [f"the cat {i} " * 2000 for i in range(500)]        # over 10 MB in a batch
    rows = pa.RecordBatch.from_pydict({"id": list(range(500)), "text": texts})
    out = pa.Table.from_batches(list(bpe._digester(model)(iter([rows])))).to_pylist()
    assert [r["id"] for r in out] == list(range(500)) and max(sizes) <= 5 << 20 < sum(sizes)
    for r in out[::50]:
        data = texts[r["id"]].encode()
        assert r["decoded_sha256"] == hashlib.sha256(data).hexdigest()
