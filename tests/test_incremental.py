import os
import random

import pytest

from sortproof import incremental as IC
from sortproof.operators import generate as G
from sortproof.operators import sort as S
from sortproof.operators import validate as V
from sortproof.sources import fixed_record as FR


def put(path, name, keys):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "wb") as f:
        f.write(b"".join(k + bytes(90) for k in keys))


def keys(seed, n):
    rng = random.Random(seed)
    return sorted(rng.randbytes(10) for _ in range(n))


def rows(df):
    return sorted((r.kind, r.file or "", r.detail) for r in df.collect())


def full(spark, path):
    return rows(V.validate(FR.read_fixed_records(spark, path), method="scan"))


def test_report_equals_a_full_run_and_old_files_are_not_read(spark, tmp_path, monkeypatch):
    path, state = str(tmp_path / "data"), str(tmp_path / "state")
    ks = keys(1, 300)
    read = []
    scan = FR.read_fixed_records

    def seen(spark, path, *a, **k):
        read.append(sorted({os.path.basename(f) for f, _, _ in k["ranges"]}))
        return scan(spark, path, *a, **k)

    def step():
        want = full(spark, path)
        monkeypatch.setattr(FR, "read_fixed_records", seen)
        assert rows(IC.validate_incremental(spark, path, state, split_bytes=2000)) == want
        monkeypatch.setattr(FR, "read_fixed_records", scan)
        return want

    put(path, "a", ks[:100])
    put(path, "b", [])
    assert [r[0] for r in step()] == ["checksum"]
    put(path, "c", ks[100:200])
    assert [r[0] for r in step()] == ["checksum"]
    step()                                        # nothing new
    assert read == [["a"], ["c"]]                 # an empty file has no records to read
    put(path, "bb", ks[200:])                     # between two others: falls at a file border
    assert [r[0] for r in step()] == ["error"]
    put(path, "d", ks[250:][::-1])                # falls in the file, across pieces too
    assert len(step()) > 50
    os.remove(os.path.join(path, "d"))
    assert [r[0] for r in step()] == ["error"]
    put(path, "bb", ks[100:101])                  # changed in place
    assert [r[0] for r in step()] == ["checksum"]
    assert read[2:] == [["bb"], ["d"], ["bb"]]
    with pytest.raises(ValueError, match="was kept with"):
        IC.validate_incremental(spark, path, state, columns="key")


def test_errors_raise_and_bad_files_leave_the_state(spark, tmp_path):
    path, state = str(tmp_path / "data"), str(tmp_path / "state")
    put(path, "a", keys(2, 20))
    good = rows(IC.validate_incremental(spark, path, state))
    with open(os.path.join(path, "b"), "wb") as f:
        f.write(bytes(130))
    with pytest.raises(EOFError, match="partial record of 30 bytes"):
        IC.validate_incremental(spark, path, state)
    with pytest.raises(ValueError, match="does not know"):
        IC.present_state(spark, path, state)
    os.remove(os.path.join(path, "b"))
    assert rows(IC.validate_incremental(spark, path, state)) == good
    put(path, "b", keys(2, 20)[:5])
    with pytest.raises(ValueError, match="Data validation failed: bad key partitioning"):
        IC.validate_incremental(spark, path, state, raise_on_error=True)


def test_an_interrupted_update_leaves_the_old_state(spark, tmp_path, monkeypatch):
    path, state = str(tmp_path / "data"), str(tmp_path / "state")
    put(path, "a", keys(3, 10))
    IC.update_state(spark, path, state)
    put(path, "b", keys(4, 10))
    monkeypatch.setattr(IC, "_publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError, match="killed"):
        IC.update_state(spark, path, state)
    monkeypatch.undo()
    assert [os.path.basename(f) for f, _, _ in IC.new_files(spark, path, state)] == ["b"]
    assert rows(IC.validate_incremental(spark, path, state)) == full(spark, path)


def test_batches_are_written_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(IC, "MOST_BATCHES", 2)
    path, state = str(tmp_path / "data"), str(tmp_path / "state")
    ks = keys(5, 60)
    for i in range(4):
        put(path, f"p{i}", ks[15 * i:15 * i + 15])
        got = rows(IC.validate_incremental(spark, path, state))
    assert len(IC._current(state)["batches"]) <= 2
    assert got == full(spark, path) and got[0][0] == "checksum"


def test_empty_dataset(spark, tmp_path):
    path, state = str(tmp_path / "data"), str(tmp_path / "state")
    os.makedirs(path)
    assert rows(IC.validate_incremental(spark, path, state)) == [("checksum", "", "0")]
    assert IC.dataset_summary(IC.present_state(spark, path, state)[0])["rows"] == 0


def test_merge_is_associative_and_equals_the_whole(spark, tmp_path):
    rng = random.Random(8)
    parts = []
    for _ in range(40):
        ks = sorted(rng.choice([None, b"", rng.randbytes(1)]) or b"" for _ in range(rng.choice([0, 1, 3])))
        parts.append({"rows": 0} if not ks else {"rows": len(ks), "first_key": rng.choice([None, ks[0]]),
                                                 "last_key": ks[-1], "checksum": rng.randrange(9), "falls": 0})
    for a, b, c in zip(parts, parts[1:], parts[2:]):
        assert IC.merge(IC.merge(a, b), c) == IC.merge(a, IC.merge(b, c))
    path, state = str(tmp_path / "data"), str(tmp_path / "state")
    FR.write_fixed_records(S.total_order_sort(G.generate_records(spark, 500), 5, "prefix7"), path)
    put(path, "zz", [b"\x00" * 10])
    IC.update_state(spark, path, state)
    summary, _ = IC.present_state(spark, path, state)
    got = IC.dataset_summary(summary)
    want = V.checksum_total(FR.read_fixed_records(spark, path)).first()
    assert (got["rows"], got["checksum"], got["falls"]) == (501, want["checksum"], 1)
