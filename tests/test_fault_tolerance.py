"""A task that dies mid-write is retried; the output holds every record exactly once."""

import json
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import json, sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    spark = (SparkSession.builder.master("local[4,4]")        # up to 4 attempts per task
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.setCheckpointDir({ckpt!r})
    from sortproof.operators import generate as G, sort as S, validate as V
    from sortproof.sources import fixed_record as FR

    def flaky(batches):
        ctx = TaskContext.get()
        for i, b in enumerate(batches):
            if ctx.partitionId() == 1 and ctx.attemptNumber() == 0 and i == 1:
                open({marker!r}, "w").close()
                raise RuntimeError("executor lost")
            yield b

    recs = G.generate_records(spark, 50_000, num_partitions=4)
    s = S.total_order_sort(recs, 4, "prefix7")
    s = s.mapInArrow(flaky, s.schema)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    FR.write_fixed_records(s, {out!r})
    back = FR.read_fixed_records(spark, {out!r})
    rep = [(r.kind, r.detail) for r in V.validate(back).collect()]
    tot = V.checksum_total(recs).collect()[0]
    print(json.dumps({{"rows": back.count(), "report": rep, "want": tot.checksum_hex,
                      "temp_left": __import__("os").path.exists({out!r} + "/_temporary")}}))
""")


def test_write_survives_task_failure(tmp_path):
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    marker = str(tmp_path / "failed-once")
    code = SCRIPT.format(root=ROOT, out=out, ckpt=ckpt, marker=marker)
    res = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         timeout=600, cwd=str(tmp_path))
    line = [x for x in res.stdout.splitlines() if x.startswith("{")]
    assert line, res.stderr[-2000:]
    got = json.loads(line[-1])
    assert os.path.exists(marker)  # the first attempt really died mid-write
    assert got["rows"] == 50_000
    assert got["report"] == [["checksum", got["want"]]]
    assert got["temp_left"] is False
    assert sorted(os.listdir(out)) == ["_SUCCESS"] + [f"part-{i:010d}" for i in range(4)]


def test_validate_job_compares_checksums(spark, tmp_path):
    from sortproof import jobs
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    made = jobs.generate_job(spark, 2000, src, num_partitions=2)
    assert jobs.sort_job(spark, src, out, num_partitions=3) == made
    assert [r.kind for r in jobs.validate_job(spark, out, expected=made).collect()] == ["checksum"]
    other = dict(made, rows=1999)
    assert "error" in [r.kind for r in jobs.validate_job(spark, out, expected=other).collect()]
    # an unsorted dataset is reported by file name
    bad = [r for r in jobs.validate_job(spark, src).collect() if r.kind == "error"]
    assert bad and all(r.file.startswith(src) for r in bad)
