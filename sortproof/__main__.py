"""Command line: the three programs of the sort workflow.

    spark-submit --py-files sortproof.zip -m sortproof gen 10m  <out dir>
    spark-submit ... -m sortproof sort <in dir> <out dir> [--partitions N] [--method M]
    spark-submit ... -m sortproof validate <in dir> [<report dir>]
    spark-submit ... -m sortproof check <in dir>

(or ``python -m sortproof ...`` for a local session).  Row counts take the
suffixes k, m, b, t in any case.  Exit status 1 when validation finds errors.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _count(spark: SparkSession, text: str) -> int:
    from sortproof.functions.counts import parse_human_count
    n = spark.range(1).select(parse_human_count(F.lit(text)).alias("n")).first()["n"]
    if n is None:
        raise SystemExit(f"not a row count: {text!r}")
    return int(n)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="sortproof")
    sub = ap.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("gen", help="generate records")
    g.add_argument("rows")
    g.add_argument("out")
    g.add_argument("--start", default="0")
    g.add_argument("--ascii", action="store_true")
    g.add_argument("--partitions", type=int)
    s = sub.add_parser("sort", help="totally sort a record dataset")
    s.add_argument("input")
    s.add_argument("out")
    s.add_argument("--partitions", type=int)
    s.add_argument("--method", default="sampled", choices=["range", "sampled", "prefix7", "prefix3"])
    s.add_argument("--sampler", default="spread", choices=["blocks", "spread", "sketch"],
                   help="keys for --method sampled: of a few blocks, some of every split, or a sketch of all")
    v = sub.add_parser("validate", help="check order and checksum")
    v.add_argument("input")
    v.add_argument("report", nargs="?")
    v.add_argument("--key-only", action="store_true", help="checksum the keys only")
    v.add_argument("--format", default="text", choices=["text", "json"],
                   help="report file format")
    c = sub.add_parser("check", help="list the data files, their sizes and record counts")
    c.add_argument("input")
    args = ap.parse_args(argv)

    from sortproof import jobs
    spark = SparkSession.builder.appName(f"sortproof-{args.cmd}").getOrCreate()
    if args.cmd == "gen":
        out = jobs.generate_job(spark, _count(spark, args.rows), args.out,
                                start=_count(spark, args.start), ascii=args.ascii,
                                num_partitions=args.partitions)
        print(json.dumps({"rows": out["rows"], "checksum": format(out["checksum"], "x")}))
        return 0
    if args.cmd == "sort":
        out = jobs.sort_job(spark, args.input, args.out, args.partitions, args.method,
                            sampler=args.sampler)
        print(json.dumps({"rows": out["rows"], "checksum": format(out["checksum"], "x")}))
        return 0
    if args.cmd == "check":
        from sortproof.sources.inventory import inventory
        inv = inventory(spark, args.input).orderBy("path").collect()
        for r in inv:
            print(f"{r.path}\t{r.length}\t{r.records}\t{r.remainder}")
        print(f"files {len(inv)}\tbytes {sum(r.length for r in inv)}\t"
              f"records {sum(r.records for r in inv)}")
        return 1 if any(r.remainder for r in inv) else 0
    report = jobs.validate_job(spark, args.input, args.report,
                               columns="key" if args.key_only else "record",
                               report_format=args.format)
    # stream the report: a badly ordered dataset can have a row per record,
    # so it is never held whole on the driver
    failed = False
    for r in report.toLocalIterator():
        failed = failed or r.kind == "error"
        print(f"{r.kind}\t{r.file or ''}\t{r.detail}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
