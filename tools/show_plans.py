"""Write PLANS.md: the physical plans of the headline operators at sf0.01.

    python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    qe = df._jdf.queryExecution()
    text = qe.executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    text = re.sub(r"file:[^,\]]*", "<path>", text)
    return text.strip()


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from sortproof.operators import generate as G
    from sortproof.operators import partition as P
    from sortproof.operators import sort as S
    from sortproof.operators import validate as V
    from sortproof.plans import fixtures as X
    from sortproof.session import local_session
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    o = X.order_records(spark, sf)
    splits = P.split_points(o.select("key").sample(0.1, seed=1), 7)
    cases = {
        "generate 1M records (spark.range -> mapInArrow)":
            G.generate_records(spark, 1_000_000, num_partitions=4),
        "sort, prefix7 (one pass-through exchange + sort)":
            S.total_order_sort(o, 7, "prefix7"),
        "sort, sampled split points (codegen'd CASE tree + pass-through exchange)":
            S.total_order_sort(o, 7, "sampled", splits=splits),
        "sort, sampled with 400 partitions (split lookup as a bucketed broadcast join)":
            S.total_order_sort(o, 400, "sampled",
                               splits=P.split_points(o.select("key"), 400)),
        "sort, range (range exchange over key + row hash)":
            S.total_order_sort(o, 7, "range"),
        "global position, sampled (counts by partial aggregation, broadcast offsets)":
            S.sort_with_global_position(o, 7, "sampled", splits=splits),
        "checksum (partial + final sum)": V.checksum_total(o),
        "run scan feeding the validator (one read, no record shuffle)":
            V.scan_runs(X.event_records(spark, sf), materialize=False),
        "validation report over the checkpointed run table":
            V.validate(X.event_records(spark, sf)),
        "misorders, window form (shuffles every key)":
            V.misorders(X.event_records(spark, sf)),
    }
    out = ["# Physical plans of the headline operators",
           "",
           "Generated by `tools/show_plans.py` on the sf0.01 tables with AQE off, so the static",
           "plan is shown. Expression ids and paths are stripped.", ""]
    for title, df in cases.items():
        out += [f"## {title}", "", "```", plan_text(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main(sys.argv)
