"""Look for plan shapes that do not scale, over all registered queries.

    python tools/plans.py [--sf DIR]

Broadcasts are off, so that every join shows the way it takes on big inputs.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os

import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SHAPES = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "Window [", "SinglePartition", "Exchange hashpartitioning"]


def main() -> None:
    from opsmart.session import get_spark
    from registry import Sources, load_all

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    ap.add_argument("--broadcast", action="store_true")
    args = ap.parse_args()
    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"}
    if not args.broadcast:
        conf["spark.sql.autoBroadcastJoinThreshold"] = "-1"
    spark = get_spark(master="local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    for key, q in load_all().items():
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            q.build(Sources(spark, args.sf)).explain()
        plan = out.getvalue()
        counts = {s: plan.count(s) for s in SHAPES}
        flags = [s for s in SHAPES[:4] if counts[s]]
        print(f"{key:32} exchanges={counts['Exchange hashpartitioning']:2} single={counts['SinglePartition']:2} windows={counts['Window [']:2} {' '.join(flags)}")


if __name__ == "__main__":
    main()
