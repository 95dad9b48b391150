"""Largest task of the position key when one group holds a third of the rows.

Usage: python tools/skew_demo.py [sf_dir] [scratch_dir]

Builds the keyed picks from the driver tables, gives a third of them one NULL
order key (a hot group), and numbers positions two ways: the plain
``row_number`` window and ``running_position``. Reports, per run, the most
rows any single task read from a shuffle (from the event log) and the time.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from pickmarts.operators import curation as cur  # noqa: E402
from pickmarts.operators.positions import running_position  # noqa: E402
from pickmarts.session import build_session  # noqa: E402
from pickmarts.sources.tpch_adapter import staged_picks  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-demo-")
    ev = os.path.join(scratch, "events")
    os.makedirs(ev, exist_ok=True)
    spark = build_session(
        "local[8]",
        shuffle_partitions=16,
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": ev,
            "spark.eventLog.compress": "false",
            # show the planned partitioning, not partitions AQE merges because they are small here
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    keyed = cur.with_order_key(staged_picks(spark, sf_dir))
    keyed = keyed.withColumn(
        "sk_order_id", F.when(F.col("pick_volume") % 3 == 0, F.lit(None)).otherwise(F.col("sk_order_id"))
    )
    keys, order = list(cur.POSITION_GROUP), list(cur.POSITION_ORDER)
    n = keyed.count()
    runs = {}
    for label, build in [
        ("plain row_number", lambda: keyed.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))),
        ("running_position", lambda: running_position(keyed, keys, order, "pos")),
    ]:
        spark.sparkContext.setJobGroup(label, label)
        t0 = time.time()
        build().write.format("noop").mode("overwrite").save()
        runs[label] = time.time() - t0
    spark.stop()

    log = sorted(glob.glob(os.path.join(ev, "**", "events_*"), recursive=True))[0]
    group_of_stage, max_read = {}, {}
    for line in open(log):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                group_of_stage[sid] = g
        elif e["Event"] == "SparkListenerTaskEnd":
            g = group_of_stage.get(e["Stage ID"])
            m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            rows = m.get("Total Records Read", 0)
            if g:
                max_read[g] = max(max_read.get(g, 0), rows)
    print(json.dumps({"rows": n, "hot_group_rows": n // 3, "max_rows_read_by_one_task": max_read,
                      "sec": {k: round(v, 2) for k, v in runs.items()}}))


if __name__ == "__main__":
    main()
