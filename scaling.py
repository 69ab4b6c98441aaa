"""Rows per second of the product build and of each layer, by rows or by cores.

    python scaling.py ROWS CPUS

Prints one JSON line. Tables go to the folder named by spark.checkpoint.dir.
"""

from __future__ import annotations

import json
import sys
import time

from larder.operators import layers as L
from larder.plans.builder import build_products
from larder.plans.layer_run import LayerConfig, run_bronze, run_gold, run_silver
from larder.session import local_session, scratch
from larder.sources.landing import write_rows


def main(rows: int, cpus: str) -> None:
    spark = local_session(cpus)
    root = scratch(spark, "scaling")

    def run(landing: str, n: int, tag: str) -> dict[str, float]:
        cfg = LayerConfig(
            landing, bronze=f"b_{tag}", silver=f"s_{tag}", gold=f"g_{tag}",
            location=f"{root}/{tag}", expected_rows=n, full_rules=True,
        )
        steps = {
            "build": lambda: write_rows(build_products(spark, n), landing),
            "bronze": lambda: run_bronze(spark, cfg),
            "silver": lambda: run_silver(spark, cfg),
            "gold": lambda: run_gold(spark, cfg),
            "stats": lambda: L.layer_stats(spark.table(f"{cfg.gold}.{cfg.table}")).collect(),
        }
        out = {}
        for name, step in steps.items():
            start = time.perf_counter()
            step()
            out[name] = round(time.perf_counter() - start, 2)
        return out

    run(f"{root}/warm", 1000, "warm")
    seconds = run(f"{root}/landing", rows, "run")
    rate = {k: round(rows / s) for k, s in seconds.items()}
    print(json.dumps({"rows": rows, "cpus": cpus, "seconds": seconds, "rows_per_sec": rate}))
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]), sys.argv[2])
