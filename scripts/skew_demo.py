"""Hot-key experiment: one unit holds a third of all establishments and accounts.

    python scripts/skew_demo.py [sf_dir]

Builds the hot-key tables from the driver's orders (every third order re-keyed to one unit),
lands them as 16 Parquet files each in a scratch folder, then runs revenue per place two ways
with the event log on: the row-level join then sum (what the dashboard's pandas code does —
every establishment row meets every account row of its unit) and ``revenue_by_group``
(pre-aggregated per (place, unit) and per unit, then joined one row per key). Prints wall
time, rows entering the join, and the slowest task against the median task per query.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from firmlens.operators.aggregates import revenue_by_group  # noqa: E402
from firmlens.roles import ROLE_VIEWS  # noqa: E402
from firmlens.session import tune  # noqa: E402

HOT = "000000007"


def hot_view(spark, sf, view):
    v = ROLE_VIEWS[view]
    exprs = dict(v.columns)
    cols = [f"CASE WHEN o_orderkey % 3 = 0 THEN '{HOT}' ELSE {exprs['siren']} END AS siren"]
    cols += [f"{e} AS {n}" for n, e in v.columns if n != "siren"]
    return spark.read.parquet(f"{sf}/{v.source}.parquet").selectExpr(*cols)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="run-skew-")
    spark = (
        SparkSession.builder.master("local[8]").appName("firmlens-skew")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", scratch)
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    for view in ("etablissements", "donnees_financieres"):
        hot_view(spark, sf, view).repartition(16).write.parquet(f"{scratch}/{view}")
    etab = spark.read.parquet(f"{scratch}/etablissements")
    fin = spark.read.parquet(f"{scratch}/donnees_financieres")
    place = "libellecommuneetablissement"

    naive = (etab.where(F.col(place).isNotNull()).select(place, "siren")
             .join(fin.select("siren", "chiffre_d_affaires"), "siren", "left")
             .groupBy(place).agg(F.sum(F.col("chiffre_d_affaires").cast("decimal(18,2)")).alias("ca")))
    pre = revenue_by_group(etab, fin, place)
    pairs = (etab.groupBy("siren").count().withColumnRenamed("count", "ne")
             .join(fin.groupBy("siren").count().withColumnRenamed("count", "nf"), "siren")
             .agg(F.sum(F.col("ne") * F.col("nf"))).first()[0])
    sc = spark.sparkContext
    results = {}
    for name, df in (("row-level join then sum", naive), ("revenue_by_group", pre)):
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        results[name] = sorted(tuple(r) for r in df.collect())
        print(f"{name:26s} {time.perf_counter() - t0:6.2f} s")
    spark.stop()
    same = [(p, float(v) if v is not None else 0.0) for p, v in results["row-level join then sum"]] == \
        [(p, v) for p, v in results["revenue_by_group"]]
    print(f"rows entering the row-level join output: {pairs:,} (hot unit: a third of both tables); "
          f"same totals: {same}")

    tasks: dict[str, list[int]] = {}
    stage_group: dict[int, str] = {}
    for path in glob.glob(f"{scratch}/**/*", recursive=True):
        if os.path.isdir(path) or "eventlog" not in path or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif ev.get("Event") == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    g = stage_group.get(ev["Stage ID"])
                    if g:
                        tasks.setdefault(g, []).append(info["Finish Time"] - info["Launch Time"])
    for g, d in tasks.items():
        print(f"{g:26s} tasks={len(d):4d} median={statistics.median(d):6.0f} ms  slowest={max(d):6.0f} ms")


if __name__ == "__main__":
    main()
