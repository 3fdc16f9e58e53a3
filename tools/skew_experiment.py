"""Hot-key experiment: one key holds a third of all rows.

    python tools/skew_experiment.py [--copies N] [--sf-dir DIR]

Builds a skewed table from lineitem (each row repeated N times via
``explode(sequence)``; every third order's rows all get key 0) and times the
package's operators against the plain window formulations:

* keep-latest: ``max(row struct)`` partial aggregate vs ``row_number`` window;
* next row per key: bucketed ``next_in_sequence`` vs ``lead`` over the key.

Each variant runs to completion into the ``noop`` sink; the results are
also checked for equality.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--copies", type=int, default=10)
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    a = ap.parse_args(argv)
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from strata.operators import silver
    from strata.operators.sequence import next_in_sequence
    from strata.session import cut_lineage, local_session

    spark = local_session(8, shuffle_partitions=32)
    li = spark.read.parquet(f"{a.sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice")
    rep = li.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(a.copies - 1))))
    hot = F.col("l_orderkey") % 3 == 0
    df = rep.select(
        F.when(hot, F.lit(0)).otherwise(F.col("l_orderkey") * 1000 + F.col("rep")).alias("k"),
        (F.col("l_shipdate") + F.make_dt_interval(days=F.col("rep"))).alias("ts"),
        (F.col("l_orderkey") * 100000 + F.col("l_linenumber") * 1000 + F.col("rep")).alias("uid"),
        "l_quantity", "l_extendedprice")
    df = cut_lineage(df.repartition(32))
    n = df.count()
    hot_n = df.filter("k = 0").count()
    print(f"rows {n}, hot key rows {hot_n} ({hot_n / n:.0%})")

    def run(name, d):
        t = time.perf_counter()
        d.write.format("noop").mode("overwrite").save()
        s = time.perf_counter() - t
        print(f"{name:40s} {s:7.2f} s")
        return s

    w_latest = Window.partitionBy("k").orderBy(*[F.col(c).desc() for c in
                                                 ("ts", "uid", "l_quantity", "l_extendedprice")])
    a1 = silver.keep_latest(df, "k", ["ts"])
    b1 = df.withColumn("rn", F.row_number().over(w_latest)).filter("rn = 1").drop("rn")
    for _ in range(2):
        run("keep_latest: max(row struct)", a1)
        run("keep_latest: row_number window", b1)
    assert a1.exceptAll(b1).isEmpty() and b1.exceptAll(a1).isEmpty()

    t0 = time.perf_counter()
    a2 = next_in_sequence(df, ["k"], "ts", ["uid"], out_col="nxt", bucket="day")
    print(f"{'next row: hot-key detection (plan build)':40s} {time.perf_counter() - t0:7.2f} s")
    c2 = next_in_sequence(df, ["k"], "ts", ["uid"], out_col="nxt", bucket="day", hot_rows=None)
    b2 = df.withColumn("nxt", F.lead("ts").over(Window.partitionBy("k").orderBy("ts", "uid")))
    for _ in range(2):
        run("next row: hot keys bucketed, rest plain", a2)
        run("next row: every key bucketed", c2)
        run("next row: lead over key", b2)
    assert a2.select("uid", "nxt").exceptAll(b2.select("uid", "nxt")).isEmpty()
    assert c2.select("uid", "nxt").exceptAll(b2.select("uid", "nxt")).isEmpty()
    print("results equal")


if __name__ == "__main__":
    main()
