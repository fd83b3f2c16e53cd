"""Compare ways to write the same step, on the tables in ``BENCH_SF_DIR``.

Prints one JSON line with the seconds of the plain form and of the form the
library uses. Files go to fresh paths in the session's scratch folder.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epilake.operators.aggregate import one_outcome, outcome_counts, zero_count
from epilake.operators.latest import latest_per_key
from epilake.session import local_session, scratch_path
from epilake.sinks.files import write_rows
from epilake.sources.dialect import STAGED


def sink(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def csv_out(spark: SparkSession, df: DataFrame) -> str:
    path = scratch_path(spark, "shape")
    write_rows(df, path, "csv", STAGED)
    return path


def shapes(spark: SparkSession, sf_dir: str) -> dict[str, tuple]:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_suppkey", "l_discount", "l_returnflag", "l_linestatus"
    )
    keys = ["o_orderpriority", "mes"]
    patients = orders.select(
        "o_orderpriority",
        F.month("o_orderdate").alias("mes"),
        (F.col("o_orderstatus") == "F").alias("obito"),
    )
    landed = spark.read.schema(patients.schema).options(**STAGED.read_options())
    landed = landed.csv(csv_out(spark, patients))
    source = csv_out(spark, lines)
    scan = spark.read.schema(lines.schema).options(**STAGED.read_options()).csv(source)
    clean = scan.filter(F.col("l_returnflag") != "A")
    newest = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))

    def summaries(rows: DataFrame) -> None:
        sink(rows.select("l_suppkey", "l_returnflag").distinct())
        sink(zero_count(rows, ["l_suppkey"], "l_discount", "n"))

    def source_three_times() -> None:
        csv_out(spark, clean)
        summaries(clean)

    def source_once() -> None:
        path = scratch_path(spark, "shape")
        write_rows(clean, path, "parquet", STAGED)
        summaries(spark.read.parquet(path))

    def two_aggregates(rows: DataFrame) -> None:
        for outcome in (True, False):
            sink(rows.filter(F.col("obito") == outcome).groupBy(*keys).count().sort(F.desc("mes")))

    def one_aggregate(rows: DataFrame) -> None:
        both = outcome_counts(rows, "obito", keys, "t", "f").persist()
        sink(one_outcome(both, keys, "t", "mes"))
        sink(one_outcome(both, keys, "f", "mes"))
        both.unpersist()

    return {
        "write": (lambda: csv_out(spark, orders.coalesce(1)), lambda: csv_out(spark, orders)),
        "outcomes_parquet": (lambda: two_aggregates(patients), lambda: one_aggregate(patients)),
        "outcomes_text": (lambda: two_aggregates(landed), lambda: one_aggregate(landed)),
        "summaries": (source_three_times, source_once),
        "latest": (
            lambda: sink(events.withColumn("r", F.row_number().over(newest)).filter("r = 1").drop("r")),
            lambda: sink(latest_per_key(events, ["user_id"], "ts", ["event_id"])),
        ),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE", "8")))
    spark.sparkContext.setLogLevel("OFF")
    result = {}
    for name, forms in shapes(spark, sf_dir).items():
        result[name] = {}
        for label, run in zip(("plain", "ours"), forms):
            run()
            start = time.perf_counter()
            run()
            result[name][label] = round(time.perf_counter() - start, 2)
    spark.stop()
    print(json.dumps({"data": sf_dir, "cpus": cpus, "seconds": result}))


if __name__ == "__main__":
    main()
