"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) choose data and cores. Each
query runs once to warm up and then ``BENCH_RUNS`` times (default 2) with an empty cache; the best run counts and
includes building the plan. ``segment_long_per_segment`` is the same result written as one grouped query per
segment and book, for comparison; it is not part of the total. The query texts are written as a table of several files
first, as a corpus would be given; deriving them from orders, which has one row group, would run on one core and is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from saldoflow.checks import shapes
from saldoflow.checks.queries import QUERIES, report_for
from saldoflow.operators import corpus
from saldoflow.operators.segments import SEGMENTS, WEEKEND_LABELS
from saldoflow.session import local_session

HEADLINE = (
    "final_report_multi_cut",
    "segment_long",
    "control_totals",
    "bucket_calendar_multi_cut",
    "audited_totals",
    "corpus_dominant_date",
    "corpus_parameterised",
    "corpus_lineage",
)


def segment_long_per_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    report_for(spark, sf_dir).buckets.createOrReplaceTempView("bench_buckets")
    for name, book in shapes.books(shapes.Tables(spark, sf_dir)).items():
        book.createOrReplaceTempView(f"bench_{name}")
    branches = [
        f"""SELECT fecha_corte, '{name}' AS libro, '08' AS uc, '{code}' AS sub, columna,
                   SUM(COALESCE({measure}, 0){f' - COALESCE({minus}, 0)' if minus else ''}) AS valor
            FROM bench_{name} a JOIN bench_buckets b ON CAST(a.fecha AS DATE) = b.fecha
            WHERE columna <= 5 AND proyeccion NOT IN {WEEKEND_LABELS} GROUP BY fecha_corte, columna"""
        for name in ("TRAD", "PIB")
        for code, measure, minus in SEGMENTS
    ]
    return spark.sql(" UNION ALL ".join(branches))


CORPUS = {
    "corpus_dominant_date": corpus.dominant_dates,
    "corpus_parameterised": corpus.parameterise,
    "corpus_lineage": corpus.lineage,
}


def over_written_corpus(spark: SparkSession, sf_dir: str, files: int) -> dict:
    """The corpus queries over the query texts as a table of their own."""
    path = f"{tempfile.mkdtemp(prefix='saldoflow-bench-')}/corpus"
    shapes.corpus(shapes.Tables(spark, sf_dir)).repartition(files).write.parquet(path)
    return {name: (lambda spark, sf_dir, op=op: op(spark.read.parquet(path))) for name, op in CORPUS.items()}


def timed(spark: SparkSession, build, sf_dir: str) -> float:
    spark.catalog.clearCache()
    started = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session("saldoflow-bench", cpus=cpus, shuffle_partitions=int(cpus))
    builds = {name: QUERIES[name] for name in HEADLINE} | over_written_corpus(spark, sf_dir, 2 * int(cpus))
    builds["segment_long_per_segment"] = segment_long_per_segment
    seconds = {}
    for name, build in builds.items():
        timed(spark, build, sf_dir)
        seconds[name] = round(min(timed(spark, build, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds[name] for name in HEADLINE), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cpus": cpus,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
