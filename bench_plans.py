"""Compare ways to plan the same work, at ``BENCH_SF_DIR``; prints a table.

Each pair gives the same rows: one scan per check against one pass per table,
one query per component against one grouped sum, decimal sums against
fixed-point sums, and lambdas against compiled expressions over arrays.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bench import session
from samples.derived import SampleTables
from sparkchecks import column_check_items, column_items
from sparkchecks.functions.exact import exact_sums
from sparkchecks.functions.measures import not_a_number
from sparkchecks.operators.groups import refinement_items


def best(run: Callable[[], object], times: int = 3) -> float:
    seconds = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return min(seconds)


def ran(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def copies(n: int) -> Column:
    return F.explode(F.sequence(F.lit(1), F.lit(n))).alias("copy")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    tables = SampleTables(spark, sf_dir)
    lines = tables.table("lineitem")

    checks = column_items("n", "null", [{"table": "lineitem", "column": c} for c in lines.columns])
    alone = [column_check_items(tables, [item]) for item in checks]
    together = column_check_items(tables, checks)

    carriers = [r[0] for r in tables.table("generator").select("carrier").distinct().collect()]
    generator = tables.table("generator")
    single = [
        generator.filter(F.col("carrier") == c).agg(F.sum(F.col("p_nom").cast("decimal(28,10)")))
        for c in carriers
    ]
    grouped = exact_sums(generator, ["carrier"], {"total": F.col("p_nom")})

    # The same rows several times over, for costs per row rather than per job.
    many = lines.select("l_returnflag", "l_extendedprice", copies(40))
    keys = many.groupBy("l_returnflag")
    decimal = keys.agg(F.sum(F.col("l_extendedprice").cast("decimal(28,10)")))
    fixed = exact_sums(many, ["l_returnflag"], {"total": F.col("l_extendedprice")})
    plain = keys.agg(F.sum("l_extendedprice"))

    vectors = tables.table("embeddings").select("embedding", copies(400))
    array = vectors.schema["embedding"].dataType
    infinity = float("inf")
    by_lambda = vectors.agg(
        F.count_if(F.exists("embedding", lambda v: F.isnan(v) | (F.abs(v) == infinity)))
    )
    compiled = vectors.agg(F.count_if(not_a_number(F.col("embedding"), array)))
    folded = vectors.agg(
        F.sum(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0))))
    )
    exploded = vectors.select(F.explode("embedding").alias("v")).agg(F.sum("v"))

    refined = tables.table("refined")
    nested = (
        refined.groupBy("nuts3", "characteristics_code", "cell_id")
        .agg(F.sum("hh_10types").alias("r"), F.sum_distinct("hh_5types").alias("c"))
        .groupBy("nuts3", "characteristics_code")
        .agg(F.sum("r"), F.sum("c"))
    )
    one_shuffle = refinement_items(
        refined, "r", 1e-5, "nuts3", "characteristics_code", "cell_id", "hh_5types", "hh_10types"
    )

    measured = [
        ("null checks of 11 columns, one query each", lambda: [ran(df) for df in alone]),
        ("null checks of 11 columns, one pass", lambda: ran(together)),
        (f"totals of {len(carriers)} carriers, one query each", lambda: [ran(df) for df in single]),
        (f"totals of {len(carriers)} carriers, one grouped sum", lambda: ran(grouped)),
        ("decimal sum, 40 x lineitem", lambda: ran(decimal)),
        ("fixed-point sum, 40 x lineitem", lambda: ran(fixed)),
        ("plain double sum, 40 x lineitem", lambda: ran(plain)),
        ("NaN in arrays by lambda, 400 x embeddings", lambda: ran(by_lambda)),
        ("NaN in arrays compiled, 400 x embeddings", lambda: ran(compiled)),
        ("array totals by lambda, 400 x embeddings", lambda: ran(folded)),
        ("array totals exploded, 400 x embeddings", lambda: ran(exploded)),
        ("refinement with sum(DISTINCT)", lambda: ran(nested)),
        ("refinement over distinct rows", lambda: ran(one_shuffle)),
    ]
    print(f"| {os.path.basename(sf_dir)} | seconds |\n|---|---|")
    for name, run in measured:
        print(f"| {name} | {best(run):.2f} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
