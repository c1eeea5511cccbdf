"""Run queries in Spark and DuckDB and compare columns, types, row counts and values."""

from __future__ import annotations

import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


_KINDS = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE", "double": "DOUBLE"}


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, build, text: str) -> list[str]:
    """Differences as text; empty when both results agree."""
    df = build(spark, sf_dir)
    want = con.sql(text)
    problems = []
    ours = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) for f in df.schema}
    theirs = dict(zip(want.columns, map(str, want.types)))
    if set(ours) != set(theirs):
        return [f"columns only in Spark {sorted(set(ours) - set(theirs))}, only in SQL {sorted(set(theirs) - set(ours))}"]
    for name, kind in ours.items():
        if kind != theirs[name]:
            problems.append(f"type of {name}: {kind} != {theirs[name]}")
    names = sorted(ours)
    quoted = ", ".join(f'"{n}"' for n in names)
    # the expected rows go to Spark as a table, and only rows that differ come to the driver
    with tempfile.TemporaryDirectory() as folder:
        con.execute(f"COPY (SELECT {quoted} FROM ({text})) TO '{folder}/expected.parquet' (FORMAT parquet)")
        right = spark.read.parquet(f"{folder}/expected.parquet")
        keys = [F.col(f"`{n}`") for n in names]
        both = (
            df.select(*names)
            .withColumn("_side", F.lit(1))
            .unionByName(right.select(*[F.col(f"`{n}`").cast(df.schema[n].dataType).alias(n) for n in names]).withColumn("_side", F.lit(-1)))
            .groupBy(*keys)
            .agg(F.sum("_side").alias("_surplus"), F.sum(F.abs("_side")).alias("_rows"))
        )
        left_over = both.filter("_surplus <> 0").orderBy(F.desc("_surplus")).limit(1000).collect()
    more = [tuple(r)[:-2] for r in left_over if r["_surplus"] > 0]
    fewer = [tuple(r)[:-2] for r in left_over if r["_surplus"] < 0]
    if left_over:
        problems.append(f"rows: {sum(r['_surplus'] for r in left_over):+d} in Spark")
        problems.append(f"values: only in Spark {more[:2]}; only in SQL {fewer[:2]}")
        if more and fewer:
            a, b = more[0], fewer[0]
            problems.append(f"first difference: {[(n, x, y) for n, x, y in zip(names, a, b) if x != y]}")
    return problems


def main(argv: list[str]) -> int:
    from checks.expected import EXPECTED
    from checks.queries import QUERIES

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    chosen = argv[2:] or sorted(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in chosen:
        start = time.time()
        try:
            problems = compare(spark, con, sf_dir, QUERIES[name], EXPECTED[name]) if name in EXPECTED else ["no SQL"]
        except Exception as error:  # a failing query is a finding, not a stop
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     ", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
