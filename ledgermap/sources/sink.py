"""Writing import files and mapping sheets as text."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgermap.sources.workspace import clear


def text_form(df: DataFrame) -> DataFrame:
    """Every column as text: NULL is blank, other values their exact text."""
    return df.select(*[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")).alias(n) for n in df.columns])


def write_import(
    df: DataFrame, header: Sequence[str], path: str, order_by: Sequence[str] = (), helpers: Sequence[str] = ()
) -> int:
    """Write one dataset as CSV files under ``path`` with the verbatim header; returns the row count.

    The rows are counted during the write. ``order_by`` sorts across the files in name order;
    the ``helpers`` among its columns are not written.
    """
    ordered = df.orderBy(*[F.col(n).asc_nulls_first() for n in order_by]) if order_by else df
    seen = Observation()
    rows = text_form(ordered.drop(*helpers)).observe(seen, F.count(F.lit(1)).alias("rows")).toDF(*header)
    exact = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
    rows.write.mode("overwrite").options(header=True, escape='"', **exact).csv(path)
    return seen.get["rows"]


@dataclass(frozen=True)
class Outcome:
    name: str
    rows: int | None = None
    error: str | None = None


@dataclass(frozen=True)
class ImportJob:
    """A builder, the function from its columns to the header, and how to sort; ``_sort…`` columns sort too."""

    build: Callable[[], DataFrame]
    header: Callable[[Sequence[str]], Sequence[str]]
    order_by: Sequence[str] = ()
    helpers: Sequence[str] = ()


def _write(job: ImportJob, path: str) -> int:
    df = job.build()
    own = [n for n in df.columns if n.startswith("_sort")]
    helpers = [*own, *job.helpers]
    header = job.header([n for n in df.columns if n not in helpers])
    return write_import(df, header, path, [*own, *job.order_by], helpers)


def generate_imports(jobs: Mapping[str, ImportJob], out_dir: str) -> list[Outcome]:
    """Write every dataset in name order; one that fails does not stop the rest."""
    done = []
    for name in sorted(jobs):
        try:
            done.append(Outcome(name, rows=_write(jobs[name], f"{out_dir}/{name}")))
        except Exception as problem:  # reported per dataset, like a failed file
            done.append(Outcome(name, error=str(problem)))
        finally:
            if session := SparkSession.getActiveSession():
                clear(session)
    return done
