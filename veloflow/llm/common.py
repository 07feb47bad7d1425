"""Helpers shared by the corpus operators: tables in the shared folder, ranks without a global window, word patterns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veloflow.session import local_folder

#: Words are runs of everything but these white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset (tests, a local master), a folder made once per session and set as such."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.veloflow.llm.dir", None)
    if folder is None:
        context_dir = spark.sparkContext.getCheckpointDir()
        folder = context_dir or local_folder(spark, "veloflow-shared-")
        spark.conf.set("spark.veloflow.llm.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared folder and read it back.

    Lost executors do not lose such a table, unlike cached blocks. Files stay as long as the folder does.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where the frame already has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def parts_for(rows: int, per_part: int) -> int:
    """Number of parts, a power of two, so that each holds about ``per_part`` rows."""
    parts = 1
    while parts * per_part < rows:
        parts *= 2
    return parts


def ranked(df: DataFrame, group: list[str], order: list[Column], part: Column, rank: str) -> DataFrame:
    """Rank from 0 within each group, without gathering a group in one task.

    ``part`` is a deterministic number that cuts a group into parts; ranks run through the parts in their order. Each part
    is numbered by itself, and offsets are prefix sums over (group, part) counts. A group holds as many rows in a task as
    its largest part. Nulls in the group columns count as equal.
    """
    p, below = fresh(df, "part_no"), fresh(df, "rows_below")
    keyed = df.withColumn(p, part)
    counts = keyed.groupBy(*group, p).agg(F.count(F.lit(1)).alias(below))
    before = Window.partitionBy(*group).orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(below, F.coalesce(F.sum(below).over(before), F.lit(0)))
    numbered = keyed.withColumn(rank, F.row_number().over(Window.partitionBy(*group, p).orderBy(*order)) - 1)
    right = offsets.select(*(F.col(c).alias(f"{below}_{i}") for i, c in enumerate([*group, p])), below)
    same = F.lit(True)
    for i, c in enumerate([*group, p]):
        same = same & F.col(c).eqNullSafe(F.col(f"{below}_{i}"))
    joined = numbered.join(right, same, "left").withColumn(rank, F.col(rank) + F.col(below))
    return joined.drop(p, below, *(f"{below}_{i}" for i in range(len(group) + 1)))
