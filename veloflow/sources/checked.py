"""Writing a table under a contract in one execution: good rows, rows set aside with the rules they break, and all counts.

The counts are observed in the last stage, on the way to the files. There each partition's numbers arrive once, with the commit
of its task, so they hold when executors are lost and work is done again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators.contracts import Contract, failed_rules, get_contract, rule_names

RULES, ACCEPTED = "failed_rules", "accepted"


@dataclass(frozen=True)
class CheckedTable:
    """What was written. ``failed`` holds the rows that break each rule of the contract, by ``column:rule``."""

    spark: SparkSession
    path: str
    schema: T.StructType
    n_rows: int
    n_kept: int
    n_aside: int
    failed: dict[str, int]

    def _read(self) -> DataFrame:
        # with a stated schema a table without rows can be read too
        stored = T.StructType([*self.schema.fields, T.StructField(RULES, T.ArrayType(T.StringType())), T.StructField(ACCEPTED, T.BooleanType())])
        return self.spark.read.schema(stored).parquet(self.path)

    def kept(self) -> DataFrame:
        """Rows that keep all rules, with the columns of the table; the others' files are not read."""
        return self._read().where(F.col(ACCEPTED)).drop(RULES, ACCEPTED)

    def aside(self) -> DataFrame:
        """Rows that break a rule, with the list of those rules in ``failed_rules``."""
        return self._read().where(~F.col(ACCEPTED)).drop(ACCEPTED)


def _repeated(df: DataFrame, contract: Contract) -> tuple[DataFrame, list[Column]]:
    """Marks rows whose key comes more than once. Keys are counted before they meet the rows, so a hot key is one row there."""
    marks = []
    for i, rule in enumerate(r for r in contract.rules if r.unique and r.column in df.columns):
        key, mark = F.col(f"`{rule.column}`").cast("string"), f"_repeated{i}"
        often = df.groupBy(key.alias(f"_key{i}")).agg(F.count("*").alias("_n")).where((F.col("_n") > 1) & F.col(f"_key{i}").isNotNull())
        df = df.join(often.select(f"_key{i}", F.lit(True).alias(mark)), key == F.col(f"_key{i}"), "left").drop(f"_key{i}")
        marks.append(F.when(F.col(mark), F.lit(f"{rule.column}:unique")))
    return df, marks


def write_checked(df: DataFrame, contract: Contract | str, path: str) -> CheckedTable:
    """Write all rows of a table, those that break a rule apart from the others.

    Every row is written once and comes back from either ``kept`` or ``aside``, so their numbers add up to the rows given.
    A missing key counts under its own rule and is never a repeated one; of a repeated key all rows are set aside. A table
    without rows gives two without rows. Columns beyond the contract are written as they are; a table that lacks a required
    column, or has one of the two added names, is refused. Only unique rules shuffle rows.
    """
    spec = get_contract(contract) if isinstance(contract, str) else contract
    lacking = [r.column for r in spec.rules if not r.optional and r.column not in df.columns]
    clashing = [c for c in (RULES, ACCEPTED) if c in df.columns]
    if lacking or clashing:
        raise ValueError(f"Contract {spec.name}: columns lacking {lacking}, names taken {clashing}")
    names = rule_names(spec, df.columns)
    marked, repeated = _repeated(df, spec)
    rules = F.array_compact(F.array(*failed_rules(spec, df.columns), *repeated)).cast("array<string>")
    out = marked.withColumn(RULES, rules).select(*[F.col(f"`{c}`") for c in df.columns], RULES)
    good = F.size(RULES) == 0
    seen = Observation()
    counts = [F.count_if(F.array_contains(RULES, n)).alias(f"r{i}") for i, n in enumerate(names)]
    watched = out.withColumn(ACCEPTED, good).observe(seen, F.count("*").alias("n"), F.count_if(F.col(ACCEPTED)).alias("kept"), *counts)
    watched.write.mode("overwrite").partitionBy(ACCEPTED).parquet(path)
    got = seen.get
    failed = {n: got[f"r{i}"] for i, n in enumerate(names) if got[f"r{i}"]}
    return CheckedTable(df.sparkSession, path, df.schema, got["n"], got["kept"], got["n"] - got["kept"], failed)
