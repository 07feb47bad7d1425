"""Tables written under a contract: every row once, counts seen in passing."""

import pytest
from pyspark.sql import functions as F

from veloflow.operators.contracts import Contract, Rule, check_contract
from veloflow.sources.checked import write_checked

PROBE = Contract(
    "probe",
    (Rule("k", "string", unique=True), Rule("v", "bigint", nullable=True, at_least=0, at_most=9), Rule("w", "double", optional=True)),
)
SCHEMA = "k string, v string, extra int"
ROWS = [("a", "1", 1), ("b", "x", 2), ("c", "-1", 3), ("d", None, 4), ("e", "3.0", 5), (None, "2", 6), (None, "99", 7), ("f", "4", 8), ("f", "5", 8), ("f", "nope", 9)]


def slow(rows):
    keys = [k for k, *_ in rows]
    out = []
    for k, v, _ in rows:
        bad = []
        if k is None:
            bad.append("k:not_null")
        try:
            n = None if v is None else float(v)
            bad += ["v:at_least_0"] * (n is not None and n < 0) + ["v:at_most_9"] * (n is not None and n > 9)
        except ValueError:
            bad.append("v:type")
        if k is not None and keys.count(k) > 1:
            bad.append("k:unique")
        out.append(bad)
    return out


def test_every_row_is_kept_or_set_aside_with_its_rules(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    got = write_checked(df, PROBE, str(tmp_path / "t"))
    want = slow(ROWS)
    assert (got.n_rows, got.n_kept, got.n_aside) == (len(ROWS), want.count([]), len(ROWS) - want.count([]))
    order = lambda rows: sorted(rows, key=repr)
    assert got.kept().columns == df.columns
    assert order(map(tuple, got.kept().collect())) == order(r for r, bad in zip(ROWS, want) if not bad)
    aside = [(r["k"], r["v"], r["extra"], sorted(r["failed_rules"])) for r in got.aside().collect()]
    assert order(aside) == order((*r, sorted(bad)) for r, bad in zip(ROWS, want) if bad)
    names = [n for bad in want for n in bad]
    assert got.failed == {n: names.count(n) for n in names}
    # the same numbers as the separate check
    assert {f"{r['column']}:{r['rule']}": r["n_failed"] for r in check_contract(df.where("k is not null"), PROBE).collect()}["k:unique"] == got.failed["k:unique"]


def test_no_rows(spark, tmp_path):
    got = write_checked(spark.createDataFrame([], SCHEMA), PROBE, str(tmp_path / "t"))
    assert (got.n_rows, got.n_kept, got.n_aside, got.failed) == (0, 0, 0, {})
    assert got.kept().count() == 0 and got.aside().count() == 0 and got.kept().columns == ["k", "v", "extra"]


def test_all_bad_and_all_good(spark, tmp_path):
    for i, (v, kept) in enumerate((("100", 0), ("1", 50))):
        df = spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit(v).alias("v"))
        got = write_checked(df, PROBE, str(tmp_path / f"t{i}"))
        assert (got.n_kept, got.kept().count(), got.aside().count()) == (kept, kept, 50 - kept)


def test_refused_tables(spark, tmp_path):
    for columns in ("k string", "k string, v string, accepted int", "k string, v string, failed_rules int"):
        with pytest.raises(ValueError, match="Contract probe"):
            write_checked(spark.createDataFrame([], columns), PROBE, str(tmp_path / "t"))


def test_counts_come_with_one_execution_of_the_rows(spark, tmp_path):
    """Without unique rules each row is computed once: an accumulator sees every row a single time."""
    seen = spark.sparkContext.accumulator(0)
    plain = Contract("plain", (Rule("v", "bigint", at_least=10),))

    def watched(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(0, 1000, 1, 7).select(F.col("id").alias("v")).mapInPandas(watched, "v long")
    got = write_checked(df, plain, str(tmp_path / "t"))
    assert (got.n_rows, got.n_aside, seen.value) == (1000, 10, 1000)
