"""Mix sources to target weights: hash-random order within each source, prefix sums of sizes, a cut at the exact budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veloflow.llm.common import fresh, parts_for, ranked, written
from veloflow.llm.quality import words_of

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
#: Rows of a source that one task sorts, about.
PART_ROWS = 10_000

#: Sources are numbered in one task and broadcast up to this number (about 100 bytes each); beyond it they are numbered in
#: ranges and joined.
FEW_SOURCES = 20_000


def random_key(*columns: str) -> Column:
    """Hash-random key, the same in every run."""
    return F.md5(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns)))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS) -> DataFrame:
    """Adds ``weight``, ``target`` (words, double) and ``budget`` (whole words) to (source, source_size).

    Sources in code point order, null last, weigh 1, 2, 3, repeating. Together they get what they have; a target above
    ``most`` times its source's size stops there and the excess goes to the others by weight, until none is above. Each
    round is one sum over the open sources, and closes at least one or is the last.
    """
    row = fresh(sources, "row_no")
    parts = parts_for(sources.count(), FEW_SOURCES)
    order = F.col("source").asc_nulls_last()
    if parts == 1:
        numbered = sources.withColumn(row, F.row_number().over(Window.orderBy(order)) - 1)
    else:  # cut into ranges at sources picked by hash, and number the ranges by prefix sums
        cuts = [r[0] for r in sources.filter("source IS NOT NULL").orderBy(F.xxhash64("source")).limit(parts).select("source").collect()]
        part = F.when(F.col("source").isNull(), F.lit(len(cuts))).otherwise(sum((F.col("source") > F.lit(c)).cast("int") for c in cuts))
        numbered = ranked(sources, [], [order], part, row)
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col(row) % len(weights) + 1).cast("int"))
    weighed = written(numbered.withColumn("weight", weight.cast("long")).drop(row), "sources")
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("s")).first()["s"]
    rate_top, rate_bottom = total, weighed.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()["w"]
    cap = F.col("source_size") * most
    while True:
        # a source is closed where weight * rate reaches its cap; compared in whole numbers
        closed = F.col("weight").cast("decimal(38,0)") * F.lit(rate_top).cast("decimal(19,0)") > cap.cast("decimal(38,0)") * F.lit(rate_bottom).cast("decimal(19,0)")
        now = weighed.agg(
            F.coalesce(F.sum(F.when(closed, cap)), F.lit(0)).alias("capped"), F.coalesce(F.sum(F.when(~closed, F.col("weight"))), F.lit(0)).alias("open")
        ).first()
        if (total - now["capped"], now["open"]) == (rate_top, rate_bottom) or now["open"] == 0:
            break
        rate_top, rate_bottom = total - now["capped"], now["open"]
    share = F.col("weight").cast("double") * F.lit(float(rate_top)) / F.lit(float(rate_bottom or 1))
    target = F.when(closed, cap.cast("double")).otherwise(share)
    return weighed.withColumn("target", target).withColumn("budget", F.floor("target").cast("long"))


def _shares(docs: DataFrame, keys: list[Column], weights: tuple[int, ...], most: int) -> DataFrame:
    """``keys``, size, source_size, target and taken of each row."""
    names = [f"key{i}" for i in range(len(keys))]
    words = F.size(words_of(F.col("text"))).cast("long")
    sized = written(docs.select(*(k.alias(n) for k, n in zip(keys, names, strict=True)), F.col("source").alias("source"), words.alias("size"), random_key("doc_id").alias("turn")), "sizes")
    aimed = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")), weights, most)
    few = aimed.count() <= FEW_SOURCES
    aimed = aimed.withColumnRenamed("source", "s")
    # a source's parts are ranges of the random key, as many as its rows ask for; prefix sums run over parts, then within
    span = 16**6
    place = F.conv(F.substring("turn", 1, 6), 16, 10).cast("long")
    parts = F.greatest(F.ceil(F.col("source_rows") / PART_ROWS), F.lit(1))
    cut = sized.join(F.broadcast(aimed) if few else aimed, F.col("source").eqNullSafe(F.col("s"))).withColumn("part", F.floor(place * parts / F.lit(span)).cast("long"))
    sums = cut.groupBy(F.col("source").alias("_s"), F.col("part").alias("_p")).agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("_s").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_s", "_p", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "part").orderBy("turn", *names, "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("part") == F.col("_p")))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("budget") - rounds * F.col("source_size")
    partial = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before") - F.col("inner")))
    return placed.select(*names, "size", "source_size", "target", (rounds * F.col("size") + partial).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) of each document.

    Within a source, documents stand in the order of hash-random keys. The budget is as many whole rounds through the
    source as fit, and what is left is cut off the front of the order, at the exact word: the document at the cut gives
    its first words only. Reruns agree; equal rows are interchangeable. A null text has no words and takes none; a null
    source is a source of its own; an empty table gives no rows. Other columns are ignored.
    """
    return _shares(docs, [F.col("doc_id")], weights, most).withColumnRenamed("key0", "doc_id")


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS) -> DataFrame:
    """The mix as rows with all columns of ``docs``: a document comes once for each round that takes it.

    Texts stay whole: of the document at a source's cut all is taken when at least half of it lies before the cut. Documents
    without words are in no mix. What equal rows take together is dealt evenly among them.
    """
    text_hash = F.xxhash64("text")
    hashed, same_id, same_hash, times, rows, turn = (fresh(docs, name) for name in ("text_hash", "mixed_id", "mixed_hash", "mixed_times", "mixed_rows", "mixed_turn"))
    shares = _shares(docs, [F.col("doc_id"), text_hash], weights, most).filter("size > 0")
    copies = shares.groupBy(F.col("key0").alias(same_id), F.col("key1").alias(same_hash)).agg(
        F.sum(F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size")))).cast("int").alias(times), F.count(F.lit(1)).cast("int").alias(rows)
    )
    joined = docs.withColumn(hashed, text_hash).join(copies.filter(F.col(times) > 0), F.col("doc_id").eqNullSafe(F.col(same_id)) & (F.col(hashed) == F.col(same_hash)))
    numbered = joined.withColumn(turn, F.row_number().over(Window.partitionBy(same_id, same_hash).orderBy(F.lit(1))))
    own = F.floor(F.col(times) / F.col(rows)).cast("int") + (F.col(turn) <= F.col(times) % F.col(rows)).cast("int")
    return numbered.withColumn(turn, F.explode(F.array_repeat(F.lit(1), own))).select(*docs.columns)
