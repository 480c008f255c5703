"""Mixing sources to target weights.

The words of each source are summed, a target is set for each source, and the
source's repetition rate is its target over its size. Each document is emitted
floor(rate) times, plus one more copy if a coin falls below the fraction of the
rate. The coin is a hash of the seed, the doc_id, the text and, among rows equal
in both, the row's number, so equal rows have coins of their own.

Targets: sources in code point order (null last) take the weights in turn and
share the whole size by weight. A target stops at ``max_rate`` times its
source's size; what is cut off is shared again by weight among the others until
none is above. The level at which the sharing stops is found by sums over the table
of sources, which is written once; a few sums a round reach the driver, and a
round stops one source at least.

Equal rows are numbered by the tasks that write them, and a table of their
counts (equal rows, task) gives each task's first number, so a row that a third
of the table repeats is numbered in as many tasks as write it.

Defined results: a null or empty text has size 0 and adds nothing; a source
without words has target 0 and rate 0; a null source is a source of its own.
Rows that repeat a doc_id have coins of their own, and so have rows without one;
ties do not arise, as a coin is only compared with a rate. A text of any length
is one document. An empty table gives an empty result. Further columns, also such named like a
result column, are passed on by ``mix`` and left out by ``mix_plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerwatch.llm.common import WORD_SPACE, free_prefix, global_position, row_number_columns, shared_table

WEIGHTS = (1, 2, 3)
MAX_RATE = 3
SEED = "mix-2"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text``."""
    return F.coalesce(F.size(F.filter(F.split(text, WORD_SPACE), lambda w: w != "")), F.lit(0)).cast("long")


def coin(doc_id: Column, text_key: Column, number: Column, seed: str = SEED) -> Column:
    """Uniform in [0, 1) from a hash of the seed, the document and its number among equal rows."""
    own = [F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), text_key, number.cast("string")]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *own)), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _numbered(rows: DataFrame, doc_id: str, key: str, number: str, name: str) -> DataFrame:
    """``rows`` with ``number``: from 1, among the rows equal in ``doc_id`` and ``key``."""
    part, row = row_number_columns()
    p = free_prefix(rows)
    placed = shared_table(rows.withColumns({f"{p}part": part, f"{p}row": row}), name)
    held = placed.groupBy(doc_id, key, f"{p}part").agg(F.count("*").alias(f"{p}n"))
    before = Window.partitionBy(doc_id, key).orderBy(f"{p}part").rowsBetween(Window.unboundedPreceding, -1)
    first = held.select(F.col(doc_id).alias(f"{p}id"), F.col(key).alias(f"{p}key"), F.col(f"{p}part").alias(f"{p}at"), F.coalesce(F.sum(f"{p}n").over(before), F.lit(0)).alias(f"{p}before"))
    within = F.row_number().over(Window.partitionBy(doc_id, key, f"{p}part").orderBy(f"{p}row"))
    met = F.col(doc_id).eqNullSafe(F.col(f"{p}id")) & (F.col(key) == F.col(f"{p}key")) & (F.col(f"{p}part") == F.col(f"{p}at"))
    counted = placed.withColumn(f"{p}within", within).join(first, met).withColumn(number, F.col(f"{p}within") + F.col(f"{p}before"))
    return counted.drop(*(f"{p}{c}" for c in ("part", "row", "id", "key", "at", "before", "within")))


def _coined(rows: DataFrame, doc_id: str, key: str, out: str, seed: str, name: str) -> DataFrame:
    """``rows`` with the coin of each; only those that equal others are numbered."""
    p = free_prefix(rows)
    repeated = rows.groupBy(F.col(doc_id).alias(f"{p}id"), F.col(key).alias(f"{p}key")).agg(F.count("*").alias(f"{p}n")).where(f"{p}n > 1").drop(f"{p}n")
    repeated = shared_table(repeated, f"{name}-repeated")
    one = lambda number: coin(F.col(doc_id), F.col(key), number, seed).alias(out)
    if repeated.isEmpty():
        return rows.select("*", one(F.lit(1)))
    met = F.col(doc_id).eqNullSafe(F.col(f"{p}id")) & (F.col(key) == F.col(f"{p}key"))
    single = rows.join(repeated, met, "left_anti").select("*", one(F.lit(1)))
    numbered = _numbered(rows.join(repeated, met, "left_semi"), doc_id, key, f"{p}number", name)
    return single.unionByName(numbered.select("*", one(F.col(f"{p}number"))).drop(f"{p}number"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """source, source_size, target of every source of (source, size) rows."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_position(sums, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = ranked.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * max_rate).alias("cap"))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:  # each round stops one source more at least, or ends
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        cut, left, now = sources.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if now == stopped or not left:
            break
        level, stopped = (total - (cut or 0)) / left, now
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def _sized(docs: DataFrame, p: str, *keep: str) -> DataFrame:
    return docs.select(*keep, F.col("doc_id").cast("string").alias(f"{p}doc"), text_key(F.col("text")).alias(f"{p}text"), word_count(F.col("text")).alias(f"{p}size"))


def _with_copies(sized: DataFrame, targets: DataFrame, max_rate: int, p: str) -> DataFrame:
    """``sized`` with the source's size and target and the copies, named with the prefix ``p``."""
    # one row a source: Spark broadcasts the table where its files are under the session's limit, else splits hot sources
    named = targets.select(*(F.col(c).alias(f"{p}{c}") for c in ("source", "source_size", "target")))
    t = shared_table(named, "mix-targets")
    size, target = F.col(f"{p}source_size"), F.col(f"{p}target")
    rate = F.least(F.when(size > 0, target / size).otherwise(0.0), F.lit(float(max_rate)))
    copies = F.floor(rate) + (F.col(f"{p}coin") < rate - F.floor(rate)).cast("long")
    return sized.join(t, F.col("source").eqNullSafe(F.col(f"{p}source")), "left").withColumn(f"{p}copies", copies)


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies of every document. The
    texts are read once, into a narrow table in the shared folder."""
    sized = shared_table(_sized(docs, "__", "doc_id", "source"), "mix-sizes")
    targets = source_targets(sized.select("source", F.col("__size").alias("size")), weights, max_rate)
    planned = _with_copies(_coined(sized, "__doc", "__text", "__coin", seed, "mix-equal"), targets, max_rate, "__")
    return planned.select("doc_id", "source", *(F.col(f"__{c}").alias(c) for c in ("size", "source_size", "target", "copies")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each repeated as often as it is taken."""
    p = free_prefix(docs)
    narrow = shared_table(_sized(docs, "__", "source").select("source", F.col("__size").alias("size")), "mix-sizes")
    sized = _coined(_sized(docs, p, "*"), f"{p}doc", f"{p}text", f"{p}coin", seed, "mix-equal")
    planned = _with_copies(sized, source_targets(narrow, weights, max_rate), max_rate, p)
    copies = F.explode(F.array_repeat(F.lit(0), F.col(f"{p}copies").cast("int")))
    return planned.select(*docs.columns, copies.alias(f"{p}copy")).drop(f"{p}copy")
