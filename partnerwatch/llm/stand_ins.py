"""Stand-in inputs of two queries: the given tables, damaged by fixed rules. Only
rows in the schema that the operators expect; none of their work is done here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def _crc(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def with_repeating_tails(docs: DataFrame) -> DataFrame:
    """``docs``; where h = crc32(doc_id) is divisible by 10, the words from place
    (h / 10) % n on repeat the first of them. Rows without doc_id stay as they are."""
    h = _crc(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (F.floor((n - a) / (F.lit(3) + g % 8)) + 1).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    repeated = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return docs.withColumn("text", F.when((h % 10 == 0) & F.col("text").rlike(WORD), repeated).otherwise(F.col("text")))


def damaged_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text; by crc32(``conv_id:turn``) % 20 a row is dropped
    (0), loses its text (1) or its sentence marks (2), stands twice (3) or gets
    the role user (4). Null roles, texts and parts of the key are one space."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = _crc(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(told("text"), "[.!?]", "")).otherwise(told("text"))
    role = F.when(fate == 4, "user").otherwise(told("role"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(fate == 3, 2).otherwise(1).alias("__copies"), fate.alias("__fate"))
    rows = rows.where("__fate <> 0").withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies"))))
    return rows.select("conv_id", "turn", "role", "text")
