"""Exact duplicates by skew-safe combining: each task combines its own rows,
salted digest groups merge those, and the salts' winners are combined last.
The winner goes back to the salts that hold rows, so no join is dealt by the
digest alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SALTS = 32  # parts of a digest, at most 63: the parts that hold rows are the bits of a long


def _number(x: int):
    return F.lit(str(x)).cast("decimal(38,0)")


_SPAN, _LAST = 10**20, 2**63  # _SPAN is above any distance of a 64-bit id from _LAST


def _rank():
    """More code points first, then the smaller doc_id: one number, so that the
    maximum is a hash aggregate.  A null doc_id comes after every other."""
    near = F.coalesce(_number(_LAST) - F.col("doc_id").cast("decimal(20,0)"), _number(0))
    return (F.col("n_points").cast("decimal(12,0)") * F.lit(str(_SPAN)).cast("decimal(21,0)") + near).cast("decimal(38,0)")


def exact_duplicates(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of docs(doc_id, text, ...).

    Texts are equal when identical without the characters of ``[\\x20\\x09-\\x0D]``.
    Every combining step groups by the digest and the full normalised text, so
    content is compared each time: inside a task (the partial aggregate), within
    one of ``salts`` parts of a digest, and over the parts.  A task therefore
    sends one row for each different text it holds, however many copies there
    are, and no task gets more than one row a part and sender.  Two contents
    under one SHA-256 raise an error.  The row that stays is written once for
    each part of its digest that has rows, and joined by digest and part: a hot
    digest's rows meet it in ``salts`` places.  Rows that also share doc_id and
    length are one part.

    Null text counts as empty.  A null doc_id stays only where all of its
    group are null; such rows are then all kept, as are repeated rows of the
    doc_id that stays.  Other columns are ignored; an empty table gives no rows.
    """
    if not 0 < salts < 64:
        raise ValueError("salts must be 1 to 63")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("string").alias("text"))
    rows = rows.select("doc_id", F.length("text").alias("n_points"), F.regexp_replace("text", SPACE, "").alias("content"))
    rows = rows.select("doc_id", "n_points", "content", F.unhex(F.sha2("content", 256)).alias("digest"),
                       F.pmod(F.xxhash64("doc_id", "n_points"), F.lit(salts)).cast("int").alias("salt"))
    salted = rows.withColumn("rank", _rank()).groupBy("digest", "content", "salt").agg(F.max("rank").alias("rank"), F.count("*").alias("n"))
    groups = salted.groupBy("digest", "content").agg(F.max("rank").alias("rank"), F.sum("n").alias("group_size"),
                                                     F.bit_or(F.expr("shiftleft(1L, salt)")).alias("parts"))
    near = F.col("rank") % _number(_SPAN)
    groups = groups.groupBy("digest").agg(F.max("rank").alias("rank"), F.max("group_size").alias("group_size"),
                                          F.bit_or("parts").alias("parts"), F.count("*").alias("texts"))
    winners = groups.select(
        "digest", F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share one SHA-256"))).otherwise(F.col("group_size")).alias("group_size"),
        F.when(near > 0, _number(_LAST) - near).cast("long").alias("keep_id"),
        F.explode(F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda part: F.getbit("parts", part) == 1)).alias("salt"))
    return (rows.select("doc_id", "digest", "salt").join(winners, ["digest", "salt"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))
