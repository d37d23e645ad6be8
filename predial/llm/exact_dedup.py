"""Exact copies, found by skew-safe combining.

Rows are combined in three steps, and every step compares whole texts, because the text
itself is part of each grouping key:

1. locally: the partial aggregation merges equal rows inside each task before any shuffle;
2. per digest and salt: a text that fills a third of the table is merged in `SALTS` places;
3. per digest: the winners of the salts, at most `SALTS` rows a text, are merged globally.

The winners carry a 64-bit mask of the salts that occur, so rows find their winner by a
join on digest and salt, in which no key is hotter than a 64th of its group.

Defined results: null text counts as empty, and empty texts are copies of each other. A
null id loses against any other; rows with the largest id that repeat with the same text
are one document (all are marked kept, and `drop_copies` leaves one of them). An empty
table gives an empty result. Other columns are neither read nor in the way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from predial.llm.support import fresh, full_text, keep

SALTS = 64  # one bit each in a long

Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _rows(df: DataFrame, doc_id: str, text: str, digest: Digest) -> DataFrame:
    return df.select(F.col(doc_id).alias("doc_id"), full_text(text).alias("text")).select(
        "doc_id",
        "text",
        F.unhex(digest(F.col("text"))).alias("digest"),
        salt_of("doc_id").alias("salt"),
    )


def salt_of(doc_id: str) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(SALTS)).cast("int")


def winners_of(rows: DataFrame, smallest: bool, content: Sequence[str] = ("text",)) -> DataFrame:
    """One row per different content: who stays, how many rows, which salts occur.

    `rows` have doc_id, digest, salt and the columns of the content, which are compared.
    """
    best = F.min if smallest else F.max
    salted = rows.groupBy("digest", "salt", *content).agg(
        best("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    bit = F.expr("shiftleft(1L, salt)")
    return salted.groupBy("digest", *content).agg(
        best("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size"),
        F.bit_or(bit).alias("salts"),
    )


def per_salt(winners: DataFrame) -> DataFrame:
    """A row for each salt that a winner's rows have, for the join on digest and salt."""
    places = F.filter(
        F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.getbit("salts", s) == 1
    )
    return winners.withColumn("salt", F.explode(places)).drop("salts")


def _unclear(winners: DataFrame) -> DataFrame:
    """Digests that more than one text has."""
    return winners.groupBy("digest").count().filter("count > 1").select("digest")


def mark_copies(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    smallest: bool = False,
    digest: Digest = sha256,
) -> DataFrame:
    """One row per row of `df`: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays (`smallest`: the smallest). Rows meet
    their winner by digest; the digests that two texts share, if there are any, are
    resolved by a join on the texts themselves.
    """
    rows = _rows(df, doc_id, text, digest)
    winners = keep(winners_of(rows, smallest).drop("text"), "copies")
    unclear = _unclear(winners)
    light = rows.drop("text") if digest is sha256 else rows
    if unclear.isEmpty():
        placed = light.join(per_salt(winners), ["digest", "salt"])
    else:
        clear = per_salt(winners.join(unclear, "digest", "left_anti"))
        shared = rows.join(unclear, "digest", "left_semi")
        by_text = per_salt(winners_of(shared, smallest))
        columns = ["digest", "salt", "doc_id", "text", "keep_id", "group_size"]
        placed = rows.join(clear, ["digest", "salt"]).select(*columns).unionByName(
            shared.join(by_text, ["digest", "salt", "text"]).select(*columns)
        )
    sha = F.lower(F.hex("digest")) if digest is sha256 else sha256(F.col("text"))
    return placed.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        sha.alias("text_sha256"),
    )


def drop_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` with one row of each different text, the one with the largest id; all columns.

    Winners come from comparing whole texts; rows find them, and each other, by digest and id.
    """
    columns = df.columns
    winners = keep(winners_of(_rows(df, doc_id, text, sha256), False).drop("text"), "copies")
    mark, no_id, id_text, row = (fresh(df, name) for name in ("digest", "no_id", "id_text", "row"))
    keys = [mark, no_id, id_text]

    def keyed(digest: Column, own: Column) -> list[Column]:
        """Null ids are equal here; the join is by plain columns, as the groups are."""
        return [digest.alias(mark), own.isNull().alias(no_id),
                F.coalesce(own.cast("string"), F.lit("")).alias(id_text)]

    stays = winners.select(*keyed(F.col("digest"), F.col("keep_id")))
    whole = F.struct(*(F.col(f"`{c}`") for c in columns)).alias(row)
    marked = df.select(*keyed(F.unhex(sha256(full_text(text))), F.col(doc_id)), whole)
    # A row may be repeated with the same id; such rows are combined inside each task, before
    # their whole texts are shuffled.
    single = marked.groupBy(*keys).agg(F.first(row).alias(row))
    return single.join(stays, keys, "left_semi").select(f"{row}.*")
