"""Exact deduplication: group by a 128-bit content hash, compare bytes inside groups.

Only built-in functions. Texts are grouped by (hash, text), so that two texts end up in one
class only if their bytes are equal; the hash alone never decides. The grouping combines
before it shuffles: however many copies a text has, each task sends it once. What goes back
to the rows is keyed by the hash, except for hashes that two different texts share, where
the text itself is compared once more.

Defined cases: a null text is an empty text and equals other empty texts. A null id is
smaller than any other. Rows that agree in id and text are one document and are marked
alike. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import id_and_text, read_table
from wardline.session import materialize


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hash_of: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` says which id of a class stays, the "smallest" or the "largest".
    """
    chosen = {"smallest": _smallest, "largest": F.max}[keep]
    rows = id_and_text(docs, id_col, text_col).withColumn("hash", hash_of(F.col("text")))
    grouped = rows.groupBy("hash", "text").agg(
        chosen(F.col("doc_id")).alias("keep_id"), F.count("*").alias("group_size")
    )
    # The class of a text in the shared folder, under its hash: no text, unless it has to tell
    # classes apart.
    classes = materialize(
        grouped.select("hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"), "exact-classes"
    )
    shared = classes.groupBy("hash").count().where("count > 1").select("hash")
    if shared.isEmpty():
        marked = rows.select("doc_id", "hash").join(classes, "hash")
    else:
        shared = materialize(shared, "exact-shared")
        single = classes.join(shared, "hash", "left_anti")
        several = grouped.join(shared, "hash", "left_semi").withColumn("text_sha256", F.sha2("text", 256))
        marked = (
            rows.select("doc_id", "hash")
            .join(single, "hash")
            .unionByName(rows.join(several, ["hash", "text"]).drop("text"))
        )
    return marked.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, that with the smallest id, all columns as they are.

    The row itself travels with its class: no join, and copies are reduced before the shuffle.
    Of rows with the smallest id any one stays.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    own_id = F.col(f"`{id_col}`")
    place = F.struct(own_id.isNotNull(), own_id)
    rows = docs.select(
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.struct(F.col(f"`{text_col}`").isNull().alias("missing"), F.struct(*others).alias("others")).alias("row"),
        place.alias("place"),
    ).withColumn("hash", content_hash(F.col("text")))
    kept = rows.groupBy("hash", "text").agg(F.min_by("row", "place").alias("row"))
    text = F.when(~F.col("row.missing"), F.col("text"))
    return kept.select(*(text.alias(c) if c == text_col else F.col(f"row.others.`{c}`") for c in docs.columns))


def _smallest(column: Column) -> Column:
    """The least value, null before all others."""
    return F.when(F.count(column) == F.count("*"), F.min(column))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_classes(read_table(spark, sf_dir, "documents"), keep="largest")


OP7_SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""
