"""Tables written to the shared folder, and whole rows chosen by decisions on narrow ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.words import whole
from reelgauge.session import scratch_path


def written(df: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read again.

    This cuts the lineage, survives lost executors, and Spark then knows the table's real size, so it
    broadcasts it only if it is small.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame) -> DataFrame:
    """The table with columns c0, c1, ..., so that no helper column can clash with one of its own."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def place(docs: DataFrame, name: str) -> Column:
    """A column of the table, by its number."""
    return F.col(f"c{docs.columns.index(name)}")


def row_tag(doc_id: Column, text: Column) -> Column:
    """128 bits that stand for a row's id and text; null ids and null texts have tags too, and null text is empty text."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), whole(text)).cast("binary")))


def without(docs: DataFrame, tag: Column, gone: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows whose tag is not in ``gone``, and one row of each tag in ``repeated``; all columns.

    Texts meet the tags in one join. Rows of repeated tags fold inside each input task, so a tag that a third of
    all rows share is in no single task.
    """
    left = numbered(docs).withColumn("tag", tag).join(gone.select("tag"), "tag", "left_anti")
    columns = [f"c{i}" for i in range(len(docs.columns))]
    if not repeated.isEmpty():
        some = repeated.select("tag")
        one = left.join(some, "tag", "left_semi").groupBy("tag").agg(F.first(F.struct(*columns)).alias("row"))
        left = left.join(some, "tag", "left_anti").select(*columns).unionByName(one.select("row.*"))
    return left.select(*columns).toDF(*docs.columns)
