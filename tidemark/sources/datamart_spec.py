"""The datamart specification: a sheet of stacked blocks saved as one CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# Block headings, and the first two cells of the category table's heading.
BLOCK_HEADINGS = ["datamarts with granularity example", "payer/access marts",
                  "patient dynamics / market marts"]
CATEGORY_HEADING = ["category", "datamart"]


def parse_spec(spark: SparkSession, path: str, headings=None) -> DataFrame:
    """Blocks of side-by-side column lists as (name, category, description, columns).

    A heading row opens a block, the next row names its datamarts, and the rows down to the first
    blank row list their columns. The category table runs from its heading to a blank row. Blocks
    may be as wide as the sheet. The sheet is a hand-kept document of some hundred lines, so it
    is read as one file with its line numbers.
    """
    headings = headings or BLOCK_HEADINGS
    text = spark.read.text(path, wholetext=True)
    lines = text.select(F.posexplode(F.split(F.regexp_replace("value", "^﻿", ""), "\r?\n"))
                        .alias("line", "raw"))
    # One number: commas inside quotes only make it larger than needed.
    width = lines.select(F.max(F.size(F.split("raw", ",")))).head()[0] or 1
    width = max(width, 3)
    shape = ", ".join(f"c{i} string" for i in range(width))
    cells = lines.select(
        "line", F.from_csv(F.when(F.trim("raw") == "", ",").otherwise(F.col("raw")),
                           shape).alias("c"),
    ).select("line", F.array(*[F.trim(F.coalesce(F.col(f"c.c{i}"), F.lit("")))
                               for i in range(width)]).alias("cells"))
    flagged = cells.select(
        "line", "cells",
        F.lower(F.col("cells")[0]).isin(headings).alias("is_heading"),
        F.forall("cells", lambda c: c == "").alias("is_blank"))
    in_order = Window.orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    blocks = flagged.withColumn("block", F.sum(F.col("is_heading").cast("int")).over(in_order))
    in_block = Window.partitionBy("block").orderBy("line")
    marked = (
        blocks.where("block > 0")
        .withColumn("row", F.row_number().over(in_block) - 1)
        .withColumn("ended", F.max(F.when((F.col("row") > 1) & F.col("is_blank"), 1).otherwise(0))
                    .over(in_block))
    )
    spread = marked.where("row >= 1 AND ended = 0").select(
        "block", "row", F.posexplode("cells").alias("place", "cell")).where("cell <> ''")
    names = spread.where("row = 1").select(
        "block", F.col("cell").alias("name"),
        (F.row_number().over(Window.partitionBy("block").orderBy("place")) - 1).alias("place"))
    listed = (
        names.join(spread.where("row > 1"), ["block", "place"], "left")
        .groupBy("block", "place", "name")
        .agg(F.array_sort(F.collect_list(F.when(
            F.col("cell").isNotNull(), F.struct("row", "cell")))).alias("sorted"))
        .select("name", F.transform("sorted", lambda s: s["cell"]).alias("columns"))
    )
    opens = F.transform(F.slice("cells", 1, 2), F.lower) == F.array(
        *[F.lit(x) for x in CATEGORY_HEADING])
    begun = flagged.withColumn("opens", opens).withColumn(
        "table", F.sum(F.col("opens").cast("int")).over(in_order))
    in_table = Window.partitionBy("table").orderBy("line")
    listed_rows = begun.where("table > 0 AND NOT opens").withColumn(
        "over", F.max((F.col("is_blank") | F.col("is_heading")).cast("int")).over(in_table))
    categories = listed_rows.where("over = 0").select(
        F.col("cells")[1].alias("name"), F.col("cells")[0].alias("category"),
        F.col("cells")[2].alias("description")).where("name <> ''")
    return listed.join(categories, "name", "left").select(
        "name", F.coalesce("category", F.lit("")).alias("category"),
        F.coalesce("description", F.lit("")).alias("description"), "columns")
