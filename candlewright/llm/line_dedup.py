"""Lines that many sites share, removed everywhere but at their first place.

The sites of every line hash are counted by HyperLogLog sketches, built per task and merged by the
aggregation. An estimate far from the threshold decides at once; lines between half and twice the
threshold get an exact distinct count. A line found on `min_sites` sites or more is boilerplate. It
stays once, in the document with the smallest id that has it, and goes everywhere else, so that a
document copied to many sites keeps one whole copy.

Edge cases: lines are compared without the blanks around them; blank lines are never counted or
removed. A null text has no lines and stays null. A null site counts as one site of its own; rows
with a null id are treated as one document without a number and never hold the first place while
another document has the line. Repeated rows are cleaned alike. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from candlewright.llm.native import let, packed
from candlewright.session import materialize

AROUND = " \t\r\x0b\x0c"


@dataclass(frozen=True)
class LineParams:
    min_sites: int = 8
    #: Estimates below threshold / band or above threshold * band are trusted.
    band: float = 2.0
    sketch_bits: int = 12


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_places(docs: DataFrame, id_col: str, text: str, site: str) -> DataFrame:
    """Every line with words as `id, row, site, pos, line`; `row` and `line` are hashes."""
    spots = F.filter(
        F.transform(
            _lines(F.col(text)),
            lambda x, i: F.struct(i.alias("pos"), F.btrim(x, F.lit(AROUND)).alias("key")),
        ),
        lambda x: x["key"] != "",
    )
    return docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text)).alias("row"),
        F.xxhash64(F.coalesce(F.col(site).cast("string"), F.lit("\n"))).alias("site"),
        F.explode(F.transform(spots, lambda x: F.struct(x["pos"], F.xxhash64(x["key"]).alias("line")))).alias("x"),
    ).select("id", "row", "site", "x.pos", "x.line")


def boilerplate(places: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """`line, first_id` of the lines on `min_sites` sites or more."""
    seen = places.groupBy("line").agg(
        F.hll_sketch_agg("site", params.sketch_bits).alias("sketch"), F.min("id").alias("first_id")
    )
    seen = seen.select("line", "first_id", F.hll_sketch_estimate("sketch").alias("sites"))
    wide = materialize(seen.where(F.col("sites") >= params.min_sites / params.band), "wide-lines")
    near = wide.where(F.col("sites") <= params.min_sites * params.band)
    exact = (
        places.join(near.select("line", "first_id"), "line")
        .groupBy("line", "first_id", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("line", "first_id")
        .agg(F.count("*").alias("sites"))
        .where(F.col("sites") >= params.min_sites)
    )
    sure = wide.where(F.col("sites") > params.min_sites * params.band)
    return sure.select("line", "first_id").unionAll(exact.select("line", "first_id"))


def clean(
    docs: DataFrame,
    params: LineParams = LineParams(),
    id_col: str = "doc_id",
    text: str = "text",
    site: str = "source",
) -> DataFrame:
    """Each row as `doc` with `n_lines` (with words), `n_removed` and the `cleaned` text."""
    places = materialize(line_places(docs, id_col, text, site), "line-places")
    lost = materialize(boilerplate(places, params), "boilerplate")
    gone = (
        places.join(lost, "line")
        .groupBy("id", "row", "line", "first_id")
        .agg(F.collect_set("pos").alias("at"))
        .select(
            "id",
            "row",
            F.when(
                F.col("id").eqNullSafe(F.col("first_id")),
                F.array_except("at", F.array(F.array_min("at"))),
            )
            .otherwise(F.col("at"))
            .alias("at"),
        )
        .where(F.size("at") > 0)
        .groupBy("id", "row")
        .agg(F.flatten(F.collect_list("at")).alias("at"))
    )
    rows = packed(docs, F.col(id_col).alias("id"), F.xxhash64(F.col(text)).alias("row"))
    # The table of lost lines grows with the corpus: the join is the same at every size.
    gone = materialize(gone, "lost-lines").select(F.col("id").alias("gone_id"), F.col("row").alias("gone_row"), "at")
    gone = gone.hint("merge")
    body = F.col(f"doc.{text}")
    lines = _lines(body)
    counted = F.size(F.filter(lines, lambda x: F.btrim(x, F.lit(AROUND)) != ""))
    return (
        rows.join(
            gone,
            F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("row") == F.col("gone_row")),
            "left",
        )
        .withColumn(
            "left_over",
            F.when(
                F.col("at").isNotNull(),
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("at")),
            ),
        )
        .select(
            "doc",
            counted.cast("bigint").alias("n_lines"),
            F.when(F.col("at").isNotNull(), F.size("at")).otherwise(0).cast("bigint").alias("n_removed"),
            F.when(F.col("at").isNull(), body)
            .otherwise(
                let(
                    lines,
                    lambda x: F.array_join(F.transform("left_over", lambda i: F.get(x, i)), "\n"),
                )
            )
            .alias("cleaned"),
        )
    )
