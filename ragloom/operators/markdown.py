"""Markdown header splitting (T4).

A heading line matching ``^#{2,3} `` starts a new chunk unless it sits inside a code
fence (a line opening with ``````` or ``~~~``, up to three spaces in; only the marker that opened a
fence closes it, and an open fence lasts to the end). ``#`` and ``####`` are not split points. The heading line stays in its chunk; text before the first heading
is a chunk of its own; blank sections are dropped.

Expressed with array functions on each document row: the fence and heading lines are found with
``filter`` over the line indexes, one ``aggregate`` runs over them with the open marker as its state,
and sections are ``slice``s between split points. A document is never exploded into lines, so there is no shuffle and no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.functions.text import trim_unicode

# Heading levels that split (2 and 3), and fence markers.
HEADING = r"^#{2,3} "
FENCE = r"^ {0,3}(```|~~~)"


def markdown_lines(text) -> Column:
    """The lines of a text."""
    t = F.col(text) if isinstance(text, str) else text
    return F.split(F.coalesce(t, F.lit("")), "\n", -1)


def with_markdown_sections(df: DataFrame, text: str = "text", out: str = "sections") -> DataFrame:
    """Adds ``out``: T4 sections of ``text``.

    Each intermediate array (lines, fence positions, split points) is projected once as
    a column, because a value read inside an array lambda is otherwise recomputed for
    every element."""
    lines = F.col("_lines")
    staged = df.withColumn("_lines", markdown_lines(F.col(text)))
    marks = F.filter(F.transform(lines, lambda line, i: F.struct(
        i.alias("i"), F.when(line.rlike(HEADING), F.lit("#")).otherwise(F.regexp_extract(line, FENCE, 1)).alias("m"))), lambda x: x["m"] != "")
    staged = staged.withColumn("_marks", marks)
    none = F.array().cast("array<int>")
    # state: the marker of the open fence ('' outside), and the headings outside fences so far
    folded = F.aggregate(
        F.col("_marks"), F.struct(F.lit("").alias("open"), none.alias("heads")),
        lambda acc, x: F.when(x["m"] == "#", F.struct(acc["open"].alias("open"), F.when(
            acc["open"] == "", F.concat(acc["heads"], F.array(x["i"]))).otherwise(acc["heads"]).alias("heads"))).otherwise(
            F.struct(F.when(acc["open"] == "", x["m"]).when(acc["open"] == x["m"], F.lit("")).otherwise(acc["open"]).alias("open"),
                     acc["heads"].alias("heads"))),
        lambda acc: acc["heads"])
    # ``_marks`` is read twice, so the optimizer keeps it as a projection of its own
    heads = F.when(F.size("_marks") == 0, none).otherwise(folded)
    staged = staged.withColumn("_starts", F.array_distinct(F.concat(F.array(F.lit(0)), heads)))
    starts = F.col("_starts")
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.size(lines)))
    sections = F.transform(
        F.arrays_zip(starts.alias("s"), ends.alias("e")),
        lambda z: trim_unicode(F.array_join(F.slice(lines, z["s"] + 1, z["e"] - z["s"]), "\n")),
    )
    return staged.withColumn(out, F.filter(sections, lambda c: F.length(c) > 0)).drop("_lines", "_marks", "_starts")


def derived_markdown(text) -> Column:
    """Markdown made from plain text for the routing and splitting jobs: the first line
    becomes a ``#`` title, lines under 40 characters ``##`` headings and lines of 40 to
    79 characters ``###`` headings; other lines stay body text."""
    t = F.col(text) if isinstance(text, str) else text
    lines = F.split(F.coalesce(t, F.lit("")), "\n", -1)
    return F.array_join(
        F.transform(
            lines,
            lambda line, i: F.when(i == 0, F.concat(F.lit("# "), line))
            .when(F.length(line) < 40, F.concat(F.lit("## "), line))
            .when(F.length(line) < 80, F.concat(F.lit("### "), line))
            .otherwise(line),
        ),
        "\n",
    )


def fenced_markdown(text) -> Column:
    """``derived_markdown`` with code fences: body lines whose length is a multiple of 7 open or close a
    backtick fence, of 11 a tilde fence (the line itself becomes the marker's info text)."""
    lines = F.split(derived_markdown(text), "\n", -1)
    body = lambda line: ~line.startswith("#")
    return F.array_join(F.transform(lines, lambda line: F.when(body(line) & (F.length(line) % 7 == 0), F.concat(F.lit("``` "), line))
                                    .when(body(line) & (F.length(line) % 11 == 0), F.concat(F.lit(" ~~~"), line)).otherwise(line)), "\n")
