"""Line deduplication by overlapping three-line windows.

Consecutive lines are hashed three at a time, windows that occur more than
once anywhere are found by a grouped minimum, and the lines that later
occurrences cover - merged where windows overlap - are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

WIDTH = 3


def _bare(line):
    return F.btrim(line, F.lit(" \t\r"))


def _windows(docs: DataFrame, width: int, whole_short: bool) -> DataFrame:
    """(doc_id, text_hash, at, h): at counts the lines with text before the window; lines compare without the blanks at their ends."""
    lines = F.filter(F.transform(F.split("text", "\n"), _bare), lambda x: x != "")
    starts = F.sequence(F.lit(0), F.greatest(F.size("lines") - width, F.lit(0)))
    hashed = F.transform(starts, lambda i: F.struct(i.alias("at"), F.md5(F.concat_ws("\n", F.slice("lines", i + 1, width)))
                                                    .alias("h")))
    return (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), lines.alias("lines")).where(F.size("lines") >= (1 if whole_short else width))
            .select("doc_id", "text_hash", F.explode(hashed).alias("w"))
            .select("doc_id", "text_hash", "w.at", F.unhex("w.h").alias("h")))


def repeated_windows(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
                     whole_short: bool = False) -> DataFrame:
    """(doc_id, text_hash, at) of every window that occurred before, at a smaller (doc_id, at, text_hash)."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull())
    found = _windows(docs, width, whole_short)
    place = F.struct("doc_id", "at", "text_hash")
    first = (found.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where(F.col("first") != F.col("last")).select("h", "first"))
    return found.join(first, "h").where(place != F.col("first")).select("doc_id", "text_hash", "at").distinct()


def dedup_lines(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
                size_col: str = "n_chars", drop_emptied: bool = False, whole_short: bool = False) -> DataFrame:
    """``docs`` with repeated passages removed and all their columns; ``size_col``, where there is one, follows the text.

    A window is ``width`` consecutive lines that hold text, so blank lines
    neither part nor make windows.  The occurrence with the smallest
    (doc_id, position) stays; the lines of all others go.  A text that
    loses lines is joined anew from its other lines with text; one that is
    repeated as a whole keeps its row with an empty text, or with ``drop_emptied`` goes.  Repeated rows
    are one occurrence, so a row does not lose its text to itself; rows
    that share an id but not the text are texts of their own.  Null texts and rows without id are left as they are; texts of
    fewer lines have no window, or with ``whole_short`` one of all their lines,
    so that later copies of them go too.  An empty table gives none.
    """
    columns = docs.columns
    gone = (repeated_windows(docs, width, id_col, text_col, whole_short).groupBy("doc_id", "text_hash")
            .agg(F.collect_set("at").alias("__gone")).withColumnsRenamed({"doc_id": "__gone_id", "text_hash": "__gone_text"}))
    held = docs.join(gone, (F.col(id_col) == F.col("__gone_id")) & (F.xxhash64(text_col) == F.col("__gone_text")), "left")
    covered = F.flatten(F.transform("__gone", lambda at: F.sequence(at, at + (width - 1))))
    stay = F.array_except(F.transform("__lines", lambda _, i: i), covered)
    changed = F.col("__gone").isNotNull()
    held = held.withColumn("__lines", F.when(changed, F.filter(F.split(F.col(text_col), "\n"), lambda x: _bare(x) != "")))
    held = held.withColumn("__text", F.when(
        changed, F.array_join(F.transform(stay, lambda i: F.element_at("__lines", i + 1)), "\n")).otherwise(F.col(text_col)))
    if drop_emptied:
        held = held.where(~changed | (F.col("__text") != ""))
    size = F.when(changed, F.length("__text")).otherwise(F.col(size_col)) if size_col in columns else None
    return held.select(*[
        F.col("__text").alias(c) if c == text_col
        else size.cast(docs.schema[c].dataType).alias(c) if c == size_col else F.col(c) for c in columns])
