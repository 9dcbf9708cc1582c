"""Log line layouts.

R1 has a referrer in its last quotes; R2 has none and ends in the identifier. A file keeps the layout that its first
readable line has (``sticky``), or every line is read by the first layout that fits (``per_line``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .formats import UNKNOWN_DOMAIN

# The two layouts, and requests of another protocol that are expected not to fit.
R1 = r'^[^ ]+ [^ ]+ "([^"]+)" [^ ]* [^ ]* [^ ]* ([^ ]*) "[^"]*" "([^"]*)"$'
R2 = r'^[\d.]+ [^ ]+ "([^"]+)" \d+ \d+ [^ ]+ (.+)$'
OPEN_URL = r"^[\d.]+ HTTP:OpenURL"


#: Between the fields of a line that was read; a character that no text has.
BETWEEN = "\uffff"
#: More files than this and their layouts are joined as the planner likes.
MOST_FILES = 100_000


def layout(line: Column) -> Column:
    """1 or 2 for the first layout that fits, null for none."""
    return F.when(line.rlike(R1), 1).when(line.rlike(R2), 2)


def file_layouts(lines: DataFrame) -> DataFrame:
    """file, file_layout: the layout of each file's first readable line. Needs columns file, line_id and value."""
    fits = lines.select("file", "line_id", layout(F.col("value")).alias("l")).filter("l IS NOT NULL")
    return fits.groupBy("file").agg(F.min_by("l", "line_id").alias("file_layout"))


def parse_lines(lines: DataFrame, mode: str = "sticky") -> DataFrame:
    """Add layout, date_raw, doi and referrer; layout is null where the line can't be read. Each pattern runs once a line."""
    if mode not in ("sticky", "per_line"):
        raise ValueError(f"unknown mode {mode!r}")
    columns, line = lines.columns, F.col("value")
    one = F.split(F.regexp_replace(line, R1, f"$1{BETWEEN}$2{BETWEEN}$3"), BETWEEN)
    two = F.split(F.regexp_replace(line, R2, f"$1{BETWEEN}$2{BETWEEN}"), BETWEEN)
    if mode == "sticky":
        layouts = file_layouts(lines)
        # one row a file, and the number of files is known from their listing
        layouts = F.broadcast(layouts) if len(lines.inputFiles()) <= MOST_FILES else layouts
        lines = lines.join(layouts, "file", "left")
        fields = F.when(F.col("file_layout") == 1, one).when(F.col("file_layout") == 2, two)
    else:
        fields = F.when(line.rlike(R1), one).otherwise(two)
    # a line that does not fit stays as it is, in one part
    lines = lines.withColumn("_fields", fields)
    lines = lines.withColumn("_fields", F.when(F.size("_fields") == 3, F.col("_fields")))
    which = F.col("file_layout") if mode == "sticky" else F.when(line.rlike(R1), 1).otherwise(2)
    return lines.select(
        *columns,
        F.when(F.col("_fields").isNotNull(), which).alias("layout"),
        F.get("_fields", F.lit(0)).alias("date_raw"),
        F.lower(F.get("_fields", F.lit(1))).alias("doi"),
        F.when(F.col("_fields").isNotNull(), F.when(which == 2, F.lit(UNKNOWN_DOMAIN)).otherwise(F.get("_fields", F.lit(2)))).alias("referrer"),
    )
