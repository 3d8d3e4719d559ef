"""Curated interest tags: the dictionary file (S7) and its load."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


REQUIRED_COLUMNS = ("cmte_id", "category", "notes")

# The comment block written at the top of a generated dictionary.
DICTIONARY_PREAMBLE = [
    "# Committee interest dictionary.",
    "# One row per committee: cmte_id, category, notes.",
    "# Categories encode stance; they are never summed across each other.",
    "",
]


def write_interest_dictionary(entries: DataFrame, path: str) -> str:
    """Write (cmte_id, category, notes) as CSV text with a comment preamble, a
    blank line and a header, the way the curated dictionary file looks.

    Rows stay distributed: Spark renders each entry to one CSV record; only the
    fixed preamble is a tiny local frame. Line order does not matter to the
    reader (comments and the header are recognised by content).
    """
    spark = entries.sparkSession

    def q(c):  # CSV field: quoted when it holds a comma, a quote or a newline
        v = F.coalesce(F.col(c), F.lit(""))
        return F.when(v.rlike('[,"\n]'),
                      F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
                      ).otherwise(v)

    head = spark.createDataFrame(
        [(line,) for line in DICTIONARY_PREAMBLE + [",".join(REQUIRED_COLUMNS)]], "value string")
    body = entries.select(F.concat_ws(",", q("cmte_id"), q("category"), q("notes")).alias("value"))
    head.coalesce(1).unionByName(body).write.mode("overwrite").text(path)
    return path


def scan_interest_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Read the tag CSV. The first line that is not blank and does not start
    with '#' is the header; columns are taken by its names, in any order, and a
    file without the required ones is refused. Lines that start with '#' are
    comments, quoted fields may hold commas, quotes and line ends, fields are
    trimmed, and rows without an id or a category are left out."""
    reader = (spark.read.option("sep", ",").option("quote", '"').option("escape", '"')
              .option("multiLine", "true").option("comment", "#")
              .option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true"))
    # one header line per file; it is found by content, since a folder may hold several files
    names = [f.strip() for f in _header(spark, path)]
    missing = [c for c in REQUIRED_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"the tag file needs the columns {', '.join(REQUIRED_COLUMNS)}; "
                         f"missing: {', '.join(missing)}")
    schema = ", ".join(f"_c{i} string" for i in range(len(names)))
    rows = reader.schema(schema).csv(path)
    at = {c: F.col(f"_c{names.index(c)}") for c in REQUIRED_COLUMNS}
    header = F.lit(True)
    for i, name in enumerate(names):
        header = header & F.coalesce(F.trim(F.col(f"_c{i}")) == name, F.lit(name == ""))
    text = {c: F.regexp_replace(v, r"^\s+|\s+$", "") for c, v in at.items()}
    return (rows.filter(~header)
            .select(text["cmte_id"].alias("cmte_id"), text["category"].alias("category"),
                    F.coalesce(text["notes"], F.lit("")).alias("notes"))
            .filter((F.col("cmte_id") != "") & (F.col("category") != "")
                    & ~F.col("cmte_id").startswith("#")))


def _header(spark: SparkSession, path: str) -> list[str]:
    """The field names of the header: the first line of the file (of a folder:
    the first that names the id column) that is neither blank nor a comment."""
    line = F.trim(F.col("value"))
    lines = spark.read.text(path).filter((line != "") & ~line.startswith("#"))
    found = (lines.filter(F.lower("value").contains(REQUIRED_COLUMNS[0])).limit(1).collect()
             or lines.limit(1).collect())
    return next(csv.reader([found[0]["value"]])) if found else []


def load_group_mappings(entries: DataFrame, committees: DataFrame) -> DataFrame:
    """The tag table = dictionary rows whose committee exists (semi join,
    so a duplicated committee row cannot multiply a tag)."""
    ids = committees.select(F.col("CMTE_ID").alias("_id"))
    return (entries.join(ids, F.col("cmte_id") == F.col("_id"), "left_semi")
            .select(F.col("cmte_id").alias("CMTE_ID"),
                    F.col("category").alias("custom_category"),
                    F.col("notes").alias("notes")))
