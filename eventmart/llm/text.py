"""What several text operators share: word splitting, null handling and Arrow batch helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(df: DataFrame, text: str = "text") -> Column:
    """The text column with null read as empty."""
    return F.coalesce(df[text].cast("string"), F.lit(""))


def split_words(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D, in order."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def count_words(text: Column) -> Column:
    return F.size(split_words(text)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Only these columns; the others never reach a task. Names that differ in case alone are ambiguous, as in Spark itself."""
    return df.select(*[df[name] for name in names])
