"""Column helpers that the native operators share; built-in functions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters of the word rule [^\x20\x09-\x0D]+.
WHITE = " \t\n\x0b\f\r"
GAP = "[\\x20\\x09-\\x0D]+"


def whole(text: str | Column) -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP, -1))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def name(df: DataFrame, base: str) -> str:
    """A column name that df doesn't have, so that extra columns never clash."""
    while base in df.columns:
        base = "_" + base
    return base
