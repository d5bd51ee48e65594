"""Text clean-up and lenient casts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUE_WORDS = ("true", "1", "yes", "y")


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def to_number(x: Column) -> Column:
    return x.try_cast("double")


def to_whole(x: Column) -> Column:
    """A whole number, also from text such as 80.0; fractions and other text give null."""
    n = x.try_cast("double")
    return F.when(n == F.floor(n), n.try_cast("bigint"))


def to_time(x: Column) -> Column:
    return F.try_to_timestamp(x)


def digits(x: Column) -> Column:
    """The digits of x, without leading zeros; null if there are none."""
    return F.nullif(F.regexp_replace(F.regexp_replace(x, "[^0-9]", ""), "^0+", ""), F.lit(""))


def extract_imo(x: Column) -> Column:
    """A ship number: the first seven digits in a row."""
    return F.nullif(F.regexp_extract(x, "([0-9]{7})", 1), F.lit("")).try_cast("bigint")


def truthy(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x)).isin(*TRUE_WORDS), F.lit(False))


def joined(*parts: Column, separator: str = " | ") -> Column:
    """The parts that aren't blank, joined; null if none is left."""
    return F.nullif(F.concat_ws(separator, *[blank_to_null(p) for p in parts]), F.lit(""))


def unescaped(x: Column, times: int = 3) -> Column:
    """XML entities replaced as long as they stand for tags, for documents that were escaped several times; entities in an
    unescaped document stay."""
    for _ in range(times):
        plain = x
        for name, mark in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
            plain = F.replace(plain, F.lit(f"&{name};"), F.lit(mark))
        x = F.when(x.rlike("&(amp;)*lt;"), plain).otherwise(x)
    return x
