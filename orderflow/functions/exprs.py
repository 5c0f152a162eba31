"""Column expressions shared by the operators (all built-in, JVM side)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Campaign key carried by every table, join, group and window.
CAMPAIGN = ["Marque", "Saison"]
RFC = "ReferenceFournisseurCouleur"

# Row values are brought to this decimal type once; sums of decimals are exact,
# so no result depends on the order in which partitions were added.  Results
# are turned into doubles once, at the output (:func:`doubles`).
EXACT = T.DecimalType(28, 6)
#: What a sum of exact values is.
SUMMED = T.DecimalType(38, 6)


def exact(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(EXACT)


def fsum(name: str | Column) -> Column:
    """SQL sum: null when every input is null."""
    return F.sum(exact(name))


def fsum0(name: str | Column) -> Column:
    """Sum where a group of only nulls gives 0 (dataframe-library semantics)."""
    return F.coalesce(fsum(name), F.lit(0).cast(EXACT))


def doubles(df: DataFrame) -> DataFrame:
    """Exact columns as doubles: the one conversion at the output."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, null when den is 0 or null (never an error or infinity)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


def text_of(df: DataFrame, name: str) -> Column:
    """A column as text, under its own name; one that is text already keeps its collation."""
    return F.col(name) if isinstance(df.schema[name].dataType, T.StringType) else F.col(name).cast("string").alias(name)


def drop_null_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Drop rows with a null in any key, as a dataframe-library group-by does."""
    return df.dropna(subset=list(keys))
