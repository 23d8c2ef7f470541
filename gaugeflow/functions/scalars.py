"""Column expressions for text, numbers and coordinates. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import fixed_values as fv


def quoted(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def strip_text(c: Column) -> Column:
    """Remove every kind of white space at both ends, not only blanks."""
    return F.btrim(c, F.lit(fv.WHITE_SPACE))


def normalised_text(c: Column) -> Column:
    """Null becomes ``unknown``; text is trimmed; blank text becomes ``Unknown``.

    One short chain without branches: the generated code of a wide table has to stay small enough for the JIT.
    """
    stripped = strip_text(F.coalesce(c, F.lit(fv.NULL_TEXT)))
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit(fv.BLANK_TEXT))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain decimal number is missing."""
    text = F.trim(c)
    return F.when(text.rlike(fv.NUMBER_PATTERN), text.try_cast("double"))


def as_number(df: DataFrame, name: str) -> Column:
    """Numeric reading of a column of any type: text is parsed, NaN becomes null, integers stay."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return to_number(quoted(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(quoted(name).cast("double"))
    return quoted(name)


def clipped(c: Column, low: float | None, high: float | None) -> Column:
    """Bound a value on either side; a missing value stays missing."""
    out = c
    if low is not None:
        out = F.when(c < F.lit(low), F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(c > F.lit(high), F.lit(high)).otherwise(out)
    return out


def coordinate(c: Column, pattern: str) -> Column:
    """One coordinate of ``(lat, lon)`` text, null when the text has another shape."""
    return to_number(F.regexp_extract(c, pattern, 1))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def relative_gap(a: Column, b: Column, base: Column) -> Column:
    """|a - b| / |base| with the base kept away from zero."""
    return F.abs(a - b) / F.greatest(F.abs(base), F.lit(fv.RATIO_FLOOR))


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def bounds_ladder(column: str):
    """The lines of bounds that apply to a column, or None for a column without bounds."""
    if "confidence" in column.lower():
        return fv.LIMIT_BOUNDS
    return fv.VALUE_BOUNDS if column in ("DataValue", "DataValueAlt") else None


def ladder_line(type_col: Column, ladder) -> Column:
    """Number of the first line with a word of the metric-type label; one past the end if none has."""
    label = F.lower(type_col)
    line = F.lit(len(ladder))
    for i, (words, _, _) in reversed(list(enumerate(ladder))):
        hit = F.lit(False)
        for word in words:
            hit = hit | label.contains(word)
        line = F.when(hit, F.lit(i)).otherwise(line)
    return line


def line_bounds(line: Column, ladder) -> tuple[Column, Column]:
    rows = [*ladder, ([], *fv.OTHER_BOUNDS)]
    return tuple(F.get(F.array(*[F.lit(row[side]) for row in rows]), line) for side in (1, 2))


def type_bounds(type_col: Column, column: str) -> tuple[Column, Column] | None:
    """Lower and upper bound for a value column, chosen by the words in its metric-type label.

    Only the value and confidence columns have bounds; other columns give None.
    """
    ladder = bounds_ladder(column)
    return None if ladder is None else line_bounds(ladder_line(type_col, ladder), ladder)
