"""Column expressions: value classes, parsing, tokens. All of them stay inside codegen."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK_TOKENS = ("?",)
# the column of a raw scan that holds the text of rows with too few or too many cells
MALFORMED = "_malformed"
# what counts as white space everywhere: the signs that \s stands for
BLANKS = " \t\n\x0b\f\r"
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd")

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER = r"^\s*[+-]?\d+\s*$"
INTEGRAL_TYPES = ("tinyint", "smallint", "int", "bigint")
NUMERIC_TYPES = INTEGRAL_TYPES + ("float", "double", "decimal")

# value classes, in the order in which messages name them
NULL, EMPTY, MASKED, NUMERIC, DATE, STRING = range(6)


def col(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """``wanted``, each with as many underscores before it as make it differ from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(dtype(df, name), T.NumericType)


def is_string(df: DataFrame, name: str) -> bool:
    return isinstance(dtype(df, name), T.StringType)


def is_temporal(df: DataFrame, name: str) -> bool:
    return isinstance(dtype(df, name), (T.DateType, T.TimestampType, T.TimestampNTZType))


def trimmed(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.trim(c, F.lit(BLANKS))


def present(df: DataFrame, name: str) -> Column:
    """The value of a column, NULL where it is missing; NaN is missing."""
    c = col(name)
    return F.nanvl(c, F.lit(None)) if isinstance(dtype(df, name), (T.DoubleType, T.FloatType)) else c


def date_regex(fmt: str) -> str:
    """The shape of a date format as a pattern.

    A run of one letter is a number of one or two digits, a longer run has as many
    digits; three or more of M, L or E are a name. Text in quotes stands for itself.
    """
    shape = ""
    for m in re.finditer(r"'([^']*)'|(([A-Za-z])\3*)|(.)", fmt, re.S):
        quoted, run, other = m.group(1), m.group(2), m.group(4)
        if run and run[0] in "MLE" and len(run) > 2:
            shape += r"\p{L}+\.?"
        elif run and run[0] == "a":
            shape += r"[AaPp][Mm]"
        elif run in ("y", "u"):
            shape += r"\d+"
        elif run:
            shape += r"\d{1,2}" if len(run) == 1 and run != "S" else rf"\d{{{len(run)}}}"
        else:
            shape += re.escape(quoted or other)
    return rf"^\s*{shape}\s*$"


def parsed_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The date in the first format that fits, else NULL."""
    tries = [F.when(c.rlike(date_regex(f)), F.try_to_date(trimmed(c), f)) for f in formats]
    return F.coalesce(*tries)


def matched_format(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Name of the first date format that fits; ``missing`` or ``other`` where none does."""
    ladder = F.when(c.isNull() | (trimmed(c) == ""), F.lit("missing"))
    for f in formats:
        fits = c.rlike(date_regex(f)) & F.try_to_date(trimmed(c), f).isNotNull()
        ladder = ladder.when(fits, F.lit(f))
    return ladder.otherwise(F.lit("other"))


def is_masked(c: Column, tokens: Sequence[str] = MASK_TOKENS) -> Column:
    return trimmed(c).isin(*tokens) if tokens else F.lit(False)


def text_class(
    c: Column, tokens: Sequence[str] = (), formats: Sequence[str] = DATE_FORMATS, shapes: bool = True
) -> Column:
    """Class of a text value by its shape: null, empty, masked, numeric, date or string."""
    ladder = F.when(c.isNull(), NULL).when(trimmed(c) == "", EMPTY)
    if tokens:
        ladder = ladder.when(is_masked(c, tokens), MASKED)
    if shapes:
        ladder = ladder.when(c.rlike(NUMBER), NUMERIC).when(parsed_date(c, formats).isNotNull(), DATE)
    return ladder.otherwise(STRING)


def typed_class(df: DataFrame, name: str) -> Column:
    """Class of a value by its column's type; NULL for text, which has to be looked at.

    NaN counts as null, as a division by zero gives NULL here.
    """
    if is_string(df, name):
        return F.lit(None)
    kind = NUMERIC if is_numeric(df, name) else DATE if is_temporal(df, name) else STRING
    absent = col(name).isNull()
    if isinstance(dtype(df, name), (T.DoubleType, T.FloatType)):
        absent = absent | F.isnan(col(name))
    return F.when(absent, NULL).otherwise(kind)


def typed(c: Column, type_name: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text to a type; what does not fit becomes NULL."""
    if type_name == "date":
        return parsed_date(c, formats)
    if type_name in INTEGRAL_TYPES:
        return F.when(c.rlike(INTEGER), trimmed(c)).try_cast(type_name)
    if type_name.split("(")[0] in NUMERIC_TYPES:
        return F.when(c.rlike(NUMBER), trimmed(c)).try_cast(type_name)
    return c.try_cast(type_name)


def unmasked(c: Column, tokens: Sequence[str] = MASK_TOKENS) -> Column:
    return F.when(~is_masked(c, tokens), c)


def folded(c: Column, style: str = "lower") -> Column:
    fold = {"lower": F.lower, "upper": F.upper, "title": F.initcap}[style]
    return fold(trimmed(c))


def tokens_of(c: Column) -> Column:
    """Lower-case words: runs of letters and digits of any script."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def words_of(text: str) -> list[str]:
    """The same words of a short text on the driver, such as a query or a listed term."""
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def added(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def quoted_list(names: Column) -> Column:
    """An array of names in the form ``['a', 'b']``."""
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))
