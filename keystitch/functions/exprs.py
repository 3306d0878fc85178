"""Column expressions shared by every operator. All are built-in Spark
functions, so they run inside whole-stage codegen; nothing here is a UDF."""

from __future__ import annotations

import sys
from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The tokens a spreadsheet/CSV reader of the reference turns into
# a missing value (the pandas 2.x default list, in its documented order).
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# ---------------------------------------------------------------------------


def _python_whitespace_class() -> str:
    """Java regex character class of exactly the characters Python's
    ``str.strip()`` removes (derived from ``str.isspace``, not typed in)."""
    chars = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]
    return "[" + "".join("\\x{%04X}" % ord(c) for c in chars) + "]"


WS = _python_whitespace_class()
_BLANK_RE = "^" + WS + "*$"
_TRIM_RE = "^" + WS + "+|" + WS + "+$"


def quote(name: str) -> str:
    """Backtick-quote a column name so dots, slashes and spaces are literal (H2)."""
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    """Column by literal name (never parsed as a nested path)."""
    return F.col(quote(name))


def strip_ws(col: Column) -> Column:
    """``str.strip()`` with Python's whitespace set (H7: ``trim`` strips spaces only)."""
    return F.regexp_replace(col, _TRIM_RE, "")


def normalize_header(col: Column) -> Column:
    """``str(x).lower().strip()`` — the case-insensitive header key."""
    return F.lower(strip_ws(col.cast("string")))


def normalize_header_py(name) -> str:
    """Driver-side twin of :func:`normalize_header` for header metadata."""
    return str(name).lower().strip()


def is_blank(col: Column) -> Column:
    """String that strips to '' (NULL stays NULL)."""
    return col.rlike(_BLANK_RE)


def is_empty(col: Column, dtype: T.DataType) -> Column:
    """Empty key cell (D1/R6): NULL, NaN for floating types, blank for strings.
    Never NULL itself."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    if isinstance(dtype, T.StringType):
        return col.isNull() | is_blank(col)
    return col.isNull()


def any_empty(cols: Iterable[tuple[Column, T.DataType]]) -> Column:
    parts = [is_empty(col, dt) for col, dt in cols]
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def na_to_null(col: Column | str, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Reader NA-token normalisation (A7) for one string column. Given a
    column *name*, the expression is built as one SQL snippet (cheap to plan
    for wide feeds); given a Column, with ``isin``."""
    tokens = list(tokens)
    if isinstance(col, str):
        name = quote(col)
        return F.expr(f"CASE WHEN {name} IN ({', '.join(map(_sql_str, tokens))}) THEN NULL ELSE {name} END")
    return F.when(col.isin(tokens), F.lit(None).cast("string")).otherwise(col)


def na_normalize(df: DataFrame, tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """Apply :func:`na_to_null` to every string column, keeping names and order."""
    tokens = list(tokens)
    return df.select(*[
        na_to_null(f.name, tokens).alias(f.name) if isinstance(f.dataType, T.StringType) else c(f.name)
        for f in df.schema.fields
    ])


# --- paths (I4) -------------------------------------------------------------

def base_name(path: Column) -> Column:
    """``os.path.basename`` for '/'-separated URIs."""
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """``os.path.splitext(basename)[0]``: a leading dot is not an extension."""
    return F.regexp_extract(base_name(path), r"^(.+?)(\.[^.]*)?$", 1)


def extension(path: Column) -> Column:
    """``os.path.splitext(basename)[1].lower()`` ('' when absent)."""
    return F.lower(F.regexp_extract(base_name(path), r"^.+?(\.[^.]*)?$", 1))


def output_ext(path: Column) -> Column:
    """Output extension rule: '.csv' stays '.csv', everything else becomes '.xlsx'."""
    return F.when(extension(path) == ".csv", F.lit(".csv")).otherwise(F.lit(".xlsx"))


def output_name(path: Column, ts: Column, counter: Column | None = None) -> Column:
    """``{stem}_{YYYYMMDDHHMMSSffffff}[_n]{ext}``."""
    stamp = F.date_format(ts, "yyyyMMddHHmmssSSSSSS")
    base = F.concat(stem(path), F.lit("_"), stamp)
    if counter is not None:
        base = F.concat(base, F.when(counter > 0, F.concat(F.lit("_"), counter.cast("string"))).otherwise(F.lit("")))
    return F.concat(base, output_ext(path))
