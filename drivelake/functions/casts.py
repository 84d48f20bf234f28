"""Column -> Column helpers for typing raw text.

Everything here is a pure Catalyst expression: it runs inside whole-stage
codegen and never raises under ANSI mode (bad input becomes NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from drivelake.schema import normalize_type

# The text shapes the lenient integral cast accepts and the
# pattern of its integer part (legacy non-ANSI cast semantics).
NUMBER_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)$"
INTEGER_PART = r"^([+-]?\d*)(\.\d*)?$"
DATE_FORMAT = "yyyy-MM-dd"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"

_INTEGRAL = {"int", "bigint", "smallint", "tinyint"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_literal(text: str) -> str:
    """Quote ``text`` as a Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def number_text_sql(t: str) -> str:
    """``t`` as a whole matches NUMBER_TEXT (``$`` would allow a line break after it)."""
    return f"{t} RLIKE {sql_literal(NUMBER_TEXT[:-1] + chr(92) + 'z')}"


def lenient_cast_sql(ref: str, datatype: str) -> str:
    """SQL text of ``lenient_cast`` over the SQL expression ``ref``.

    Integral targets: a text that is just as its value is written has that
    value (no regex on the hot path: a drop has ~80 numeric text columns).  Any
    other: shape test, integer part = text before the first '.', then
    ``try_cast`` (overflow -> NULL).  The text is short, as the JIT compiles no
    long generated method."""
    name = normalize_type(datatype)
    if name == "string":
        return f"CAST({ref} AS STRING)"
    if name in _INTEGRAL:
        t = f"trim({ref})"
        whole = f"substring_index({t}, '.', 1)"
        value = f"try_cast({ref} AS {name.upper()})"
        return (f"CASE WHEN CAST({value} AS STRING) = {ref} THEN {value} WHEN {number_text_sql(t)} THEN try_cast("
                f"CASE WHEN {whole} IN ('', '+', '-') THEN '0' ELSE {whole} END AS {name.upper()}) END")
    if name == "date":
        return strict_date_sql(ref)
    return f"try_cast({ref} AS {name.upper()})"


def strict_date_sql(ref: str, fmt: str = DATE_FORMAT) -> str:
    """``yyyy-MM-dd`` exactly: the text of 10 characters is just as its date is
    written, a date of the calendar (2013-02-30 -> NULL).  Same result
    as ``try_to_date(s, 'yyyy-MM-dd')`` and about 3x cheaper per row."""
    if fmt != DATE_FORMAT:
        return f"try_to_date({ref}, {sql_literal(fmt)})"
    # only DATE_TEXT has 10 characters and is what its date gives as text
    value = f"try_cast({ref} AS DATE)"
    return f"CASE WHEN length({ref}) = 10 AND CAST({value} AS STRING) = {ref} THEN {value} END"


def strict_timestamp_sql(ref: str, fmt: str = DATE_FORMAT) -> str:
    """text to timestamp with a fixed pattern, NULL when unparsable."""
    return f"try_to_timestamp({ref}, {sql_literal(fmt)})"


def parse_sql(rule: str, ref: str, datatype: str) -> str:
    """The value of source text ``ref`` under a parse rule of the schema."""
    if rule == "text":
        return lenient_cast_sql(blank_to_null_sql(ref), datatype)
    if rule == "date":
        return strict_date_sql(ref)
    if rule == "timestamp":
        return strict_timestamp_sql(ref)
    return lenient_cast_sql(ref, datatype)


def unparsable_sql(rule: str, ref: str, datatype: str) -> str:
    """``ref`` gives no value under the rule: it is blank, or its value is NULL (never NULL itself)."""
    return is_blank_sql(ref) if rule == "text" else f"({is_blank_sql(ref)} OR ({parse_sql(rule, ref, datatype)}) IS NULL)"


def blank_to_null_sql(ref: str) -> str:
    return f"CASE WHEN length(trim({ref})) > 0 THEN trim({ref}) END"


def is_blank_sql(ref: str) -> str:
    return f"({ref} IS NULL OR trim({ref}) = '')"


def lenient_cast(c, datatype: str) -> Column:
    """cast text to ``datatype``; anything unparsable becomes NULL.

    Integral targets follow the legacy cast: surrounding blanks are ignored,
    a fraction is truncated toward zero ('5.9' -> 5, '-7.99' -> -7, '.5' -> 0),
    exponents and overflow give NULL.  Other targets use ``try_cast``.
    """
    if isinstance(c, str):
        return F.expr(lenient_cast_sql(quote(c), datatype))
    name = normalize_type(datatype)
    if name == "string":
        return c.cast("string")
    if name in _INTEGRAL:
        t = F.trim(c)
        rest = F.translate(t, "0123456789", "")
        shape = (F.length(rest) < F.length(t)) & (rest.isin("", ".") | (
            rest.isin("+", "-", "+.", "-.") & (F.substring(t, 1, 1) == F.substring(rest, 1, 1))))
        whole = F.substring_index(t, ".", 1)
        whole = F.when(whole.isin("", "+", "-"), F.lit("0")).otherwise(whole)
        return F.when(shape, whole.try_cast(name))
    if name == "date":
        return strict_date(c)
    return c.try_cast(name)


def strict_date(c, fmt: str = DATE_FORMAT) -> Column:
    """``yyyy-MM-dd`` exactly (no trimming, real calendar days) or NULL."""
    if isinstance(c, str):
        return F.expr(strict_date_sql(quote(c), fmt))
    if fmt != DATE_FORMAT:
        return F.try_to_date(c, fmt)
    shape = ((F.length(c) == 10) & (F.translate(c, "0123456789", "") == "--")
             & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-"))
    return F.when(shape, c.try_cast("date"))


def strict_timestamp(c, fmt: str = DATE_FORMAT) -> Column:
    """text to timestamp with a fixed pattern, NULL when unparsable."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def blank_to_null(c) -> Column:
    """trim blanks; an empty result becomes NULL."""
    t = F.trim(_col(c))
    return F.when(F.length(t) > 0, t)


def is_blank(c) -> Column:
    """NULL or only blanks (never NULL itself)."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")
