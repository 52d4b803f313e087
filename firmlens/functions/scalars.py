"""Scalar column functions.

All of them return ``Column`` expressions built from Spark's own functions, so they run
inside whole-stage code generation; none is a Python UDF. Spark 4 runs in ANSI mode, where
plain ``to_date`` / ``cast`` raise on bad input: the lenient forms use the ``try_*`` family.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.column import Column as _Col

from ..fixed import CODE_LABEL_SEP, MISSING, PLACE_PREFIX_RULES, PLACE_SEPARATORS, POSTAL_LENGTH

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return c if isinstance(c, _Col) else F.col(c)


def lenient_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Text → date; unparsable text becomes null instead of failing the job."""
    return F.try_to_date(_c(c), F.lit(fmt)) if fmt else F.try_to_date(_c(c))


# plain decimal numbers, with an optional exponent and blanks around
NUMBER = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def lenient_double(c: ColumnOrName) -> Column:
    """Text or number → double; null for anything that is no plain decimal number (``NaN``,
    ``Infinity`` and suffixed numbers like ``1d`` included) or beyond the double range."""
    text = _c(c).cast("string")
    value = F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def postal_or_null(c: ColumnOrName, length: int = POSTAL_LENGTH) -> Column:
    """Keep the code as text only when it is exactly ``length`` characters long."""
    s = _c(c).cast("string")
    return F.when(F.length(s) == length, s)


def default_from(c: ColumnOrName, fallback: ColumnOrName) -> Column:
    """C4: value, or the other column where it is null."""
    return F.coalesce(_c(c), _c(fallback))


def year_of(c: ColumnOrName) -> Column:
    """Calendar year of a date (null stays null)."""
    return F.year(_c(c))


def address_line(parts: list[ColumnOrName], sep: str = " ", default: str = MISSING) -> Column:
    """Join the non-blank parts with ``sep``; ``default`` when every part is blank.

    A part counts when it is not null and not blank after trimming; it is kept as it is
    (untrimmed). Nulls are skipped instead of printed (the reference printed ``nan``).
    """
    kept = [F.when(F.trim(_c(p).cast("string")) != "", _c(p).cast("string")) for p in parts]
    line = F.concat_ws(sep, *kept)
    return F.coalesce(F.nullif(line, F.lit("")), F.lit(default))


def normalize_place(c: ColumnOrName) -> Column:
    """Upper case; hyphens and apostrophes → space; runs of spaces → one; trim; then
    the prefix rules (every ``MARSEILLE…`` → ``MARSEILLE``, every ``AIX EN PROVENCE…`` →
    ``AIX-EN-PROVENCE``)."""
    s = F.upper(_c(c))
    s = F.regexp_replace(s, "[" + PLACE_SEPARATORS + "]", " ")
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    out = None
    for prefix, name in PLACE_PREFIX_RULES:
        out = (F.when if out is None else out.when)(s.startswith(prefix), F.lit(name))
    return out.otherwise(s)


def code_label(code: ColumnOrName, label: ColumnOrName, sep: str = CODE_LABEL_SEP) -> Column:
    """``code - label`` display text."""
    return F.concat(_c(code), F.lit(sep), _c(label))


def code_of(c: ColumnOrName, sep: str = CODE_LABEL_SEP) -> Column:
    """The code part of ``code - label`` (text before the first separator)."""
    return F.substring_index(_c(c), sep, 1)


def label_of(c: ColumnOrName, sep: str = CODE_LABEL_SEP) -> Column:
    """The label part: everything after the first separator (a label may itself
    contain the separator), empty when there is none."""
    pos = F.instr(_c(c), sep)
    rest = _c(c).substr(pos + F.lit(len(sep)), F.length(_c(c)))
    return F.when(pos > 0, rest).otherwise(F.lit(""))


def growth_pct(recent: ColumnOrName, past: ColumnOrName) -> Column:
    """(recent - past) / past * 100; null when the past value is null or zero
    (ANSI mode would raise on /0; the reference kept ±inf — a documented deviation)."""
    r, p = _c(recent), _c(past)
    return F.when(p != 0, (r - p) / p * 100)


def or_default(c: ColumnOrName, default: str = MISSING) -> Column:
    """C11: the value as text, or ``default`` when null."""
    return F.coalesce(_c(c).cast("string"), F.lit(default))


def money(c: ColumnOrName, scale: int = 2) -> Column:
    """Amount as an exact decimal, so sums do not depend on the order of addition.

    Amounts are rounded to ``scale`` digits (cents). One that is not finite or needs more than
    28 digits is null instead of failing the job; ``money_rejects`` counts those."""
    return _c(c).try_cast(f"decimal(28,{scale})")


def money_rejects(c: ColumnOrName, scale: int = 2) -> Column:
    """Aggregate: how many non-null amounts ``money`` cannot hold."""
    return F.count(F.when(_c(c).isNotNull() & money(c, scale).isNull(), 1))


def money_sum(c: ColumnOrName, scale: int = 2) -> Column:
    """Exact sum of amounts (decimal), returned as double; null when all are null."""
    return F.sum(money(c, scale)).cast("double")


def money_mean(c: ColumnOrName, scale: int = 2) -> Column:
    """Mean of the non-null amounts: exact decimal sum over the count, as double."""
    return F.sum(money(c, scale)).cast("double") / F.count(money(c, scale))
