"""Column functions that clean, convert and classify single values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\x0b"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
YEAR = r"((?:18|19|20)\d{2})"

# Dates as patterns whose group is the year. Reading the year this way costs one match,
# while a parser would throw for every text it cannot read. Day comes first. Years are
# those a nanosecond timestamp can hold in full, 1678 to 2261.
_DATE_YEAR = r"(167[89]|16[89]\d|1[7-9]\d\d|2[01]\d\d|22[0-5]\d|226[01])"
_DAY_MONTH = (
    r"(?:(?:0?[1-9]|[12]\d)[-/.](?:0?[1-9]|1[0-2])|30[-/.](?:0?[13-9]|1[0-2])|31[-/.](?:0?[13578]|1[02]))"
)
_TIME = r"(?:[T ]\d{1,2}:\d{2}.*)?"
_YEAR_FIRST = _DATE_YEAR + r"(?:[-/.](?:0?[1-9]|1[0-2])[-/.](?:0?[1-9]|[12]\d|3[01])" + _TIME + ")?"
_YEAR_LAST = _DAY_MONTH + "[-/.]" + _DATE_YEAR + _TIME
LONG_DATE = f"^(?:{_YEAR_FIRST}|{_YEAR_LAST})$"
SHORT_DATE = "^" + _DAY_MONTH + r"[-/.](\d{2})$"
# Fixed value: two-digit years from 69 on belong to the last century.
CENTURY_PIVOT = 69


def once(value: Column, body) -> Column:
    """``body(value)`` with the value worked out a single time.

    Spark shares repeated expressions in generated code only; the array functions used
    here are interpreted and would otherwise build a geometry anew for every mention. Code generated for a
    long expression can also outgrow what the JVM compiles; this keeps it short.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim_text(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(BLANKS))


def nullify(c: Column, tokens: Sequence[str]) -> Column:
    """Null where the text is exactly one of the tokens."""
    return F.when(~c.isin(list(tokens)), c)


def finite(c: Column) -> Column:
    """Null for NaN and the infinities, which would otherwise compare as large numbers."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def to_double(c: Column) -> Column:
    """Number in a text, else null. Type suffixes such as ``5d`` are no numbers."""
    text = trim_text(c)
    number = text.try_cast("double")
    return F.when(text.rlike(NUMBER) & (F.abs(number) < float("inf")), number)


def none_if(c: Column, value) -> Column:
    """Null where the column has the value.

    Written as a condition: Spark's own ``nullif`` is rewritten through an extra
    projection, which costs more and hinders code generation inside conditions.
    """
    return F.when(c != F.lit(value), c)


def zero_to_null(c: Column) -> Column:
    return none_if(c, 0.0)


def within(c: Column, low=None, high=None, low_open=False, high_open=False) -> Column:
    """The value if it lies in the range, else null."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & ((c > low) if low_open else (c >= low))
    if high is not None:
        ok = ok & ((c < high) if high_open else (c <= high))
    return F.when(ok, c)


def clip_low(c: Column, low: float) -> Column:
    """Lower bound that leaves null alone (``greatest`` alone would not)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


def clip_range(c: Column, low: Column, high: Column) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


def log_length(c: Column) -> Column:
    return F.log1p(clip_low(c, 0.0))


def normalize_number_text(c: Column, tokens: Sequence[str]) -> Column:
    """Shortest text of a number: ``000000200`` to ``200``, ``9.5600`` to ``9.56``."""
    return number_text(trim_text(c), to_double(c), tokens)


def number_text(text: Column, number: Column, tokens: Sequence[str]) -> Column:
    """``normalize_number_text`` from a trimmed text and the number it holds, if any."""
    whole = number.cast("decimal(38,0)").cast("string")
    fraction = F.rtrim(
        F.rtrim(F.round(number, 6).cast("decimal(28,6)").cast("string"), F.lit("0")), F.lit(".")
    )
    return (
        F.when(text.isin(list(tokens)) | number.isNull(), text)
        .when(number == F.floor(number), whole)
        .otherwise(fraction)
    )


def file_stem(path: Column) -> Column:
    """Lower-case file name without folder and extension."""
    name = F.regexp_replace(path, r"^.*/", "")
    return F.lower(F.regexp_replace(name, r"\.[^.]*$", ""))


def _whole(digits: Column) -> Column:
    """Number of an extracted group; null where nothing was extracted, without a failed cast, which costs an exception."""
    return none_if(digits, "").try_cast("int")


def year_in_text(c: Column) -> Column:
    return _whole(F.regexp_extract(c, YEAR, 1))


def install_year(c: Column, tokens: Sequence[str]) -> Column:
    """Year of a date text in mixed formats, else the first plausible year in the text."""
    return year_of_date(nullify(trim_text(c), tokens))


def year_of_date(text: Column) -> Column:
    """``install_year`` of a text already trimmed and free of null tokens."""

    def year(t: Column) -> Column:
        # Only one of the two groups takes part in a match, so both together are the year.
        long = F.when(t.rlike(LONG_DATE), F.regexp_replace(t, LONG_DATE, "$1$2").try_cast("int"))
        short = _whole(F.regexp_extract(t, SHORT_DATE, 1))
        century = F.pmod(short + (100 - CENTURY_PIVOT), F.lit(100)) + (1900 + CENTURY_PIVOT)
        return F.coalesce(long, century, year_in_text(t))

    return once(text, year)


def flag_text(pieces: Sequence[tuple[Column, str]]) -> Column:
    """Concatenate the texts of the conditions that hold, in the given order."""
    return F.concat(*[F.when(cond, F.lit(text)).otherwise(F.lit("")) for cond, text in pieces])


def label_of(c: Column, mapping: Mapping) -> Column:
    """Label of a code; null for a code without one."""
    out = None
    for code, label in mapping.items():
        out = (F if out is None else out).when(c == F.lit(code), F.lit(label))
    return out


def mean_strict(a: Column, b: Column) -> Column:
    """Mean of two values, null if either is missing."""
    return (a + b) / 2


def mean_skip_null(*cols: Column) -> Column:
    """Mean over the values present."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols[1:]), F.coalesce(cols[0], F.lit(0.0)))
    present = sum((c.isNotNull().cast("int") for c in cols[1:]), cols[0].isNotNull().cast("int"))
    return F.when(present > 0, total / present)


def cut(c: Column, edges: Sequence[float], labels: Sequence[str], right: bool) -> Column:
    """Class label by sorted edges with open ends; intervals closed left or right."""
    if len(labels) != len(edges) + 1:
        raise ValueError(f"{len(labels)} labels for {len(edges) + 1} intervals")
    out = None
    for edge, label in zip(edges, labels):
        out = (F if out is None else out).when(c <= edge if right else c < edge, F.lit(label))
    return F.when(c.isNotNull(), out.otherwise(F.lit(labels[-1])))


def recode_state(c: Column, level: str) -> Column:
    """Condition state 1..4 as the zero-based class of a level."""
    valid = F.when(c.isin(1, 2, 3, 4), c.cast("int"))
    if level == "niveau_1_multiclasse":
        return valid - 1
    if level == "niveau_2_isolation_4":
        return (valid == 4).cast("int")
    if level == "niveau_3_bon_vs_degrade":
        return (valid >= 3).cast("int")
    raise ValueError(f"unknown level {level}")


def present_share(cols: Sequence[Column]) -> Column:
    """Share of the columns that hold a value in this row."""
    total = sum((c.isNotNull().cast("int") for c in cols[1:]), cols[0].isNotNull().cast("int"))
    return total / F.lit(float(len(cols)))
