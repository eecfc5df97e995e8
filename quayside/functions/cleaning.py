"""Column-level cleaning and parsing rules.

All functions return Columns built from Spark built-ins, so they stay inside
whole-stage codegen. The rules follow Python's ``str.strip``/``float``/``int``
grammar, which is what the raw feeds were validated against:

* ``clean``: strip every Unicode whitespace character, empty -> NULL
  (``trim`` alone only strips spaces).
* ``parse_bool``: true/1/yes and false/0/no in any case; NULL stays NULL;
  anything else is an error (``cast('t' as boolean)`` would be true).
* ``parse_float``/``parse_int``: a regex guard keeps Spark's cast from accepting
  '1d' or rejecting '1_000'; anything outside the grammar is an error.

* ``parse_timestamp``: ISO date, or date and time to minutes or more, without an
  offset (which TIMESTAMP_NTZ would silently drop); partial dates are an error.

With ``strict=False`` invalid values become NULL instead of failing the job, and
:class:`Fields` describes them, so that the row can go to quarantine with its reasons.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the whitespace set of Python's str.isspace(), derived by rule so
# it stays exact (tabs, newlines, \x1c-\x1f, NBSP, the U+2000 block, ...).
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Accepted boolean spellings (after strip + lowercase).
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")

# Python float()/int() grammar, with '_' allowed only between digits.
_DIGITS = r"\d(?:_?\d)*"
FLOAT_PATTERN = (rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
                 r"|(?i:inf|infinity|nan))$")
INT_PATTERN = rf"^[+-]?{_DIGITS}$"
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?$"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
# What nearly all numbers look like (\z: ``$`` would let a line end through).
PLAIN_INTEGER, PLAIN_NUMBER = r"^[+-]?\d+\z", r"^[+-]?\d+(?:\.\d+)?\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip(c) -> Column:
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def clean(c) -> Column:
    """strip() then empty -> NULL. Nearly all texts begin and end with a printable ASCII character: these are
    returned as they are, since a strip looks its whole set up for either end."""
    text = _col(c).cast("string")
    plain = F.ascii(text).between(33, 126) & F.ascii(F.substring(text, -1, 1)).between(33, 126)
    return F.when(plain, text).when(text != "", F.nullif(_strip(text), F.lit("")))


def lower_clean(c) -> Column:
    return F.lower(clean(c))


def upper_or_empty(c) -> Column:
    """``(clean(x) or '').upper()``: missing becomes '' rather than NULL."""
    return F.upper(F.coalesce(clean(c), F.lit("")))


def _fail(message: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(message), value))


def parse_bool(c, strict: bool = True) -> Column:
    text, v = _col(c).cast("string"), F.lower(_strip(c))
    bad = _fail("invalid boolean: ", v) if strict else F.lit(None)
    return (F.when(text.isin(*TRUE_WORDS, "True"), F.lit(True))
            .when(text.isin(*FALSE_WORDS, "False"), F.lit(False))
            .when(v.isin(*TRUE_WORDS), F.lit(True))
            .when(v.isin(*FALSE_WORDS), F.lit(False))
            .when(v != "", bad.cast("boolean")))


def _parse(c, pattern: str, target: str, label: str, strict: bool, drop: str = "", plain: str | None = None) -> Column:
    """``plain``: texts of this form need neither a strip nor the ``drop``, and are cast as they are."""
    raw, v = _col(c).cast("string"), _strip(c)
    text = F.regexp_replace(v, drop, "") if drop else v
    to = lambda x: x.cast(target) if strict else x.try_cast(target)
    bad = _fail(f"invalid {label}: ", v) if strict else F.lit(None)
    return (F.when(raw.rlike(plain or rf"{pattern[:-1]}\z"), to(raw))
            .when(raw == "", F.lit(None).cast(target))
            .when(v.rlike(pattern), to(text))
            .when(v != "", bad.cast(target)))


def parse_float(c, strict: bool = True) -> Column:
    return _parse(c, FLOAT_PATTERN, "double", "number", strict, "_", PLAIN_NUMBER)


def parse_decimal(c, precision: int = 18, scale: int = 2, strict: bool = True) -> Column:
    return _parse(c, FLOAT_PATTERN, f"decimal({precision},{scale})", "number", strict, "_", PLAIN_NUMBER)


def parse_int(c, target: str = "int", strict: bool = True) -> Column:
    return _parse(c, INT_PATTERN, target, "integer", strict, "_", PLAIN_INTEGER)


def parse_timestamp(c, strict: bool = True) -> Column:
    """ISO text -> TIMESTAMP_NTZ (no session-zone shift)."""
    return _parse(c, ISO_PATTERN, "timestamp_ntz", "timestamp", strict)


def parse_date(c, strict: bool = True) -> Column:
    return _parse(c, DATE_PATTERN, "date", "date", strict)


ERROR_TYPE = "array<struct<column:string,rule:string,text:string>>"


class Fields:
    """The typed columns of a raw feed. Strict, an invalid value fails the job. Lenient, it is
    NULL and ``errors`` gets (column, rule, text) for it, all in one projection."""

    def __init__(self, df, strict: bool):
        self.types, self.strict, self.found = dict(df.dtypes), strict, []

    def _noted(self, name: str, rule: str, parsed: Column) -> Column:
        if not self.strict:
            text = clean(name)
            wrong = text.isNotNull() & parsed.isNull()
            self.found.append(F.when(wrong, F.struct(F.lit(name).alias("column"), F.lit(rule).alias("rule"), text.alias("text"))))
        return parsed

    def boolean(self, name: str) -> Column:
        return self._noted(name, "boolean", parse_bool(name, self.strict))

    def number(self, name: str) -> Column:
        return self._noted(name, "number", parse_float(name, self.strict))

    def decimal(self, name: str, precision: int = 18, scale: int = 2) -> Column:
        return self._noted(name, "number", parse_decimal(name, precision, scale, self.strict))

    def integer(self, name: str, target: str = "int") -> Column:
        return self._noted(name, "integer", parse_int(name, target, self.strict))

    def timestamp(self, name: str) -> Column:
        if self.types.get(name) != "string":  # typed by the source
            return F.col(name).cast("timestamp_ntz")
        return self._noted(name, "timestamp", parse_timestamp(name, self.strict))

    def date(self, name: str) -> Column:
        if self.types.get(name) != "string":
            return F.col(name).cast("date")
        return self._noted(name, "date", parse_date(name, self.strict))

    def errors(self, required=()) -> list[Column]:
        """The ``_errors`` column of a lenient projection; ``required`` columns that are missing are errors too."""
        if self.strict:
            return []
        missing = [F.when(clean(c).isNull(), F.struct(F.lit(c).alias("column"), F.lit("missing").alias("rule"),
                                                      F.lit("").alias("text"))) for c in required]
        every = F.array(*self.found, *missing) if self.found or missing else F.array()
        return [F.filter(every.cast(ERROR_TYPE), lambda e: e.isNotNull()).alias("_errors")]
