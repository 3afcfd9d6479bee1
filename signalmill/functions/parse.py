"""Lenient parsers of numbers, lists, booleans and dates, as column expressions.

ANSI mode is on, so every cast that may fail is a ``try_`` form behind a pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
#: Patterns of dates with and without a time, tried in this order.
DATE_FORMATS = ("M/d/yyyy h:mm a", "M/d/yyyy HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy")


def strip(c: Column) -> Column:
    """Without white space at the ends, in the Unicode sense."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _number(c: Column) -> Column:
    plain = F.regexp_replace(c, ",", "")
    return F.when(plain.rlike(NUMBER), F.trim(plain).try_cast("double"))


def facility_number(c: Column) -> Column:
    """Thousands separators dropped; null, blank and what is no number are 0."""
    return F.coalesce(_number(c), F.lit(0.0))


def generator_number(c: Column) -> Column:
    """Blank is null; what is no number is 0."""
    plain = c.cast("string")
    return F.when(plain.isNull() | (F.trim(plain) == ""), F.lit(None).cast("double")).otherwise(F.coalesce(F.when(plain.rlike(NUMBER), F.trim(plain).try_cast("double")), F.lit(0.0)))


def number_or_zero(c: Column) -> Column:
    """Null and NaN are 0."""
    return F.coalesce(F.nanvl(c.cast("double"), F.lit(None).cast("double")), F.lit(0.0))


def integer_or_zero(c: Column) -> Column:
    """A number cut off toward zero; what is none is 0."""
    return F.coalesce(F.when(c.rlike(NUMBER), F.trim(c).try_cast("double")), F.lit(0.0)).cast("int")


def null_if_nan(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def is_true(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c)) == "true", F.lit(False))


def _split_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.regexp_replace(c, r'[\[\]"]', ""), ","), strip), lambda x: x != "")


def _json_items(c: Column) -> Column:
    """The items of a JSON list, or the one item of a JSON scalar; null if it is neither."""
    text = strip(c)
    scalar = F.when(text.rlike(r'^"[^"]*"$'), F.array(F.substring(text, 2, 1_000_000).substr(F.lit(1), F.length(text) - 2))).when(text.rlike(NUMBER), F.array(text))
    return F.when(text.rlike(r"(?s)^\[.*\]$"), F.from_json(text, "array<string>")).otherwise(scalar)


def facility_list(c: Column) -> Column:
    """A JSON list (or scalar) without empty items; other text is cut at commas; blank is an empty list."""
    items = F.filter(F.transform(_json_items(c), strip), lambda x: x.isNotNull() & (x != "") & ~x.isin("0", "false"))
    empty = F.array().cast("array<string>")
    return F.when(c.isNull() | (strip(c) == ""), empty).otherwise(F.coalesce(items, _split_list(c), empty))


def article_list(c: Column) -> Column:
    """As ``facility_list``, but a null item of a list stays as ``None``, and the words ``None``, ``nan`` and ``[]`` are empty lists."""
    items = F.filter(F.transform(_json_items(c), lambda x: F.coalesce(strip(x), F.lit("None"))), lambda x: x != "")
    empty = F.array().cast("array<string>")
    return F.when(c.isNull() | strip(c).isin("", "[]", "None", "nan"), empty).otherwise(F.coalesce(items, _split_list(c), empty))


def issue_list(c: Column) -> Column:
    """Facility ids of an issue's stories: the items of a JSON list as text, blank ones left out; other text is cut at commas and keeps brackets and quotes.

    A JSON text is cut into its characters, as a list of them, and a JSON object gives its keys; ``nan``, ``None`` and ``[]`` are empty lists.
    """
    text = strip(c)
    listed = F.when(text.rlike(r"(?s)^\[.*\]$"), F.transform(F.from_json(text, "array<string>"), lambda x: F.coalesce(x, F.lit("None"))))
    lettered = F.when(text.rlike(r'(?s)^"([^"\\]|\\.)*"$'), F.split(F.from_json(F.concat(F.lit('{"x":'), text, F.lit("}")), "x string")["x"], ""))
    keyed = F.when(text.rlike(r"(?s)^\{.*\}$"), F.map_keys(F.from_json(text, "map<string, string>")))
    items = F.coalesce(listed, lettered, keyed, F.split(text, ","))
    empty = F.array().cast("array<string>")
    return F.when(c.isNull() | text.isin("", "[]", "None", "nan"), empty).otherwise(F.filter(F.transform(items, strip), lambda x: x != ""))


def encode_list(c: Column) -> Column:
    return F.to_json(c)


def joined_list(c: Column) -> Column:
    return F.array_join(c, "; ")


def any_date(c: Column) -> Column:
    """A timestamp by the first of DATE_FORMATS that fits; null without one."""
    text = strip(c)
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS)).cast("timestamp_ntz")


def feed_date(now: Column, *fields: Column) -> Column:
    """The first field that is a mail date, else ``now``, in UTC as MM/dd/yyyy hh:mm AM. Other date forms count as none."""
    def parsed(c: Column) -> Column:
        return F.try_to_timestamp(F.regexp_replace(strip(c), r"^[A-Za-z]{3},\s*", ""), F.lit("d MMM yyyy HH:mm:ss Z"))

    return F.date_format(F.coalesce(*(parsed(f) for f in fields), now), "MM/dd/yyyy hh:mm a")


def day_label(c: Column) -> Column:
    return F.date_format(c, "MMM d, yyyy")


def first_status(items: Column, valid: tuple[str, ...], unknown: str) -> Column:
    """The first item that is a valid status."""
    return F.coalesce(F.get(F.filter(items, lambda x: x.isin(*valid)), F.lit(0)), F.lit(unknown))


def first_type(items: Column, default: str) -> Column:
    return F.coalesce(F.nullif(strip(F.get(items, F.lit(0))), F.lit("")), F.lit(default))
