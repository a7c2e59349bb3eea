"""Tolerant value readers for loosely typed feed fields.

Feed attributes arrive as JSON of unknown type (a station id may be ``5``,
``"5"`` or ``0``), so decoders keep them as ``VARIANT`` and these helpers
turn them into typed columns with the feeds' truthiness rules:

* a value is *falsy* when it is JSON null/absent, ``""``, ``0``/``0.0``,
  ``false``, ``[]`` or ``{}``;
* ``first_truthy(a, b, ...)`` is the ``a or b or ...`` chain: the first
  truthy value, else the last one as it is.

The JSON kind of a variant is read from the first character of its JSON
text.  All of it is built-in expressions (no Python UDF) and stays small,
because optimiser rewrites (e.g. filter push-down) may inline it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlake.schemas import FALSE_WORDS, TRUE_WORDS

# Decimal, exponent, infinity and not-a-number texts.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_FLOAT_TEXT = (rf"^\s*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
               r"|(?i:inf|infinity|nan))\s*$")
_FALSY_JSON = ["null", '""', "false", "[]", "{}"]


def vfield(obj: Column, name: str) -> Column:
    """Field ``name`` of a variant object (null when absent or not an object)."""
    return F.try_variant_get(obj, f"$.{name}", "variant")


def vdouble(obj: Column, name: str) -> Column:
    """Field ``name`` of a variant object as a tolerant float: numbers as
    they are, text parsed leniently (spaces, exponents, nan, inf), and
    ``""``, ``"null"``, junk, null, objects and arrays -> null."""
    return to_float(vfield(obj, name))


def vjson(v: Column) -> Column:
    return F.to_json(v)


def vstring(v: Column) -> Column:
    """Variant as text: strings as they are, numbers/booleans printed."""
    return F.try_variant_get(v, "$", "string")


def is_text(v: Column) -> Column:
    """The variant holds a JSON string."""
    return F.schema_of_variant(v) == "STRING"


def is_object(v: Column) -> Column:
    """The variant holds a JSON object (a cast to a one-field struct succeeds
    only for objects; nothing is serialised)."""
    return F.try_variant_get(v, "$", "struct<_k:int>").isNotNull()


def is_number(v: Column) -> Column:
    """The variant holds a JSON number."""
    return vjson(v).rlike("^-?[0-9]")


def truthy(v: Column) -> Column:
    """Python truthiness of a JSON value held as variant (never null)."""
    j = vjson(v)
    zero = F.coalesce(~j.startswith('"') & (F.try_variant_get(v, "$", "double") == 0),
                      F.lit(False))
    return F.coalesce(v.isNotNull() & ~j.isin(*_FALSY_JSON) & ~zero, F.lit(False))


def first_truthy(*vals: Column) -> Column:
    """``a or b or c``: first truthy value, else the last value unchanged."""
    out = vals[-1]
    for v in reversed(vals[:-1]):
        out = F.when(truthy(v), v).otherwise(out)
    return out


def to_float(v: Column) -> Column:
    """Tolerant float of a variant (see :func:`vdouble`)."""
    return F.when(F.coalesce(is_text(v), F.lit(False)), text_to_float(vstring(v))) \
        .otherwise(F.try_variant_get(v, "$", "double"))


def text_to_float(s: Column) -> Column:
    """Tolerant float of a text column: null, "", "null", junk -> null; digits
    may be grouped by single underscores, type suffixes and hexadecimal forms
    are junk."""
    return F.when(s.rlike(_FLOAT_TEXT), F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))


def digits_id(v: Column, default: int = -1) -> Column:
    """Integer id when the printed value is all ASCII digits, else ``default``.

    ``5`` and ``"5"`` give 5; ``2.0``, ``7.0``, ``"-5"``, ``"x"``, ``true``
    give the default (the value's printed form must be digits only; a JSON
    number written with a point or exponent is a float, held as DECIMAL or
    DOUBLE, whose printed form never is)."""
    s = vstring(v)
    t = F.schema_of_variant(v)
    # an integer literal beyond BIGINT is held as DECIMAL(19+, 0): still an
    # integer; narrower decimals and doubles were written as floats
    big_integer = t.rlike(r"^DECIMAL\((19|[2-9][0-9]|[1-9][0-9]{2}),0\)")
    fractional = F.coalesce(t.rlike("^(DECIMAL|DOUBLE|FLOAT)") & ~big_integer, F.lit(False))
    return F.when(~fractional & s.rlike("^[0-9]+$"), s.try_cast("int")) \
        .otherwise(F.lit(default)).cast("int")


def strip_ws(s: Column) -> Column:
    """Remove leading/trailing whitespace of any kind (not only spaces)."""
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def to_bool(s: Column) -> Column:
    """Tolerant boolean of text: yes/true/t/1/y and no/false/f/0/n (any case,
    surrounding whitespace ignored); anything else -> null."""
    w = F.lower(strip_ws(s))
    return (F.when(w.isin(*TRUE_WORDS), F.lit(True))
            .when(w.isin(*FALSE_WORDS), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def nonempty(s: Column) -> Column:
    """Null for empty text (``'' -> null``), value otherwise."""
    return F.nullif(s, F.lit(""))
