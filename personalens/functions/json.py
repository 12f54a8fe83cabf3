"""JSON column helpers (JS-1..6).

JSON arrives as STRING text. Arrays of strings are parsed to
``array<string>`` and arrays of objects or mixed elements to
``array<variant>``; both parsers return NULL for anything that is not an
array, which is the guard the models need. All work stays inside Spark's
expressions: no Python per row.

Texts of elements are those of the reports' JSON type: keys by length, then
by bytes, the last of a repeated key, one space after ':' and ',', numbers in
plain decimal form with the scale they were written in. Spark's own parsers
read numbers into binary or stripped decimals, so numbers are wrapped as strings (a
NUL, which that JSON type doesn't allow, then their text) before parsing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An array written as a JSON *string* (double-encoded), e.g. "\"[1,2]\"".
_BRACKETED = r"(?s)^\[.*\]\z"

# An object that repeats a key keeps its last value, as the reports' JSON type
# does; without this setting Spark gives NULL for the whole array.
JSON_CONF = {"spark.sql.variant.allowDuplicateKeys": "true"}


def keep_last_of_repeated_keys(df: DataFrame) -> DataFrame:
    """df, its session set to JSON_CONF (a session the library didn't build lacks it)."""
    for key, value in JSON_CONF.items():
        df.sparkSession.conf.set(key, value)
    return df


# Texts nest so many levels in the reports' form; what lies deeper is in Spark's compact form.
MAX_DEPTH = 8

_NUL = "\x00"
# Raw control characters are not valid inside JSON: they stand for a number's start and end, escaped backslashes and escaped quotes.
_OPEN, _BACKSLASH, _QUOTE, _CLOSE = "\x01", "\x02", "\x03", "\x04"
_STRING_OR_NUMBER = r'("[^"]*+")|(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+(?!\s*:))'
# A number stands at the start or after '[', ',', ':' or a space; text without such a digit has none (single quotes may hide one).
_MAY_HOLD_NUMBER = r"(?:^|[\[,:\s])-?[0-9]|'"
# Digits a shifted number may get; numbers with larger exponents keep their written form.
_LARGEST_SHIFT = 20_000


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _numbers_as_strings(c: Column) -> Column:
    """JSON text whose numbers are strings of NUL and the number in plain decimal form."""
    t = F.replace(F.replace(c, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    t = F.replace(F.regexp_replace(t, _STRING_OR_NUMBER, f"$1{_OPEN}$2{_CLOSE}"), F.lit(_OPEN + _CLOSE), F.lit(""))
    t = _let(t, _wrapped)
    t = F.replace(F.replace(t, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    return F.when(~c.rlike(_MAY_HOLD_NUMBER) | c.rlike(f"[{_OPEN}-{_CLOSE}]"), c).otherwise(t)


def _wrapped(t: Column) -> Column:
    """Marked numbers as strings; only where one has an exponent or is zero with a sign are they taken one by one."""
    plain = F.regexp_replace(t, f"{_OPEN}([^{_CLOSE}]*+){_CLOSE}", r'"\\u0000$1"')
    # Text and numbers take turns once opening marks are closing ones too.
    parts = F.split(F.replace(t, F.lit(_OPEN), F.lit(_CLOSE)), _CLOSE)
    shifted = F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 0, x).otherwise(
        F.concat(F.lit(r'"\u0000'), _plain_number(x), F.lit('"')))), "")
    return F.when(t.rlike(f"{_OPEN}(?:-0|[^{_CLOSE}]*[eE])"), shifted).otherwise(plain)


def _elements(c: Column) -> Column:
    return F.from_json(_numbers_as_strings(c), "array<variant>")


def _plain_number(t: Column) -> Column:
    """A JSON number in plain decimal form: no exponent, no negative zero, scale kept."""
    size = F.when(t.rlike("[eE]"), _shifted(t)).otherwise(F.ltrim(t, F.lit("-")))
    return F.when(t.startswith("-") & t.rlike("^[^eE]*[1-9]"), F.concat(F.lit("-"), size)).otherwise(size)


def _shifted(t: Column) -> Column:
    """A number with an exponent, without its sign and exponent."""
    whole, frac = F.regexp_extract(t, r"^-?([0-9]+)", 1), F.regexp_extract(t, r"\.([0-9]+)", 1)
    shift = F.regexp_extract(t, r"[eE]([+-]?[0-9]+)", 1).try_cast("int")
    right = F.rpad(frac, F.greatest(F.length(frac), shift), "0")
    left = F.lpad(whole, F.greatest(F.length(whole), 1 - shift), "0")
    up = F.concat_ws(".", F.concat(whole, F.substring(right, F.lit(1), shift)),
                     F.nullif(F.substring(right, shift + 1, F.length(right)), F.lit("")))
    down = F.concat(F.substring(left, F.lit(1), F.length(left) + shift), F.lit("."),
                    F.substring(left, F.length(left) + shift + 1, -shift), frac)
    moved = F.regexp_replace(F.when(shift >= 0, up).otherwise(down), r"^0+(?=[0-9])", "")
    return F.when(F.abs(shift) <= _LARGEST_SHIFT, moved).otherwise(F.ltrim(t, F.lit("-")))


def _entries(v: Column) -> Column:
    """(key, value) of an object, keys by length and bytes; (NULL, value) of an array; else NULL."""
    def order(a, b):
        x, y = F.octet_length(a["key"]), F.octet_length(b["key"])
        return F.when(x != y, x - y).when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)

    pairs = F.array_sort(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), order)
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"),
                        lambda x: F.struct(F.lit(None).cast("string").alias("key"), x.alias("value")))
    return F.coalesce(pairs, items)


def _nested(v: Column, depth: int) -> Column:
    """Text of a value, numbers still as marked strings."""
    if not depth:
        return F.to_json(v)
    kind = F.schema_of_variant(v)
    obj = kind.startswith("OBJECT")
    inner = F.array_join(F.transform(_entries(v), lambda e: F.concat(_key(e["key"]), _nested(e["value"], depth - 1))), ", ")
    return (F.when(obj | kind.startswith("ARRAY"), F.concat(F.when(obj, "{").otherwise("["), inner, F.when(obj, "}").otherwise("]")))
            .otherwise(F.to_json(v)))


def _key(k: Column) -> Column:
    """A key as a JSON string and a colon; nothing for elements of arrays."""
    listed = F.to_json(F.array(k))
    return F.when(k.isNull(), "").otherwise(F.concat(F.substring(listed, F.lit(2), F.length(listed) - 2), F.lit(": ")))


def _json_text(v: Column) -> Column:
    """JSON text: numbers unwrapped, escapes of control characters in lower case."""
    t = F.regexp_replace(_nested(v, MAX_DEPTH), r'"\\u0000([^"]*+)"', "$1")
    low = F.replace(t, F.lit("\\\\"), F.lit(_BACKSLASH))
    for code in ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F"):
        low = F.replace(low, F.lit(f"\\u00{code}"), F.lit(f"\\u00{code.lower()}"))
    return F.when(t.contains("\\u00"), F.replace(low, F.lit(_BACKSLASH), F.lit("\\\\"))).otherwise(t)


def _text(v: Column) -> Column:
    """Strings as they are, numbers as written, JSON null as NULL, other values as JSON."""
    kind = F.schema_of_variant(v)
    return (F.when(kind == "STRING", F.ltrim(F.try_variant_get(v, "$", "string"), F.lit(_NUL)))
            .when(kind != "VOID", _json_text(v)))


def text_elements(col) -> Column:
    """Elements of a JSON array as text (strings unquoted, other values as JSON).

    NULL when the value is NULL, malformed or not an array; JSON null
    elements become NULL.
    """
    c = _c(col)
    bare = F.regexp_replace(F.replace(F.replace(c, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit("")), '"[^"]*+"', "")
    plain = F.from_json(c, "array<string>")  # exact where all elements are strings, true, false or null
    return F.when(bare.rlike(r"[0-9{]|\[[^\[]*\["), F.coalesce(F.transform(_elements(c), _text), plain)).otherwise(plain)


def variant_elements(col, double_encoded: bool = False) -> Column:
    """Elements of a JSON array as VARIANT values, to be read by the functions below.

    With ``double_encoded`` a JSON string whose content is an array (text such
    as ``"[{\\"a\\":1}]"``) is unescaped and parsed as that array.
    """
    c = _c(col)
    direct = _elements(c)
    if not double_encoded:
        return direct
    parsed = F.try_parse_json(c)
    inner = F.when(F.schema_of_variant(parsed) == F.lit("STRING"),
                   F.try_variant_get(parsed, "$", "string"))
    unwrapped = F.when(inner.rlike(_BRACKETED), _elements(inner))
    return F.coalesce(direct, unwrapped)


def field_texts(element: Column, keys: list[str]) -> Column:
    """Texts of keys of a JSON object, as an array; NULL for JSON null, a missing key or a
    non-object element."""
    return F.transform(F.array(*[F.try_variant_get(element, f"$.{k}", "variant") for k in keys]), _text)


def field_text(element: Column, key: str) -> Column:
    """Text of one key of a JSON object, see :func:`field_texts`."""
    return F.element_at(field_texts(element, [key]), 1)


def element_json(element: Column) -> Column:
    """The JSON text of an element: strings keep their quotes."""
    return _json_text(element)


def is_object(element: Column) -> Column:
    return F.try_variant_get(element, "$", "map<string,variant>").isNotNull()
