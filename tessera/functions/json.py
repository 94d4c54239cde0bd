"""JSON, cast and time functions over document text.

All helpers return ``Column`` expressions built from Spark built-ins, so
they stay inside whole-stage codegen and can be pushed around by Catalyst.
The payload is kept as JSON *text* (never Variant in storage): parsing to
Variant rewrites numbers (``65000.0`` -> ``65000``) and would change what a
strict integer cast accepts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What text a strict cast reads as a number (Spark alone also
# takes Java's type suffixes: '1.5d', '2f', '3L').
_FLOAT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
_INTEGER = r"^\s*[+-]?\d+\s*$"
# Fixed value: the ISO date prefix a "safe" timestamp must start with.
_ISO_DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_kind(payload: Column | str, path: str) -> Column:
    """Type name of the value at ``path`` ('OBJECT<…>', 'ARRAY<…>', 'STRING', …);
    NULL when the path is missing or the text is not JSON."""
    v = F.try_variant_get(F.try_parse_json(_col(payload)), path, "variant")
    return F.schema_of_variant(v)


def json_value(payload: Column | str, path: str, scalar_guard: bool = True) -> Column:
    """SQL/JSON ``JSON_VALUE``: the scalar at ``path`` as text.

    Missing path, JSON null, object or array -> NULL. ``get_json_object``
    alone returns JSON text for objects/arrays; the guard asks the parsed
    value for its kind instead of trusting the first character (a string
    ``"[x"`` is a scalar). The probe parses the document again, so it only
    runs when the text *could* be a container (starts with ``{`` or ``[``);
    it sits in a CASE branch, which subexpression elimination leaves lazy.
    """
    p = _col(payload)
    text = F.get_json_object(p, path)
    if not scalar_guard:
        return text
    container = json_kind(p, path).rlike("^(OBJECT|ARRAY)")
    probe = F.when(container, F.lit(None).cast("string")).otherwise(text)
    return F.when(_may_be_container(text), probe).otherwise(text)


def _may_be_container(text: Column) -> Column:
    head = F.substring(text, 1, 1)
    return (head == "{") | (head == "[")


def cast_number(text: Column | str, to: str) -> Column:
    """The number that ``text`` spells, NULL for any other text."""
    t = _col(text)
    pattern = _FLOAT if to in ("double", "float") else _INTEGER
    return F.when(t.rlike(pattern), t.try_cast(to))


def strict_cast(text: Column | str, to: str) -> Column:
    """``CAST(x AS FLOAT64/INT64)``: bad text fails the query (ANSI cast).

    Uses ``raise_error`` on the offending row rather than relying on the
    session's ANSI flag, so the semantics do not depend on configuration.
    """
    t = _col(text)
    casted = cast_number(t, to)
    return F.when(t.isNotNull() & casted.isNull(),
                  F.raise_error(F.concat(F.lit(f"cannot cast to {to}: "), t))
                  ).otherwise(casted)


def safe_timestamp(text: Column | str) -> Column:
    """``SAFE.TIMESTAMP(x)``: ISO text -> timestamp, anything else -> NULL.

    Spark alone is too kind ('2026', '12:00' parse); require a full date
    first (H5).
    """
    t = _col(text)
    return F.when(t.rlike(_ISO_DATE_PREFIX), t.try_cast("timestamp"))


def string_array(payload: Column | str, path: str) -> Column:
    """``ARRAY(SELECT c FROM UNNEST(JSON_EXTRACT_STRING_ARRAY(p, path)) c WHERE c IS NOT NULL)``.

    Not an array / missing -> empty array; null items dropped (F5+F6).
    A JSON string at the path is not an array even if it parses as one, so
    the kind probe decides, not the text.
    """
    p = _col(payload)
    raw = F.get_json_object(p, path)
    # only text starting with "[" can be an array; the kind probe then tells
    # an array from a string holding array-like text
    is_array = F.when(F.substring(raw, 1, 1) == "[", json_kind(p, path).startswith("ARRAY"))
    arr = F.when(is_array, F.from_json(raw, "array<string>"))
    return F.coalesce(F.array_compact(arr), F.array().cast("array<string>"))


def iso_utc(ts: Column | str) -> Column:
    """Python ``datetime.isoformat()`` of a UTC instant: ``+00:00`` offset,
    microseconds only when non-zero (S5). Session zone must be UTC."""
    t = _col(ts)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(t.cast("timestamp")), F.lit(1_000_000))
    frac = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit(""))
    return F.concat(whole, frac, F.lit("+00:00"))


def is_single_json_document(text: Column | str) -> Column:
    """True iff the text is exactly one JSON value.

    ``try_parse_json`` accepts trailing garbage, so two wrappers are used:
    as the only item of an array and as the only value of an object. Each
    alone misses a stray closing bracket of its own kind; together they
    reject it, and duplicate keys are accepted. A text without ``]`` needs the
    first wrapper only. ``json_array_length`` and
    ``json_object_keys`` only tokenise (children are skipped, not built),
    so the check allocates no copy of the document.
    """
    t = _col(text)
    as_item = F.json_array_length(F.concat(F.lit("["), t, F.lit("]"))) == 1
    as_value = F.array_size(F.json_object_keys(F.concat(F.lit('{"x":'), t, F.lit("}")))) == 1
    as_value = F.when(F.contains(t, F.lit("]")), as_value).otherwise(True)
    return t.isNotNull() & F.coalesce(as_item, F.lit(False)) & F.coalesce(as_value, F.lit(False))


def format_figure(x: Column | str, decimals: int = 2) -> Column:
    """Grouped figure for presentation (``1,234,567.89``); never stored."""
    return F.format_number(_col(x), decimals)
