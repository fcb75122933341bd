"""Typed reads of dirty JSON leaves, as SQL expressions over column names.

A leaf that is read as a number or a date arrives as VARIANT, so that it keeps its JSON type: the number ``1.5`` in an
integer field is cut to 1, the text ``"1.5"`` is bad. A read has three outcomes that must stay apart: blank (null or a
default), parsed, and bad. The steps are separate so that each builds on the finished one before it: ``leaf_text`` is the
leaf as text, ``present`` drops blank texts, ``number`` parses what is left, ``or_default`` and ``any_bad`` compare the two.

They are SQL text because a projection has dozens of them: one parsed expression costs far less on
the driver than a tree of single column calls.
"""

from __future__ import annotations

#: Keeps ten decimals and 28 digits before them; a number that needs more is bad, never rounded.
DECIMAL = "decimal(38,10)"

# Texts that count as "no value".
BLANK_TEXTS = "('', 'null', 'NULL')"

# 0001-01-02 and 9999-12-31 in epoch milliseconds: the range where days are exact in any zone.
MIN_MILLIS = -62_135_510_400_000
MAX_MILLIS = 253_402_214_400_000

DAY_MILLIS = 86_400_000


def leaf_text(leaf: str) -> str:
    """The leaf as text, whatever its JSON type; null for a missing leaf and for JSON's null."""
    return f"try_variant_get({leaf}, '$', 'string')"


def json_kind(leaf: str) -> str:
    """``number``, ``text``, ``boolean``, ``object`` or ``array``; null for a missing leaf and for JSON's null."""
    kind = f"schema_of_variant({leaf})"
    return f"""CASE WHEN {kind} IN ('BIGINT', 'DOUBLE') OR startswith({kind}, 'DECIMAL') THEN 'number' WHEN {kind} = 'STRING' THEN 'text'
        WHEN {kind} = 'BOOLEAN' THEN 'boolean' WHEN startswith({kind}, 'OBJECT') THEN 'object' WHEN startswith({kind}, 'ARRAY') THEN 'array' END"""


def present(text: str) -> str:
    """The text, or null when it is blank."""
    return f"CASE WHEN {text} NOT IN {BLANK_TEXTS} THEN {text} END"


def number(text: str, data_type: str) -> str:
    """Number in a present text without thousands commas; null when malformed or when the type would
    not keep it whole. A cast would accept outer blanks, the contract does not. A whole number may be
    spelled ``5``, ``5.0`` or ``5e0`` for an integer type, too. The usual spelling is tried first."""
    plain = f"replace({text}, ',', '')"
    wide = f"try_cast({plain} AS {DECIMAL})"
    # a number with an exponent is kept if the decimal is the same double
    scaled = f"{plain} RLIKE '[eE]' AND CAST({wide} AS DOUBLE) = try_cast({plain} AS DOUBLE)"
    if data_type == DECIMAL:
        read = f"CASE WHEN {plain} RLIKE '^[+-]?[0-9]*[.]?[0-9]{{0,10}}0*$' THEN {wide} WHEN {scaled} THEN {wide} END"
    else:
        read = f"""coalesce(try_cast({plain} AS {data_type}), CASE
            WHEN {plain} RLIKE '^[+-]?[0-9]+[.]0*$' THEN try_cast(substring_index({plain}, '.', 1) AS {data_type})
            WHEN {scaled} AND {wide} = floor({wide}) THEN try_cast({wide} AS {data_type}) END)"""
    return f"CASE WHEN trim({text}) = {text} THEN {read} END"


def typed_number(leaf: str, text: str, data_type: str) -> str:
    """``number`` of the leaf's present ``text``; what it does not read goes by the leaf's JSON type. For an integer type a JSON
    number is cut towards zero, and true and false are 1 and 0 for ``int`` only. Numbers beyond the type stay bad."""
    if data_type == DECIMAL:
        return number(text, data_type)
    kinds = "('number', 'boolean')" if data_type == "int" else "('number')"
    return f"coalesce({number(text, data_type)}, CASE WHEN {text} IS NOT NULL AND {json_kind(leaf)} IN {kinds} THEN try_variant_get({leaf}, '$', '{data_type}') END)"


def typed_millis(leaf: str, text: str) -> str:
    """The present ``text`` of a date leaf; a JSON number that is not spelled in digits is one of whole milliseconds."""
    return f"CASE WHEN {text} RLIKE '[.eE]' AND {json_kind(leaf)} = 'number' THEN CAST(try_variant_get({leaf}, '$', 'bigint') AS STRING) ELSE {text} END"


def present_count(texts: list[str]) -> str:
    """How many of the texts of ``present`` are there."""
    return f"size(filter(array({', '.join(texts)}), t -> t IS NOT NULL))"


def any_bad(count: str, values: list[str]) -> str:
    """True when fewer of ``values`` were parsed than ``count`` texts were present."""
    return f"{count} > {' + '.join(f'int({value} IS NOT NULL)' for value in values)}"


def or_default(text: str, value: str, default: int) -> str:
    return f"CASE WHEN {text} IS NULL THEN {default} ELSE {value} END"


_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}"


def _usual_date(text: str) -> str:
    """A date, or a date and time to the second, told by length and separators without a pattern."""
    length = f"length({text})"
    return f"substr({text}, 5, 1) = '-' AND ({length} = 10 OR ({length} = 19 AND substr({text}, 17, 1) = ':'))"


def instant_millis(text: str) -> str:
    """Epoch milliseconds of a present text that names an instant: digits, or a date and time with Z
    or an offset. Null for local and malformed text."""
    return f"""CASE
        WHEN {_usual_date(text)} OR trim({text}) <> {text} THEN NULL
        WHEN {text} RLIKE '^-?[0-9]+$' THEN try_cast({text} AS BIGINT)
        WHEN {text} RLIKE '{_DATE}[T ].*(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$' THEN unix_millis(try_cast({text} AS TIMESTAMP))
    END"""


def local_day(text: str, millis: str, zone: str) -> str:
    """Days since 1970-01-01 of the local day in ``zone`` that a present text falls on, given its
    ``instant_millis``. Text that is no instant must start with a full date and is local. Null for
    malformed text; independent of the session time zone."""
    shifted = f"unix_millis(from_utc_timestamp(timestamp_millis({millis}), '{zone}'))"
    in_range = f"{millis} >= {MIN_MILLIS} AND {millis} <= {MAX_MILLIS}"
    return f"""CASE
        WHEN {in_range} THEN CAST(floor({shifted} / {DAY_MILLIS}D) AS INT)
        WHEN {millis} IS NOT NULL OR trim({text}) <> {text} THEN NULL
        WHEN ({_usual_date(text)}) OR {text} RLIKE '{_DATE}[T ][^Z+-]*$'
            THEN unix_date(CAST(try_cast({text} AS TIMESTAMP_NTZ) AS DATE))
    END"""


def midnight_seconds(day: str, zone: str) -> str:
    """Epoch seconds (BIGINT) at which the local ``day`` starts in ``zone``."""
    return f"unix_seconds(to_utc_timestamp(timestamp_seconds({day} * 86400L), '{zone}'))"
