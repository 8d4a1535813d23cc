"""The closed envelope: validation with reasons, defaults, dead letters and their replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.schema import ENVELOPE_DEFAULTS, ENVELOPE_FIELDS, IDENTITY_FIELDS

_TEXT_FIELDS = (*IDENTITY_FIELDS, "priority", "schema_version")


def _parsed(raw: DataFrame, body: str) -> DataFrame:
    """Add ``_top``: the body's top-level entries, NULL unless it starts with one JSON object.

    ``inline`` is a border that the optimizer moves no predicate across, so a body is parsed
    once per row and not once per reference.
    """
    wrapped = f"'{{\"_top\":' || {body} || '}}'"
    strict = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"
    return raw.selectExpr(
        "*", f"inline(array(from_json({wrapped}, '_top map<string,variant>', {strict})))"
    )


# The tests below are SQL text, put together and parsed once: the plan of a short job is then
# not dominated by building it column by column.


def _one_value(body: str) -> str:
    """No text after the value. The parser stops at the end of a value, so the body is also
    read inside an array: what could close one wrapper early breaks the other."""
    return f"(json_array_length('[' || {body} || ']') <=> 1)"


def _is_json(body: str) -> str:
    return (
        f"(try_parse_json('[' || {body} || ']') IS NOT NULL "
        f"AND try_parse_json('{{\"v\":' || {body} || '}}') IS NOT NULL)"
    )


def _entry(name: str) -> str:
    return f"try_element_at(_top, '{name}')"


def _present(name: str) -> str:
    return f"map_contains_key(_top, '{name}')"


def _text(name: str) -> str:
    return f"try_variant_get({_entry(name)}, '$', 'string')"


def _is_text(name: str) -> str:
    return f"(schema_of_variant({_entry(name)}) <=> 'STRING')"


_PAYLOAD_IS_OBJECT = f"(try_variant_get({_entry('payload')}, '$', 'struct<>') IS NOT NULL)"


def _healthy() -> str:
    """No problem at all, as one cheap test: the reasons are worked out for other rows only."""
    known = " + ".join(f"CAST({_present(name)} AS INT)" for name in ENVELOPE_FIELDS)
    tests = [f"{_is_text(n)} AND {_text(n)} <> ''" for n in IDENTITY_FIELDS]
    tests += [f"(NOT {_present(n)} OR {_is_text(n)})" for n in ("priority", "schema_version")]
    tests += [f"(NOT {_present('payload')} OR {_PAYLOAD_IS_OBJECT})", f"size(_top) = {known}"]
    return f"coalesce({' AND '.join(tests)}, false)"


def _problems() -> str:
    checks = []
    for name in IDENTITY_FIELDS:
        checks.append((f"NOT {_present(name)}", f"'missing:{name}'"))
        checks.append((f"{_is_text(name)} AND {_text(name)} = ''", f"'empty:{name}'"))
    for name in _TEXT_FIELDS:
        checks.append((f"{_present(name)} AND NOT {_is_text(name)}", f"'type:{name}'"))
    checks.append((f"{_present('payload')} AND NOT {_PAYLOAD_IS_OBJECT}", "'type:payload'"))
    known = ", ".join(f"'{name}'" for name in ENVELOPE_FIELDS)
    extras = f"array_sort(array_except(map_keys(_top), array({known})))"
    checks.append((f"size({extras}) > 0", f"'extra:' || array_join({extras}, ',')"))
    checks.append(("size(array_distinct(map_keys(_top))) < size(_top)", "'repeated_key'"))
    listed = ", ".join(f"CASE WHEN {test} THEN {reason} END" for test, reason in checks)
    return f"array_compact(array({listed}))"


def envelope_defaults() -> dict[str, str]:
    """Envelope columns of the parsed entries. Only an *absent* key takes the default; an
    explicit null stays a type problem."""
    columns = {name: _text(name) for name in IDENTITY_FIELDS}
    for name in ("priority", "schema_version"):
        default = ENVELOPE_DEFAULTS[name]
        columns[name] = f"CASE WHEN {_present(name)} THEN {_text(name)} ELSE '{default}' END"
    columns["payload"] = (
        f"CASE WHEN {_present('payload')} THEN {_entry('payload')} "
        f"ELSE parse_json('{ENVELOPE_DEFAULTS['payload']}') END"
    )
    return columns


def annotate_envelope(raw: DataFrame, body: str = "value") -> DataFrame:
    """Parse each body once; add ``_valid``, ``_problems`` and the envelope columns."""
    readable = f"(_top IS NOT NULL AND {_one_value(body)})"
    return _parsed(raw, body).selectExpr(
        *raw.columns,
        f"{readable} AND {_healthy()} AS _valid",
        f"CASE WHEN {readable} THEN {_problems()} WHEN {_is_json(body)} THEN "
        "array('not_an_object') ELSE array('invalid_json') END AS _problems",
        *[f"{c} AS {n}" for n, c in envelope_defaults().items()],
    )


def valid_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter("_valid").drop("_valid", "_problems")


def reject_rows(annotated: DataFrame, body: str = "value", at: Column | None = None) -> DataFrame:
    """Dead-letter records: raw body, reason text, time."""
    return annotated.filter("NOT _valid").select(
        F.col(body).alias("raw_body"),
        F.array_join("_problems", ";").alias("error_reason"),
        (F.current_timestamp() if at is None else at).alias("dlq_timestamp"),
    )


def validate_envelope(raw: DataFrame, body: str = "value") -> tuple[DataFrame, DataFrame]:
    """(valid rows with envelope columns, rejects); together they hold every raw row once."""
    annotated = annotate_envelope(raw, body)
    return valid_rows(annotated).drop(body), reject_rows(annotated, body)


def replay_dead_letters(
    dead_letters: DataFrame, repair: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Send raw bodies (after an optional ``repair`` expression) through the gate again."""
    body = F.col("raw_body") if repair is None else repair
    return validate_envelope(dead_letters.select(body.alias("value")))


def to_body(df: DataFrame) -> DataFrame:
    """Envelope rows as compact JSON text in ``value``."""
    return df.select(F.to_json(F.struct(*ENVELOPE_FIELDS)).alias("value"))
