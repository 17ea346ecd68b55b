"""DuckDB spellings the oracle texts share."""

from __future__ import annotations


def json_text(path: str, document: str = "jsonb") -> str:
    return f"json_extract_string({document}, '$.{path}')"


def local_day(instant: str) -> str:
    return f"cast(({instant} at time zone 'UTC') at time zone 'US/Pacific' as date)"


def elements(relation: str, key: str, columns: str) -> str:
    """Array elements of a document as ``n``, numbered from 1 as ``ord``."""
    path = f"'$.{key}'"
    return f"""(select {columns}, unnest(from_json(json_extract(jsonb, {path}), '["JSON"]')) as n,
        unnest(range(1, cast(json_array_length(jsonb, {path}) as bigint) + 1)) as ord
        from {{{relation}}} where json_type(jsonb, {path}) = 'ARRAY')"""


def array_text(path: str, document: str = "jsonb", each: str = "e") -> str:
    """A document's array as the database prints it, each element ``e`` as ``each`` says."""
    elements = f"from_json(json_extract({document}, '$.{path}'), '[\"JSON\"]')"
    return f"'[' || array_to_string(list_transform({elements}, lambda e: {each}), ', ') || ']'"
