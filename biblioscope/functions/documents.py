"""Reading JSON documents and casting the texts found in them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_text(document: Column, *path: str | int) -> Column:
    """Text at ``path``; steps are keys or array positions. NULL where a step is absent."""
    steps = "".join(f"[{step}]" if isinstance(step, int) else f".{step}" for step in path)
    return F.get_json_object(document, "$" + steps)


#: Levels of arrays and objects in each other that are printed; deeper ones are an error.
DEPTH = 3


def database_text(document: Column, *path: str | int, depth: int = DEPTH) -> Column:
    """What the database prints for the value at ``path`` of a JSON document; NULL for null or nothing.

    Texts come without quotes.  Arrays and objects have a blank after ``,`` and ``:``, keys by their length in bytes
    and then by their bytes, numbers with the digits they were written with (an exponent is carried out),
    characters as themselves unless JSON needs them escaped.  Of equal keys the last counts, where the session allows them
    (``spark.sql.variant.allowDuplicateKeys``); otherwise they are an error, as is what is nested deeper than ``depth``.
    Numbers pass the parser as texts behind a control character, as it would not keep their digits.
    """
    steps = "".join(f"[{step}]" if isinstance(step, int) else f".{step}" for step in path)
    outside = r'\G((?:[^"\-0-9]|"(?:[^"\\]|\\.)*+")*+)(-?[0-9][0-9.eE+\-]*+)'
    shielded = F.regexp_replace(document, F.lit(outside), F.lit(r'$1"\\u0001$2"'))

    def text(value: Column) -> Column:
        bare = F.variant_get(value, "$", "string")
        # Each part but the first begins with a shielded number.
        parts = F.split(_printed(value, depth), '(?="\\\\u0001)')
        whole = F.array_join(F.transform(parts, lambda x: F.when(x.startswith('"\\u0001'), F.concat(_number(F.regexp_extract(x, '^"\\\\u0001([^"]*)"', 1)), F.regexp_replace(x, '^"[^"]*"', ""))).otherwise(x)), "")
        return F.when(F.left(F.to_json(value), F.lit(1)).isin("[", "{"), whole).when(bare.startswith("\x01"), _number(F.substring(bare, 2, 1 << 20))).otherwise(bare)

    return _named(F.variant_get(F.parse_json(shielded), "$" + steps, "variant"), text)


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _printed(value: Column, depth: int) -> Column:
    """A variant with blanks and its keys in order."""

    def of(text: Column) -> Column:
        kind = F.left(text, F.lit(1))
        if depth == 0:
            deeper = F.raise_error(F.lit("a document is nested deeper than is printed")).cast("string")
            return F.when(kind.isin("[", "{") & ~text.isin("[]", "{}"), deeper).otherwise(text)
        items = F.transform(F.variant_get(F.when(kind == "[", value), "$", "array<variant>"), lambda x: _printed(x, depth - 1))
        fields = F.transform(
            F.map_entries(F.variant_get(F.when(kind == "{", value), "$", "map<string,variant>")),
            lambda f: F.struct(F.octet_length(f["key"]).alias("size"), f["key"].cast("binary").alias("bytes"), F.concat(_quoted(f["key"]), F.lit(": "), _printed(f["value"], depth - 1)).alias("text")),
        )
        array = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
        object_ = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(fields), lambda f: f["text"]), ", "), F.lit("}"))
        return F.when(kind == "[", array).when(kind == "{", object_).otherwise(text)

    return _named(F.to_json(value), of)


def _quoted(text: Column) -> Column:
    return _named(F.to_json(F.array(text)), lambda array: F.substring(array, F.lit(2), F.length(array) - 2))


def _number(text: Column) -> Column:
    """A number as the database prints it: 1.5e3 is 1500, 1.50e-1 is 0.150."""
    plain = F.when(~text.rlike("[eE]|^-0"), text)
    parts = F.array(*[F.regexp_extract(text, r"^(-?)([0-9]+)(?:\.([0-9]+))?(?:[eE]([+-]?[0-9]+))?$", k) for k in (1, 2, 3, 4)])

    def carried_out(x: Column) -> Column:
        sign, whole, fraction, exponent = (x[k] for k in range(4))
        shift = F.coalesce(F.when(exponent != "", exponent.cast("int")), F.lit(0))
        zeros = F.repeat(F.lit("0"), F.greatest(F.lit(0), 1 - shift)), F.repeat(F.lit("0"), F.greatest(F.lit(0), shift - F.length(fraction)))
        scale = F.greatest(F.lit(0), F.length(fraction) - shift)
        digits = F.struct(sign.alias("sign"), F.concat(zeros[0], whole, fraction, zeros[1]).alias("digits"), scale.alias("scale"))
        return digits

    def joined(x: Column) -> Column:
        before = F.regexp_replace(F.left(x["digits"], F.length(x["digits"]) - x["scale"]), "^0+(?=[0-9])", "")
        after = F.when(x["scale"] > 0, F.concat(F.lit("."), F.right(x["digits"], x["scale"]))).otherwise("")
        return F.concat(F.when(x["digits"].rlike("[1-9]"), x["sign"]).otherwise(""), before, after)

    return F.coalesce(plain, _named(_named(parts, carried_out), joined))


def text_fields(*names: str, **nested: T.DataType) -> T.StructType:
    """Schema that reads the given keys as text, plus nested parts by keyword.

    Naming only the keys a report uses keeps ``from_json`` from building the others.
    """
    fields = [T.StructField(name, T.StringType()) for name in names]
    fields += [T.StructField(name, kind) for name, kind in nested.items()]
    return T.StructType(fields)


def uuid_norm(text: Column) -> Column:
    """Canonical text of an identifier taken from a document."""
    return F.lower(text)


# The texts the database takes for true and false.
TRUE_TEXTS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
FALSE_TEXTS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")


def text_bool(text: Column) -> Column:
    """Boolean from text in any letter case; other texts are an error."""
    word = F.lower(F.trim(text))
    known = F.when(word.isin(*TRUE_TEXTS), True).when(word.isin(*FALSE_TEXTS), False)
    return known.otherwise(text.cast("boolean"))


def flag(value: Column) -> Column:
    """Boolean, or text for one, whose absence means false."""
    return F.coalesce(text_bool(value.cast("string")), F.lit(False))


def absent_or_false(document: Column, key: str) -> Column:
    """True where a document's flag is missing or false (a JSON or a text boolean)."""
    value = json_text(document, key)
    return value.isNull() | (value == "false")


def json_instant(text: Column) -> Column:
    """ISO text with an offset to the UTC wall clock (TIMESTAMP_NTZ), in any session zone."""
    instant = F.to_timestamp(text)
    return F.convert_timezone(None, F.lit("UTC"), instant.cast("timestamp_ntz"))
