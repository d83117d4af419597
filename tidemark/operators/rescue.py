"""JSON documents read by a declared schema of any depth, with all that does not fit kept by its path.

The document is parsed once into a variant. Each declared field takes its value from there if that
has the declared kind; unknown fields and single values of another kind land in one rescued column,
named by their path. Everything is built-in expressions, so it works on tables and streams alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OBJECT, ITEMS = "map<string,variant>", "array<variant>"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBER = (T.FloatType, T.DoubleType, T.DecimalType)


def rescue_document(df: DataFrame, text: str, schema: T.StructType, rescued: str = "_rescued_data") -> DataFrame:
    """Replace the JSON texts in ``text`` by the fields of ``schema`` and a column of what did not fit.

    ``rescued`` is a JSON object from paths (``a.b``; names with a dot in backticks) to values, or
    null if everything fitted. A text that is no JSON object, or names a field twice, is kept there
    whole and its fields are null; a null text gives nulls throughout. A JSON null fits every field.
    Whole numbers fit number fields, any plain value fits a string field, times are ISO texts. Of an
    array in which something does not fit, the fitting parts stay in place and the array is rescued
    whole. Columns of ``df`` with a name of the result are replaced.
    """
    names = [f.name for f in schema.fields]
    kept = [c for c in df.columns if c not in (text, rescued, *names)]
    source, parsed = _unused("text", kept), _unused("document", kept)
    rows = df.select(*kept, F.col(text).alias(source), _document(F.col(text)).alias(parsed))
    document = F.col(parsed)
    fitting, left = _fields(document, schema, ())
    others = F.when(F.size(left) > 0, F.to_json(left))
    return rows.select(
        *kept,
        *[c.alias(name) for c, name in zip(fitting, names, strict=True)],
        F.when(document.isNull(), F.col(source)).otherwise(others).alias(rescued),
    )


def _document(text: Column) -> Column:
    """The fields of the one object that a text holds, else null.

    The parser stops at the end of a document and so would pass over what follows it. Within an
    array, and within an object, it cannot: only in a text without more are both well formed.
    """
    items = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).try_cast(ITEMS)
    ends = F.try_parse_json(F.concat(F.lit('{"_":'), text, F.lit("}"))).isNotNull()
    return F.when((F.size(items) == 1) & ends, F.try_element_at(items, F.lit(1)).try_cast(OBJECT))


def _unused(name: str, taken: list[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name


def _path(names: tuple[str, ...]) -> str:
    return ".".join(f"`{n}`" if "." in n else n for n in names)


def _empty() -> Column:
    return F.create_map().cast(OBJECT)


def _fields(values: Column, schema: T.StructType, path: tuple[str, ...]) -> tuple[list[Column], Column]:
    """The declared fields of an object, and by path what is left of it."""
    fitting, left = [], []
    for f in schema.fields:
        inside, rest = _split(F.try_element_at(values, F.lit(f.name)), f.dataType, (*path, f.name))
        fitting.append(inside)
        left.append(rest)
    unknown = F.map_filter(values, lambda name, _: ~name.isin([f.name for f in schema.fields]))
    if path:
        prefix = f"{_path(path)}."
        unknown = F.transform_keys(unknown, lambda name, _: F.concat(F.lit(prefix), _quoted(name)))
    else:
        unknown = F.transform_keys(unknown, lambda name, _: _quoted(name))
    return fitting, F.map_concat(F.coalesce(unknown, _empty()), *left)


def _quoted(name: Column) -> Column:
    return F.when(F.contains(name, F.lit(".")), F.concat(F.lit("`"), name, F.lit("`"))).otherwise(name)


def _split(value: Column, kind: T.DataType, path: tuple[str, ...]) -> tuple[Column, Column]:
    """A value as ``kind``, null if it is something else, and by path what does not fit."""
    if isinstance(kind, T.VariantType):
        return value, _empty()
    present = value.isNotNull() & ~F.is_variant_null(value)
    alone = F.create_map(F.lit(_path(path)), value)
    if isinstance(kind, T.StructType):
        inside = value.try_cast(OBJECT)
        fields, left = _fields(inside, kind, path)
        named = F.struct(*[c.alias(f.name) for c, f in zip(fields, kind.fields, strict=True)])
        rest = F.when(inside.isNotNull(), left).when(present, alone).otherwise(_empty())
        return F.when(inside.isNotNull(), named), rest
    if isinstance(kind, T.ArrayType):
        items = value.try_cast(ITEMS)
        fitting = F.transform(items, lambda item: _split(item, kind.elementType, ())[0])
        unfit = F.exists(items, lambda item: F.size(_split(item, kind.elementType, ())[1]) > 0)
        return fitting, F.when(present & F.coalesce(unfit, F.lit(True)), alone).otherwise(_empty())
    if isinstance(kind, T.MapType):
        inside = value.try_cast(OBJECT)
        fitting = F.transform_values(inside, lambda _, item: _split(item, kind.valueType, ())[0])
        unfit = F.exists(F.map_values(inside), lambda item: F.size(_split(item, kind.valueType, ())[1]) > 0)
        return fitting, F.when(present & F.coalesce(unfit, F.lit(True)), alone).otherwise(_empty())
    fitting = F.when(_has_kind(value, kind), F.try_variant_get(value, "$", kind.simpleString()))
    return fitting, F.when(present & fitting.isNull(), alone).otherwise(_empty())


def _has_kind(value: Column, kind: T.DataType) -> Column:
    """Whether a JSON value is of the sort that a plain type is written as."""
    found = F.schema_of_variant(value)
    whole = (found == "BIGINT") | found.rlike(r"^DECIMAL\(\d+,0\)$")
    if isinstance(kind, _WHOLE):
        return whole
    if isinstance(kind, _NUMBER):
        return whole | found.startswith("DECIMAL") | found.isin("DOUBLE", "FLOAT")
    if isinstance(kind, T.BooleanType):
        return found == "BOOLEAN"
    if isinstance(kind, T.StringType):
        return ~(found.startswith("OBJECT") | found.startswith("ARRAY") | (found == "VOID"))
    return found == "STRING"
