"""Values of a known shape read from JSON in two layers: texts first, types second.

In the first layer every leaf is a text, so nothing is lost to its type. In the second each leaf is cast to the wanted
type, and one that cannot be is named by its path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegralType, MapType, StringType, StructField, StructType

WRONG_VALUES_TYPE = "array<struct<path: string, value: string>>"


def text_leaves(kind: DataType) -> DataType:
    """The same shape with a text for every leaf."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, text_leaves(f.dataType)) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(text_leaves(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(kind.keyType, text_leaves(kind.valueType))
    return StringType()


def typed(value: str, kind: DataType) -> Column:
    """The column ``value``, of the shape :func:`text_leaves`, in its wanted types; what has another type is NULL.

    Whole numbers may be written with a fraction or an exponent, and are cut towards zero as by a cast. Booleans are what a
    cast takes for one.
    """
    return F.expr(_typed(value, kind, 0))


def wrong_values(value: str, kind: DataType) -> Column:
    """(path, value) of every leaf that :func:`typed` cannot keep. Steps of a path are joined by dots; elements of an array
    are numbered from 0."""
    return F.expr(f"coalesce({_wrong(value, kind, [], 0)}, {_NONE})")


# One SQL text for each, since a shape of some sixty leaves is slow to put together column by column.

_NONE = f"cast(array() AS {WRONG_VALUES_TYPE})"


def _leaf(text: str, kind: DataType) -> str:
    if isinstance(kind, StringType):
        return text
    name = kind.simpleString()
    plain = f"try_cast({text} AS {name})"
    if isinstance(kind, IntegralType):
        return f"coalesce({plain}, try_cast(try_cast({text} AS decimal(38,9)) AS {name}))"
    return plain


def _typed(value: str, kind: DataType, depth: int) -> str:
    v = f"v{depth}"
    if isinstance(kind, StructType):
        fields = ", ".join(f"'{f.name}', {_typed(f'{value}.`{f.name}`', f.dataType, depth)}" for f in kind)
        return f"CASE WHEN {value} IS NOT NULL THEN named_struct({fields}) END"
    if isinstance(kind, ArrayType):
        return f"transform({value}, {v} -> {_typed(v, kind.elementType, depth + 1)})"
    if isinstance(kind, MapType):
        return f"transform_values({value}, (k{depth}, {v}) -> {_typed(v, kind.valueType, depth + 1)})"
    return _leaf(value, kind)


def _wrong(value: str, kind: DataType, path: list[str], depth: int) -> str:
    """The list for ``value``, NULL where that is NULL."""
    v = f"v{depth}"
    if isinstance(kind, StructType):
        lists = [
            f"coalesce({_wrong(f'{value}.`{f.name}`', f.dataType, [*path, repr(f.name)], depth)}, {_NONE})"
            for f in kind
            if _can_fail(f.dataType)
        ]
        return f"concat({', '.join([_NONE, *lists])})"
    if isinstance(kind, ArrayType):
        each = _wrong(v, kind.elementType, [*path, f"cast(i{depth} AS string)"], depth + 1)
        return f"flatten(transform({value}, ({v}, i{depth}) -> coalesce({each}, {_NONE})))"
    if isinstance(kind, MapType):
        each = _wrong(f"{v}.value", kind.valueType, [*path, f"{v}.key"], depth + 1)
        return f"flatten(transform(map_entries({value}), {v} -> coalesce({each}, {_NONE})))"
    lost = f"named_struct('path', concat_ws('.', {', '.join(path)}), 'value', {value})"
    return f"CASE WHEN {value} IS NOT NULL AND {_leaf(value, kind)} IS NULL THEN array({lost}) END"


def _can_fail(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_can_fail(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _can_fail(kind.elementType)
    if isinstance(kind, MapType):
        return _can_fail(kind.valueType)
    return not isinstance(kind, StringType)
