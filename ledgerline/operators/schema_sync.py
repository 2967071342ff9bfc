"""Schema sync of a load: stored columns follow the batch, types only widen.

A column's type becomes the smallest type that holds every value of both sides
exactly: byte < short < int < long < decimal, float < double, int and smaller
into double, decimals by the digits before and after the point, date into
timestamp (without time zone), NULL into anything.  Any other change would lose
or reinterpret values and is refused with the column's name.
"""

from __future__ import annotations

from pyspark.sql import types as T

_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


class LossyChange(ValueError):
    """A type change that could lose values."""


def _digits(t: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point that a number type needs."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return (_WHOLE[type(t)], 0) if type(t) in _WHOLE else None


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The smallest type that holds both exactly; None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda t: _ORDER.index(type(t)))
    da, db = _digits(a), _digits(b)
    if da and db:
        before, after = max(da[0], db[0]), max(da[1], db[1])
        return T.DecimalType(before + after, after) if before + after <= 38 else None
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.DoubleType) and (isinstance(y, T.FloatType) or type(y) in _ORDER[:3]):
            return x
        if isinstance(x, T.FloatType) and type(y) in _ORDER[:2]:
            return x
        if isinstance(x, (T.TimestampNTZType, T.TimestampType)) and isinstance(y, T.DateType):
            return x
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = wider(a.elementType, b.elementType)
        return inner and T.ArrayType(inner, a.containsNull or b.containsNull)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType) and a.names == b.names:
        inner = [wider(x.dataType, y.dataType) for x, y in zip(a, b)]
        return None if None in inner else T.StructType([T.StructField(x.name, t) for x, t in zip(a, inner)])
    return None


def synced_schema(stored: T.StructType, batch: T.StructType) -> tuple[T.StructType, bool]:
    """The batch's columns with types that also hold the stored values, and
    whether the stored files need another schema."""
    fields, changed = [], set(stored.names) != set(batch.names)
    for field in batch:
        if field.name in stored.names:
            old = stored[field.name].dataType
            both = wider(old, field.dataType)
            if both is None:
                raise LossyChange(f"column {field.name}: {old.simpleString()} and {field.dataType.simpleString()} "
                                  "have no type that holds both")
            changed = changed or both != old
            fields.append(T.StructField(field.name, both))
        else:
            fields.append(T.StructField(field.name, field.dataType))
    return T.StructType(fields), changed
