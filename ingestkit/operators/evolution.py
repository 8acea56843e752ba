"""Schema evolution of a loaded table: merge the stored layout with each batch, lose no value.

The layout of a table is kept beside its files and grows: columns are matched by name (in any case and
order), new ones are added, missing ones are null, and a type gives way to a wider one that holds every value
of both exactly (``widened``; nested fields too). Where no such type exists the stored one stays: a value that
turns into it and back unchanged is kept, any other goes as text into the map ``_rescued_data`` of its row,
under its column's name. Older files are read by the present layout and never rewritten for a change.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
_RESCUED_TYPE = T.MapType(T.StringType(), T.StringType())

# Whole-number types from narrow to wide, and the decimal digits that hold them in files.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 10, T.ShortType: 10, T.IntegerType: 10, T.LongType: 20}


def widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both exactly; None without one."""
    if a == b:
        return a
    if isinstance(b, T.NullType) or isinstance(a, T.NullType):
        return a if isinstance(b, T.NullType) else b
    ta, tb = type(a), type(b)
    if ta in _WHOLE and tb in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    small = {*_WHOLE[:3], T.FloatType, T.DoubleType}
    if {ta, tb} <= small and {ta, tb} & {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if T.DecimalType in (ta, tb) and {ta, tb} <= {*_WHOLE, T.DecimalType}:
        digits = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
        left, scale = (max(d[i] for d in digits) for i in (0, 1))
        return T.DecimalType(left + scale, scale) if left + scale <= 38 else None
    if {ta, tb} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if ta is tb is T.StructType:
        fields = merged_fields(a.fields, b.fields)
        return T.StructType(fields) if fields is not None else None
    if ta is tb is T.ArrayType:
        element = widened(a.elementType, b.elementType)
        return T.ArrayType(element) if element is not None else None
    if ta is tb is T.MapType and a.keyType == b.keyType:
        value = widened(a.valueType, b.valueType)
        return T.MapType(a.keyType, value) if value is not None else None
    return None


def merged_fields(a: list[T.StructField], b: list[T.StructField]) -> list[T.StructField] | None:
    """Fields of both by name, those of ``a`` first, all nullable; None when some have no common type."""
    other = {f.name.lower(): f for f in b}
    out = []
    for f in a:
        g = other.pop(f.name.lower(), None)
        kind = widened(f.dataType, g.dataType) if g else f.dataType
        if kind is None:
            return None
        out.append(T.StructField(f.name, kind))
    return out + [T.StructField(f.name, f.dataType) for f in b if f.name.lower() in other]


def merged(stored: T.StructType, batch: T.StructType) -> T.StructType:
    """The layout after a batch; ``_rescued_data`` joins it when some type of the batch has to be rescued."""
    other = {f.name.lower(): f for f in batch.fields}
    out, rescue = [], False
    for f in stored.fields:
        g = other.pop(f.name.lower(), None)
        kind = widened(f.dataType, g.dataType) if g else f.dataType
        rescue |= kind is None
        out.append(T.StructField(f.name, f.dataType if kind is None else kind))
    out += [T.StructField(f.name, f.dataType) for f in batch.fields if f.name.lower() in other]
    if rescue and RESCUED not in {f.name for f in out}:
        out.append(T.StructField(RESCUED, _RESCUED_TYPE))
    return T.StructType(out)


def _as(col: Column, old: T.DataType, new: T.DataType) -> Column:
    """``col`` in a type that ``widened`` gave."""
    if old == new:
        return col
    if isinstance(new, T.StructType):
        have = {f.name.lower(): f for f in old.fields}
        parts = []
        for f in new.fields:
            g = have.get(f.name.lower())
            part = _as(col[g.name], g.dataType, f.dataType) if g else F.lit(None).cast(f.dataType)
            parts.append(part.alias(f.name))
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(new, T.ArrayType):
        return F.transform(col, lambda x: _as(x, old.elementType, new.elementType))
    if isinstance(new, T.MapType):
        return F.transform_values(col, lambda _, v: _as(v, old.valueType, new.valueType))
    return col.cast(new)


def _nested(t: T.DataType) -> bool:
    return isinstance(t, (T.StructType, T.ArrayType, T.MapType, T.VariantType))


def _fitted(col: Column, old: T.DataType, new: T.DataType) -> tuple[Column, Column | None]:
    """The value in the stored type, and the text to rescue where it does not fit (None: always fits)."""
    if widened(old, new) == new:
        return _as(col, old, new), None
    if _nested(old) or _nested(new):
        text = F.to_json(F.struct(col.alias("v"))) if _nested(old) else col.cast("string")
        if _nested(old):  # the value alone, without the wrapper that to_json asks for
            text = F.substr(text, F.lit(6), F.length(text) - F.lit(6))
        return F.lit(None).cast(new), F.when(col.isNotNull(), text)
    tried = col.try_cast(new)
    fits = tried.try_cast(old).eqNullSafe(col)
    return F.when(fits, tried), F.when(col.isNotNull() & ~fits, col.cast("string"))


def conform(df: DataFrame, layout: T.StructType) -> DataFrame:
    """``df`` by name in the columns of ``layout`` (from ``merged``), values that do not fit rescued."""
    have = {f.name.lower(): f for f in df.schema.fields}
    values, saved = [], []
    for f in layout.fields:
        g = have.get(f.name.lower())
        if g is None:
            values.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value, text = _fitted(df[g.name], g.dataType, f.dataType)
        values.append(value.alias(f.name))
        if text is not None:
            saved.append(F.struct(F.lit(f.name).alias("key"), text.alias("value")))
    if not saved:
        return df.select(*values)
    found = F.filter(F.array(*saved), lambda e: e["value"].isNotNull())
    rescued = F.when(F.size(found) > 0, F.map_from_entries(found))
    before = df[have[RESCUED].name] if RESCUED in have else F.lit(None).cast(_RESCUED_TYPE)
    both = F.when(rescued.isNull(), before).otherwise(F.map_concat(F.coalesce(before, F.create_map().cast(_RESCUED_TYPE)), rescued))
    return df.select(*[c for f, c in zip(layout.fields, values) if f.name != RESCUED], both.alias(RESCUED)).select(
        *[f.name for f in layout.fields]
    )


def lossless(layout: T.StructType, df: DataFrame) -> bool:
    """Whether every column of ``df`` has a place of its own type, or a wider one, in ``layout``."""
    have = {f.name.lower(): f.dataType for f in layout.fields}
    return reduce(
        lambda ok, f: ok and f.name.lower() in have and widened(f.dataType, have[f.name.lower()]) == have[f.name.lower()],
        df.schema.fields,
        True,
    )
