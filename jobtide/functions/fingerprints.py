"""Hashes that bind approvals to the exact rows and files they were given for."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, StructType


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def double_text(value: Column) -> Column:
    """The shortest decimal text that reads back as the number: plain digits from 0.0001 up to 16 places before the point, else with an
    exponent of two digits or more (``15000000000.0``, ``1e+16``, ``1.5e-07``)."""
    zero = F.lit("0")

    def parts(text: Column) -> Column:
        """The number as 0.digits times ten to the power of point."""
        mantissa = F.substring_index(text, "E", 1)
        whole = F.substring_index(mantissa, ".", 1)
        shift = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).try_cast("int")).otherwise(0)
        padded = F.concat(whole, F.substring_index(mantissa, ".", -1))
        digits = F.ltrim(padded, zero)
        return F.struct(F.rtrim(digits, zero).alias("digits"), (F.length(whole) + shift - F.length(padded) + F.length(digits)).alias("point"))

    def shorter(p: Column, less: int, add: int) -> Column:
        """The digits without the last ``less``, if they read back as the number."""
        kept = F.call_function("div", p["digits"].try_cast("bigint") + F.lit(add), F.lit(10**less)).cast("string")
        power = p["point"] - F.length(p["digits"]) + less
        same = F.concat(kept, F.lit("E"), power.cast("string")).try_cast("double") == F.abs(value)
        return F.when(same, F.struct(F.rtrim(kept, zero).alias("digits"), (power + F.length(kept)).alias("point")))

    def shortest(p: Column) -> Column:
        """The platform's text is at times longer than need be, by two digits at most: beyond 15 digits, and where numbers lie less dense."""
        tried = F.coalesce(shorter(p, 2, 50), shorter(p, 2, 0), shorter(p, 1, 5), shorter(p, 1, 0), p)
        return F.when((F.length(p["digits"]) > 15) | (F.abs(value) < 1e-300), tried).otherwise(p)

    def written(p: Column) -> Column:
        d, point, size = p["digits"], p["point"], F.length(p["digits"])
        small = F.concat(F.lit("0."), F.repeat(zero, -point), d)
        whole = F.concat(d, F.repeat(zero, point - size), F.lit(".0"))
        inside = F.concat(F.substr(d, F.lit(1), point), F.lit("."), F.substr(d, point + 1))
        power = F.abs(point - 1).cast("string")
        tail = F.concat(F.when(point > 0, F.lit("e+")).otherwise(F.lit("e-")), F.when(F.length(power) < 2, F.concat(zero, power)).otherwise(power))
        long = F.concat(F.substr(d, F.lit(1), F.lit(1)), F.when(size > 1, F.concat(F.lit("."), F.substr(d, F.lit(2)))).otherwise(""), tail)
        plain = F.when(point <= 0, small).when(point >= size, whole).otherwise(inside)
        return F.when((point < -3) | (point > 16), long).otherwise(plain)

    def spelled(text: Column) -> Column:
        exact = F.ltrim(text, F.lit("-"))
        # Plain digits, 15 at most and none in vain: no shorter text reads back as the number.
        done = ~F.contains(text, F.lit("E")) & (F.length(exact) <= 16) & (F.endswith(text, F.lit(".0")) | ~F.endswith(text, zero))
        sign = F.when(F.startswith(text, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
        unsigned = _once(_once(parts(exact), shortest), written)
        return F.when(done | F.isnan(value) | (F.abs(value) == float("inf")), text).otherwise(F.concat(sign, unsigned))

    return _once(value.cast("string"), spelled)


def _has_double(data_type: DataType) -> bool:
    if isinstance(data_type, StructType):
        return any(_has_double(f.dataType) for f in data_type.fields)
    return isinstance(data_type, (DoubleType, FloatType)) or isinstance(data_type, ArrayType) and _has_double(data_type.elementType)


def _json(col: Column, data_type: DataType) -> Column:
    """JSON text of a value, ``null`` for null."""
    if isinstance(data_type, StructType):
        fields = sorted(data_type.fields, key=lambda f: f.name)
        inner = [F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ":"), _json(col[f.name], f.dataType)) for f in fields]
        text = F.concat(F.lit("{"), F.concat_ws(",", *inner), F.lit("}"))
    elif isinstance(data_type, ArrayType) and _has_double(data_type):
        text = F.concat(F.lit("["), F.array_join(F.transform(col, lambda x: _json(x, data_type.elementType)), ","), F.lit("]"))
    elif isinstance(data_type, (DoubleType, FloatType)):
        text = double_text(col.cast("double"))
    else:
        whole = F.to_json(F.struct(col.alias("v")), {"ignoreNullFields": "false"})
        text = F.substring(whole, 6, 2**31 - 1)
        text = F.substr(text, F.lit(1), F.length(text) - 1)
    return F.when(col.isNull(), F.lit("null")).otherwise(text)


def _sorted_struct(col: Column, data_type: DataType) -> Column:
    if not isinstance(data_type, StructType):
        return col
    fields = sorted(data_type.fields, key=lambda f: f.name)
    return F.struct(*[_sorted_struct(col[f.name], f.dataType).alias(f.name) for f in fields])


def canonical_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Compact JSON of a row with sorted keys at every level and nulls written out; floating numbers in their shortest text
    (``double_text``), also in structs and arrays. Within maps they stay as Spark writes them."""
    names = sorted(columns or df.columns)
    if any(_has_double(df.schema[n].dataType) for n in names):
        pairs = [F.concat(F.lit(json.dumps(n, ensure_ascii=False) + ":"), _json(F.col(f"`{n}`"), df.schema[n].dataType)) for n in names]
        return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    fields = [_sorted_struct(F.col(n), df.schema[n].dataType).alias(n) for n in names]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def record_fingerprint(df: DataFrame, columns: list[str] | None = None) -> Column:
    return F.sha2(canonical_json(df, columns), 256)


def row_set_fingerprint(row_text: Column) -> Column:
    """Order-free hash of a set of rows, as an aggregate.

    Each row is hashed with SHA-256; four slices of 60 bits are summed as decimals, so partial sums combine on the
    map side and no group is ever gathered. Equal row multisets give equal text.
    """
    digest = F.sha2(row_text, 256)
    sums = [
        F.sum(F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).cast("string")
        for i in range(4)
    ]
    return F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *sums), 256)


def release_fingerprint(year: Column, source_hashes: Column, artifacts: Column) -> Column:
    """Fingerprint of an annual release.

    ``source_hashes`` is an array of SHA-256 texts (sorted here); ``artifacts`` is an array of
    (position, name, sha256) structs and is read in position order. The byte layout is fixed.
    """
    sources = F.transform(F.array_sort(source_hashes), lambda s: F.concat(F.lit("source:"), s, F.lit("\n")))
    files = F.transform(
        F.array_sort(artifacts),
        lambda a: F.concat(F.lit("artifact:"), a["name"], F.lit(":"), a["sha256"], F.lit("\n")),
    )
    header = F.concat(F.lit("rais-release:"), year.cast("string"), F.lit("\n"))
    return F.sha2(F.concat(header, F.array_join(sources, ""), F.array_join(files, "")), 256)
