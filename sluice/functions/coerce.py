"""JSON values to column types.

``coerced(type, value)`` gives the value as a Spark column and whether it has to be
refused: there is something, and the type cannot hold it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.ip import V4
from sluice.functions.jsonpath import as_text, bound, kind, once, present
from sluice.functions.timestamps import epoch_of, parse_iso

#: Bounds and Spark types of the integer types.
INTEGERS = {
    "Int8": (-(2**7), 2**7 - 1, "tinyint"), "Int16": (-(2**15), 2**15 - 1, "smallint"), "Int32": (-(2**31), 2**31 - 1, "int"), "Int64": (-(2**63), 2**63 - 1, "bigint"),
    "UInt8": (0, 2**8 - 1, "smallint"), "UInt16": (0, 2**16 - 1, "int"), "UInt32": (0, 2**32 - 1, "bigint"), "UInt64": (0, 2**64 - 1, "decimal(20,0)"),
    "Int128": (-(10**38 - 1), 10**38 - 1, "decimal(38,0)"), "UInt128": (0, 10**38 - 1, "decimal(38,0)"),
}
_POINT = "struct<x:double,y:double>"
REFUSED = ("Tuple", "Variant", "Dynamic", "Nested", "AggregateFunction")


def split_type(text: str) -> tuple[str, list[str]]:
    """A type's name and its arguments, split at the outer commas."""
    m = re.fullmatch(r"\s*(\w+)\s*(?:\((.*)\))?\s*", text, re.S)
    if not m:
        raise ValueError(f"not a type: {text}")
    args, depth, last = [], 0, ""
    for c in m[2] or "":
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            args.append(last.strip())
            last = ""
        else:
            last += c
    return m[1], [*args, last.strip()] if last.strip() else args


def spark_type(text: str) -> str:
    name, args = split_type(text)
    if name in ("Nullable", "LowCardinality"):
        return spark_type(args[0])
    if name in REFUSED:
        raise ValueError(f"columns of type {name} are not filled")
    if name in INTEGERS:
        return INTEGERS[name][2]
    if name == "Decimal":
        return f"decimal({args[0]},{args[1] if len(args) > 1 else 0})"
    if name == "Array":
        return f"array<{spark_type(args[0])}>"
    if name == "Map":
        return f"map<{spark_type(args[0])},{spark_type(args[1])}>"
    plain = {"Float32": "float", "Float64": "double", "Bool": "boolean", "Date": "date", "Date32": "date", "DateTime": "timestamp", "DateTime64": "timestamp", "Point": _POINT}
    plain |= {"Ring": f"array<{_POINT}>", "LineString": f"array<{_POINT}>", "Polygon": f"array<array<{_POINT}>>", "MultiLineString": f"array<array<{_POINT}>>", "MultiPolygon": f"array<array<array<{_POINT}>>>"}
    return plain.get(name, "string")


def _point(value: Column, text: Column, kind: Column) -> Column:
    """(longitude, latitude) from an object, GeoJSON, "lat,lon", [lon,lat] or WKT."""
    get = lambda p: F.try_variant_get(value, p, "double")
    two = r"^\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*$"
    wkt = r"(?i)^\s*POINT\s*\(\s*(-?\d+(?:\.\d+)?)\s+(-?\d+(?:\.\d+)?)\s*\)\s*$"
    part = lambda pattern, k: F.regexp_extract(text, pattern, k).try_cast("double")
    array, string = kind.startswith("ARRAY"), kind == "STRING"
    x = F.coalesce(F.when(array, get("$[0]")), F.when(string, F.coalesce(part(wkt, 1), part(two, 2))), get("$.lon"), get("$.lng"), get("$.longitude"), get("$.x"), get("$.coordinates[0]"))
    y = F.coalesce(F.when(array, get("$[1]")), F.when(string, F.coalesce(part(wkt, 2), part(two, 1))), get("$.lat"), get("$.latitude"), get("$.y"), get("$.coordinates[1]"))
    return bound(F.struct(x.alias("x"), y.alias("y")), lambda p: F.when((F.abs(p["x"]) <= 180) & (F.abs(p["y"]) <= 90), p))


def _scalar(name: str, args: list[str], value: Column, text: Column, kind: Column, number: Column | None = None) -> Column:
    if name in INTEGERS and INTEGERS[name][2] in ("tinyint", "smallint", "int", "bigint"):
        low, high, spark = INTEGERS[name]
        whole = F.when(text.contains("."), F.regexp_extract(text, r"^\s*([+-]?\d+)\.0*\s*$", 1).try_cast("long"))
        # a number that was read as one holds, but for what it would have lost behind a point
        n = F.coalesce(text.try_cast("long"), whole, F.when(kind == "BOOLEAN", (text == "true").cast("long"))) if number is None else F.when(text.contains("."), whole).otherwise(number)
        return n.try_cast(spark) if low < 0 else bound(n, lambda n: F.when(n.between(low, high), n.try_cast(spark)))
    if name in INTEGERS:
        low, high, spark = INTEGERS[name]
        n = F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("int").cast("decimal(38,0)")).otherwise(F.when(text.rlike(r"^\s*[+-]?\d+(\.0*)?\s*$"), text.try_cast("decimal(38,0)")))
        return bound(n, lambda n: F.when((n >= F.lit(str(low)).cast("decimal(38,0)")) & (n <= F.lit(str(high)).cast("decimal(38,0)")), n.try_cast(spark)))
    if name == "Decimal":
        p, s = int(args[0]), int(args[1]) if len(args) > 1 else 0
        if p > 38:
            return F.when(text.rlike(rf"^[+-]?\d{{1,{p - s}}}(\.\d{{1,{max(s, 1)}}})?$"), text)
        exact = text.try_cast(f"decimal({p},{s})")
        return F.when(exact == text.try_cast("decimal(38,10)"), exact) if s <= 10 else exact
    if name in ("Float32", "Float64"):
        return text.try_cast("float" if name == "Float32" else "double")
    if name == "Bool":
        return F.when(text.rlike("^(?i:true|1)$"), True).when(text.rlike("^(?i:false|0)$"), False)
    if name in ("Date", "Date32"):
        day = F.when(F.length(text) == 10, F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), text.try_cast("date")))
        low, high = ("1970-01-01", "2149-06-06") if name == "Date" else ("1900-01-01", "2299-12-31")
        return bound(day, lambda d: F.when(d.between(low, high), d))
    if name in ("DateTime", "DateTime64"):
        ts = F.coalesce(parse_iso(text), epoch_of(text))
        return F.date_trunc("second", ts) if name == "DateTime" else ts
    if name == "UUID":
        plain = F.lower(F.regexp_replace(text, "-", ""))
        parts = [F.substring(plain, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.when(text.rlike(r"(?i)^([0-9a-f]{32}|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})$"), F.concat_ws("-", *parts))
    if name == "IPv4":
        octets = [F.shiftright(text.try_cast("long"), s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)]
        return F.when(text.rlike(V4), text).when(text.rlike(r"^\d{1,10}$") & (text.try_cast("long") < 2**32), F.concat_ws(".", *octets))
    if name == "IPv6":
        return F.when(text.rlike(V4), F.concat(F.lit("::ffff:"), text)).when(text.rlike(r"^[0-9A-Fa-f:]*:[0-9A-Fa-f:.]*$"), F.lower(text))
    if name in ("Enum8", "Enum16"):
        pairs = [re.fullmatch(r"'(.*)'\s*=\s*(-?\d+)", a) for a in args]
        by_number = F.create_map(*[F.lit(x) for m in pairs for x in (m[2], m[1])])
        return F.when(text.isin(*[m[1] for m in pairs]), text).otherwise(F.try_element_at(by_number, text))
    if name == "FixedString":
        return F.when(F.octet_length(text) <= int(args[0]), text)
    if name == "JSON":
        inner = F.when(kind == "STRING", F.try_parse_json(text))
        wrap = lambda key, x: F.concat(F.lit('{"' + key + '":'), x, F.lit("}"))
        return (
            F.when(kind.startswith("OBJECT"), F.to_json(value)).when(kind.startswith("ARRAY"), wrap("list", F.to_json(value)))
            .when(F.schema_of_variant(inner).startswith("OBJECT"), text).when(F.schema_of_variant(inner).startswith("ARRAY"), wrap("list", text)).otherwise(wrap("value", F.to_json(value)))
        )
    return text


def _read(value: Column) -> Column:
    """A variant with its text and kind, to be read once."""
    return F.struct(value.alias("value"), as_text(value).alias("text"), kind(value).alias("kind"))


def _convert(type_: str, value: Column, text: Column, kind: Column, number: Column | None = None) -> Column:
    """The value in its Spark type; null if it doesn't fit."""
    name, args = split_type(type_)
    if name in ("Nullable", "LowCardinality"):
        return _convert(args[0], value, text, kind, number)
    if name in ("Ring", "LineString"):
        return _convert("Array(Point)", value, text, kind)
    if name in ("Polygon", "MultiLineString"):
        return _convert("Array(Ring)", value, text, kind)
    if name == "MultiPolygon":
        return _convert("Array(Polygon)", value, text, kind)
    if name == "Point":
        return _point(value, text, kind)
    if name == "Array":
        items = F.try_variant_get(value, "$", "array<variant>")
        single = kind.startswith("OBJECT") if args[0] != "Point" else F.lit(False)
        if args[0] == "Point":  # a bare pair of numbers is one point
            items = F.when(kind.startswith("ARRAY") & _point(value, text, kind).isNotNull(), F.array(value)).otherwise(items)
        each = F.transform(F.transform(F.coalesce(items, F.array(value)), _read), lambda x: _convert(args[0], x["value"], x["text"], x["kind"]))
        nullable = split_type(args[0])[0] == "Nullable"
        return F.when(~single, each if nullable else bound(each, lambda e: F.when(~F.exists(e, lambda x: x.isNull()), e)))
    if name == "Map":
        items = F.try_variant_get(value, "$", "map<string,variant>")
        made = F.transform_values(F.transform_values(items, lambda _, x: _read(x)), lambda _, x: _convert(args[1], x["value"], x["text"], x["kind"]))
        keys = spark_type(args[0])
        return made if keys == "string" else F.transform_keys(made, lambda k, _: k.try_cast(keys))
    return _scalar(name, args, value, text, kind, number)


def wants_number(type_: str) -> bool:
    """Whether values of a type can be read as 64-bit numbers, which then take the place of
    their kind."""
    name, args = split_type(type_)
    if name in ("Nullable", "LowCardinality"):
        return wants_number(args[0])
    return name in INTEGERS and INTEGERS[name][2] in ("tinyint", "smallint", "int", "bigint")


def wants_kind(type_: str) -> bool:
    """Whether values of a type are told apart by their kind; else it may be null."""
    name, args = split_type(type_)
    if name in ("Nullable", "LowCardinality"):
        return wants_kind(args[0])
    return name in INTEGERS or name in ("JSON", "Point", "Array", "Map", "Ring", "LineString", "Polygon", "MultiLineString", "MultiPolygon")


def made_of(type_: str, value: Column, text: Column, kind: Column, number: Column | None = None) -> Column:
    """A value of ``type_`` from a variant column, its text and its kind, or the number that
    the variant casts to; null if there is none, if it is a JSON null, or if the type
    cannot hold it."""
    return F.when(text.isNotNull(), _convert(type_, value, text, kind, number).cast(spark_type(type_)))


def finished(type_: str, made: Column, text: Column) -> tuple[Column, Column]:
    """What ``made_of`` gave, for an array the empty one where nothing is there, and whether
    something is there that the type cannot hold."""
    empty = split_type(type_)[0] == "Array"
    return (F.when(text.isNull(), F.array().cast(spark_type(type_))).otherwise(made) if empty else made), text.isNotNull() & made.isNull()


def with_coerced(df: DataFrame, columns: dict[str, tuple[str, Column]]) -> DataFrame:
    """``df`` with a column for each name, of a type and from a variant, and ``name_refused``
    for each; every value is read once."""
    df = once(df, "_values", F.struct(*[v.alias(n) for n, (_, v) in columns.items()]))
    df = once(df, "_read", F.struct(*[_read(F.col(f"_values.{n}")).alias(n) for n in columns]))
    df = once(df, "_made", F.struct(*[made_of(t, F.col(f"_read.{n}.value"), F.col(f"_read.{n}.text"), F.col(f"_read.{n}.kind")).alias(n) for n, (t, _) in columns.items()]))
    for n, (t, _) in columns.items():
        out, wrong = finished(t, F.col(f"_made.{n}"), F.col(f"_read.{n}.text"))
        df = df.withColumns({n: out, f"{n}_refused": wrong})
    return df.drop("_values", "_read", "_made")


def coerced(type_: str, value: Column) -> tuple[Column, Column]:
    """The value of ``type_`` and whether a value is there that the type cannot hold.
    A missing value, or a JSON null, is null; for an array it is the empty array."""
    there = present(value)
    both = bound(_read(there), lambda x: F.struct(x["text"].alias("text"), made_of(type_, x["value"], x["text"], x["kind"]).alias("made")))
    return finished(type_, both["made"], both["text"])
