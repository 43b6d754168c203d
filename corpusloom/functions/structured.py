"""Structured replies of models: a schema as instructions, and as a check of what comes back.

A schema is DDL (`question STRING NOT NULL, references ARRAY<STRING> NOT NULL, note STRING COMMENT 'a remark'`), with structs and arrays of any depth.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, MapType, StringType, StructType, _parse_datatype_string

from . import text as T

#: Types by what a reply's reader calls them, and the names of JSON values' own types that they take.
PLAIN = {StringType: ("text", "STRING"), BooleanType: ("true or false", "BOOLEAN"), LongType: ("a whole number", "BIGINT"), IntegerType: ("a whole number", "BIGINT"), DoubleType: ("a number", "BIGINT|DOUBLE|FLOAT|DECIMAL.*"), FloatType: ("a number", "BIGINT|DOUBLE|FLOAT|DECIMAL.*")}


def parsed_schema(ddl: str) -> StructType:
    schema = _parse_datatype_string(ddl)
    for kind in _kinds(schema):
        if not isinstance(kind, (StructType, ArrayType, MapType, *PLAIN)) or isinstance(kind, MapType) and not isinstance(kind.keyType, StringType):
            raise ValueError(f"a reply can't hold {kind.simpleString()}")
    return schema


def _kinds(kind: DataType) -> list[DataType]:
    inner = [f.dataType for f in kind.fields] if isinstance(kind, StructType) else [kind.elementType] if isinstance(kind, ArrayType) else [kind.valueType] if isinstance(kind, MapType) else []
    return [kind, *(k for x in inner for k in _kinds(x))]


def _described(kind: DataType) -> str:
    if isinstance(kind, StructType):
        return "an object of " + ", ".join(f'"{f.name}": {_described(f.dataType)}' + ("" if not f.nullable else " or null") for f in kind.fields)
    if isinstance(kind, ArrayType):
        return "a list, each item " + _described(kind.elementType)
    return "an object, each value " + _described(kind.valueType) if isinstance(kind, MapType) else PLAIN[type(kind)][0]


def instructions(ddl: str) -> str:
    """What a prompt says about the reply's form."""
    lines = []
    for f in parsed_schema(ddl).fields:
        remark = f.metadata.get("comment", "")
        lines.append(f'- "{f.name}": {_described(f.dataType)}{"" if not f.nullable else " (may be left out)"}{": " + remark if remark else ""}')
    return "Answer with a single JSON object and nothing else. Its keys are:\n" + "\n".join(lines)


def _fault(v: Column, kind: DataType, nullable: bool, at: Column) -> Column:
    """Why a value (VARIANT) is none of a kind, as text; null if it is one."""
    missing = v.isNull() | F.is_variant_null(v)
    wrong = lambda what: F.concat(at, F.lit(f" is not {what}"))
    shape = F.schema_of_variant(v)
    first = lambda faults: F.try_element_at(F.filter(faults, lambda x: x.isNotNull()), F.lit(1))
    if isinstance(kind, StructType):
        inner = F.coalesce(*(_fault(F.try_variant_get(v, f"$['{f.name}']", "variant"), f.dataType, f.nullable, F.concat(at, F.lit("." + f.name))) for f in kind.fields))
        fault = F.when(~shape.startswith("OBJECT"), wrong("an object")).otherwise(inner)
    elif isinstance(kind, (ArrayType, MapType)):
        whole, item, name = ("array<variant>", kind.elementType, "a list") if isinstance(kind, ArrayType) else ("map<string,variant>", kind.valueType, "an object")
        values = F.try_variant_get(v, "$", whole)
        items = values if isinstance(kind, ArrayType) else F.map_values(values)
        null_ok = kind.containsNull if isinstance(kind, ArrayType) else kind.valueContainsNull
        each = first(F.transform(items, lambda x, i: _fault(x, item, False if null_ok is None else null_ok and not isinstance(item, tuple(PLAIN)), F.concat(at, F.lit("["), i.cast("string"), F.lit("]")))))
        fault = F.when(~shape.startswith("ARRAY" if isinstance(kind, ArrayType) else "OBJECT"), wrong(name)).otherwise(each)
    else:
        what, names = PLAIN[type(kind)]
        fault = F.when(~shape.rlike(f"^({names})$"), wrong(what))
        if isinstance(kind, IntegerType):
            fault = F.coalesce(fault, F.when(F.try_variant_get(v, "$", "int").isNull(), wrong("a number of that size")))
    return F.when(missing, F.lit(None).cast("string") if nullable else F.concat(at, F.lit(" is missing"))).otherwise(fault)


def structured(reply: Column | str, ddl: str) -> Column:
    """(value, reason): the reply, fences stripped, as a struct of the schema; or null and why it is none.

    Keys that aren't NOT NULL may be null or missing; keys beyond the schema are passed over; values are taken as they are, a number is no text; lists of plain
    values hold no nulls.
    """
    schema = parsed_schema(ddl)
    text = T.strip_fence(reply)
    v = F.try_parse_json(text)
    fault = F.coalesce(F.when(v.isNull(), F.lit("no JSON")), _fault(v, schema, False, F.lit("reply")))
    value = F.from_json(text, schema)
    return F.struct(F.when(fault.isNull(), value).alias("value"), F.coalesce(fault, F.when(value.isNull(), F.lit("no JSON"))).alias("reason"))
