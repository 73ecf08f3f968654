"""JSON text to typed columns, with the unreadable rows kept apart."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

CORRUPT = "_corrupt_record"
# The field by which an added last element shows that a text was read to its end.
END = "_end"


def text_leaves(kind: DataType) -> DataType:
    """The same shape with every leaf a string, so that a number may arrive
    quoted: ``from_json`` to bigint would turn ``"12"`` into null."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, text_leaves(f.dataType)) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(text_leaves(kind.elementType))
    return StringType()


def cast_leaves(col: Column, kind: DataType) -> Column:
    """Text leaves to their declared types; what cannot be read becomes null.
    Parts that hold text alone are left as they are."""
    if kind == text_leaves(kind):
        return col
    if isinstance(kind, StructType):
        return F.when(col.isNotNull(), F.struct(*cast_fields(col, kind)))
    if isinstance(kind, ArrayType):
        return F.transform(col, lambda item: cast_leaves(item, kind.elementType))
    if isinstance(kind, LongType):
        # 1.5 and 1e3 go through double; whole numbers must not lose digits there
        return F.coalesce(col.try_cast("bigint"), col.try_cast("double").try_cast("bigint"))
    return col.try_cast(kind)


def cast_fields(record: Column, schema: StructType) -> list[Column]:
    return [cast_leaves(record[f.name], f.dataType).alias(f.name) for f in schema]


def _framed(value: Column) -> Column:
    """The text as the first of two elements of an array.

    ``from_json`` stops after the first object and says nothing of what follows. The
    second element holds a hash of the text: it is found, as the second, exactly if
    the text before it is one value, and no text can bring its own hash along.
    """
    return F.concat(F.lit('{"v":['), value, F.lit(f',{{"{END}":"'), _mark(value), F.lit('"}]}'))


def _mark(value: Column) -> Column:
    return F.xxhash64(value).cast("string")


def with_variant(df: DataFrame, value: str = "value", into: str = "_variant") -> DataFrame:
    """Add ``into``: a variant whose first element is the text's object, or null where the
    text is not one JSON object and nothing else, or an object in it has a repeated key.

    A variant keeps all digits of numbers, up to 38; zeros at the end of a fraction may
    go and keys change places. The text is framed, and its parse the input of
    ``explode``, as in ``with_json``.
    """
    text = F.col(value)
    framed = F.concat(F.lit("["), text, F.lit(',"'), _mark(text), F.lit('"]'))
    parsed = df.withColumn(into, F.explode(F.array(F.when(text.rlike(r"\A\s*\{"), F.try_parse_json(framed)))))
    whole = F.try_variant_get(into, "$[1]", "string") == _mark(text)
    return parsed.withColumn(into, F.when(whole, F.col(into)))


def with_json(df: DataFrame, schema: StructType, value: str = "value", into: str = "j") -> DataFrame:
    """Add ``into``: the typed record, or null where the text is not one JSON object
    and nothing else.

    The parse and the casts are inputs of ``explode`` on purpose. Filters on the
    parsed fields stop at it; pushed below a plain projection they would repeat
    the whole parse and all casts, once to test and once to project.
    """
    element = StructType([*text_leaves(schema).fields, StructField(END, StringType())])
    lenient = StructType([StructField("v", ArrayType(element)), StructField(CORRUPT, StringType())])
    text = F.from_json(_framed(F.col(value)), lenient, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    raw = f"_{into}_text"
    parsed = df.withColumn(raw, F.explode(F.array(text)))
    both = F.col(raw)["v"]
    first, last = F.try_element_at(both, F.lit(1)), F.try_element_at(both, F.lit(2))
    whole = F.col(raw)[CORRUPT].isNull() & (F.size(both) == 2) & (last[END] == _mark(F.col(value)))
    record = F.when(whole & first.isNotNull(), F.struct(*cast_fields(first, schema)))
    return parsed.withColumn(into, F.explode(F.array(record))).drop(raw)


def zero_for_missing(record: Column, schema: StructType, keys: tuple[str, ...] = ()) -> list[Column]:
    """The record's fields, a missing number read as 0 except in ``keys``."""
    columns = []
    for field in schema:
        col = record[field.name]
        if field.name not in keys and isinstance(field.dataType, (LongType, DoubleType)):
            col = F.coalesce(col, F.lit(0).cast(field.dataType))
        columns.append(col.alias(field.name))
    return columns


def json_text(*columns: str | Column) -> Column:
    """Columns to one JSON object; null fields are left out."""
    return F.to_json(F.struct(*columns))
