"""Declared database types and the Spark types that hold them."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type -> Spark type. Anything not listed is text.
DECLARED_TYPES = {
    "timestamp with time zone": T.TimestampType(),
    "timestamp without time zone": T.TimestampType(),
    "date": T.DateType(),
    "numeric": T.DecimalType(38, 9),
    "integer": T.LongType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "real": T.DoubleType(),
    "ARRAY": T.ArrayType(T.StringType()),
}


def spark_type(declared: str) -> T.DataType:
    """Spark type for a declared column type; documents, ids and text are strings."""
    return DECLARED_TYPES.get(declared, T.StringType())


# Classes of type names, and the classes that hold all values of a class. Anything not listed is text.
TYPE_CLASSES = {
    "bigint": ("tinyint", "smallint", "integer", "int", "bigint"),
    "numeric": ("numeric", "decimal"),
    "real": ("real", "float", "double", "double precision"),
    "boolean": ("boolean",),
    "date": ("date",),
    "timestamp without time zone": ("timestamp", "timestamp_ntz", "timestamp with time zone", "timestamp without time zone"),
}
WIDER = {
    "bigint": ("numeric", "text"),
    "numeric": ("text",),
    "real": ("text",),
    "boolean": ("text",),
    "date": ("timestamp without time zone", "text"),
    "timestamp without time zone": ("text",),
    "text": (),
}


def type_class(name: Column) -> Column:
    """Class of a type name in lower case, without its precision; the class is a declared type itself."""
    plain = F.regexp_replace(name, r"\(.*\)", "")
    classes = F.create_map(*[F.lit(x) for wide, names in TYPE_CLASSES.items() for n in names for x in (n, wide)])
    return F.when(name.isNotNull(), F.coalesce(classes[plain], F.lit("text")))
