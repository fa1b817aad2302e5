"""Exports.  CSV has no nested values, so those are written as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

FORMATS = ("csv", "json", "parquet")
#: Quotes are doubled, NULL is ``\\N``; read back with the same options and ``multiLine``.
CSV = {"header": "true", "escape": '"', "nullValue": r"\N"}
NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def flat(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.VariantType):
            out.append(F.to_json(f.name).alias(f.name))
        elif isinstance(f.dataType, NESTED):
            out.append(F.to_json(f.name, {"ignoreNullFields": "false"}).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def export(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> None:
    """Write a frame as a folder of part files, one per partition."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    writer = (flat(df) if fmt == "csv" else df).write.mode(mode)
    if fmt == "csv":
        writer = writer.options(**CSV)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.format(fmt).save(path)
