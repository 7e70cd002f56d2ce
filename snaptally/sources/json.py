"""JSON-lines and Parquet table reads with a schema inferred by Spark."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

CORRUPT = "_corrupt_record"


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    schema: StructType | str | None = None,
    drop_corrupt: bool = True,
) -> DataFrame:
    """JSON lines as a typed table of the good lines.

    A line counts only if it is exactly one JSON object
    (:func:`snaptally.operators.records.parse_records`); all others are left
    out, with a given schema as with an inferred one. With ``schema`` the lines
    are read in one pass. Without it every line is parsed once: the records are
    written to the shared folder, their merged schema is observed in the same
    pass, and the table is read from that copy. Its types are those that Spark's
    JSON reader infers; bad lines never add a column. Where a field's types
    conflict between records (a string of the values' JSON text then), or a record is
    too large for VARIANT, the lines are parsed a second time. Column names that
    collide (equal except for case) raise, as Parquet cannot hold them. An input
    without a good line gives a table without rows.

    ``drop_corrupt=False`` is Spark's own JSON reader: every line gives a row,
    lines it cannot parse in ``_corrupt_record``.
    """
    p = [paths] if isinstance(paths, str) else list(paths)
    if not drop_corrupt:
        return _read(spark.read.option("columnNameOfCorruptRecord", CORRUPT), p, schema)
    from snaptally.functions.json import variant_schema_to_type
    from snaptally.operators.records import IS_VALID, RECORD, parse_records, written_with_schema
    from snaptally.session import scratch_path
    from snaptally.sources.text import scan_lines

    lines = scan_lines(spark, p)
    if schema is not None:
        good = parse_records(lines, keep_record=False).where(F.col(IS_VALID))
        df = good.select(F.from_json("value", schema, _LIMITS).alias("r")).select("r.*")
        check_column_names(df)
        return df
    records, merged, n, unheld = written_with_schema(parse_records(lines).where(F.col(IS_VALID)).select(RECORD))
    if not n:
        return spark.createDataFrame([], StructType([]))
    kind, conflict = variant_schema_to_type(merged) if merged else (None, True)
    if kind is not None:
        check_nested_names(kind)
    if conflict or unheld:  # Spark's reader over a copy of the good lines; it infers only what VARIANT couldn't hold
        path = scratch_path(spark, "good-lines")
        parse_records(lines, keep_record=False).where(F.col(IS_VALID)).select("value").write.text(path)
        return _read(spark.read.options(**_LIMITS), [path], None if unheld else kind)
    if not kind.fields:  # nothing but empty objects: rows without columns
        return records.select()
    return records.select(F.try_variant_get(RECORD, "$", f"struct<{kind.toDDL()}>").alias("r")).select("r.*")


_LIMITS = {"maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1), "maxNestingDepth": str(2**31 - 1)}


def _read(reader, paths: list[str], schema) -> DataFrame:
    try:
        df = reader.json(paths, schema=schema)
    except AnalysisException as e:  # Spark itself refuses names equal but for case
        if "COLUMN_ALREADY_EXISTS" in str(e):
            raise ValueError(f"colliding column names: {e}") from e
        raise
    check_column_names(df)
    return df


def check_nested_names(kind) -> None:
    """Raise if a struct at any level has names equal except for case."""
    if isinstance(kind, StructType):
        names = Counter(f.name.lower() for f in kind.fields)
        if dup := sorted(n for n, k in names.items() if k > 1):
            raise ValueError(f"colliding column names {dup}: filter bad records before inference")
        for f in kind.fields:
            check_nested_names(f.dataType)
    elif isinstance(kind, ArrayType):
        check_nested_names(kind.elementType)
    elif isinstance(kind, MapType):
        check_nested_names(kind.valueType)


def check_column_names(df: DataFrame, case_sensitive: bool = False) -> None:
    names = [c if case_sensitive else c.lower() for c in df.columns]
    dup = sorted(n for n, k in Counter(names).items() if k > 1)
    if dup:
        raise ValueError(f"colliding column names {dup}: filter bad records before inference")


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet read (the default load format)."""
    p = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.parquet(*p)
