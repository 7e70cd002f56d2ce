"""JSON line → record with intrinsics, tolerant of bad lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptally.functions.json import (
    CHECKSUM_FIELD,
    ERROR_CODE,
    RECORD_SIZE_FIELD,
    parse_line,
    table_key,
    variant_schema_to_ddl,
)
from snaptally.functions.text import text_length

TABLE_NAME = "tableName"
RECORD = "record"
IS_VALID = "is_valid"
ERROR = "error"
ERROR_KIND = "error_kind"
_TABLE_RAW = "__snaptally_table_raw"


def parse_records(
    lines: DataFrame,
    value_col: str = "value",
    *,
    lenient: bool = False,
    unit: str = "utf16",
    checksum: bool = False,
    keep_record: bool = True,
) -> DataFrame:
    """Parse each line as one JSON object and add the record's intrinsics.

    Added columns:

    ``record``        the parsed object (VARIANT; MAP<STRING,STRING> when
                      ``lenient``), NULL for a bad line. Left out when
                      ``keep_record`` is False, which lets the optimizer drop
                      the object once the table name is taken from it.
    ``is_valid``      the line is exactly one JSON object (blank lines, JSON
                      null, arrays, scalars, cut or trailing text are bad).
    ``error``         ``MALFORMED_JSON`` for a bad line, else NULL.
    ``error_kind``    for a bad line, why: ``EMPTY_LINE``, ``NOT_AN_OBJECT``
                      (strict mode), ``TRAILING_CONTENT`` or ``INVALID_JSON``;
                      else NULL. Computed only for bad lines.
    ``tableName``     the ``~table`` field (JSON text when not a string),
                      ``unknown`` when absent, null, or the line is bad.
    ``~recordSize``   length of the line in ``unit`` for a good line, NULL for
                      a bad one; it stands for any ``~recordSize`` field of the
                      input, which it overrides.
    ``~checksum``     with ``checksum``: SHA-256 (hex) of the line.

    A bad line never fails the job; every line yields exactly one row. A good
    line that VARIANT cannot hold (a string of 20,000,000 characters, 128 MiB,
    1,000 levels) is counted like any other; only its ``record`` is NULL.
    """
    added = {RECORD, IS_VALID, ERROR, ERROR_KIND, TABLE_NAME, RECORD_SIZE_FIELD, CHECKSUM_FIELD}
    clash = sorted(added.intersection(lines.columns))
    if clash:
        raise ValueError(f"input already has columns {clash}; rename them before parse_records")
    v = F.col(value_col)
    p = parse_line(v, lenient=lenient)
    keep = [F.col(f"`{c}`") for c in lines.columns]
    # Projections in order: the parse stages (each parse once), then validity
    # decided once, then the outputs derived from it.
    parsed, hidden = lines, []
    for stage in p.first:
        parsed = parsed.select(*keep, *[F.col(h) for h in hidden], *[e.alias(n) for n, e in stage.items()])
        hidden += list(stage)
    decided = parsed.select(
        *keep,
        *([F.when(p.is_valid, p.record).alias(RECORD)] if keep_record else []),
        p.is_valid.alias(IS_VALID),
        F.when(p.is_valid, p.table_raw).alias(_TABLE_RAW),
        F.when(~p.is_valid, p.error_kind).alias(ERROR_KIND),
    )
    valid = F.col(IS_VALID)
    out = [
        *keep,
        *([F.col(RECORD)] if keep_record else []),
        valid,
        F.when(~valid, F.lit(ERROR_CODE)).alias(ERROR),
        F.col(ERROR_KIND),
        table_key(F.col(_TABLE_RAW)).alias(TABLE_NAME),
        F.when(valid, text_length(v, unit)).alias(RECORD_SIZE_FIELD),
    ]
    if checksum:
        out.append(F.sha2(v, 256).alias(CHECKSUM_FIELD))
    return decided.select(*out)


def record_size_or_zero(col: str = RECORD_SIZE_FIELD):
    """Size used by the statistics: the record size, 0 for a bad line."""
    return F.coalesce(F.col(f"`{col}`"), F.lit(0).cast("bigint"))


def written_with_schema(good: DataFrame, record_col: str = RECORD) -> tuple[DataFrame, str | None, int, int]:
    """Write records once to the shared folder as Parquet and observe, in the same pass, the
    merged schema, how many there are and how many VARIANT could not hold.

    Returns the written copy with these three."""
    from pyspark.sql import Observation

    from snaptally.session import scratch_path

    spark = good.sparkSession
    path = scratch_path(spark, "records")
    seen = Observation()
    record = F.col(record_col)
    counts = [F.schema_of_variant_agg(record).alias("schema"), F.count(F.lit(1)).alias("n"), F.count_if(record.isNull()).alias("unheld")]
    good.observe(seen, *counts).write.parquet(path)
    got = seen.get
    return spark.read.schema(good.schema).parquet(path), got["schema"], got["n"], got["unheld"]


def typed_records(records: DataFrame, record_col: str = RECORD, *, schema=None) -> DataFrame:
    """The good records of :func:`parse_records` (strict mode) as typed columns.

    Without ``schema`` it is merged by Spark over all good records in one
    distributed pass (``schema_of_variant_agg``; only the schema string reaches
    the driver): the one that parses them and writes them once to the shared
    folder, from where every record is cast to it. Give a ``schema`` (type or DDL) to
    skip that copy; values that don't fit are NULL.

    Bad lines, duplicate keys included, never reach the inference. A field
    whose type differs between records stays VARIANT, except that whole
    numbers beside fractions become the wider number type; an object without
    fields is VARIANT too. A computed ``~recordSize`` column replaces a field
    of that name and is always present, as does ``~checksum`` if the records have one. Field names equal except for case
    raise at any level, as Parquet columns would collide. A good record that
    VARIANT cannot hold raises when it is read, never goes missing.
    """
    from pyspark.sql.types import StructType, VariantType

    from snaptally.sources.json import check_column_names, check_nested_names

    if record_col not in records.columns:
        raise ValueError(f"no {record_col!r} column: parse with keep_record=True")
    if not isinstance(records.schema[record_col].dataType, VariantType):
        raise ValueError("typed_records needs VARIANT records (strict mode)")
    held = F.when(F.col(record_col).isNull(), F.raise_error(F.lit("a good record is too large or too deep for VARIANT")))
    size = F.col(f"`{RECORD_SIZE_FIELD}`") if RECORD_SIZE_FIELD in records.columns else F.lit(None).cast("bigint")
    extra = {RECORD_SIZE_FIELD: size} | ({CHECKSUM_FIELD: F.col(f"`{CHECKSUM_FIELD}`")} if CHECKSUM_FIELD in records.columns else {})
    good = records.where(F.col(IS_VALID)).select(held.otherwise(F.col(record_col)).alias(record_col), *[c.alias(n) for n, c in extra.items()])
    if schema is None:
        spark = records.sparkSession
        good, merged, _, _ = written_with_schema(good, record_col)
        if not merged or not merged.startswith("OBJECT"):  # no good record at all
            return spark.createDataFrame([], StructType([]))
        ddl = None if merged == "OBJECT<>" else variant_schema_to_ddl(merged)
    else:
        ddl = schema if isinstance(schema, str) else schema.simpleString()
        if not ddl.lower().lstrip().startswith("struct<"):
            ddl = f"struct<{ddl}>"
    if ddl is None:
        return good.select(*[F.col(f"`{n}`") for n in extra])
    typed = good.select(F.try_variant_get(F.col(record_col), "$", ddl).alias("r"), *[F.col(f"`{n}`").alias(f"x{i}") for i, n in enumerate(extra)])
    check_nested_names(typed.schema["r"].dataType)
    names = [f.name for f in typed.schema["r"].dataType.fields if f.name not in extra]
    quoted = [n.replace("`", "``") for n in names]
    out = typed.select(*[F.col("r").getField(n).alias(n) if "`" not in n else F.col(f"r.`{q}`").alias(n) for n, q in zip(names, quoted, strict=True)], *[F.col(f"x{i}").alias(n) for i, n in enumerate(extra)])
    check_column_names(out)
    return out
