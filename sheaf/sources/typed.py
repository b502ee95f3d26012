"""Delimited files with declared types, quoted fields and a stream of rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sheaf.functions.text import with_once
from sheaf.sources.lines import Records

_LINE, _REASON = "_line", "_reason"


def read_typed(
    spark: SparkSession,
    *paths: str,
    schema: StructType | str,
    sep: str = ",",
    header: bool = False,
    multiline: bool = False,
    required: Sequence[str] = (),
) -> Records:
    """Rows that fit the schema, and ``line, reason`` of those that do not.

    Fields may be quoted by ``"``, a quote inside doubled; quoted fields may hold the separator, and line breaks with
    ``multiline``, when a file is read by one task. An unquoted empty field is NULL. A row is a reject if it has another
    number of fields, a field that its type cannot hold, or none where one is ``required``. Every field is read as text
    first and checked by expressions; the parser is told to parse all columns whatever a query needs, since its own mark
    for damaged rows depends on the columns asked for. ``line`` is the text of the row if its number of fields is wrong,
    else its fields joined by the separator without quotes.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = StructType([*[StructField(f.name, StringType()) for f in wanted], StructField(_LINE, StringType())])
    rows = spark.read.csv(
        list(paths),
        schema=raw,
        sep=sep,
        header=header,
        multiLine=multiline,
        quote='"',
        escape='"',
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=_LINE,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    # every use keeps all columns up to here, so the mark is filled whatever is asked for later
    whole = rows.select(F.struct(*raw.names).alias("_row"))
    checked = with_once(whole, _REASON, reject_reason(wanted, required))
    good = checked.where(F.col(_REASON).isNull())
    rejects = checked.where(F.col(_REASON).isNotNull())
    joined = F.array_join(F.array(*[_field(f.name) for f in wanted]), sep, "")
    return Records(
        good=good.select(*[_field(f.name).try_cast(f.dataType).alias(f.name) for f in wanted]),
        rejects=rejects.select(F.coalesce(_field(_LINE), joined).alias("line"), F.col(_REASON).alias("reason")),
    )


def reject_reason(schema: StructType, required: Sequence[str]) -> Column:
    """NULL for a row that fits, otherwise why not, by the first field that does not."""
    reason = F.when(_field(_LINE).isNotNull(), F.lit("field count"))
    for f in schema:
        value = _field(f.name)
        kind = f.dataType.simpleString()
        reason = reason.when(value.isNotNull() & value.try_cast(f.dataType).isNull(), F.lit(f"not a {kind}: {f.name}"))
        if f.name in required or not f.nullable:
            reason = reason.when(value.isNull(), F.lit(f"missing: {f.name}"))
    return reason


def _field(name: str) -> Column:
    return F.col("_row").getField(name)


def read_typed_tables(spark: SparkSession, folder: str, schemas: dict[str, str]) -> dict[str, Records]:
    """:func:`read_typed` for comma-separated tables with a header line, one sub-folder or file per table."""
    return {name: read_typed(spark, f"{folder}/{name}", schema=ddl, header=True) for name, ddl in schemas.items()}
