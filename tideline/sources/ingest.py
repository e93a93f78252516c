"""Incremental ingest of JSON and CSV files with a stored schema and rescued fields."""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from tideline.streaming import paths
from tideline.streaming.writers import Prepared

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _unfit(raw: Column, typed: Column, kind: DataType) -> Column:
    """Whether the JSON text ``raw`` holds something that its parsed form ``typed`` lost; each level is parsed once."""
    if isinstance(kind, StructType):
        names = F.array(*[F.lit(f.name) for f in kind.fields])

        def lost(fields: Column) -> Column:
            found = F.exists(F.map_keys(F.map_filter(fields, lambda k, v: v.isNotNull())),
                             lambda k: ~F.array_contains(names, k))
            for f in kind.fields:
                found = found | _unfit(F.try_element_at(fields, F.lit(f.name)), typed.getField(f.name), f.dataType)
            return F.when(fields.isNull(), True).otherwise(found)

        inner = _bound(F.from_json(raw, "map<string,string>"), lost)
    elif isinstance(kind, ArrayType):
        inner = _bound(F.from_json(raw, "array<string>"), lambda items: F.when(
            items.isNull() | typed.isNull() | (F.size(items) != F.size(typed)), True).otherwise(
            F.exists(F.zip_with(items, typed, lambda r, t: _unfit(r, t, kind.elementType)), lambda x: x)))
    elif isinstance(kind, MapType):
        inner = _bound(F.from_json(raw, "map<string,string>"), lambda entries: F.when(
            entries.isNull() | typed.isNull(), True).otherwise(F.exists(F.map_values(
                F.map_zip_with(entries, typed, lambda k, r, t: _unfit(r, t, kind.valueType))), lambda x: x)))
    else:
        return raw.isNotNull() & typed.isNull()
    return F.coalesce(F.when(raw.isNull(), False).otherwise(inner), F.lit(False))


def rescue_json(lines: DataFrame, line: str, schema: StructType, rescued: str = RESCUED) -> DataFrame:
    """Columns of ``schema`` parsed from the JSON text in ``line``, plus the fields that did not fit.

    The last column is a JSON object with every field that is not in the schema, or whose value
    does not have the declared type; NULL when all fields fit. A struct, array or map that lost
    anything inside is kept as a whole there. A line that is no JSON object at
    all is kept whole under ``_corrupt_record``. Each line is parsed twice: by schema, and as a
    map of texts. Both results are columns of their own, so no later expression parses again;
    nested fields are parsed once more per level.
    """
    parsed = lines.select(F.col(line).alias("__line"), F.from_json(line, schema).alias("__typed"),
                          F.from_json(line, "map<string,string>").alias("__raw"))

    def fits(field: StructField) -> Column:
        typed = F.col("__typed").getField(field.name)
        if not isinstance(field.dataType, (StructType, ArrayType, MapType)):
            return typed.isNotNull()
        return typed.isNotNull() & ~_unfit(F.try_element_at("__raw", F.lit(field.name)), typed, field.dataType)

    fitted = F.array(*[F.when(fits(f), F.lit(f.name)) for f in schema.fields])
    # Fields that fit and explicit nulls leave the map.
    unfit = parsed.withColumn("__fitted", F.array_compact(fitted)).withColumn("__left", F.map_filter(
        "__raw", lambda k, v: v.isNotNull() & ~F.array_contains("__fitted", k)))
    corrupt = F.when(F.trim("__line") != "", F.to_json(F.create_map(F.lit(CORRUPT), "__line")))
    kept = (F.when(F.col("__raw").isNull(), corrupt)
            .when(F.size("__left") > 0, F.to_json("__left")))
    return unfit.select(*[F.col("__typed").getField(f.name).alias(f.name) for f in schema.fields],
                        kept.alias(rescued))


def _split_header(line: str, options: dict) -> list[str]:
    return next(csv.reader([line], delimiter=options.get("sep", options.get("delimiter", ",")),
                           quotechar=options.get("quote", '"') or None))


def _literal_path(path: str) -> str:
    """A file's URI as a path that is taken literally, without wildcards."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", unquote(path))


def _by_header(lines: DataFrame, options: dict) -> dict[str, list[str]]:
    """Header line to the files that begin with it, for rows of text with their file and block start.

    Only a file's first block is looked at, in tasks; files without a line have no header.
    """
    first = (lines.where("__start = 0").withColumn("__at", F.monotonically_increasing_id())
             .groupBy("__file").agg(F.min_by("value", "__at").alias("header")))
    found: dict[str, list[str]] = {}
    for r in first.collect():
        found.setdefault(r["header"], []).append(r["__file"])
    return found


def _with_files(reader, source: str) -> DataFrame:
    return reader.text(source).select("value", F.col("_metadata.file_path").alias("__file"),
                                      F.col("_metadata.file_block_start").alias("__start"))


def _texts(spark: SparkSession, header: list[str], files: list[str], options: dict) -> DataFrame:
    """The rows of files that share a header; columns ``__0``, ``__1``, ... as text."""
    schema = StructType([*[StructField(f"__{i}", StringType()) for i in range(len(header))],
                         StructField(CORRUPT, StringType())])
    return (spark.read.options(**options).option("header", True).option("columnNameOfCorruptRecord", CORRUPT)
            .schema(schema).csv([_literal_path(f) for f in files]))


def _named(texts: DataFrame, header: list[str], schema: StructType, rescued: str | None) -> DataFrame:
    """Columns of ``schema`` by name from the text columns of one header (see ``csv_by_name``)."""
    places: dict[str, int] = {}
    unknown: list[tuple[str, int]] = []
    wanted = set(schema.names)
    for i, name in enumerate(header):
        if name in wanted and name not in places:
            places[name] = i
        else:
            again = header[:i].count(name)
            unknown.append((f"{name}#{again + 1}" if again else name, i))
    typed, lost = {}, []
    for f in schema.fields:
        text = F.col(f"__{places[f.name]}") if f.name in places else F.lit(None).cast("string")
        typed[f.name] = text if isinstance(f.dataType, StringType) else F.trim(text).try_cast(f.dataType)
        entry = F.struct(F.lit(f.name).alias("key"), text.alias("value"))
        lost.append(F.when(text.isNotNull() & typed[f.name].isNull(), entry))
    lost += [F.when(F.col(f"__{i}").isNotNull(), F.struct(F.lit(name).alias("key"), F.col(f"__{i}").alias("value")))
             for name, i in unknown]
    columns = [typed[f.name].alias(f.name) for f in schema.fields]
    if rescued is None:
        return texts.select(*columns)
    whole = F.when(F.col(CORRUPT).isNotNull(), F.array(F.struct(F.lit(CORRUPT).alias("key"), F.col(CORRUPT).alias("value"))))
    kept = F.map_from_entries(F.coalesce(whole, F.array_compact(F.array(*lost))))
    return texts.select(*columns, F.when(F.size(kept) > 0, F.to_json(kept)).alias(rescued))


def csv_by_name(lines: DataFrame, schema: StructType, rescued: str | None, options: dict) -> DataFrame:
    """The records of CSV files, their columns found by the names in each file's own header.

    A first pass finds the header lines of the files; files with the same one are read together. A column that a file lacks is
    NULL. With ``rescued``, a JSON object keeps what does not fit: values under names that the schema lacks, values
    of the wrong type, and rows with more or fewer values than the header, whole, under ``_corrupt_record``. A name that a
    header repeats counts once; the others are kept as ``name#2``, ``name#3``.
    """
    spark, found = lines.sparkSession, None
    for header, files in sorted(_by_header(lines, options).items()):
        names = _split_header(header, options)
        part = _named(_texts(spark, names, files, options), names, schema, rescued)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], _with_rescued(schema, rescued))


def _with_rescued(schema: StructType, rescued: str | None) -> StructType:
    return schema if rescued is None else StructType([*schema.fields, StructField(rescued, StringType())])


_NUMBERS = ("int", "bigint", "double")


def _common(one: DataType, other: DataType) -> DataType:
    """A type for values of both: the wider number, else text."""
    if one == other:
        return one
    names = one.simpleString(), other.simpleString()
    if all(n in _NUMBERS for n in names):
        return max(one, other, key=lambda t: _NUMBERS.index(t.simpleString()))
    return StringType()


def _infer_csv(spark: SparkSession, source: str, infer_types: bool, options: dict) -> StructType:
    """Columns of all headers by name, in order of their first header; types are inferred per header."""
    found: dict[str, DataType] = {}
    by_header = _by_header(_with_files(spark.read.options(recursiveFileLookup=True), source), options)
    for header, files in sorted(by_header.items(), key=lambda item: min(item[1])):
        names = _split_header(header, options)
        kinds = (spark.read.options(**options).option("header", True).option("inferSchema", infer_types)
                 .csv([_literal_path(f) for f in files]).schema.fields)
        for name, f in zip(names, kinds):
            kind = f.dataType if infer_types else StringType()
            found[name] = _common(found[name], kind) if name in found else kind
    return StructType([StructField(n, t) for n, t in found.items()])


def infer_schema(spark: SparkSession, source: str, file_format: str, infer_types: bool = True,
                 options: dict | None = None) -> StructType:
    """Schema of all files under a folder or glob, at any depth; without types all columns are text."""
    try:
        if file_format == "csv":
            schema = _infer_csv(spark, source, infer_types, options or {})
        else:
            schema = spark.read.options(recursiveFileLookup=True, **(options or {})).json(source).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise ValueError(f"no file to infer a schema from at {source}") from error
        raise
    schema = StructType([f for f in schema.fields if f.name != CORRUPT])
    if not schema.fields:
        raise ValueError(f"no file to infer a schema from at {source}")
    if infer_types:
        return schema
    return StructType([StructField(f.name, StringType()) for f in schema.fields])


def stored_schema(spark: SparkSession, schema_location: str, source: str, file_format: str,
                  infer_types: bool, options: dict | None) -> StructType:
    """The schema kept at ``schema_location``; inferred and stored on first use."""
    path = f"{schema_location.rstrip('/')}/schema.json"
    if not paths.exists(spark, path):
        schema = infer_schema(spark, source, file_format, infer_types, options)
        paths.write_text(spark, path, schema.json())
    return StructType.fromJson(json.loads(paths.read_text(spark, path)))


def ingest_files(spark: SparkSession, source: str, file_format: str,
                 schema: StructType | str | None = None, schema_location: str | None = None,
                 infer_types: bool = True, rescued: str | None = None,
                 max_files: int | None = None, options: dict | None = None) -> DataFrame | Prepared:
    """A stream of the records in the files at ``source`` (a folder or glob), for ``write_streaming_table``.

    The schema is the one given, else the stored one, else inferred from all files at any depth. With
    ``rescued`` a column of that name keeps what does not fit (see ``rescue_json``, ``csv_by_name``). CSV files
    are read batch by batch, as their headers name the columns.
    """
    if file_format not in ("json", "csv"):
        raise ValueError(f"unsupported format {file_format}")
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if schema is None and schema_location:
        schema = stored_schema(spark, schema_location, source, file_format, infer_types, options)
    if schema is None:
        schema = infer_schema(spark, source, file_format, infer_types, options)

    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if file_format == "csv":
        settings = dict(options or {})
        return Prepared(_with_files(reader, source),
                        lambda lines: csv_by_name(lines, schema, rescued, settings), _with_rescued(schema, rescued))
    reader = reader.options(**(options or {}))
    if rescued is None:
        return reader.schema(schema).json(source)
    # Parsed batch by batch: what Spark derives about a stream's rows before it hands them over grows fast with the
    # number of parsed fields.
    return Prepared(reader.text(source),
                    lambda lines: rescue_json(lines.where(F.trim("value") != ""), "value", schema, rescued),
                    _with_rescued(schema, rescued))
