"""Raw feeds and layer tables as files."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed_values import CSV_MISSING
from ..functions.text import missing_to_null
from ..operators.dedup import ORDINAL
from .shared import dropping_shuffles, gathered, materialise
from .split_records import csv_records, json_records


# Options of reading and writing layer tables, by format. Zstandard and the delta encodings of Parquet's second version take
# some 40 % less disk than the defaults.
_READING = {"parquet": {}, "csv": {"header": True, "escape": '"', "multiLine": True}}
_WRITING = {"parquet": {"compression": "zstd", "parquet.writer.version": "v2"},
            "csv": {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}}


def list_files(spark: SparkSession, path: str, extension: str) -> DataFrame:
    """Files directly under `path` with the extension, sorted; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{extension}").load(path)
    return files.select("path", "length").orderBy("path")


def feed_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in a folder, sorted: files, and tables that are folders of files."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(entry.getPath().getName() for entry in files.listStatus(place))


def with_ordinal(df: DataFrame) -> DataFrame:
    """Add the arrival position of each row: file, block of the file, row within the block.

    The generated id only ever decides within one block of one file, where it follows the order of rows, so the
    order does not depend on how blocks are spread over tasks.
    """
    place = F.struct("_metadata.file_path", "_metadata.file_block_start",
                     F.monotonically_increasing_id().alias("row"))
    return df.withColumn(ORDINAL, place)


def _cells_span_lines(spark: SparkSession, path: str) -> bool:
    """Whether some line has an odd number of quotes, so a quoted cell goes on in the next line."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not gathered(spark.read.text(path)).where(quotes % 2 == 1).isEmpty()


def read_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """CSV with a header, all columns as text, the usual missing-value tokens as null.

    Missing cells at the end of a record are null; a record with more cells than the header fails the job that reads
    it. Files with line feeds inside of quoted cells are split like others, by way of an intermediate table; without
    `multi_line` a pass over the lines, which ends at the first such cell, finds out.
    """
    if multi_line is None:
        multi_line = _cells_span_lines(spark, path)
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    names, record = reader.csv(path).columns, "__record"
    if multi_line:
        # Cells by position, since names may hold any sign.
        layout = ", ".join([*[f"c{i} string" for i in range(len(names))], f"{record} string"])
        parsed = F.from_csv("value", layout, {"escape": '"', "columnNameOfCorruptRecord": record})
        cells = csv_records(spark, path).select(parsed.alias("cells"), ORDINAL).select(
            *[F.col("cells")[f"c{i}"].alias(c) for i, c in enumerate(names)], F.col("cells")[record].alias(record), ORDINAL)
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, record]])
        cells = with_ordinal(reader.schema(schema).option("columnNameOfCorruptRecord", record).csv(path))
    # Spark keeps the record beside the cells if their numbers differ; only then it is read again.
    again = F.from_csv(record, ", ".join(f"c{i} string" for i in range(len(names) + 1)), {"escape": '"'})
    surplus = F.col(record).isNotNull() & again[f"c{len(names)}"].isNotNull()
    fail = F.raise_error(F.concat(F.lit("More cells than columns: "), F.col(record)))
    text = {f"`{c}`": missing_to_null(F.col(f"`{c}`"), CSV_MISSING) for c in names}
    columns = [value.alias(c) for c, value in zip(names, text.values())]
    columns[0] = F.when(surplus, fail.cast("string")).otherwise(text[f"`{names[0]}`"]).alias(names[0])
    return cells.select(*columns, ORDINAL)


def read_json(spark: SparkSession, path: str, one_array: bool = True) -> DataFrame:
    """JSON records with all their fields, as text: one array per file, or one record per line. Arrays are split like
    lines, by way of an intermediate table. Fields are found by a pass over all records. Nested values become JSON text;
    a malformed record fails the read."""
    options = {"primitivesAsString": "true", "mode": "FAILFAST"}
    if one_array:
        records = materialise(json_records(spark, path))
        texts = getattr(records.select("value")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
        fields = spark._jsparkSession.read().options(options).json(texts).schema().json()
        schema = T.StructType.fromJson(json.loads(fields))
        cells = records.select(F.from_json("value", schema, options).alias("cells"), ORDINAL).select(
            *[F.col("cells")[name].alias(name) for name in schema.names], ORDINAL)
    else:
        cells = with_ordinal(spark.read.options(**options).json(path))
    nested = [f.name for f in cells.drop(ORDINAL).schema.fields if not isinstance(f.dataType, T.StringType)]
    return cells.withColumns({c: F.to_json(F.col(f"`{c}`")) for c in nested})


def _layer(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, str]:
    for extension, options in _READING.items():
        try:
            return spark.read.options(**options).format(extension).load(f"{folder}/{name}.{extension}"), extension
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    raise FileNotFoundError(f"{folder}/{name}.parquet or .csv")


def read_layer(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A layer table: Parquet if it is there, else CSV.

    With a schema the table has its columns and types, and the ordinal if it is there; CSV is text without one.
    """
    df, _ = _layer(spark, folder, name)
    if schema is None:
        return df
    kept = [ORDINAL] if ORDINAL in df.columns else []
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], *kept)


def read_layer_parts(spark: SparkSession, folder: str, name: str, part_bytes: int) -> list[DataFrame]:
    """A layer table in parts of whole files, of at most `part_bytes` unless a single file is larger; together they are all its rows."""
    whole, extension = _layer(spark, folder, name)
    path = f"{folder}/{name}.{extension}"
    parts: list[list[str]] = [[]]
    size = 0
    files = spark.read.format("binaryFile").load(path).select("path", "length").orderBy("path")
    for file, length in files.collect():  # one row per file, without its content
        if parts[-1] and size + length > part_bytes:
            parts.append([])
            size = 0
        parts[-1].append(file)
        size += length
    if len(parts) == 1:
        return [whole]
    reader = spark.read.options(**_READING[extension], basePath=path).schema(whole.schema).format(extension)
    return [reader.load(part) for part in parts]


def remove_layer(spark: SparkSession, folder: str, name: str, output_format: str = "parquet") -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.{output_format}")
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _flat(df: DataFrame) -> DataFrame:
    """Structs, which CSV cannot hold, as text that sorts as they do."""
    def text(column: T.StructField) -> Column:
        parts = [F.col(f"`{column.name}`")[f.name].cast("string") if isinstance(f.dataType, T.StringType)
                 else F.lpad(F.col(f"`{column.name}`")[f.name].cast("string"), 20, "0") for f in column.dataType.fields]
        return F.concat_ws("|", *parts)

    return df.withColumns({c.name: text(c) for c in df.schema.fields if isinstance(c.dataType, T.StructType)})


def write_layer(df: DataFrame, folder: str, name: str, output_format: str = "parquet",
                partition_by: list[str] | None = None, sort_by: list[str] | None = None,
                counts: dict[str, Column] | None = None, add: bool = False) -> dict[str, int]:
    """Replace a layer table, or with `add` put rows beside its own. Returns the number of rows as `linhas` and other aggregates asked for, which are counted
    while the rows are written.

    `partition_by` makes directories for pruning. Rows are gathered by directory, and directories with many rows are
    split over several tasks once their size is known, so each has few files and none waits for one large task.
    Without directories, `sort_by` gives the whole table that order. Shuffles of the write are removed when it ends.
    """
    path = f"{folder}/{name}.{output_format}"
    if output_format == "csv":
        df = _flat(df)
    order = [*(partition_by or []), *(sort_by or [])]
    # Counted after the rows are dealt, since dealing by ranges reads what lies before it twice.
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    elif sort_by:
        df = df.repartitionByRange(*sort_by)
    seen, counts = Observation(), {"linhas": F.count(F.lit(1)), **(counts or {})}
    df = df.observe(seen, *[count.alias(name) for name, count in counts.items()])
    if order:
        df = df.sortWithinPartitions(*order)
    writer = df.write.mode("append" if add else "overwrite").format(output_format).options(**_WRITING.get(output_format, {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with dropping_shuffles(df.sparkSession):
        writer.save(path)
    found = seen.get
    return {name: int(found.get(name) or 0) for name in counts}
