"""Sources and sinks (S1-S11).  Splits are a ``split`` column, written with ``partitionBy``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.sources import documents, records

SPLIT = "split"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_delimited(spark: SparkSession, paths: dict[str, str | list[str]], sep: str = "\t",
                   schema: T.StructType | str | None = None, header: bool = True, multi_line: bool = False) -> DataFrame:
    """Delimited files per split.  ``multi_line`` is for data whose quoted fields span lines; large files are
    split there too (``records.read_records``)."""
    frames = []
    for split, path in paths.items():
        reader = spark.read.options(header=header, multiLine=multi_line, **_delimited_options(sep))
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", False)
        rows = reader.csv(path)
        if multi_line:
            rows = _parse_records(records.read_records(spark, path, sep), rows.schema, sep, header)
        frames.append(rows.withColumn(SPLIT, F.lit(split)))
    return _union(frames)


def _delimited_options(sep: str) -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _parse_records(rows: DataFrame, schema: T.StructType, sep: str, header: bool) -> DataFrame:
    """Records to columns; the first record of a file is its header."""
    kept = rows.where(F.col("record") > 0) if header else rows
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("value", ddl, {**_delimited_options(sep), "multiLine": "true"})
    return kept.select(parsed.alias("row")).select("row.*")


def write_delimited(df: DataFrame, path: str, sep: str = "\t", mode: str = "overwrite") -> None:
    """S1 reverse: delimited files with a header, fields quoted where needed."""
    df.write.mode(mode).option("sep", sep).option("header", True).option("quote", '"').option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per line, column ``text``."""
    return spark.read.text(paths).withColumnRenamed("value", "text")


def read_jsonl(spark: SparkSession, paths: dict[str, str | list[str]] | str, schema: T.StructType | str) -> DataFrame:
    """S3: JSON lines, one object per line, optionally per split; explicit schema (no inference)."""
    if isinstance(paths, str):
        return spark.read.schema(schema).json(paths)
    return _union([spark.read.schema(schema).json(p).withColumn(SPLIT, F.lit(s)) for s, p in paths.items()])


def read_json_field(spark: SparkSession, path: str, field: str, schema: T.StructType) -> DataFrame:
    """Rows stored as a list under one top-level key of a JSON document.  Large documents are split
    (``documents.read_elements``); a compressed one (``.gz`` allowed) is one task."""
    return documents.read_rows(spark, path, field, schema)


def save_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Columnar save, one folder per split."""
    df.write.mode(mode).partitionBy(SPLIT).parquet(path)


def load_splits(spark: SparkSession, path: str) -> DataFrame:
    """Reload; the split folders become the ``split`` column again (pruned on filter)."""
    return spark.read.parquet(path)


def export_jsonl(df: DataFrame, path: str, by_split: bool = True, mode: str = "overwrite") -> None:
    """JSON lines, one output folder per split when ``by_split``."""
    writer = df.write.mode(mode)
    if by_split and SPLIT in df.columns:
        writer = writer.partitionBy(SPLIT)
    writer.json(path)


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Each record as one JSON line."""
    df.write.mode(mode).json(path)


# Marker of a log line that could not be parsed.
PARSE_ERROR = "parse_error"


def parse_event_lines(lines: DataFrame, schema: T.StructType, text_col: str = "text") -> DataFrame:
    """S8 core: parse JSON lines; an unparsable line becomes ``event = parse_error`` with its raw text."""
    corrupt = "_corrupt"
    full = T.StructType(list(schema.fields) + [T.StructField(corrupt, T.StringType())])
    parsed = F.from_json(F.col(text_col), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    broken = parsed.isNull() | parsed[corrupt].isNotNull()
    cols = []
    for f in schema.fields:
        value = parsed[f.name]
        if f.name == "event":
            value = F.when(broken, F.lit(PARSE_ERROR)).otherwise(value)
        else:
            value = F.when(broken, F.lit(None).cast(f.dataType)).otherwise(value)
        cols.append(value.alias(f.name))
    cols.append(F.when(broken, F.col(text_col)).alias("raw"))
    return lines.where(F.trim(F.col(text_col)) != "").select(*cols)


def read_event_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON-lines log read that never fails."""
    return parse_event_lines(read_text(spark, path), schema)



def export_pages(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw HTML with a source comment plus the text rendering, keyed by the safe title.
    ``df`` is the output of ``operators.web.render_text``."""
    out = df.select(
        F.col("file_name"),
        F.concat(F.lit("<!-- Source: "), F.col("url"), F.lit(" -->\n"), F.col("html")).alias("html_file"),
        F.col("rendered").alias("text_file"),
    )
    out.write.mode(mode).parquet(path)


def archive_transcripts(df: DataFrame, path: str, key: str = "conv_id", order_by: str = "turn",
                        mode: str = "overwrite") -> None:
    """Every message as one JSON line (key included), in ranges of (conversation, turn) sorted inside each
    file; a conversation that holds much of the table is spread over several files in order."""
    msg = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    df.repartitionByRange(key, order_by).sortWithinPartitions(key, order_by).select(msg.alias("value")) \
        .write.mode(mode).text(path)


def save_embeddings(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Embedding table saved apart from any index built on it."""
    df.write.mode(mode).parquet(path)


def load_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
