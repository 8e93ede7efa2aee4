"""Typed and untyped readers of the raw, curated and result layers."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.defaults import CATALOG_SCHEMA, DATE_FORMAT
from ratingloom.sources.publish import Files
from ratingloom.sources.workspace import default_file_system, require_disjoint
from ratingloom.sources.writers import LAYOUT, bucketed_name

CORRUPT = "_corrupt_record"


def _csv_options(multi_line: bool) -> dict[str, object]:
    # A quote inside a quoted field is written twice, hence the escape character.
    return {"header": True, "escape": '"', "mode": "PERMISSIVE", "multiLine": multi_line}


def _by_header(
    spark: SparkSession, path: str | list[str], types: Mapping[str, T.DataType], options: dict
) -> DataFrame:
    """Columns as the header names them, whatever their order; others come as text.

    The first file's header gives the order. A file whose header differs raises an error
    that names it: Spark compares every header with the schema.
    """
    header = spark.read.options(**options).csv(path).columns
    fields = [T.StructField(name, types.get(name, T.StringType())) for name in header]
    return spark.read.schema(T.StructType(fields)).options(**options, enforceSchema=False).csv(path)


def read_catalog(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str = CATALOG_SCHEMA,
    *,
    names: Mapping[str, str] | None = None,
    date_format: str = DATE_FORMAT,
    multi_line: bool = False,
) -> DataFrame:
    """Catalogue CSV by header name, typed and ordered as declared; bad cells become null.

    ``names`` maps declared columns to the names that the file gives them, where these
    differ. A declared column that the header lacks is an error; further columns are
    left out. ``multi_line=True`` reads fields with line breaks inside quotes. Such a
    file cannot be split, so one task reads each file: keep the files small.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    in_file = {f.name: (names or {}).get(f.name, f.name) for f in declared}
    types = {in_file[f.name]: f.dataType for f in declared}
    options = _csv_options(multi_line) | {"dateFormat": date_format}
    table = _by_header(spark, path, types, options)
    missing = [name for name in types if name not in table.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return table.select(*[F.col(f"`{in_file[f.name]}`").alias(f.name) for f in declared])


def read_audited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str = CATALOG_SCHEMA,
    *,
    names: Mapping[str, str] | None = None,
    date_format: str = DATE_FORMAT,
    multi_line: bool = False,
) -> DataFrame:
    """As ``read_catalog``, but no cell becomes null in silence.

    ``_file`` and ``_line`` are the file and the raw text of a row that holds a bad cell, else
    null, and ``_bad`` lists those cells: struct of column and text. A cell is bad if it has text
    and no value of its type. A row with too many or too few fields is listed under column
    ``*`` with its whole text.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    in_file = {f.name: (names or {}).get(f.name, f.name) for f in declared}
    types = {in_file[f.name]: f.dataType for f in declared}
    options = _csv_options(multi_line) | {"dateFormat": date_format}
    header = spark.read.options(**options).csv(path).columns
    missing = [name for name in types if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    fields = [T.StructField(name, types.get(name, T.StringType())) for name in header]
    with_line = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    table = (
        spark.read.schema(with_line)
        .options(**options, enforceSchema=False, columnNameOfCorruptRecord=CORRUPT, columnPruning=False)
        .csv(path)
        .withColumn("_file", F.col("_metadata.file_path"))
    )
    plain = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
    cells = F.from_csv(F.col(CORRUPT), plain.simpleString()[7:-1].replace(":", " "), {"escape": '"'})
    table = table.withColumn("_cells", F.when(F.col(CORRUPT).isNotNull(), cells))
    bad = [
        F.when(
            F.col(f"`{name}`").isNull() & (F.col(f"_cells.c{i}") != ""),
            F.struct(F.lit(name).alias("column"), F.col(f"_cells.c{i}").alias("text")),
        )
        for i, name in enumerate(header)
        if not isinstance(types.get(name, T.StringType()), T.StringType)
    ]
    listed = F.filter(F.array(*bad), lambda cell: cell.isNotNull())
    whole = F.array(F.struct(F.lit("*").alias("column"), F.col(CORRUPT).alias("text")))
    found = F.when(F.col(CORRUPT).isNotNull(), F.when(F.size(listed) > 0, listed).otherwise(whole))
    return table.select(
        *[F.col(f"`{in_file[f.name]}`").alias(f.name) for f in declared],
        F.when(F.col(CORRUPT).isNotNull(), F.col("_file")).alias("_file"),
        F.col(CORRUPT).alias("_line"),
        found.alias("_bad"),
    )


def rejected_cells(audited: DataFrame) -> DataFrame:
    """One row per bad cell of ``read_audited`` rows: file, line, column and text."""
    rows = audited.where("_line IS NOT NULL").select("_file", "_line", F.explode("_bad").alias("cell"))
    return rows.select(
        F.col("_file").alias("file"), F.col("_line").alias("line"), "cell.column", F.col("cell.text").alias("text")
    )


def read_text_table(
    spark: SparkSession, path: str | list[str], *, multi_line: bool = False
) -> DataFrame:
    """CSV with a header, every column as text: nothing is lost to typing."""
    return spark.read.options(**_csv_options(multi_line)).csv(path)


def read_wide_votes(
    spark: SparkSession, path: str | list[str], *, key: str = "appid", multi_line: bool = False
) -> DataFrame:
    """Vote matrix whose header names the tags: an integer key, a count per tag.

    The schema comes from the header alone; inferring types would read the whole
    file once more. Files whose headers differ are an error, never misread.
    """
    options = _csv_options(multi_line)
    header = spark.read.options(**options).csv(path).columns
    types = {name: T.IntegerType() if name == key else T.LongType() for name in header}
    return _by_header(spark, path, types, options)


def read_votes_by_header(
    spark: SparkSession, path: str | list[str], *, key: str = "appid", multi_line: bool = False
) -> DataFrame:
    """Vote matrices whose files do not list the same tags: one table with all of them.

    Files are grouped by their header line, which the driver reads from each; a group is one
    scan. A tag that a file does not list has zero votes there, while a cell that a file
    leaves empty stays null, as in ``read_wide_votes``. Tags come in the order in which the
    files, by name, list them first. A file without the key is an error.
    """
    files, groups = Files(spark), {}
    for one in [path] if isinstance(path, str) else path:
        for file in files.data_files(one):
            groups.setdefault(files.first_line(file).lstrip("\ufeff"), []).append(file)
    groups.pop("", None)  # empty files
    tables = [read_wide_votes(spark, held, key=key, multi_line=multi_line) for held in groups.values()]
    without = [held[0] for held, table in zip(groups.values(), tables) if key not in table.columns]
    if without or not tables:
        raise ValueError(f"{without[0] if without else path} has no column {key}")
    tags = list(dict.fromkeys(c for table in tables for c in table.columns if c != key))
    zero = F.lit(0).cast("long")
    aligned = [
        table.select(
            F.col(f"`{key}`"),
            *[F.col(f"`{tag}`") if tag in table.columns else zero.alias(tag) for tag in tags],
        )
        for table in tables
    ]
    union = aligned[0]
    for table in aligned[1:]:
        union = union.unionByName(table)
    return union


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """Curated Parquet; the partition column comes back last, from the folder names."""
    return spark.read.parquet(path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``writers.write_bucketed`` with its layout, in this or a later session."""
    layout = json.loads(Files(spark).read(f"{path}/{LAYOUT}"))
    name, key = bucketed_name(path), f"`{layout['key']}`"
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(layout["schema"]))
    )
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {layout['buckets']} BUCKETS LOCATION '{location}'"
    )
    return spark.table(name)


def read_result(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A result table written as CSV. Rows of a file have no order: sort after reading.

    Without a schema the types are inferred, which suits small results only.
    """
    reader = spark.read.options(**_csv_options(False))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_summary(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A summary object, on one line or pretty-printed."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def land_raw(
    spark: SparkSession, sources: Mapping[str, str | None], target: str, *, multi_line: bool = False
) -> dict[str, str]:
    """Copy raw files into the raw zone as text columns with their file of origin.

    ``sources`` maps a table name to its path; a table whose path is None is
    optional and skipped. A rerun replaces the landed tables, which must not overlap
    the files that they come from.
    """
    given = [path for path in sources.values() if path is not None]
    require_disjoint(given, [target], default_file_system(spark))
    landed = {}
    for name, path in sources.items():
        if path is None:
            continue
        table = read_text_table(spark, path, multi_line=multi_line)
        landed[name] = f"{target}/{name}"
        table.select("*", F.col("_metadata.file_path").alias("source_file")).write.mode(
            "overwrite"
        ).parquet(landed[name])
    return landed
