"""RAW landing: gzipped NDJSON in date and batch folders, and its validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerforge.sources.scans import RAW_FILES

# Fixed value: most rows a landed file may hold.
MAX_LINES_PER_FILE = 20_000

_LISTED = 20


class LandingError(RuntimeError):
    """A landed file is missing, empty or not NDJSON."""


def raw_folder(base: str, source: str, entity: str, day: str, batch_id: str) -> str:
    return "/".join([base.rstrip("/"), source, entity, day, batch_id])


def write_raw(
    items: DataFrame, folder: str, max_lines: int = MAX_LINES_PER_FILE, validate: bool = True
) -> bool:
    """Land rows as gzipped NDJSON, NULL fields included; False when there is nothing to land.

    Every task writes its own files, so no row moves. The batch folder is
    overwritten as a whole, which makes a repeated landing of one batch safe.
    """
    if items.isEmpty():
        return False
    landed = Observation()
    (
        items.observe(landed, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_lines)
        .option("ignoreNullFields", "false")
        .json(folder)
    )
    if validate:
        validate_landing(items.sparkSession, folder, landed.get["rows"])
    return True


def _below(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    return (
        spark.read.format(fmt)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", RAW_FILES)
        .load(path)
    )


def _listed(files: DataFrame) -> DataFrame:
    """Names of all files of a scan, empty ones too, as `file_origin`.

    A scan leaves files of zero length out, so the names are those of the file
    index. They stay in the JVM that holds it; none comes to Python.
    """
    spark = files.sparkSession
    names = Column(spark._jvm.org.apache.spark.sql.functions.lit(files._jdf.inputFiles()))
    # The listing writes local paths as file:///, scans write file:/.
    path = F.regexp_replace("name", "^file:/+", "file:/").alias("file_origin")
    return spark.range(1).select(F.explode(names).alias("name")).select(path)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """`file_origin, n_bytes` of every raw file; the contents are not read."""
    files = _below(spark, "binaryFile", path)
    sized = files.select(F.col("_metadata.file_path").alias("file_origin"), "length")
    return _listed(files).join(sized, "file_origin", "left").select(
        "file_origin", F.coalesce("length", F.lit(0)).alias("n_bytes")
    )


def valid_json_line(column: str = "value") -> F.Column:
    """Whether the text is one JSON value. Never NULL."""
    return F.try_parse_json(column).isNotNull()


def line_report(lines: DataFrame, by: str = "file_origin") -> DataFrame:
    """Lines and broken lines per file. Every line is checked, in one pass."""
    return lines.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(~valid_json_line()).alias("n_bad"),
    )


def bad_files(spark: SparkSession, path: str, counted: Observation | None = None) -> DataFrame:
    """`file_origin, reason` of files that are empty or hold a line that is not JSON. `counted` gets the number of `lines`."""
    lines = _below(spark, "text", path).select(
        "value", F.col("_metadata.file_path").alias("file_origin")
    )
    report = line_report(lines)
    if counted is not None:
        report = report.observe(counted, F.coalesce(F.sum("n_lines"), F.lit(0)).alias("lines"))
    invalid = report.where("n_bad > 0").select(
        "file_origin", F.lit("invalid JSON").alias("reason")
    )
    empty = file_sizes(spark, path).where("n_bytes = 0").select(
        "file_origin", F.lit("empty").alias("reason")
    )
    return empty.unionByName(invalid)


def validate_landing(spark: SparkSession, path: str, rows: int | None = None) -> None:
    """Raise `LandingError` when no file landed, a landed file is empty or invalid, or lines are missing.

    `rows` is the number of rows that were written, where it is known.
    """
    files = _below(spark, "text", path)
    if len(files._jdf.inputFiles()) == 0:
        raise LandingError(f"no landed file under {path}")
    # One scan decides on the files and counts the lines.
    counted = Observation()
    first = bad_files(spark, path, counted).orderBy("file_origin").limit(_LISTED + 1).collect()
    if first:
        named = "; ".join(f"{r['file_origin']} ({r['reason']})" for r in first[:_LISTED])
        more = " and more" if len(first) > _LISTED else ""
        raise LandingError(f"bad landed files: {named}{more}")
    if rows is not None and (found := counted.get["lines"]) != rows:
        raise LandingError(f"{rows} rows were written under {path}, {found} lines are there")
