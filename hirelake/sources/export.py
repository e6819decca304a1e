"""CSV export of the serving views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed names of the three downloads (the filtered serving tables).
VIEW_FILES = {"detail": "jobs_detail_filtered", "summary": "jobs_summary_filtered",
              "salary": "salary_analysis_filtered"}


CSV_QUOTING = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "emptyValue": "",
               "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
# Fields may span lines, so a reader takes each file whole in one task: rows of a file.
FILE_ROWS = 200_000


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """Header line, no index column; one folder of part files per view.

    Written in parallel by the frame's tasks; NULL and the empty text are both an
    empty field (read back as NULL), as pandas writes them. A quote inside a field is doubled, and a field with a
    quote, comma or line break is quoted, so any CSV reader gets it back. A task writes
    a file for every ``FILE_ROWS`` rows, since ``read_csv`` cannot split files.
    """
    (df.write.mode(mode).options(**CSV_QUOTING).option("header", header)
     .option("maxRecordsPerFile", FILE_ROWS).csv(path))


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of ``write_csv``; fields may span lines."""
    return (spark.read.schema(schema).options(**CSV_QUOTING)
            .option("header", True).option("multiLine", True).csv(path))


def export_views(views, folder: str) -> dict[str, str]:
    """The three filtered views (``serve.Views``) as CSV folders under
    ``folder``; returns view -> path."""
    paths = {}
    for attr, name in VIEW_FILES.items():
        path = f"{folder.rstrip('/')}/{name}"
        write_csv(getattr(views, attr), path)
        paths[attr] = path
    return paths
