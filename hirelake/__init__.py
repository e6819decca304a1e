"""hirelake: a Spark-native batch engine for job adverts.

Raw JSON batches (Bronze) are checked, mapped from each feed's shape to one
common job table (Silver), cleaned, reported on, and rolled up into three
serving tables (Gold). Serving analytics run as lazy DataFrame functions over
Gold so that filters reach the Parquet scan.

Sub-packages:
    functions  column expressions (salary parsing, contract fields, keys, text)
    operators  DataFrame -> DataFrame steps (bronze, normalize, silver, quality,
               gold, serve, batches)
    sources    lake layout readers/writers, JDBC, CSV, source registry
    plans      end-to-end jobs and the query catalog
    streaming  incremental Bronze -> Silver with Structured Streaming
"""

__version__ = "0.1.0"
