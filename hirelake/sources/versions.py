"""Versions of a stored day (S8, S10): readers see the old day or the new one, never a
mixture and never nothing.

    <root>/dt=YYYY-MM-DD/run=<id>/[bucket=<n>/]part-*.parquet    what a run wrote
    <root>/_log/dt=YYYY-MM-DD/<number>.json                      what the day consists of

A run writes a folder of its own; nothing that is stored is renamed, moved or written
over, so an object store needs no copy. The day changes when the run adds the next
numbered entry to the day's log, a small file created once (a second run that creates
the same number fails). Readers take the highest entry that is whole: a file cut short
by a crash is no JSON and does not count. An entry names the folder of each bucket, so a
run may replace some buckets and carry over the rest. Folders that neither of the last
entries names are deleted by ``expire``; a reader that has resolved an older entry before
that can finish.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructType

from hirelake.functions.time import to_dt
from hirelake.session import file_system

KEEP = 2          # entries whose folders stay
WHOLE = "*"       # the one bucket of a table without buckets


class PublishError(Exception):
    """Another run has published the day meanwhile; nothing was changed."""


@dataclass(frozen=True)
class Entry:
    """What a day consists of: the folder of each bucket, below the table's root."""

    number: int
    schema: str
    paths: dict[str, str]
    buckets: int = 0                                    # 0: not bucketed
    facts: dict[str, dict] = field(default_factory=dict)  # figures of each bucket
    hashed: str = "xxhash64"                            # the hash by which rows have buckets


def _log(root: str, dt: str = "") -> str:
    return f"{root.rstrip('/')}/_log" + (f"/dt={to_dt(dt)}" if dt else "")


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, where = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _read(spark: SparkSession, path: str) -> dict | None:
    """The entry in a file, None if the file is not whole."""
    fs, where = file_system(spark, path)
    stream = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except json.JSONDecodeError:
        return None
    except Py4JJavaError as e:
        if "ChecksumException" in str(e.java_exception):      # cut short, on a local disk
            return None
        raise
    finally:
        stream.close()


def entries(spark: SparkSession, root: str, dt: str, most: int = KEEP) -> list[Entry]:
    """The last whole entries of a day, newest first."""
    found: list[Entry] = []
    for name in reversed(_names(spark, _log(root, dt))):
        if len(found) == most:
            break
        whole = _read(spark, f"{_log(root, dt)}/{name}") if name.endswith(".json") else None
        if whole:
            found.append(Entry(**whole))
    return found


def current(spark: SparkSession, root: str, dt: str) -> Entry | None:
    return next(iter(entries(spark, root, dt, 1)), None)


def days(spark: SparkSession, root: str) -> list[str]:
    return [n.removeprefix("dt=") for n in _names(spark, _log(root)) if n.startswith("dt=")]


def new_run(dt: str) -> str:
    """A folder for a run's files, below the table's root."""
    return f"dt={to_dt(dt)}/run={uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, dt: str, after: Entry | None, schema: str,
            paths: dict[str, str], buckets: int = 0, facts: dict | None = None,
            hashed: str = Entry.hashed) -> Entry:
    """Add the entry that follows ``after``; from then on readers see it."""
    names = [n for n in _names(spark, _log(root, dt)) if n.endswith(".json")]
    newest = current(spark, root, dt)
    if (newest.number if newest else 0) != (after.number if after else 0):
        raise PublishError(f"{root} {dt}: entry {newest.number} came in between")
    # numbers of files cut short are not used again
    number = max([after.number if after else 0, *(int(n.split(".")[0]) for n in names)]) + 1
    entry = Entry(number, schema, paths, buckets, facts or {}, hashed)
    fs, where = file_system(spark, f"{_log(root, dt)}/{number:012d}.json")
    try:
        stream = fs.create(where, False)
    except Exception as e:  # noqa: BLE001  the file system's own kind of "exists"
        raise PublishError(f"{root} {dt}: entry {number} exists") from e
    try:
        stream.write(bytearray(json.dumps(asdict(entry)).encode()))
    finally:
        stream.close()
    return entry


def expire(spark: SparkSession, root: str, dt: str, keep: int = KEEP) -> list[str]:
    """Delete the day's folders that none of its last ``keep`` entries names, among them
    those of runs that failed, and older entries. Not while another run writes the day."""
    kept = entries(spark, root, dt, keep)
    named = {p.split("/bucket=")[0] for e in kept for p in e.paths.values()}
    gone = []
    for name in _names(spark, f"{root.rstrip('/')}/dt={to_dt(dt)}"):
        path = f"dt={to_dt(dt)}/{name}"
        if path not in named:
            remove(spark, f"{root.rstrip('/')}/{path}")
            gone.append(path)
            continue
        used = {p for e in kept for p in e.paths.values() if p.startswith(path)}
        for bucket in _names(spark, f"{root.rstrip('/')}/{path}"):
            inner = f"{path}/{bucket}"
            if bucket.startswith("bucket=") and path not in used and inner not in used:
                remove(spark, f"{root.rstrip('/')}/{inner}")
                gone.append(inner)
    numbers = {e.number for e in kept}
    for name in _names(spark, _log(root, dt)):
        if kept and name.endswith(".json") and int(name.split(".")[0]) not in numbers:
            remove(spark, f"{_log(root, dt)}/{name}")
    return gone


def remove(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def read(spark: SparkSession, root: str, dt: str | None = None) -> DataFrame:
    """The current rows of one day or of all, with the column ``dt``."""
    wanted = [to_dt(dt)] if dt else days(spark, root)
    found = [e for d in wanted if (e := current(spark, root, d))]
    if not found:
        known = [e for d in reversed(days(spark, root)) if (e := current(spark, root, d))][:1]
        if not known:
            raise FileNotFoundError(f"no stored day under {root}")
        return spark.createDataFrame([], StructType.fromJson(json.loads(known[0].schema)).add(
            "dt", DateType()))
    schema = StructType.fromJson(json.loads(found[-1].schema))
    paths = [f"{root.rstrip('/')}/{p}" for e in found for p in dict.fromkeys(e.paths.values())]
    if not paths:
        return spark.createDataFrame([], schema.add("dt", DateType()))
    rows = spark.read.schema(StructType(schema.fields).add("dt", DateType())).option(
        "basePath", root).parquet(*paths)
    return rows.select(*schema.names, "dt")
