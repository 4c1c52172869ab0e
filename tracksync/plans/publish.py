"""O-12: publish a run as a whole or not at all.

Every table of a run is written under ``<root>/run=<run_id>/<table>``.  Only when
all writes have succeeded does a pointer file appear in ``<root>/_pointers/``,
created by an atomic rename of a fully written temporary file.  Readers take the
greatest pointer name, so a failed or half-written run is never visible and the
previous run stays current.  A pointer name is the time of its commit, then the run id,
so that the order of commits counts and not the ids callers choose.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .eav_store import EavTable

POINTERS = "_pointers"
#: A table kept in buckets is published by the list of its parts, in a file of this name.
PARTS = "parts.json"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def new_run_id() -> str:
    return _now() + "-" + uuid.uuid4().hex[:8]


def publish(spark: SparkSession, outputs: Mapping[str, DataFrame | EavTable], root: str, run_id: str | None = None,
            fmt: str = "parquet") -> str:
    """Write all ``outputs`` of one run, then commit the pointer.  Returns the run id.

    Of an :class:`EavTable` only the list of its parts is written: its files are there already.
    """
    run_id = run_id or new_run_id()
    run_dir = f"{root.rstrip('/')}/run={run_id}"
    for name, df in outputs.items():
        if isinstance(df, EavTable):
            _write_text(spark, f"{run_dir}/{name}/{PARTS}", json.dumps(df.described()))
            continue
        df.write.mode("error").format(fmt).save(f"{run_dir}/{name}")
    _commit_pointer(spark, root, run_id)
    return run_id


def _write_text(spark: SparkSession, path: str, text: str):
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return p


def _commit_pointer(spark: SparkSession, root: str, run_id: str) -> None:
    fs, _, jvm = _fs(spark, root)
    Path = jvm.org.apache.hadoop.fs.Path
    pdir = Path(f"{root.rstrip('/')}/{POINTERS}")
    fs.mkdirs(pdir)
    tmp = _write_text(spark, f"{pdir}/.tmp-{uuid.uuid4().hex}", run_id)
    final = Path(pdir, f"{_now()}~{run_id}")
    if not fs.rename(tmp, final):
        fs.delete(tmp, False)
        raise RuntimeError(f"could not commit run {run_id}")


def current_run(spark: SparkSession, root: str) -> str | None:
    """Id of the last committed run, or None."""
    fs, _, jvm = _fs(spark, root)
    pdir = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{POINTERS}")
    if not fs.exists(pdir):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(pdir)]
    names = [n for n in names if not n.startswith(".")]
    return max(names).partition("~")[2] if names else None


def _run_dir(spark: SparkSession, root: str) -> str:
    run_id = current_run(spark, root)
    if run_id is None:
        raise FileNotFoundError(f"no committed run under {root}")
    return f"{root.rstrip('/')}/run={run_id}"


def current_parts(spark: SparkSession, root: str, table: str) -> EavTable | None:
    """The bucketed table of the last committed run, or None if it was published as rows."""
    path = f"{_run_dir(spark, root)}/{table}/{PARTS}"
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return None
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    return EavTable.of_description(spark, json.loads(text))


def read_current(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    parts = current_parts(spark, root, table)
    return parts.read() if parts is not None else spark.read.format(fmt).load(f"{_run_dir(spark, root)}/{table}")
