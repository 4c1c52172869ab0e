"""The EAV table kept in buckets of fields, so that a step writes only the fields it touches.

Rows lie in ``<root>/<version>/bucket=<b>``, the bucket a hash of the field id.  A table is the list of
which version holds which bucket (at most :data:`BUCKETS` entries).  A step reads the buckets of
its fields and writes them as a new version; files of other buckets, and of earlier versions,
are never touched, so a lost executor or a failed step leaves every earlier state readable.
Publishing a run publishes the list, and the next run goes on from it: no rows are copied.

Reading a table is a plain Parquet scan.  It carries no plan, statistics or inferred constraints of the
steps before, which would otherwise grow from step to step and from run to run.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import eav
from ..operators.eav import Fields

#: A field holds a share of the table, so a bucket is one to a few fields; buckets are split into files by size.
BUCKETS = 32


def _bucket(field):
    return F.pmod(F.xxhash64(field.cast("long")), F.lit(BUCKETS)).cast("int")


@contextlib.contextmanager
def _writers(spark: SparkSession, most: int):
    """Meanwhile a task keeps a file open for each of its at most ``most`` partition values, so it streams its
    rows and holds none; with one open file Spark sorts all rows of a task by those values first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass(frozen=True)
class EavTable:
    """Immutable: :meth:`replaced` gives the next state."""

    spark: SparkSession
    root: str
    schema: StructType
    versions: dict[int, str]  # bucket -> version that holds it; buckets without rows are missing

    @classmethod
    def create(cls, values: DataFrame, root: str) -> EavTable:
        """Write all rows of ``values`` below ``root``, once."""
        return cls(values.sparkSession, root.rstrip("/"), values.schema, {})._written(values, range(BUCKETS))

    def _written(self, rows: DataFrame, buckets: Sequence[int]) -> EavTable:
        version = uuid.uuid4().hex
        # rebalanced: a bucket with most rows becomes many files, small ones share a task
        dealt = rows.withColumn("bucket", _bucket(F.col("custom_field_id"))).hint("rebalance", "bucket")
        with _writers(self.spark, BUCKETS):
            dealt.write.partitionBy("bucket").parquet(f"{self.root}/{version}")
        held = self._buckets_of(version)
        strange = held - set(buckets)
        if strange:
            raise ValueError(f"a step wrote rows of fields it does not name (buckets {sorted(strange)})")
        kept = {b: v for b, v in self.versions.items() if b not in set(buckets)}
        return replace(self, versions={**kept, **dict.fromkeys(held, version)})

    def _buckets_of(self, version: str) -> set[int]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{version}")
        names = [s.getPath().getName() for s in path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
        return {int(n.partition("=")[2]) for n in names if n.startswith("bucket=")}

    def buckets(self, fields: Fields) -> list[int]:
        """The buckets of some fields (a list of ids, or a frame of the dictionary's)."""
        ids = fields if isinstance(fields, DataFrame) else \
            self.spark.createDataFrame([(int(f),) for f in fields], "custom_field_id long")
        return sorted(r[0] for r in ids.select(_bucket(F.col("custom_field_id"))).distinct().collect())

    def read(self, fields: Fields | None = None) -> DataFrame:
        """All rows, or those of the buckets that hold ``fields`` (others may share them)."""
        return self._read(range(BUCKETS) if fields is None else self.buckets(fields))

    def _read(self, buckets: Sequence[int]) -> DataFrame:
        paths = [f"{self.root}/{self.versions[b]}/bucket={b}" for b in buckets if b in self.versions]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def replaced(self, fields: Fields, step) -> EavTable:
        """The table after ``step`` (rows of ``fields`` -> their new rows, inserted ones included)."""
        buckets = self.buckets(fields)
        touched, rest = eav.split_by_fields(self._read(buckets), fields)
        return self._written(step(touched).select(*self.schema.names).unionByName(rest), buckets)

    def described(self) -> dict:
        return {"root": self.root, "schema": self.schema.jsonValue(), "versions": {str(b): v for b, v in sorted(self.versions.items())}}

    @classmethod
    def of_description(cls, spark: SparkSession, d: dict) -> EavTable:
        return cls(spark, d["root"], StructType.fromJson(d["schema"]), {int(b): v for b, v in d["versions"].items()})
