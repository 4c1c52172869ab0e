"""O-01 / O-02: relational reads with an explicit schema, partitioned and pushed down.

Connection details always come from the caller; nothing is stored here.  A
numeric ``partition_column`` splits the read into parallel range scans; filters
and column selection applied to the returned DataFrame are pushed into the
remote query (``PushedFilters`` in the plan), including prefix predicates built
with ``functions.starts_with`` (``LIKE 'p%'`` remotely).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, *, table: str | None = None, query: str | None = None,
                 custom_schema: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10_000, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of ``spark.read.format('jdbc')``; exactly one of ``table`` / ``query``."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts: dict[str, str] = {"url": url, "fetchsize": str(fetch_size)}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query  # type: ignore[assignment]
    if custom_schema:
        opts["customSchema"] = custom_schema
    if partition_column is not None:
        if table is None:
            raise ValueError("partitioned reads need dbtable (Spark does not split a query option)")
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    opts.update(dict(extra or {}))
    return opts


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """Read a remote table or query; see :func:`jdbc_options` for the arguments."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()
