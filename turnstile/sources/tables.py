"""Table sources (SRC1/SRC2): Parquet at rest, JDBC at the edge."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


class ParquetTables:
    """Lazy Parquet scans of ``{root}/{name}.parquet``, with the files listed
    anew by each report.

    ``overrides`` maps a table name to a DataFrame to use instead, e.g. a
    bucketed or month-partitioned copy (``sources.layout``)."""

    def __init__(self, spark: SparkSession, root: str, overrides: dict | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.overrides: dict[str, DataFrame] = dict(overrides or {})

    def __call__(self, name: str) -> DataFrame:
        if name in self.overrides:
            return self.overrides[name]
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def read_if_there(spark: SparkSession, path: str, base: str | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is no such path.  Folders
    below ``base`` are partition columns."""
    try:
        return (spark.read if base is None else spark.read.option("basePath", base)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_jdbc(spark: SparkSession, url: str, table: str, *, user: str | None = None,
              password: str | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 10_000,
              driver: str | None = None) -> DataFrame:
    """Parallel JDBC read of one table.

    Credentials are passed at run time (never stored).  When a numeric
    ``partition_column`` and bounds are given, Spark issues ``num_partitions``
    range queries in parallel instead of one cursor; filters and column
    selections of the calling report are pushed into each query.
    """
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", str(fetch_size)))
    if user is not None:
        r = r.option("user", user)
    if password is not None:
        r = r.option("password", password)
    if driver is not None:
        r = r.option("driver", driver)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound, num_partitions")
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions)))
    return r.load()


def read_jdbc_config(spark: SparkSession, config_path: str, section: str, table: str, **kw) -> DataFrame:
    """SRC2: connection settings from an INI file (host, port, name, user,
    pass keys); a missing file or section raises instead of returning None."""
    import configparser

    cp = configparser.ConfigParser()
    if not cp.read(config_path):
        raise FileNotFoundError(config_path)
    s = cp[section]
    url = f"jdbc:postgresql://{s['dbhost']}:{s['dbport']}/{s['dbname']}"
    return read_jdbc(spark, url, table, user=s.get("dbuser"), password=s.get("dbpass"), **kw)
