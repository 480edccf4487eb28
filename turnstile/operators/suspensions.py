"""Suspension state refresh (SUS1, JN12, SNK3).

The reference clears every flag, commits, then sets flags one row and one
commit at a time, so readers briefly see nobody suspended (Q14).  Here the
new person table is one set-based plan, written as a new version and then
published by appending one row to a version log; readers resolve the newest
logged version, so they see either the old or the new state, never a mix.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.binding import Binding
from turnstile.operators.endpoints import OpenSuspensions
from turnstile.operators.person_store import PersonStore
from turnstile.sources.tables import read_if_there


def active_suspensions(b: Binding, as_of: str, require_started: bool = False) -> DataFrame:
    """FIL7: suspensions still running at ``as_of`` (end strictly after it).
    The reference does not test the start (Q13); ``require_started`` does."""
    now = F.lit(as_of).cast("timestamp_ntz")
    s = b.suspensions().where(F.col("endtime") > now)
    if require_started:
        s = s.where(F.col("starttime") <= now)
    return s


def suspension_flags(b: Binding, as_of: str, require_started: bool = False) -> DataFrame:
    """Every person with ``iscurrentlysuspended`` recomputed as of ``as_of``."""
    active = active_suspensions(b, as_of, require_started).select(F.col("person_id").alias("_sid")).distinct()
    p = b.person().select("idperson")
    return (p.join(active, p.idperson == active["_sid"], "left")
            .select("idperson", F.col("_sid").isNotNull().alias("iscurrentlysuspended")))


def write_version(df: DataFrame, root: str, version: int | None = None) -> str:
    """Write ``df`` as a new version, then publish it.

    The data goes to its own directory first; only after that job has
    committed is one row appended to the version log.  Readers resolve the
    newest logged version, so a half-written version is never visible and
    the previous state stays readable throughout.
    """
    spark = df.sparkSession
    root = root.rstrip("/")
    version = version if version is not None else time.time_ns()
    path = f"{root}/data/version={version:020d}"
    df.write.mode("errorifexists").parquet(path)
    entry = spark.createDataFrame([(version, path)], "version long, path string")
    entry.coalesce(1).write.mode("append").parquet(f"{root}/log")
    return path


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    """The version log, or None if nothing was published yet; any other error of the storage is raised."""
    return read_if_there(spark, f"{root.rstrip('/')}/log")


def committed_versions(spark: SparkSession, root: str) -> list[str]:
    """Paths of published versions, oldest first (the log is one small row
    per publish)."""
    log = _log(spark, root)
    return [] if log is None else [r.path for r in log.orderBy("version").collect()]


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The newest published version (only that one log row reaches the driver)."""
    log = _log(spark, root)
    newest = log.orderBy(F.desc("version")).select("path").first() if log is not None else None
    if newest is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return spark.read.parquet(newest.path)


def refreshed_person_table(b: Binding, as_of: str, require_started: bool = False) -> DataFrame:
    """The whole person table, every column kept, with ``iscurrentlysuspended``
    recomputed as of ``as_of``."""
    person = b.person_table()
    flags = suspension_flags(b, as_of, require_started)
    rest = [c for c in person.columns if c not in ("idperson", "iscurrentlysuspended")]
    return person.drop("iscurrentlysuspended").join(flags, "idperson").select("idperson", *rest, "iscurrentlysuspended")


def refresh_suspension_flags(b: Binding, as_of: str, root: str, require_started: bool = False) -> str:
    """SNK3: the person table with the recomputed flag, published atomically as
    a new version.  Returns the written path."""
    return write_version(refreshed_person_table(b, as_of, require_started), root)


def published_twice(b: Binding, root: str, first: str, second: str, buckets: int = 64) -> DataFrame:
    """SNK3 by buckets: the person table with the flags of one time, then with those of a later one.  The second publish
    writes only buckets with a turned flag.  Returns what both versions say: ``(idperson, flag_first, flag_second)``."""
    store = PersonStore(b.spark, root, buckets=buckets)
    store.create(refreshed_person_table(b, first))
    then = store.read()
    version = store.update(suspension_flags(b, second), parent=0)
    old = then.select("idperson", F.col("iscurrentlysuspended").alias("flag_first"))
    new = store.read(version).select("idperson", F.col("iscurrentlysuspended").alias("flag_second"))
    return old.join(new, "idperson")


def walked(b: Binding, root: str, times: list[str], require_started: bool = False) -> DataFrame:
    """ST4 by endpoints: the people with open suspensions at each of the rising ``times``, every state made from the one
    before it: ``(as_of, idperson, open)``.  Only people of the person table come out."""
    state = OpenSuspensions(b.spark, root, require_started)
    state.build(b.suspensions())
    known = b.person().select("idperson")
    found = [state.advance(t).select(F.lit(t).cast("timestamp_ntz").alias("as_of"), F.col("person_id").alias("idperson"), "open") for t in times]
    return reduce(DataFrame.unionByName, found).join(known, "idperson", "left_semi").select("as_of", "idperson", "open")
