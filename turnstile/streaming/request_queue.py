"""Report-request queue (ST1-ST3, SRC3/SRC4, JN13, JN14) on Structured Streaming.

Requests are JSON lines dropped in a directory.  A file-source stream reads
them with an explicit schema (malformed lines land in ``_corrupt_record``);
``foreachBatch`` routes each micro-batch:

* ``type = 'ALL'``  -> population figures for the request's period,
* ``type = 'IND'``  -> the same for one person (``client``),
* no type but ``idperson`` -> profile request with period ``PW``,
* anything else, or an unknown period code -> the reject table.

All requests of a batch are answered by one plan (no per-request loop): the
figures of each different period, by a calendar-day range join with the visits,
and of each different (person, period), by an equi-join on the person, are joined
back to the requests by those values.  So repeated requests cost nothing more and
get a row each.  Acknowledgement is the stream checkpoint, not file deletion: a
restart with the same checkpoint re-reads nothing.  Each batch overwrites only its own ``batch=<epoch>`` output, so a
replayed batch is idempotent.
"""

from __future__ import annotations

import copy
import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.binding import Binding
from turnstile.functions.periods import RELATIVE_CODES, period_bounds, period_label
from turnstile.plans.bundle import narrowed, person_bundle, population_bundle, report_name, write_bundles
from turnstile.plans.calendar import period_figures
from turnstile.plans.person import person_profile
from turnstile.session import written
from turnstile.sources import files
from turnstile.sources.tables import read_if_there

REQUEST_SCHEMA = ("type string, interval string, appuser long, client long, idperson long, "
                  "_corrupt_record string")
PROFILE_DEFAULT_INTERVAL = "PW"

RESULT_SCHEMA = ("request_key string, kind string, interval string, label string, start timestamp_ntz, "
                 "end timestamp_ntz, appuser long, email string, client long, visits long, clients long")
REJECT_SCHEMA = "request_key string, source_file string, type string, interval string, _corrupt_record string"
RESULT_COLUMNS = [c.split()[0] for c in RESULT_SCHEMA.split(", ")]


def read_requests(spark: SparkSession, queue_dir: str, max_files_per_trigger: int | None = None,
                  archive_dir: str | None = None) -> DataFrame:
    """SRC3 as a stream; ``source_file`` keeps where each request came from.
    ``archive_dir`` moves processed files there (SRC4 ``cleanSource``); the
    checkpoint alone already guarantees a file is answered once."""
    r = (spark.readStream.schema(REQUEST_SCHEMA)
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.json(queue_dir).select("*", F.col("_metadata.file_path").alias("source_file"))


def read_requests_batch(spark: SparkSession, queue_dir: str) -> DataFrame:
    """SRC3 batch form: every request currently in the directory."""
    return (spark.read.schema(REQUEST_SCHEMA)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(queue_dir).select("*", F.col("_metadata.file_path").alias("source_file")))


def classify(requests: DataFrame, b: Binding, as_of: str | None = None) -> DataFrame:
    """ST2 + PER15: kind, the period as of ``as_of`` (the binding's, if None),
    and a name for the request's content and file (equal requests share it)."""
    interval = F.when(F.col("type").isNull() & F.col("idperson").isNotNull(),
                      F.coalesce("interval", F.lit(PROFILE_DEFAULT_INTERVAL))).otherwise(F.col("interval"))
    r = requests.withColumn("interval", interval)
    bounds = period_bounds(F.col("interval"), F.lit(as_of or b.as_of_for("visits")), F.lit(b.inception))
    kind = (F.when(F.col("_corrupt_record").isNotNull(), "REJECT")
            .when(F.col("type") == "ALL", "ALL")
            .when((F.col("type") == "IND") & F.col("client").isNotNull(), "IND")
            .when(F.col("type").isNull() & F.col("idperson").isNotNull(), "PROFILE")
            .otherwise("REJECT"))
    r = (r.withColumn("_b", bounds)
         .withColumn("start", F.col("_b.start")).withColumn("end", F.col("_b.end")).drop("_b")
         .withColumn("kind", F.when(F.col("start").isNull(), "REJECT").otherwise(kind))
         .withColumn("label", period_label(F.col("interval")))
         .withColumn("client", F.coalesce("client", "idperson")))
    # the JSON text names each field it has, so a value can't pass for another field's
    said = F.to_json(F.struct("source_file", "type", "interval", "appuser", "client", "kind", "_corrupt_record"))
    return r.withColumn("request_key", F.sha2(said, 256))


def answer(requests: DataFrame, b: Binding) -> DataFrame:
    """Figures for every accepted request, one row per request."""
    ok = requests.where(F.col("kind") != "REJECT")
    everyone = period_figures(b, ok.where(F.col("kind") == "ALL").select("start", "end").distinct())
    asked = ok.where(F.col("kind") != "ALL").select(F.col("client").alias("person_id"), "start", "end").distinct()
    visits = b.visits().select("person_id", "timestamp")
    own = (visits.join(asked, "person_id").where(F.col("timestamp").between(F.col("start"), F.col("end")))
           .groupBy("person_id", "start", "end").agg(F.count(F.lit(1)).alias("visits")))
    figures = everyone.select(F.lit("ALL").alias("_kind"), F.lit(None).cast("long").alias("_who"),
                              F.col("start").alias("_s"), F.col("end").alias("_e"), "visits", "clients").unionByName(
        own.select(F.lit("ONE").alias("_kind"), F.col("person_id").alias("_who"), F.col("start").alias("_s"),
                   F.col("end").alias("_e"), "visits", F.lit(1).cast("long").alias("clients")))
    users = b.app_users().select(F.col("id").alias("_uid"), "email")
    whole = F.col("kind") == "ALL"
    out = (ok.withColumn("_k", F.when(whole, "ALL").otherwise("ONE"))
           .withColumn("_w", F.when(~whole, F.col("client")))
           .join(figures, (F.col("_k") == F.col("_kind")) & F.col("_w").eqNullSafe(F.col("_who"))
                 & (F.col("start") == F.col("_s")) & (F.col("end") == F.col("_e")), "left")
           .join(users, F.col("appuser") == F.col("_uid"), "left"))
    return out.select("request_key", "kind", "interval", "label", "start", "end", "appuser", "email", "client",
                      F.coalesce("visits", F.lit(0)).cast("bigint").alias("visits"),
                      F.coalesce("clients", F.lit(0)).cast("bigint").alias("clients"))


def as_of_binding(b: Binding, as_of: str | None) -> Binding:
    """The same tables, reported as of another time."""
    if as_of is None:
        return b
    out = copy.copy(b)
    out.as_of, out._memo = {k: as_of for k in b.as_of}, {}
    return out


def write_reports(requests: DataFrame, b: Binding, base: str, at: datetime) -> tuple[DataFrame, DataFrame]:
    """ST2: the reports that classified requests ask for: a population bundle
    for each different period, a person bundle for each different period with
    the people asked for in it, one profile table for all profile requests.

    The periods are a column of the reports, and a tab of all of them is written
    at once, so the number of jobs depends neither on the requests nor on their
    periods; no code is collected.  All goes to a folder of its own below
    ``base``; one rename of a pointer then makes it current (``read_reports``).

    Returns the manifest (kind, report, ordinal, tab, path, rows) of what was
    written, and the path of each request's report (request_key, kind, path)."""
    spark = requests.sparkSession
    root = f"{base}/version={uuid.uuid4().hex}"
    ok = requests.where(F.col("kind") != "REJECT")
    asked = written(spark, ok.select("request_key", "kind", "interval", "client"), "asked")
    whole = asked.where("kind = 'ALL'").select("interval").distinct()
    people = asked.where("kind = 'IND'").select("interval", F.col("client").alias("idperson")).distinct()
    manifests = []
    for kind, codes, tabs in (("ALL", whole, lambda: population_bundle(narrowed(b, whole), whole)),
                              ("IND", people, lambda: person_bundle(narrowed(b, people), people, people))):
        if codes.limit(1).count():      # at most the two kinds of bundle
            m = write_bundles(tabs(), f"{root}/{kind}", at)
            manifests.append(m.select(F.lit(kind).alias("kind"), "interval", "report", "ordinal", "tab", "path", "rows"))
    profiles = asked.where("kind = 'PROFILE'").select(F.col("client").alias("idperson")).distinct()
    profile = f"{root}/PROFILE/report={report_name('profile', at)}"
    person_profile(b, persons=profiles).write.mode("overwrite").parquet(profile)
    rows = spark.read.parquet(profile).agg(F.count(F.lit(1)).alias("rows"))
    manifests.append(rows.select(F.lit("PROFILE").alias("kind"), F.lit(None).cast("string").alias("interval"),
                                 F.lit(report_name("profile", at)).alias("report"), F.lit(0).alias("ordinal"),
                                 F.lit("Profile").alias("tab"), F.lit(profile).alias("path"), "rows"))
    manifest = reduce(DataFrame.unionByName, manifests)
    manifest.write.parquet(f"{root}/_manifest")
    files.write_text(spark, f"{base}/_current.json", root, replace=True)
    manifest = read_reports(spark, base)
    of = manifest.where("ordinal = 0 AND kind != 'PROFILE'").select("kind", "interval", F.regexp_replace("path", "/tab=[^/]*$", "").alias("path"))
    found = asked.join(of, ["kind", "interval"], "left")
    found = found.select("request_key", "kind", F.coalesce("path", F.lit(profile)).alias("path"))
    return manifest.drop("interval"), found


def read_reports(spark: SparkSession, base: str) -> DataFrame:
    """The manifest of the current reports below ``base``: (kind, interval, report, ordinal, tab, path, rows)."""
    root = files.read_text(spark, f"{base}/_current.json")
    if root is None:
        raise FileNotFoundError(f"no reports under {base}")
    return spark.read.parquet(f"{root}/_manifest")


def serve(spark: SparkSession, b: Binding, queue_dir: str, out_dir: str, checkpoint_dir: str,
          max_files_per_trigger: int | None = None, archive_dir: str | None = None,
          now: Callable[[], str] | None = None, reports_dir: str | None = None):
    """ST1: drain the queue with ``availableNow`` and stop.  ``now`` gives the
    as-of time of each batch, for a stream that lives on; without it the
    binding's holds.  With ``reports_dir`` each batch's reports are written
    there, and where each request's report is goes to ``paths``."""

    def process(batch: DataFrame, epoch_id: int) -> None:
        as_of = now() if now else None
        c = classify(batch, b, as_of)
        c.persist()
        try:
            if reports_dir and c.where(F.col("kind") != "REJECT").limit(1).count():
                own = as_of_binding(b, as_of)
                at = datetime.fromisoformat(own.as_of_for("visits"))
                _, found = write_reports(c, own, f"{reports_dir}/batch={epoch_id}", at)
                found.write.mode("overwrite").parquet(f"{out_dir}/paths/batch={epoch_id}")
            answer(c, b).write.mode("overwrite").parquet(f"{out_dir}/results/batch={epoch_id}")
            (c.where(F.col("kind") == "REJECT")
             .select("request_key", "source_file", "type", "interval", "_corrupt_record")
             .write.mode("overwrite").parquet(f"{out_dir}/rejects/batch={epoch_id}"))
        finally:
            c.unpersist()

    q = (read_requests(spark, queue_dir, max_files_per_trigger, archive_dir).writeStream
         .foreachBatch(process)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q


def serve_batch(spark: SparkSession, b: Binding, queue_dir: str) -> tuple[DataFrame, DataFrame]:
    """Batch form of the router: (answers, rejects) for every queued request."""
    c = classify(read_requests_batch(spark, queue_dir), b)
    rej = c.where(F.col("kind") == "REJECT").select("request_key", "source_file", "type", "interval",
                                                      "_corrupt_record")
    return answer(c, b), rej


def results(spark: SparkSession, out_dir: str) -> DataFrame:
    """All answers so far; none if no request came yet."""
    found = read_if_there(spark, f"{out_dir}/results")
    return spark.createDataFrame([], f"{RESULT_SCHEMA}, batch int") if found is None else found


def rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    found = read_if_there(spark, f"{out_dir}/rejects")
    return spark.createDataFrame([], f"{REJECT_SCHEMA}, batch int") if found is None else found


def requests_from_app_users(b: Binding) -> DataFrame:
    """A request per app user, derived from the app-user table: a rotating
    type (population, person, profile) and period code."""
    codes = F.array(*[F.lit(c) for c in RELATIVE_CODES])
    u = b.app_users().select("id")
    kind = F.col("id") % 3
    return u.select(
        F.when(kind == 0, "ALL").when(kind == 1, "IND").alias("type"),
        F.when(kind != 2, F.element_at(codes, (F.col("id") % len(RELATIVE_CODES) + 1).cast("int"))).alias("interval"),
        F.when(kind != 2, F.col("id")).alias("appuser"),
        F.when(kind == 1, F.col("id")).alias("client"),
        F.when(kind == 2, F.col("id")).alias("idperson"))


def request_lines(b: Binding) -> DataFrame:
    """The lines of a request file: every request of ``requests_from_app_users``
    twice, a profile request with the number of an app user for each of them, and
    lines that must be rejected (not JSON, unknown type, unknown period)."""
    asked = requests_from_app_users(b)
    codes = F.array(*[F.lit(c) for c in RELATIVE_CODES])
    users = b.app_users().select("id")
    profiles = users.select(F.element_at(codes, (F.col("id") % len(RELATIVE_CODES) + 1).cast("int")).alias("interval"),
                            F.col("id").alias("idperson"))
    bad = users.select(F.explode(F.array(
        F.concat(F.lit("{not json "), F.col("id").cast("string")),
        F.to_json(F.struct(F.lit("ZZZ").alias("type"), F.lit("PQ").alias("interval"), F.col("id").alias("appuser"))),
        F.to_json(F.struct(F.lit("ALL").alias("type"), F.lit("SOON").alias("interval"), F.col("id").alias("appuser"))),
    )).alias("value"))
    lines = [df.select(F.to_json(F.struct(*df.columns)).alias("value")) for df in (asked, asked, profiles)]
    return lines[0].union(lines[1]).union(lines[2]).union(bad)
