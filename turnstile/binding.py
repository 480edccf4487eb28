"""Logical roles -> DataFrames.

Reports are written against roles (person, visit, service request, service,
survey answer, response dimension, person category, suspension, app user), so
the same DataFrame code serves the service-centre schema and the driver's
TPC-H-style tables.  Every role is a lazy projection of a scan: Catalyst
prunes columns and pushes report filters through it into the Parquet reader.

Role schemas
------------
person            idperson, firstname, lastname, aliasname, credits, sexoffender
person_table      every column of the person table, its id as idperson
first_seen        idperson, timelinestarttime
visits            idsnapshot, person_id, timestamp
requests          connection_id, service_id
services          idservice, name, points
survey            idsnapshot, person_id, timestamp, prompt_id, object_id
response(kind)    id, name                          (kind: housing, city)
person_label(k)   idperson, label                   (k: gender, ethnicity, veteran)
person_codes      idperson, gender_id, ethnicity_id, veteran_id, language_id, credits
suspensions       person_id, reason_id, starttime, endtime
reasons           id, name
app_users         id, email
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.functions import columns as C
from turnstile.sources.tables import ParquetTables


@dataclass
class Binding:
    spark: SparkSession
    # per fact source: the explicit "now" of the reports
    as_of: dict = field(default_factory=dict)
    inception: str = "2018-01-01"
    prompts: dict = field(default_factory=dict)
    service_delim: str = "/"
    housing_delim: str = "("
    unsheltered_object: int = 5
    incarcerated_object: int = 2
    # size bounds fixed by a schema's specification (role -> rows), used to
    # decide broadcasts without a counting job
    dimension_rows: dict = field(default_factory=dict)

    # -- roles (implemented per schema) ---------------------------------
    def person(self) -> DataFrame: raise NotImplementedError
    def person_table(self) -> DataFrame: raise NotImplementedError
    def first_seen(self) -> DataFrame: raise NotImplementedError
    def visits(self) -> DataFrame: raise NotImplementedError
    def requests(self) -> DataFrame: raise NotImplementedError
    def services(self) -> DataFrame: raise NotImplementedError

    def free_services(self) -> DataFrame:
        """Services with non-positive points (FIL6)."""
        return self.services().where(F.col("points") <= 0)
    def survey(self) -> DataFrame: raise NotImplementedError
    def response(self, kind: str) -> DataFrame: raise NotImplementedError
    def person_label(self, kind: str) -> DataFrame: raise NotImplementedError
    def person_codes(self) -> DataFrame: raise NotImplementedError
    def suspensions(self) -> DataFrame: raise NotImplementedError
    def reasons(self) -> DataFrame: raise NotImplementedError
    def app_users(self) -> DataFrame: raise NotImplementedError

    def response_delim(self, kind: str) -> str | None:
        return self.housing_delim if kind == "housing" else None

    def as_of_for(self, source: str) -> str:
        return self.as_of.get(source) or self.as_of["visits"]

    def memo(self, key, build):
        """Per-binding memo of resolved periods, which no table feeds."""
        cache = self.__dict__.setdefault("_memo", {})
        if key not in cache:
            cache[key] = build()
        return cache[key]


class DriverBinding(Binding):
    """Binding onto the driver's tables (see README, "Driver binding")."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables: dict | None = None):
        super().__init__(
            spark=spark,
            as_of={"visits": "2000-05-15 12:00:00", "survey": "2024-01-24 15:30:00"},
            inception="1995-01-01",
            prompts={"housing": "view", "city": "click", "incarceration": "signup"},
            service_delim=" ",
            housing_delim=" ",
            unsheltered_object=5,
            incarcerated_object=2,
            # nation has 25 rows at every scale factor (TPC-H specification)
            dimension_rows={"city": 25, "ethnicity_dim": 25},
        )
        self.t = ParquetTables(spark, sf_dir, tables)

    def person(self):
        return self.t("customer").select(
            F.col("c_custkey").alias("idperson"),
            F.col("c_mktsegment").alias("firstname"),
            F.col("c_name").alias("lastname"),
            F.lit(None).cast("string").alias("aliasname"),
            F.col("c_acctbal").alias("credits"),
            F.lit(None).cast("int").alias("sexoffender"))

    def person_table(self):
        return self.t("customer").withColumnRenamed("c_custkey", "idperson")

    def first_seen(self):
        # first visit of each person; the partial aggregate runs map-side
        return (self.t("orders").groupBy(F.col("o_custkey").alias("idperson"))
                .agg(F.min("o_orderdate").alias("timelinestarttime")))

    def visits(self):
        return self.t("orders").select(
            F.col("o_orderkey").alias("idsnapshot"),
            F.col("o_custkey").alias("person_id"),
            F.col("o_orderdate").alias("timestamp"))

    def event_visits(self):
        """Events as visits: the source where the time of day matters."""
        return self.t("events").select(
            F.col("event_id").alias("idsnapshot"),
            F.col("user_id").alias("person_id"),
            F.col("ts").alias("timestamp"))

    def requests(self):
        return self.t("lineitem").select(
            F.col("l_orderkey").alias("connection_id"),
            F.col("l_partkey").alias("service_id"))

    def services(self):
        return self.t("part").select(
            F.col("p_partkey").alias("idservice"),
            F.col("p_name").alias("name"),
            (F.col("p_size") - F.lit(25)).alias("points"))

    def free_services(self):
        # p_size <= 25 is the same predicate as points <= 0, stated on the
        # stored column so it reaches the Parquet scan as a pushed filter
        return self.t("part").where(F.col("p_size") <= 25).select(
            F.col("p_partkey").alias("idservice"),
            F.col("p_name").alias("name"),
            (F.col("p_size") - F.lit(25)).alias("points"))

    def survey(self):
        return self.t("events").select(
            F.col("event_id").alias("idsnapshot"),
            F.col("user_id").alias("person_id"),
            F.col("ts").alias("timestamp"),
            F.col("event_type").alias("prompt_id"),
            F.get_json_object("props", "$.k").cast("int").alias("object_id"))

    def response(self, kind):
        if kind == "housing":
            return self.t("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
        if kind == "city":
            return self.t("nation").select(F.col("n_nationkey").cast("bigint").alias("id"),
                                           F.col("n_name").alias("name"))
        raise KeyError(kind)

    def person_label(self, kind):
        c = self.t("customer")
        if kind == "gender":
            return c.select(F.col("c_custkey").alias("idperson"), F.col("c_mktsegment").alias("label"))
        if kind == "ethnicity":
            n = F.broadcast(self.t("nation").select("n_nationkey", F.col("n_name").alias("label")))
            return (c.join(n, c.c_nationkey == n.n_nationkey)
                    .select(F.col("c_custkey").alias("idperson"), "label"))
        if kind == "veteran":
            status = (F.when(F.col("c_acctbal") < 0, "No")
                      .when(F.col("c_acctbal") < 5000, "Unknown")
                      .when(F.col("c_acctbal").isNotNull(), "Yes"))
            return c.select(F.col("c_custkey").alias("idperson"), status.alias("label"))
        raise KeyError(kind)

    def person_codes(self):
        # numeric codes: region + 1, nation + 1, and the three-way balance
        # status coded like the reference's yes/no list (1 unknown, 2 yes, 3 no)
        c = self.t("customer")
        n = F.broadcast(self.t("nation").select("n_nationkey", "n_regionkey"))   # 25 rows by spec
        status = (F.when(F.col("c_acctbal") < 0, 3).when(F.col("c_acctbal") < 5000, 1)
                  .when(F.col("c_acctbal").isNotNull(), 2))
        return (c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
            F.col("c_custkey").alias("idperson"),
            (F.col("n_regionkey") + 1).cast("int").alias("gender_id"),
            (F.col("c_nationkey") + 1).cast("int").alias("ethnicity_id"),
            status.cast("int").alias("veteran_id"),
            F.lit(None).cast("int").alias("language_id"),
            F.col("c_acctbal").alias("credits")))

    def part_people(self):
        """Parts as people (for the exact-duplicate key): name = p_name,
        first name = p_type."""
        return self.t("part").select(F.col("p_partkey").alias("idperson"),
                                     F.col("p_type").alias("firstname"), F.col("p_name").alias("lastname"))

    def suspensions(self):
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        li = self.t("lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .where(F.col("l_shipdate") > F.col("o_orderdate"))
                .select(F.col("o_custkey").alias("person_id"),
                        F.col("l_suppkey").alias("reason_id"),
                        F.col("o_orderdate").alias("starttime"),
                        F.col("l_shipdate").alias("endtime")))

    def reasons(self):
        return self.t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))

    def app_users(self):
        return self.t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("email"))

    def person_labels_text(self):
        """Header labels for RP22 on this schema: (idperson, ethnicity, gender,
        language, veteran)."""
        eth = self.person_label("ethnicity").withColumnRenamed("label", "ethnicity")
        c = self.t("customer").select(
            F.col("c_custkey").alias("idperson"),
            F.col("c_mktsegment").alias("gender"),
            F.lit(None).cast("string").alias("language"),
            (F.when(F.col("c_acctbal") < 0, "No")
             .when(F.col("c_acctbal") < 5000, "Unknown")
             .when(F.col("c_acctbal").isNotNull(), "Yes")).alias("veteran"))
        return c.join(eth, "idperson", "left")


class CentreBinding(Binding):
    """Binding onto the service-centre schema (tables given as DataFrames)."""

    def __init__(self, spark: SparkSession, tables: dict, as_of: str, inception: str = "2018-01-01"):
        super().__init__(
            spark=spark,
            as_of={"visits": as_of, "survey": as_of},
            inception=inception,
            prompts={"housing": 8, "city": 53, "incarceration": 4},
            service_delim="/",
            housing_delim="(",
            unsheltered_object=5,
            incarcerated_object=2,
        )
        self.tables = tables

    def _t(self, name):
        return self.tables[name]

    def person(self):
        p = self._t("person")
        named = "registered_offender_id"   # Q9
        offender = F.col(named) if named in p.columns else F.lit(None)
        return p.select("idperson", "firstname", "lastname", "aliasname", "credits",
                        offender.cast("int").alias("sexoffender"))

    def person_table(self):
        return self._t("person")

    def first_seen(self):
        return self._t("person").select("idperson", "timelinestarttime")

    def visits(self):
        v = self._t("visit")
        from turnstile.sources.layout import PART_COL
        keep = ["idsnapshot", "person_id", "timestamp"] + ([PART_COL] if PART_COL in v.columns else [])
        return v.select(*keep)

    def event_visits(self):
        return self.visits()

    def requests(self):
        return self._t("service_request").select("connection_id", "service_id")

    def services(self):
        return self._t("service").select("idservice", "name", "points")

    def survey(self):
        v = self.visits()
        s = self._t("survey").select("connection_id", "prompt_id", "object_id")
        return (v.join(s, v.idsnapshot == s.connection_id)
                .select("idsnapshot", "person_id", "timestamp", "prompt_id", "object_id"))

    def response(self, kind):
        t = {"housing": ("housing_response", "idhousing"), "city": ("city_response", "idcity")}[kind]
        return self._t(t[0]).select(F.col(t[1]).alias("id"), "name")

    def person_label(self, kind):
        t = {"gender": ("gender_response", "idgender", "gender_id"),
             "ethnicity": ("ethnicity_response", "idethnicity", "ethnicity_id"),
             "veteran": ("yesno_response", "idyesno", "veteran_id")}[kind]
        p = self._t("person").select("idperson", t[2])
        d = self._t(t[0]).select(F.col(t[1]).alias("_code"), F.col("name").alias("label"))
        return p.join(d, p[t[2]] == d["_code"]).select("idperson", "label")

    def person_codes(self):
        return self._t("person").select("idperson", "gender_id", "ethnicity_id", "veteran_id",
                                        "language_id", "credits")

    def suspensions(self):
        return self._t("suspension").select("person_id", "reason_id", "starttime", "endtime")

    def reasons(self):
        return self._t("suspension_reason").select(F.col("idsuspensionreason").alias("id"), "name")

    def app_users(self):
        return self._t("app_user").select("id", "email")

    def person_labels_text(self):
        p = self._t("person")
        return p.select(
            "idperson",
            C.code_label("ethnicity_id", C.ETHNICITY_LABELS).alias("ethnicity"),
            C.code_label("gender_id", C.GENDER_LABELS).alias("gender"),
            C.code_label("language_id", C.LANGUAGE_LABELS).alias("language"),
            C.code_label("veteran_id", C.VETERAN_LABELS).alias("veteran"))
