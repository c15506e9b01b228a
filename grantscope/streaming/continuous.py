"""Continuous detection (extension X7): streams of grants and of HR changes.

Every micro-batch stores its events and evaluates the grants that they concern (``streaming.state``). Nothing is dropped as late:
the state of a grant or an employee is its last event by ``event_time`` (streams without one: by micro-batch), whatever the
order of arrival, and the findings are those a batch review of these states gives. A revoked grant closes its findings, and the
change of an employee alone wakes that employee's grants.

``recheck`` evaluates all stored grants against an HR table of the day, for users without a stream of HR changes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantscope import catalogue as cat
from grantscope import schemas
from grantscope.session import file_stream
from grantscope.sources import derived
from grantscope.streaming.state import EMPLOYEE_EVENTS, GRANT_EVENTS, RECHECKS, DetectionState

STREAM_RULES = ("RULE-001", "RULE-003", "RULE-006", "RULE-007")


def grant_stream(spark: SparkSession, source_dir: str, schema: T.StructType = schemas.ACCESS_BASE, fmt: str = "parquet",
                 max_files: int | None = None, file_glob: str | None = None) -> DataFrame:
    """Grants landing as files in ``source_dir``; ``max_files`` bounds a micro-batch (default: all that are there).

    Give ``schema=GRANT_EVENTS`` for files with an ``event_time``.
    """
    expected = GRANT_EVENTS if "event_time" in schema.names else schemas.ACCESS_BASE
    return schemas.validate(file_stream(spark, source_dir, schema, fmt, max_files, file_glob), expected, "access_base stream")


def employee_stream(spark: SparkSession, source_dir: str, schema: T.StructType = EMPLOYEE_EVENTS, fmt: str = "parquet",
                    max_files: int | None = None, file_glob: str | None = None) -> DataFrame:
    """HR rows (with ``event_time``, if the schema has it) landing as files in ``source_dir``, one for every change."""
    expected = EMPLOYEE_EVENTS if "event_time" in schema.names else schemas.EMPLOYEES
    return schemas.validate(file_stream(spark, source_dir, schema, fmt, max_files, file_glob), expected, "employees stream")


def _events(df: DataFrame | None, schema: T.StructType) -> DataFrame | None:
    """Events with ``event_time``, NULL where the source has none."""
    if df is None or "event_time" in df.columns:
        return df
    return df.withColumn("event_time", F.lit(None).cast("timestamp_ntz")).select(*schema.names)


def changes(grants: DataFrame, employees: DataFrame) -> DataFrame:
    """Both streams as one (columns ``grant`` and ``employee``, one of them NULL), so that one query orders their batches."""
    def side(df, name):
        events = _events(df, {"grant": GRANT_EVENTS, "employee": EMPLOYEE_EVENTS}[name])
        parts = {n: F.lit(None).cast(s.simpleString()).alias(n) for n, s in (("grant", GRANT_EVENTS), ("employee", EMPLOYEE_EVENTS))}
        parts[name] = F.struct(*events.columns).alias(name)
        return events.select(parts["grant"], parts["employee"])

    return side(grants, "grant").unionByName(side(employees, "employee"))


def _run(stream: DataFrame, out_dir: str, apply) -> DataFrame:
    """Apply every micro-batch that is there now, then stop; the current findings."""
    state = DetectionState(stream.sparkSession, f"{out_dir}/state")

    def put(batch: DataFrame, batch_id: int) -> None:
        apply(state, batch, f"s{batch_id}", (batch_id + 1) * RECHECKS)

    q = (stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{out_dir}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return state.current_findings()


def run_available_now(grants: DataFrame, employees: DataFrame, systems: DataFrame, out_dir: str, as_of: str,
                      rules=STREAM_RULES, params: cat.RuleParams = cat.RuleParams()) -> DataFrame:
    """Process every file of the stream ``grants`` with the HR table ``employees``; return the current findings."""
    def apply(state, batch, name, version):
        state.apply(name, version, systems, as_of, rules, params, grants=_events(batch, GRANT_EVENTS), hr=employees)

    return _run(grants, out_dir, apply)


def run_changes(stream: DataFrame, systems: DataFrame, out_dir: str, as_of: str, rules=STREAM_RULES,
                params: cat.RuleParams = cat.RuleParams()) -> DataFrame:
    """Process every file of ``changes(grants, employees)``; return the current findings. HR rows are events too, the first
    table included: an employee of whom no event has come has no findings yet."""
    def apply(state, batch, name, version):
        state.apply(name, version, systems, as_of, rules, params,
                    grants=batch.where("grant is not null").select("grant.*"), employees=batch.where("employee is not null").select("employee.*"))

    return _run(stream, out_dir, apply)


def recheck(employees: DataFrame, systems: DataFrame, out_dir: str, as_of: str, rules=STREAM_RULES,
            params: cat.RuleParams = cat.RuleParams(), run_id: str | None = None) -> DataFrame:
    """Evaluate the last state of every stored grant with the HR table of now; return the current findings.

    Give the ``run_id`` of an interrupted run to redo it in place.
    """
    state, batch = DetectionState(employees.sparkSession, f"{out_dir}/state"), f"r{run_id or uuid.uuid4().hex}"
    state.evaluate_all(batch, state.next_version(batch), systems, as_of, rules, params, hr=employees)
    return state.current_findings()


def derived_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grants derived from the ``orders`` test table, as a stream of its files."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").schema
    raw = file_stream(spark, sf_dir, schema, file_glob="orders*.parquet")
    return schemas.validate(raw.select(*[F.expr(e).alias(n) for n, e in derived.ACCESS_BASE_EXPRS]),
                            schemas.ACCESS_BASE, "access_base stream")
