"""Clinical resource queries: JSON resources are derived from the business tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from millrace.functions.columns import iso_utc
from millrace.operators import fhir, patients
from millrace.plans.clinical import patient_counts, patient_table, store_batch
from millrace.plans.scratch import scratch_path
from millrace.queries.registry import query, spread_table, table
from millrace.sources.files import read_resources


def _json(**fields):
    return F.to_json(F.struct(*[e.alias(n) for n, e in fields.items()])).alias("value")


def _object(**members):
    """JSON text of an object whose members are JSON texts, without those that are NULL: what `to_json` gives, at a
    fraction of its cost on large tables."""
    named = [F.concat(F.lit(f'"{n}":'), e) for n, e in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *named), F.lit("}"))


def _array(item):
    return F.concat(F.lit("["), item, F.lit("]"))


def _safe(text):
    """JSON text of a string that needs no escapes."""
    return F.concat(F.lit('"'), text, F.lit('"'))


def _text(text):
    """JSON text of any string; `to_json` where there may be something to escape."""
    escaped = F.to_json(F.struct(text.alias("x")))
    escaped = F.substring(escaped, F.lit(len('{"x":') + 1), F.length(escaped) - len('{"x":}'))
    return F.when(text.rlike(r"^[ !#-\[\]-~]*\z"), _safe(text)).when(text.isNotNull(), escaped)


def _coding(code):
    return _object(coding=_array(_object(code=_text(code))))


def _reference(key: str):
    return _object(reference=_safe(F.concat(F.lit("Patient/"), F.col(key).cast("string"))))


def _patient_json(spark, sf, version: str = ""):
    """Customers as patients; those in debt carry no name and so fail validation."""
    customers = table(spark, sf, "customer")
    name = F.concat("c_name", F.lit(version))
    named = F.when(F.col("c_acctbal") >= 0, F.array(F.struct(name.alias("text"))))
    return customers.select(
        "c_custkey",
        _json(
            resourceType=F.lit("Patient"),
            id=F.col("c_custkey").cast("string"),
            name=named,
            gender=F.lower("c_mktsegment"),
            birthDate=F.concat((F.col("c_nationkey") + 1950).cast("string"), F.lit("-02-03")),
            address=F.array(F.struct(F.col("c_mktsegment").alias("text"))),
        ),
    )


_PATIENTS = """SELECT CAST(c_custkey AS VARCHAR) AS patient_id, c_name AS name, lower(c_mktsegment) AS gender,
       (1950 + c_nationkey) || '-02-03' AS birth_date, c_mktsegment AS address FROM customer WHERE c_acctbal >= 0"""


def _encounter_json(spark, sf):
    start = iso_utc(F.col("o_orderdate"))
    return spread_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate").select(
        _object(
            resourceType=F.lit('"Encounter"'),
            id=_safe(F.concat(F.lit("enc"), F.col("o_orderkey").cast("string"))),
            status=F.when(F.col("o_orderstatus") != "P", _text(F.col("o_orderstatus"))),
            **{"class": _object(code=_text(F.col("o_orderpriority")))},
            subject=_reference("o_custkey"),
            period=_object(start=_safe(start)),
        ).alias("value")
    )


def _observation_json(spark, sf):
    seen = F.col("event_type") == "view"
    return spread_table(spark, sf, "events", "event_id", "event_type", "user_id", "ts", "value").select(
        _object(
            resourceType=F.lit('"Observation"'),
            id=_safe(F.concat(F.lit("obs"), F.col("event_id").cast("string"))),
            status=F.lit('"final"'),
            code=_coding(F.col("event_type")),
            subject=_reference("user_id"),
            effectiveDateTime=_safe(iso_utc(F.col("ts"))),
            valueQuantity=F.when(~seen, F.to_json(F.struct("value"))),
            valueString=F.when(seen, F.lit('"seen"')),
        ).alias("value")
    )


def _condition_json(spark, sf):
    """A line without discount has an empty status list and fails to normalise."""
    status = F.when(F.col("l_discount") == 0, F.lit("[]")).otherwise(_array(_object(code=_text(F.col("l_linestatus")))))
    return spread_table(
        spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus", "l_discount", "l_shipdate"
    ).select(
        _object(
            resourceType=F.lit('"Condition"'),
            id=_safe(F.concat_ws("-", F.lit("cond"), F.col("l_orderkey"), F.col("l_linenumber"))),
            subject=_reference("l_suppkey"),
            code=_coding(F.col("l_returnflag")),
            onsetDateTime=_safe(F.date_format("l_shipdate", "yyyy-MM-dd")),
            clinicalStatus=_object(coding=status),
        ).alias("value")
    )


def _organization_json(spark, sf):
    return table(spark, sf, "supplier").select(
        _json(resourceType=F.lit("Organization"), id=F.col("s_suppkey").cast("string"))
    )


def _only(resources, name: str):
    return fhir.ingest(resources, only=[name])[name]


@query(_PATIENTS)
def fhir_patients(spark, sf):
    return _only(_patient_json(spark, sf), "patients")


@query("""
SELECT 'enc' || o_orderkey AS encounter_id, 'Patient/' || o_custkey AS patient_id, o_orderstatus AS status, o_orderpriority AS "class",
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS start, NULL::VARCHAR AS "end"
FROM orders WHERE o_orderstatus <> 'P'
""")
def fhir_encounters(spark, sf):
    return _only(_encounter_json(spark, sf), "encounters")


@query("""
SELECT 'obs' || event_id AS observation_id, 'Patient/' || user_id AS patient_id, event_type AS code,
       CASE WHEN event_type = 'view' THEN 'seen' END AS value_text, CASE WHEN event_type <> 'view' THEN value END AS value_num,
       strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN strftime(ts, '%f') = '000000' THEN '' ELSE '.' || strftime(ts, '%f') END || '+00:00' AS effective,
       ts AS effective_ts
FROM events
""")
def fhir_observations(spark, sf):
    found = _only(_observation_json(spark, sf), "observations")
    return found.select(
        "observation_id", "patient_id", "code", F.when(F.col("value_num").isNull(), F.col("value")).alias("value_text"),
        "value_num", "effective", F.col("effective_ts").cast("timestamp_ntz").alias("effective_ts"),
    )


@query("""
SELECT 'cond-' || l_orderkey || '-' || l_linenumber AS condition_id, 'Patient/' || l_suppkey AS patient_id, l_returnflag AS code,
       strftime(l_shipdate, '%Y-%m-%d 00:00:00') AS onset, l_linestatus AS clinical_status, NULL::VARCHAR AS verification_status
FROM lineitem WHERE l_discount <> 0
""")
def fhir_conditions(spark, sf):
    return _only(_condition_json(spark, sf), "conditions").drop("onset_ts")


@query("""
SELECT 'Patient' AS resource_type, 'Validation failed' AS error, 'name:missing' AS details, count(*) AS n FROM customer WHERE c_acctbal < 0 HAVING count(*) > 0
UNION ALL SELECT 'Encounter', 'Validation failed', 'status:missing', count(*) FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0
UNION ALL SELECT 'Condition', 'Normalization failed', NULL, count(*) FROM lineitem WHERE l_discount = 0 HAVING count(*) > 0
UNION ALL SELECT 'Organization', 'Unsupported resourceType: Organization', NULL, count(*) FROM supplier
""")
def fhir_errors(spark, sf):
    everything = reduce(
        lambda a, b: a.unionAll(b),
        [
            _patient_json(spark, sf).select("value"),
            _encounter_json(spark, sf),
            _observation_json(spark, sf),
            _condition_json(spark, sf),
            _organization_json(spark, sf),
        ],
    )
    errors = _only(everything, "errors")
    listed = F.array_join(F.transform("details", lambda d: F.concat(d["loc"], F.lit(":"), d["type"])), ",")
    return errors.groupBy("resource_type", "error", listed.alias("details")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT patient_id, name || ' v2' AS name, gender, birth_date, address FROM ({_PATIENTS})
""")
def fhir_latest_patient(spark, sf):
    found = _only(_patient_json(spark, sf), "patients")
    versions = found.withColumn("sequence", F.lit(1)).unionAll(
        found.withColumn("name", F.concat("name", F.lit(" v2"))).withColumn("sequence", F.lit(2))
    )
    return patients.latest_by_key(versions, "patient_id", ["sequence"]).drop("sequence")


@query(_PATIENTS)
def fhir_store(spark, sf):
    base = scratch_path(spark, "clinical")
    rows = _patient_json(spark, sf)
    for batch_id in (0, 1):
        store_batch(rows, base, batch_id, sequence="c_custkey")
    return patients.current_patients(spark, f"{base}/patients").drop("sequence", "batch_id")


@query(f"""
SELECT patient_id, name || CASE WHEN gender = 'building' THEN ' v4' ELSE ' v2' END AS name, gender, birth_date, address
FROM ({_PATIENTS})
""")
def fhir_store_compacted(spark, sf):
    """Two batches, compacted and dropped, then a late batch for one segment's patients."""
    base = scratch_path(spark, "clinical")
    for batch_id in (0, 1):
        store_batch(_patient_json(spark, sf, f" v{batch_id + 1}"), base, batch_id, sequence="c_custkey")
    patients.compact_patients(spark, f"{base}/patients")
    patients.drop_compacted(spark, f"{base}/patients")
    late = _patient_json(spark, sf, " v4").where(F.get_json_object("value", "$.gender") == "building")
    store_batch(late, base, 2, sequence="c_custkey")
    return patients.current_patients(spark, f"{base}/patients").drop("sequence", "batch_id")


@query(f"""
SELECT patient_id, name || CASE WHEN gender = 'building' THEN ' v2' ELSE ' v1' END AS name, gender, birth_date, address
FROM ({_PATIENTS})
""")
def fhir_store_buckets(spark, sf):
    """A first batch, one of one segment's patients, and a replay of the first that must change nothing."""
    base = scratch_path(spark, "clinical")
    late = _patient_json(spark, sf, " v2").where(F.get_json_object("value", "$.gender") == "building")
    for batch_id, rows in ((0, _patient_json(spark, sf, " v1")), (1, late), (0, _patient_json(spark, sf, " v1"))):
        store_batch(rows, base, batch_id, sequence="c_custkey", buckets=16)
    return patient_table(spark, base).read().drop("sequence", "batch_id")


@query(_PATIENTS)
def fhir_envelope(spark, sf):
    """JSON lines of request bodies."""
    path = scratch_path(spark, "bodies")
    _patient_json(spark, sf).select(F.concat(F.lit('{"resource": '), "value", F.lit("}"))).write.text(path)
    return fhir.ingest(read_resources(spark, path), envelope=True, only=["patients"])["patients"]


@query(f"""
WITH p AS ({_PATIENTS}), o AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS patient_id FROM orders)
SELECT p.patient_id, name, gender, birth_date, address FROM p JOIN o USING (patient_id)
""")
def patient_lookup(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("patient_id"))
    return patients.find_patients(_only(_patient_json(spark, sf), "patients"), ids)


@query(f"""
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS patient_id FROM orders
WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT patient_id FROM ({_PATIENTS}))
""")
def patient_not_found(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("patient_id"))
    return patients.unknown_patients(_only(_patient_json(spark, sf), "patients"), ids)


_VIEW = f"""
WITH p AS ({_PATIENTS}),
     e AS (SELECT CAST(o_custkey AS VARCHAR) AS patient_id, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
     o AS (SELECT CAST(user_id AS VARCHAR) AS patient_id, count(*) AS n FROM events GROUP BY 1),
     c AS (SELECT CAST(l_suppkey AS VARCHAR) AS patient_id, count(*) AS n FROM lineitem WHERE l_discount <> 0 GROUP BY 1)
SELECT p.patient_id, name, gender, birth_date, address, coalesce(e.n, 0) AS n_encounters, coalesce(o.n, 0) AS n_observations,
       coalesce(c.n, 0) AS n_conditions
FROM p LEFT JOIN e USING (patient_id) LEFT JOIN o USING (patient_id) LEFT JOIN c USING (patient_id)
"""


@query(_VIEW)
def fhir_patient_view(spark, sf):
    return patients.patient_view(
        _only(_patient_json(spark, sf), "patients"),
        _only(_encounter_json(spark, sf), "encounters"),
        _only(_observation_json(spark, sf), "observations"),
        _only(_condition_json(spark, sf), "conditions"),
    )


@query(_VIEW)
def fhir_patient_view_incremental(spark, sf):
    """Facts in three batches by kind, the second replayed, the first two folded before the last comes."""
    counts = patient_counts(spark, scratch_path(spark, "clinical"), 16)
    kinds = {"encounters": _encounter_json, "observations": _observation_json, "conditions": _condition_json}
    for batch_id, (name, resources) in enumerate(kinds.items()):
        counts.add(batch_id, {name: _only(resources(spark, sf), name)})
        if batch_id == 1:
            counts.add(1, {name: _only(resources(spark, sf), name)})
            counts.compact()
    return counts.view(_only(_patient_json(spark, sf), "patients"))


@query(f"""
WITH p AS ({_PATIENTS})
SELECT 'enc' || o_orderkey AS encounter_id, CAST(o_custkey AS VARCHAR) AS patient_id, o_orderstatus AS status, name, gender, birth_date
FROM orders LEFT JOIN p ON p.patient_id = CAST(o_custkey AS VARCHAR) WHERE o_orderstatus <> 'P'
""")
def fhir_encounter_facts(spark, sf):
    facts = patients.patient_facts(
        _only(_patient_json(spark, sf), "patients"), _only(_encounter_json(spark, sf), "encounters")
    )
    return facts.select("encounter_id", "patient_id", "status", "name", "gender", "birth_date")
