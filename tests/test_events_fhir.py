import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import events, fhir, patients
from millrace.sources.topics import FIELDS, TOPIC_OF, kafka_options, schema_of, topic_names

GOOD = '{"event_id":"ev-0071","event_type":"user_action","timestamp":"2023-03-05T07:30:00Z","action":"upload"}'


def raw(spark, values, topic="user-actions"):
    return spark.createDataFrame([(v, topic) for v in values], "value string, topic string").withColumn(
        "timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_valid_event_is_flagged_and_kept(spark):
    extra = '{"event_id":"ev-0072","event_type":"page_view","timestamp":"2023-04-09T18:05:00Z","page":"/plans"}'
    rows = events.valid_events(events.check_events(raw(spark, [GOOD, extra]))).withColumn("m", events.mark_processed(F.col("value"))).collect()
    assert [r["processed"] for r in rows] == [True, True]
    assert json.loads(rows[1]["m"]) == {**json.loads(extra), "processed": True}


def test_dead_letters(spark):
    cases = {
        '{"event_type":"order"}': ("ValueError", "Message is missing required fields: {'event_id', 'timestamp'}"),
        "not json": ("JSONDecodeError", None), "": ("JSONDecodeError", None), None: ("JSONDecodeError", None),
        "[1,2]": ("TypeError", None), "5": ("TypeError", None), "null": ("TypeError", None),
        '{"event_id":null}': ("ValueError", "Message is missing required fields: {'event_type', 'timestamp'}"),
        '{"event_id":"a","amount":"x"}': ("ValueError", "Message is missing required fields: {'event_type', 'timestamp'}"),
        GOOD + " x": ("JSONDecodeError", None), GOOD + "}": ("JSONDecodeError", None), GOOD + "]": ("JSONDecodeError", None),
        GOOD + "," + GOOD: ("JSONDecodeError", None), GOOD.replace('"', "'"): ("JSONDecodeError", None),
    }
    letters = {r["original_message"]: r for r in events.dead_letters(events.check_events(raw(spark, list(cases)))).collect()}
    assert set(letters) == set(cases)
    for text, (kind, reason) in cases.items():
        assert letters[text]["dlq_error_type"] == kind, text
        assert reason is None or letters[text]["dlq_reason"] == reason


def test_null_values_and_repeated_keys_are_present(spark):
    ok = ['{"event_id":null,"event_type":null,"timestamp":null}', GOOD[:-1] + ',"event_id":"b"}', "  " + GOOD + "\n",
          GOOD[:-1] + ',"x":{"a":1,"a":"it\'s"}}']
    assert events.valid_events(events.check_events(raw(spark, ok))).count() == len(ok)


@pytest.mark.parametrize("topic", sorted(FIELDS))
def test_parse_keeps_every_row(spark, topic):
    schema = schema_of(topic)
    whole = {f.name: {"string": "s", "double": 1.5, "int": 7}[f.dataType.simpleString()] for f in schema}
    mistyped = {**whole, "event_id": 5, "amount": "x", "duration_ms": 2.5}
    df = events.parse_events(raw(spark, [json.dumps(whole), json.dumps(mistyped), "not json", "[1]", None], topic), schema)
    assert df.columns == ["topic", "kafka_ts", *schema.fieldNames(), "ingested_at"]
    rows = df.collect()
    assert all(rows[0][k] == v for k, v in whole.items())
    assert rows[1]["event_id"] == "5" and all(rows[1][k] is None for k in ("amount", "duration_ms") if k in whole)
    assert all(r[n] is None for r in rows[2:] for n in schema.fieldNames())
    kept = events.parse_events(raw(spark, ["not json"], topic), schema, corrupt="_corrupt").first()
    assert kept["_corrupt"] == "not json"


def test_routing(spark):
    df = spark.createDataFrame([(k, f"id{i}", None) for i, k in enumerate([*TOPIC_OF, "other"])], "event_type string, event_id string, x string")
    messages = events.to_messages(df)
    assert [r["topic"] for r in messages.collect()] == [*TOPIC_OF.values(), None]
    assert json.loads(messages.first()["value"]) == {"event_type": "user_action", "event_id": "id0"}
    assert events.unroutable(messages).first()["dlq_error_type"] == "KeyError"
    assert schema_of("nope") is None and topic_names(" a, b ") == ["a", "b"]
    assert kafka_options("h:1", "a, b", "earliest")["subscribe"] == "a,b"
    with pytest.raises(ValueError):
        kafka_options("h:1", "a", "middle")


PATIENT = {"resourceType": "Patient", "id": "p-88", "name": [{"text": "Ines Okafor"}], "gender": "female", "birthDate": "1969-11-23", "address": [{"text": "7 Quay Lane"}]}
ENCOUNTER = {"resourceType": "Encounter", "id": "visit-4", "status": "finished", "class": {"code": "AMB"}, "subject": {"reference": "Patient/p-88"},
             "period": {"start": "2021-05-17T08:10:00Z", "end": "2021-05-17T09:25:00Z"}}
OBS = {"resourceType": "Observation", "id": "lab-9", "status": "final", "code": {"coding": [{"code": "8302-2"}]}, "subject": {"reference": "Patient/p-88"}}
COND = {"resourceType": "Condition", "id": "dx-3", "subject": {"reference": "Patient/p-88"}, "code": {"coding": [{"code": "J45"}]}}


def resources(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


@pytest.mark.parametrize("how", [fhir.ingest, fhir.ingest_once])
def test_ingest(spark, how):
    out = how(resources(spark, PATIENT, ENCOUNTER, {**OBS, "valueQuantity": {"value": 70, "unit": "kg"}}, COND, {"resourceType": "Unknown", "id": "1"}))
    assert tuple(out["patients"].first()) == ("p-88", "Ines Okafor", "female", "1969-11-23", "7 Quay Lane")
    assert tuple(out["encounters"].first()) == ("visit-4", "Patient/p-88", "finished", "AMB", "2021-05-17T08:10:00Z", "2021-05-17T09:25:00Z")
    assert tuple(out["observations"].first()) == ("lab-9", "Patient/p-88", "8302-2", "70", 70.0, None, None)
    assert tuple(out["conditions"].first()) == ("dx-3", "Patient/p-88", "J45", None, None, None, None)
    bad = out["errors"].collect()
    assert [r["error"] for r in bad] == ["Unsupported resourceType: Unknown"]


def test_envelope(spark):
    out = fhir.ingest(resources(spark, {"resource": PATIENT}), envelope=True)
    assert out["patients"].first()["patient_id"] == "p-88"


def issues(spark, doc):
    row = fhir.errors_of(fhir.classify(resources(spark, doc))).first()
    return row and (row["error"], [tuple(d) for d in row["details"] or []])


def test_error_rows(spark):
    def without(doc, *names):
        return {k: v for k, v in doc.items() if k not in names}
    failed = "Validation failed"
    cases = [
        ({**PATIENT, "id": 123}, (failed, [("id", "string_type")])),
        (without(PATIENT, "name", "id"), (failed, [("id", "missing"), ("name", "missing")])),
        ({**PATIENT, "name": ["x", {}, None]}, (failed, [("name.0", "dict_type"), ("name.2", "dict_type")])),
        ({**PATIENT, "name": None, "gender": None}, (failed, [("name", "list_type")])),
        ({**PATIENT, "birthDate": "1980"}, (failed, [("birthDate", "date_from_datetime_inexact")])),
        ({**ENCOUNTER, "subject": "Patient/1"}, (failed, [("subject", "dict_type")])),
        ({**COND, "clinicalStatus": {"coding": []}}, ("Normalization failed", [])),
        ({**COND, "clinicalStatus": {"coding": [{}]}}, ("Normalization failed", [])),
        ({**COND, "code": {"coding": "x"}}, ("Normalization failed", [])),
        ({**COND, "code": {"coding": []}}, None), ({**COND, "clinicalStatus": {}}, None),
        ({**PATIENT, "name": []}, None), ({**PATIENT, "id": ""}, None),
        ({"id": "1"}, ("Unsupported resourceType: None", [])),
        ("[1]", ("Resource is not a JSON object", [])), ("nope", ("Resource is not a JSON object", [])),
    ]
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, (d, _) in enumerate(cases)], "n int, value string")
    got = {r["n"]: (r["error"], [tuple(d) for d in r["details"] or []]) for r in fhir.errors_of(fhir.classify(df), keep=("n",)).collect()}
    for i, (doc, want) in enumerate(cases):
        assert got.get(i) == want, doc


DATES = ["1980", "1980-01", "1969-11-23", "1980-13-01", "1980-02-30", "abc", "", "1980-01-01T00:00:00", "1980-01-01T00:00:00Z", "1980-01-01 00:00",
         "1980-01-01T05:00:00", "1980-01-01T00:00:00+05:00", 0, 86400, 1, 1.5, 86400.0, True, [], {}, "0", "86400", " 1980-01-01", "1980-1-1"]
TIMES = ["2022-01-01", "2021-05-17T08:10:00Z", "2022-01-01t00:00", "2022-01-01_00:00", "2022-01-01T00:00:00.5+02:00", "2022-01-01T01:00:00.1234567",
         "2022-01-01T00:00:00,5", "2022-01-01T00:00:00+0200", "2022-01-01T00:00:00+02", "2022-01-01T00:00:00-00:00", "2022-01-01T24:00:00", "2022-13-01",
         "2022", "abc", "", 5, 1.5, True, [], "5.5", "2022-01-01T00:00:00+25:00", "2022-01-01T00:00:60Z", "2022-01-01T00:00:00 +02:00",
         "2022-01-01T00:00:00.", "2022-01-01T00:00:00−02:00", 20000000001, -5, "1e3", "2022-02-30T00:00:00Z"]


def test_dates_and_times_agree_with_pydantic(spark):
    pydantic = pytest.importorskip("pydantic")
    from datetime import date, datetime
    for kind, base, field, values, table, out in (
        (date, PATIENT, "birthDate", DATES, "patients", "birth_date"), (datetime, OBS, "effectiveDateTime", TIMES, "observations", "effective")):
        model = pydantic.create_model("M", x=(kind, ...))
        df = spark.createDataFrame([(i, json.dumps({**base, field: v})) for i, v in enumerate(values)], "n int, value string")
        c = fhir.classify(df)
        good = {r["n"]: r[out] for r in fhir.table_of(c, table, keep=("n",)).collect()}
        bad = {r["n"]: r["details"][0]["type"] for r in fhir.errors_of(c, keep=("n",)).collect()}
        for i, v in enumerate(values):
            try:
                want = str(model.model_validate({"x": v}).x)
                assert good.get(i) == want, (v, want, good.get(i), bad.get(i))
            except pydantic.ValidationError as e:
                assert bad.get(i) == e.errors()[0]["type"], (v, good.get(i), bad.get(i))


def test_observation_value_order(spark):
    docs = [{**OBS, "valueQuantity": {"value": None}, "valueString": "s"}, {**OBS, "valueString": "", "valueCodeableConcept": {"text": "t"}},
            {**OBS, "valueString": "s", "valueCodeableConcept": {"text": "t"}}, {**OBS, "valueQuantity": {}, "valueString": "7"}, OBS]
    rows = fhir.ingest(resources(spark, *docs))["observations"].collect()
    assert [r["value"] for r in rows] == [None, "t", "s", "7", None]


def test_patient_store(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "patient_id string, name string, gender string, birth_date string, address string, sequence long"
    patients.append_versions(spark.createDataFrame([("p-88", "Old", None, None, None, 1), ("", "No id", None, None, None, 2)], schema), path, 0)
    for _ in range(2):
        patients.append_versions(spark.createDataFrame([("p-88", "Ines Okafor", None, None, None, 3)], schema), path, 1)
    now = patients.current_patients(spark, path)
    assert [tuple(r)[:2] for r in patients.find_patient(now, "p-88").collect()] == [("p-88", "Ines Okafor")]
    assert patients.find_patient(now, "doesnotexist").count() == 0
    assert now.count() == 1
    ids = spark.createDataFrame([("p-88",), ("9",)], "patient_id string")
    assert patients.find_patients(now, ids).count() == 1
    assert [r[0] for r in patients.unknown_patients(now, ids).collect()] == ["9"]


def test_patient_view_and_mask(spark):
    out = fhir.ingest(resources(spark, PATIENT, ENCOUNTER, ENCOUNTER, OBS))
    row = patients.patient_view(out["patients"], out["encounters"], out["observations"], out["conditions"]).first()
    assert (row["n_encounters"], row["n_observations"], row["n_conditions"]) == (2, 1, 0)
    assert patients.patient_facts(out["patients"], out["encounters"]).first()["name"] == "Ines Okafor"
    masked = patients.mask(out["patients"], hashed=["patient_id"], shortened=["name"], dropped=["address"])
    assert masked.columns == ["patient_id", "name", "gender", "birth_date"] and masked.first()["name"] == "I***"


def test_flag_is_replaced_not_repeated(spark):
    df = spark.createDataFrame([('{"event_id":"e7","processed":false,"n":1.50,"list":[1,"x"]}',), ('{"event_id":"e8"}',)], "value string")
    got = [json.loads(r[0]) for r in df.select(events.mark_processed(F.col("value"))).collect()]
    assert got == [{"event_id": "e7", "n": 1.5, "list": [1, "x"], "processed": True}, {"event_id": "e8", "processed": True}]


def test_large_checks_are_compiled(spark):
    """The JVM leaves methods over 8,000 bytecodes uncompiled."""
    import re
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        errors = fhir.ingest(resources(spark, PATIENT), only=["errors"])["errors"].groupBy("error").count()
        text = spark._jvm.PythonSQLUtils.explainString(errors._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_view_parses_once(spark, tmp_path):
    """A join's filter on the key of its counts must not parse the resources a second time."""
    path = str(tmp_path / "resources")
    resources(spark, PATIENT, ENCOUNTER, OBS, COND).write.parquet(path)
    out = fhir.ingest(spark.read.parquet(path))
    view = patients.patient_view(out["patients"], out["encounters"], out["observations"], out["conditions"])
    plan = view._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 4
    assert (view.first()["n_encounters"], view.first()["n_conditions"]) == (1, 1)


def test_items_and_times_at_the_edge(spark):
    docs = [{**PATIENT, "name": [None]}, {**PATIENT, "name": [{}, {"text": "b"}]}, {**PATIENT, "address": [1]}, {**PATIENT, "birthDate": "1980-01-01T00:00:00.0000001"},
            {**PATIENT, "birthDate": "1980-01-01T00:00:00.000001"}, {**PATIENT, "birthDate": None}, {**COND, "onsetDateTime": "2022-01-01 00:00"}]
    got = [(r["error"], [tuple(d) for d in r["details"] or []]) for r in fhir.classify(resources(spark, *docs)).select("error", "details").collect()]
    failed = "Validation failed"
    assert got == [(failed, [("name.0", "dict_type")]), (None, []), (failed, [("address.0", "dict_type")]), (None, []),
                   (failed, [("birthDate", "date_from_datetime_inexact")]), (None, []), (failed, [("onsetDateTime", "datetime_from_date_parsing")])]


def test_json_by_text_is_to_json(spark):
    from millrace.queries import clinical
    odd = [None, "", "a", 'q"q', "b\\s", "t\tn\n", "x\n", "é中", "\x7f\x01", "</>"]
    df = spark.createDataFrame([(x,) for x in odd], "s string")
    rows = df.select(F.to_json(F.struct(F.struct("s").alias("o"))).alias("want"), clinical._object(o=clinical._object(s=clinical._text(F.col("s")))).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in rows)
