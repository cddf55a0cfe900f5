"""Clinical JSON resources: dispatch, structural validation, normalisation to flat tables.

One strict parse per row feeds everything. Per field the type text of the parsed value tells
absent, null and wrongly typed apart, which a typed JSON read cannot. The work is laid out in
projections that each use what the one before computed, and ends in a generator, so that a
filter on the outcome reads a finished column and never repeats the parse.

The outcome needs only whether a field is fine. What is wrong with it is looked up for rows that
fail. Paths into the whole resource are slow, most of all where they lead nowhere, so the checks
use members that were taken out before. A resource has one date or time at most, so one check
serves all types: Spark's generated method for the checks must stay below the 8,000 bytecodes
that the JVM compiles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.scratch import scratch_path

# Fields of each resource type with their kind, in schema order ("?" = optional).
FIELDS = {
    "Patient": {"id": "string", "name": "list", "gender": "string?", "birthDate": "date?", "address": "list?"},
    "Encounter": {"id": "string", "status": "string", "class": "dict?", "subject": "dict", "period": "dict?"},
    "Observation": {
        "id": "string",
        "status": "string",
        "code": "dict",
        "subject": "dict",
        "effectiveDateTime": "datetime?",
        "valueQuantity": "dict?",
        "valueString": "string?",
        "valueCodeableConcept": "dict?",
    },
    "Condition": {
        "id": "string",
        "subject": "dict",
        "code": "dict",
        "onsetDateTime": "datetime?",
        "clinicalStatus": "dict?",
        "verificationStatus": "dict?",
    },
}
TABLES = {"Patient": "patients", "Encounter": "encounters", "Observation": "observations", "Condition": "conditions"}
ERRORS = "errors"

_STAMP = (
    r"^(\d{4}-\d{2}-\d{2})(?:[Tt _](\d{2}:\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
    r"([Zz]|[+\-−](?:[01]\d|2[0-3]):?[0-5]\d)?)?$"
)
_MIDNIGHT = (
    r"^\d{4}-\d{2}-\d{2}(?:[Tt _]00:00(?::00(?:[.,](?:0{6}\d*|0{1,5}))?)?"
    r"([Zz]|[+\-−](?:[01]\d|2[0-3]):?[0-5]\d)?)?$"
)
_NUMBER = r"^[+-]?\d+(\.\d+)?$"
_NUMERIC_KIND = "^(BIGINT|DOUBLE|FLOAT|DECIMAL)"


def _at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _kind(v: Column, path: str) -> Column:
    """Type text at a path: NULL when absent, VOID for a JSON null."""
    return F.schema_of_variant(_at(v, path))


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _has(v: Column, path: str) -> Column:
    return _at(v, path).isNotNull()


def _instant(text: Column) -> Column:
    """Seconds or, beyond 2e10, milliseconds since the epoch, as a timestamp."""
    number = text.cast("double")
    micros = F.when(F.abs(number) > 2e10, number * 1e3).otherwise(number * 1e6)
    return F.timestamp_micros(F.round(micros).cast("long"))


class _Moment:
    """A date or time field: its text and the pieces that two projections take from it."""

    def __init__(self, field: str) -> None:
        self.name = field
        self.text = F.col(f"_text_{field}")
        self.parts = F.col(f"_parts_{field}")
        self.local = F.col(f"_local_{field}")
        self.instant = F.col(f"_instant_{field}")

    def pieces(self) -> dict[str, Column]:
        """Date, minutes, seconds, fraction and offset of an ISO text; NULL for other texts."""
        split = F.split(F.regexp_replace(self.text, _STAMP, "$1|$2|$3|$4|$5"), r"\|")
        return {f"_parts_{self.name}": F.when(self.text.rlike(_STAMP), split)}

    def times(self) -> dict[str, Column]:
        """Wall-clock text of an ISO text without its offset, and the time of a number."""
        minute = F.when(self.parts[1] == "", F.lit("00:00")).otherwise(self.parts[1])
        second = F.when(self.parts[2] == "", F.lit("00")).otherwise(self.parts[2])
        return {
            f"_local_{self.name}": F.concat(self.parts[0], F.lit(" "), minute, F.lit(":"), second),
            f"_instant_{self.name}": F.when(self.text.rlike(_NUMBER), _instant(self.text)),
        }

    def fraction(self) -> Column:
        """Six digits of the fraction, or empty when they are all zero."""
        digits = F.rpad(F.substring(self.parts[3], 1, 6), 6, "0")
        return F.when(digits == "000000", F.lit("")).otherwise(F.concat(F.lit("."), digits))

    def offset(self) -> Column:
        raw = F.translate(self.parts[4], "−", "-")
        signed = F.concat(F.substring(raw, 1, 3), F.lit(":"), F.right(raw, F.lit(2)))
        return (
            F.when(raw == "", F.lit(""))
            .when(F.upper(raw) == "Z", F.lit("+00:00"))
            .when(signed == "-00:00", F.lit("+00:00"))
            .otherwise(signed)
        )

    def as_date(self) -> Column:
        """yyyy-MM-dd of a date, a midnight time or a whole number of days since the epoch."""
        return F.when(self.instant.isNull(), self.parts[0]).otherwise(F.date_format(self.instant, "yyyy-MM-dd"))

    def as_datetime(self) -> Column:
        """`yyyy-MM-dd HH:mm:ss[.ffffff][+hh:mm]`, with the offset that the source text has."""
        micros = F.date_format(self.instant, "SSSSSS")
        numeric = F.concat(
            F.date_format(self.instant, "yyyy-MM-dd HH:mm:ss"),
            F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)),
            F.lit("+00:00"),
        )
        written = F.concat(self.local, self.fraction(), self.offset())
        return F.when(self.instant.isNull(), written).otherwise(numeric)


def _issue(loc: str | Column, kind: str | Column) -> Column:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(as_column(loc).alias("loc"), as_column(kind).alias("type"))


_NO_ISSUES = "array<struct<loc:string,type:string>>"


def _readable(text: Column) -> Column:
    """Whether a text is a time; of one that matches the pattern, minutes and seconds are at fixed places."""
    minute, second = F.substring(text, 12, 5), F.substring(text, 18, 2)
    local = F.concat(
        F.substring(text, 1, 10),
        F.lit(" "),
        F.when(minute == "", F.lit("00:00")).otherwise(minute),
        F.lit(":"),
        F.when(F.substring(text, 17, 1) == ":", second).otherwise(F.lit("00")),
    )
    number = F.when(text.rlike(_NUMBER), _instant(text)).isNotNull()
    return F.when(text.rlike(_STAMP), local.try_cast("timestamp_ntz").isNotNull()).otherwise(number)


def _midnight(text: Column) -> Column:
    """The same for a time that is a date."""
    number = F.when(text.rlike(_NUMBER), F.date_format(_instant(text), "HH:mm:ss.SSSSSS") == "00:00:00.000000")
    return text.rlike(_MIDNIGHT) | F.coalesce(number, F.lit(False))


# What can be wrong with a date or time, and its name for either kind.
_NO_MOMENT = {
    "type": {"date": "date_type", "datetime": "datetime_type"},
    "parsing": {"date": "date_from_datetime_parsing", "datetime": "datetime_from_date_parsing"},
    "inexact": {"date": "date_from_datetime_inexact", "datetime": "datetime_from_date_inexact"},
}


def _moment_problem(found: Column, text: Column, dated: Column) -> Column:
    """Key of _NO_MOMENT, NULL for a good date (`dated`) or time."""
    scalar = (found == "STRING") | found.rlike(_NUMERIC_KIND)
    return F.when(~scalar, "type").when(~_readable(text), "parsing").when(dated & ~_midnight(text), "inexact")


def _fine(member: Column, field: str, declared: str) -> Column:
    """Whether a field is as declared; never NULL."""
    optional, kind = declared.endswith("?"), declared.rstrip("?")
    found = F.schema_of_variant(member)
    if kind == "string":
        fine = found == "STRING"
    elif kind == "dict":
        fine = _members_of(member, field).isNotNull()
    elif kind == "list":
        fine = F.forall(F.try_variant_get(member, "$", "array<variant>"), _object_item)
    else:
        fine = F.col("_problem").isNull()
    fine = F.coalesce(fine, F.lit(False))
    return member.isNull() | fine | (found == "VOID") if optional else fine


def _members_of(member: Column, field: str) -> Column:
    """The object at a field, with its coding if it is a code; NULL when it is not an object."""
    return F.col(f"_coded_{field}") if field in _CODED else F.try_variant_get(member, "$", "struct<_:boolean>")


def _fault(v: Column, field: str, declared: str) -> Column:
    """Name of what is wrong with a field, NULL when it is fine."""
    optional, kind = declared.endswith("?"), declared.rstrip("?")
    found = F.col(f"_kind_{field}")
    fine = F.lit(None).cast("string")
    name = F.when(found.isNull(), fine if optional else F.lit("missing"))
    if optional:
        name = name.when(found == "VOID", fine)
    typed_as = {"string": "STRING", "dict": "OBJECT", "list": "ARRAY"}
    if kind not in typed_as:
        problem = fine
        for key, named in _NO_MOMENT.items():
            problem = F.when(F.col("_problem") == key, named[kind]).otherwise(problem)
        return name.otherwise(problem)
    name = name.when(~found.startswith(typed_as[kind]), f"{kind}_type")
    if kind == "list":
        name = name.when(F.exists(_items(v, field), lambda x: ~_object_item(x)), _ITEMS)
    return name


_ITEMS = "items"


def _items(v: Column, field: str) -> Column:
    return F.try_variant_get(v, f"$.{field}", "array<variant>")


def _object_item(x: Column) -> Column:
    return F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False))


def _issues(v: Column, field: str, declared: str) -> Column:
    """Array of the issues of a field."""
    fault = F.col(f"_fault_{field}")
    own = F.array(F.when(fault.isNotNull(), _issue(field, fault)))
    if not declared.startswith("list"):
        return own
    items = F.transform(
        _items(v, field),
        lambda x, i: F.when(~_object_item(x), _issue(F.concat(F.lit(f"{field}."), i.cast("string")), "dict_type")),
    )
    return F.when(fault == _ITEMS, items).otherwise(own)


def _first_code(v: Column, field: str) -> Column:
    return F.when(_kind(v, f"$.{field}.coding").startswith("ARRAY"), _text(v, f"$.{field}.coding[0].code"))


def _empty(found: Column, v: Column, path: str) -> Column:
    """Absent, null, false, zero, empty text, empty list or empty object."""
    text = _text(v, path)
    return F.coalesce(
        (found == "VOID")
        | ((found == "BOOLEAN") & (text == "false"))
        | ((found == "STRING") & (text == ""))
        | (found == "OBJECT<>")
        | (found.startswith("ARRAY") & _at(v, f"{path}[0]").isNull())
        | (found.rlike(_NUMERIC_KIND) & (text.try_cast("double") == 0)),
        F.lit(True),
    )


_CODED = ("code", "clinicalStatus", "verificationStatus")


def _code_breaks(coding: Column) -> Column:
    """A coding that is there but is not a list that starts with an object."""
    first = F.try_variant_get(coding, "$[0]", "struct<_:boolean>")
    return coding.isNotNull() & first.isNull() & ~_empty(F.schema_of_variant(coding), coding, "$")


def _status_breaks(coding: Column) -> Column:
    return coding.isNotNull() & ~_has(coding, "$[0].code")


def _breaks(name: str) -> Column:
    """Whether a valid resource cannot be normalised."""
    coding = {f: F.col(f"_coded_{f}")["coding"] for f in _CODED}
    if name == "Observation":
        return _code_breaks(coding["code"])
    if name == "Condition":
        return (
            _code_breaks(coding["code"])
            | _status_breaks(coding["clinicalStatus"])
            | _status_breaks(coding["verificationStatus"])
        )
    return F.lit(False)


def _patient(v: Column) -> dict[str, Column]:
    return {
        "patient_id": _text(v, "$.id"),
        "name": _text(v, "$.name[0].text"),
        "gender": _text(v, "$.gender"),
        "birth_date": _Moment("birthDate").as_date(),
        "address": _text(v, "$.address[0].text"),
    }


def _encounter(v: Column) -> dict[str, Column]:
    return {
        "encounter_id": _text(v, "$.id"),
        "patient_id": _text(v, "$.subject.reference"),
        "status": _text(v, "$.status"),
        "class": _text(v, "$.class.code"),
        "start": _text(v, "$.period.start"),
        "end": _text(v, "$.period.end"),
    }


def _observation(v: Column) -> dict[str, Column]:
    written = _text(v, "$.valueString")
    value = (
        F.when(_has(v, "$.valueQuantity.value"), _text(v, "$.valueQuantity.value"))
        .when(F.length(written) > 0, written)
        .when(_has(v, "$.valueCodeableConcept.text"), _text(v, "$.valueCodeableConcept.text"))
    )
    return {
        "observation_id": _text(v, "$.id"),
        "patient_id": _text(v, "$.subject.reference"),
        "code": _first_code(v, "code"),
        "value": value,
        "value_num": value.try_cast("double"),
        "effective": F.col("_shown_effectiveDateTime"),
        "effective_ts": F.col("_shown_effectiveDateTime").try_cast("timestamp"),
    }


def _condition(v: Column) -> dict[str, Column]:
    return {
        "condition_id": _text(v, "$.id"),
        "patient_id": _text(v, "$.subject.reference"),
        "code": _first_code(v, "code"),
        "onset": F.col("_shown_onsetDateTime"),
        "clinical_status": _first_code(v, "clinicalStatus"),
        "verification_status": _first_code(v, "verificationStatus"),
        "onset_ts": F.col("_shown_onsetDateTime").try_cast("timestamp"),
    }


NORMALISERS: dict[str, Callable[[Column], dict[str, Column]]] = {
    "Patient": _patient,
    "Encounter": _encounter,
    "Observation": _observation,
    "Condition": _condition,
}


def _staged(df: DataFrame, column: str, envelope: bool, only: Sequence[str] | None = None) -> DataFrame:
    """Source columns, `outcome`, and what validation found out about each resource.

    With `only`, rows of other resource types go right after the parse, and of the rest only what these types
    ask for is looked at.

    The outcome comes out of a generator, which a filter cannot be moved past: a filter on it
    compares a finished column, and only rows that pass it are normalised.
    """
    parsed = F.try_parse_json(F.col(column).cast("string"))
    v, kind = F.col("_resource"), F.col("resource_type")
    names = [n for n in FIELDS if only is None or n in only]
    every = {f: k for n in names for f, k in FIELDS[n].items()}
    moments = [(_Moment(f), k.rstrip("?")) for f, k in every.items() if k.startswith("date")]

    # Out of a generator too: else a join's filter on a result's key moves to the scan and parses every row again there.
    rows = df.withColumn("_resource", F.explode(F.array(_at(parsed, "$.resource") if envelope else parsed)))
    # One pass over the object takes out all fields: NULL when absent, a null variant for null.
    members = ", ".join(f"`{f}`: variant" for f in ("resourceType", *every))
    rows = rows.withColumn("_member", F.try_variant_get(v, "$", f"struct<{members}>"))
    member = F.col("_member")
    rows = rows.withColumns(
        {
            "resource_type": _text(member["resourceType"], "$"),
            "_object": member.isNotNull(),
            "_named": F.coalesce(F.schema_of_variant(member["resourceType"]) == "STRING", F.lit(False)),
        }
    )
    known = F.coalesce(kind.isin(*names), F.lit(False)) & F.col("_named")
    if only is not None:
        rows = rows.withColumn("_wanted", F.explode(F.array(known))).where("_wanted").drop("_wanted")
    moment, dated = F.lit(None).cast("variant"), F.lit(False)
    for name in names:
        for f, k in FIELDS[name].items():
            if k.startswith("date"):
                moment = F.when(kind == name, member[f]).otherwise(moment)
                dated = F.when(kind == name, F.lit(k.startswith("date?"))).otherwise(dated)
    rows = rows.withColumns(
        {
            **{f"_coded_{f}": F.try_variant_get(member[f], "$", "struct<coding:variant>") for f in _CODED if f in every},
            **{f"_text_{m.name}": _text(member[m.name], "$") for m, _ in moments},
            "_moment": moment,
            "_dated": dated,
        }
    )
    rows = rows.withColumns({"_found": F.schema_of_variant("_moment"), "_text": _text(F.col("_moment"), "$")})
    rows = rows.withColumns(
        {
            "_problem": _moment_problem(F.col("_found"), F.col("_text"), F.col("_dated")),
            **{n: e for m, _ in moments for n, e in m.pieces().items()},
        }
    )
    rows = rows.withColumns({n: e for m, _ in moments for n, e in m.times().items()})
    rows = rows.withColumns({f"_shown_{m.name}": m.as_datetime() for m, k in moments if k == "datetime"})
    rows = rows.withColumns({f"_fine_{f}": _fine(member[f], f, k) for f, k in every.items()})
    invalid, broken = F.lit(False), F.lit(False)
    for name in names:
        fine = reduce(and_, [F.col(f"_fine_{f}") for f in FIELDS[name]])
        invalid = F.when(kind == name, ~fine).otherwise(invalid)
        broken = F.when(kind == name, _breaks(name)).otherwise(broken)
    rows = rows.withColumns({"_invalid": invalid, "_broken": broken})
    error = (
        F.when(~F.col("_object"), "Resource is not a JSON object")
        .when(~known, F.concat(F.lit("Unsupported resourceType: "), F.coalesce(kind, F.lit("None"))))
        .when(F.col("_invalid"), "Validation failed")
        .when(F.col("_broken"), "Normalization failed")
    )
    rows = rows.withColumn("error", error)
    outcome = F.when(F.col("error").isNotNull(), ERRORS)
    for name, table in TABLES.items():
        outcome = outcome.when(kind == name, table)
    return rows.withColumn("outcome", F.explode(F.array(outcome)))


def _with_faults(staged: DataFrame) -> DataFrame:
    """Kind and fault of every field, looked up where the validation failed."""
    v, failed = F.col("_resource"), F.col("error") == "Validation failed"
    every = {f: k for fields in FIELDS.values() for f, k in fields.items()}
    rows = staged.withColumns({f"_kind_{f}": F.when(failed, _kind(v, f"$.{f}")) for f in every})
    return rows.withColumns({f"_fault_{f}": F.when(failed, _fault(v, f, k)) for f, k in every.items()})


def _details() -> Column:
    """Issues of a failed validation in schema order; evaluated for failing rows only."""
    v, kind = F.col("_resource"), F.col("resource_type")
    details = F.lit(None).cast(_NO_ISSUES)
    for name, fields in FIELDS.items():
        listed = F.flatten(F.array(*[_issues(v, f, k) for f, k in fields.items()]))
        details = F.when(kind == name, F.array_compact(listed)).otherwise(details)
    return F.when(F.col("error") == "Validation failed", details)


def _flat(table: str) -> list[Column]:
    name = next(n for n, t in TABLES.items() if t == table)
    return [e.alias(n) for n, e in NORMALISERS[name](F.col("_resource")).items()]


def classify(df: DataFrame, column: str = "value", envelope: bool = False) -> DataFrame:
    """Add `outcome` (a table name or "errors"), `resource_type`, `error`, `details` and one
    struct per table; all other columns are kept.

    `envelope` unwraps a `{"resource": ...}` request body.
    """
    staged = _with_faults(_staged(df, column, envelope))
    return staged.select(
        *[F.col(c) for c in df.columns],
        "outcome",
        "resource_type",
        "error",
        _details().alias("details"),
        *[F.when(F.col("outcome") == t, F.struct(*_flat(t))).alias(t) for t in TABLES.values()],
    )


def table_of(classified: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One normalised table, with some source columns kept in front if asked for."""
    return classified.where(F.col("outcome") == table).select(*keep, f"{table}.*")


def errors_of(classified: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    return classified.where(F.col("outcome") == ERRORS).select(
        *keep, F.col(column).alias("raw"), "resource_type", "error", "details"
    )


def ingest(
    df: DataFrame, column: str = "value", envelope: bool = False, only: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Four normalised tables and the error table, or those named in `only`.

    Each is a plan of its own over the source; where several are written, `ingest_once` parses only once.
    """
    wanted = only or (*TABLES.values(), ERRORS)
    out = {
        t: _staged(df, column, envelope, [name]).where(F.col("outcome") == t).select(*_flat(t))
        for name, t in TABLES.items()
        if t in wanted
    }
    if ERRORS in wanted:
        out[ERRORS] = _with_faults(_staged(df, column, envelope).where(F.col("outcome") == ERRORS)).select(
            F.col(column).alias("raw"), "resource_type", "error", _details().alias("details")
        )
    return out


def ingest_once(df: DataFrame, column: str = "value", envelope: bool = False, path: str | None = None) -> dict[str, DataFrame]:
    """The same five outputs after a single parse: rows are written partitioned by outcome and
    every table reads only its own partition."""
    spark = df.sparkSession
    target = path or scratch_path(spark, "resources")
    classify(df, column, envelope).write.mode("overwrite").partitionBy("outcome").parquet(target)
    stored = spark.read.parquet(target)
    out = {t: table_of(stored, t) for t in TABLES.values()}
    out[ERRORS] = errors_of(stored, column)
    return out
