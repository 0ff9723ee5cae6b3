"""Declared schemas of the inputs and outputs, and a checker.

The events table carries one row per admission with an ordered array of codes
(position 1 is the primary diagnosis); the enrolment table one row per entity and
year with the number of HMO months.  ``bene_id`` may be a string or an integer
and ``admission_date`` a DATE or a TIMESTAMP; the checker accepts those variants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

EVENTS = T.StructType([
    T.StructField("bene_id", T.StringType(), True),
    T.StructField("admission_date", T.DateType(), True),
    T.StructField("diagnoses", T.ArrayType(T.StringType(), True), True),
])

ENROLMENT = T.StructType([
    T.StructField("bene_id", T.StringType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("hmo_mo", T.IntegerType(), True),
])

CODEBOOK_ENTRY = T.StructType([
    T.StructField("ref_period", T.IntegerType(), True),
    T.StructField("claims_criteria", T.StringType(), True),
    T.StructField("icd9", T.ArrayType(T.StringType(), True), True),
    T.StructField("icd10", T.ArrayType(T.StringType(), True), True),
    T.StructField("icd9_exclusion", T.ArrayType(T.StringType(), True), True),
    T.StructField("icd10_exclusion", T.ArrayType(T.StringType(), True), True),
])

CODEBOOK = T.MapType(T.StringType(), CODEBOOK_ENTRY, True)

# One row per (condition, code) of the codebook after explosion.
CODES = T.StructType([
    T.StructField("cond_pos", T.IntegerType(), False),
    T.StructField("condition", T.StringType(), False),
    T.StructField("ref_period", T.IntegerType(), False),
    T.StructField("criteria", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("code", T.StringType(), True),
])

_ID_TYPES = (T.StringType, T.LongType, T.IntegerType)
_DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_NUM_TYPES = (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DoubleType,
              T.FloatType, T.DecimalType)

# column -> accepted Spark type classes, per kind of input
_ACCEPTED = {
    "events": {"bene_id": _ID_TYPES, "admission_date": _DATE_TYPES,
               "diagnoses": (T.ArrayType,)},
    "enrolment": {"bene_id": _ID_TYPES, "year": _NUM_TYPES, "hmo_mo": _NUM_TYPES},
}


def check_schema(df: DataFrame, expected: T.StructType | str) -> DataFrame:
    """Validate ``df`` against a declared schema or an input kind; return it.

    ``expected`` is a StructType (names and types must match exactly) or one of
    ``"events"`` / ``"enrolment"`` (names required, type families accepted).
    Events may be in array form (``diagnoses``) or long form (``pos``, ``code``).
    Raises ``ValueError`` listing every mismatch.  Reads only the schema.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    if isinstance(expected, str):
        accepted = dict(_ACCEPTED[expected])
        if expected == "events" and "diagnoses" not in fields and {"pos", "code"} <= set(fields):
            accepted.pop("diagnoses")
            accepted.update({"pos": (T.IntegerType, T.LongType), "code": (T.StringType,)})
        for name, types in accepted.items():
            if name not in fields:
                problems.append(f"missing column {name!r}")
            elif not isinstance(fields[name], types):
                problems.append(f"column {name!r} has type {fields[name].simpleString()}")
        if expected == "events" and "diagnoses" in fields and isinstance(
                fields["diagnoses"], T.ArrayType) and not isinstance(
                fields["diagnoses"].elementType, T.StringType):
            problems.append("column 'diagnoses' must be array<string>")
    else:
        for f in expected.fields:
            if f.name not in fields:
                problems.append(f"missing column {f.name!r}")
            elif fields[f.name] != f.dataType:
                problems.append(f"column {f.name!r} has type {fields[f.name].simpleString()},"
                                f" expected {f.dataType.simpleString()}")
    if problems:
        raise ValueError("schema check failed: " + "; ".join(problems))
    return df
