"""Declared schemas of the two landing files (fixed names and types)."""

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _schema(required: set[str], **columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns.items()])


CLAIMS = _schema(
    {"claim_id", "bene_id", "service_date"},
    claim_id=T.StringType(),
    bene_id=T.StringType(),
    service_date=T.StringType(),
    claim_year=T.IntegerType(),
    claim_month=T.IntegerType(),
    service_type=T.StringType(),
    icd10_primary=T.StringType(),
    icd10_codes=T.StringType(),
    provider_specialty=T.StringType(),
    claim_amount=T.DoubleType(),
    allowed_amount=T.DoubleType(),
    paid_amount=T.DoubleType(),
    plan_type=T.StringType(),
    intervention_arm=T.IntegerType(),
)

MEMBERS = _schema(
    {"bene_id"},
    bene_id=T.StringType(),
    age=T.IntegerType(),
    sex=T.StringType(),
    dual_eligible=T.IntegerType(),
    plan_type=T.StringType(),
    state=T.StringType(),
    enrollment_date=T.StringType(),
    intervention_arm=T.IntegerType(),
)


def with_corrupt(schema: T.StructType) -> T.StructType:
    """Add the column in which a permissive CSV read keeps a malformed line.

    Fields become nullable: a malformed line has no usable values.
    """
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])
