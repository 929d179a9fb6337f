"""Wire contracts as data, compiled to one array-of-violations column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldseam import schemas as S


@dataclass(frozen=True)
class FieldRule:
    """What a JSON field must look like."""

    name: str
    kind: str
    required: bool = False
    enum: tuple[str, ...] | None = None
    pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None
    format: str | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    rules: tuple[FieldRule, ...]
    closed: bool


# The contract of transaction events.
TRANSACTION_CONTRACT = Contract(
    "transaction",
    (
        FieldRule("transaction_id", "string", True),
        FieldRule("user_id", "string", True),
        FieldRule("timestamp", "string", True, format="date-time"),
        FieldRule("transaction_type", "string", True, enum=S.TRANSACTION_TYPES),
        FieldRule("currency", "string", True, pattern="^[A-Z]{3}$"),
        FieldRule("amount_brl", "number", True, minimum=0),
        FieldRule("amount_foreign", "number", True, minimum=0),
        FieldRule("exchange_rate", "number", True, minimum=0),
        FieldRule("spread_pct", "number", True, minimum=0, maximum=100),
        FieldRule("fee_brl", "number", minimum=0),
        FieldRule("status", "string", True, enum=S.STATUSES),
        FieldRule("channel", "string", enum=S.CHANNELS),
        FieldRule("device", "string"),
        FieldRule("is_anomaly", "boolean"),
        FieldRule("anomaly_score", "number", minimum=0, maximum=1),
    ),
    closed=True,
)

# The contract of user events.
USER_CONTRACT = Contract(
    "user",
    (
        FieldRule("user_id", "string", True, format="uuid"),
        FieldRule("name", "string", True),
        FieldRule("email", "string", True, format="email"),
        FieldRule("state", "string", pattern="^[A-Z]{2}$"),
        FieldRule("tier", "string", True, enum=S.TIERS),
        FieldRule("registration_date", "string", format="date-time"),
    ),
    closed=False,
)

# Format names are annotations unless asserted, so these apply on request only.
FORMATS = {
    "uuid": "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "email": r"^[^@\s]+@[^@\s]+\.[^@\s]+$",
    "date-time": r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$",
}

_NUMBERS = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def _field_checks(rule: FieldRule, formats: bool) -> Sequence[Column]:
    field, kind = F.col(f"_f_{rule.name}"), F.col(f"_t_{rule.name}")
    text, number = field.try_cast("string"), field.try_cast("double")
    right = {
        "string": kind == "STRING",
        "number": kind.rlike(_NUMBERS),
        "boolean": kind == "BOOLEAN",
    }[rule.kind]
    checks = [F.when(~right, F.lit(f"type:{rule.name}"))]
    if rule.required:
        checks.append(F.when(kind.isNull(), F.lit(f"required:{rule.name}")))
    tests = {}
    if rule.enum:
        tests["enum"] = ~text.isin(*rule.enum)
    if rule.pattern:
        tests["pattern"] = ~text.rlike(rule.pattern)
    if rule.minimum is not None:
        tests["minimum"] = number < rule.minimum
    if rule.maximum is not None:
        tests["maximum"] = number > rule.maximum
    if formats and rule.format:
        tests["format"] = ~text.rlike(FORMATS[rule.format])
    for name, broken in tests.items():
        checks.append(F.when(right & broken, F.lit(f"{name}:{rule.name}")))
    return checks


def with_violations(
    df: DataFrame,
    contract: Contract,
    value: str = "value",
    output: str = "violations",
    assert_formats: bool = False,
) -> DataFrame:
    """Add the sorted codes of the rules that a JSON text breaks; empty when it is valid.

    The steps are separate projections: a text is parsed once into one variant per field,
    whose kind tells the JSON type. A missing field has no kind; a null one has a wrong kind.
    """
    names = [rule.name for rule in contract.rules]
    fields = T.StructType([T.StructField(n, T.VariantType(), True) for n in names])
    parsed = df.withColumns({"_doc": F.from_json(value, fields), "_keys": F.json_object_keys(value)})
    split = parsed.withColumns({f"_f_{n}": F.col("_doc").getField(n) for n in names})
    seen = split.withColumns({f"_t_{n}": F.schema_of_variant(f"_f_{n}") for n in names})
    codes = [c for rule in contract.rules for c in _field_checks(rule, assert_formats)]
    found = F.array_compact(F.array(*codes))
    if contract.closed:
        extra = F.array_except("_keys", F.array(*[F.lit(n) for n in names]))
        found = F.concat(found, F.transform(extra, lambda k: F.concat(F.lit("additional:"), k)))
    broken = F.when(F.col("_keys").isNotNull(), F.array_sort(found)).otherwise(
        F.array(F.lit("malformed"))
    )
    return seen.withColumn(output, broken).select(*df.columns, output)
