"""The event contract as column expressions.

A contract names required keys, two enumerations and four typed fields. The
first failing check gives the reason; NULL means the event is valid.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The contract used when no schema document is given.
REQUIRED_FIELDS = (
    "event_id", "sensor_id", "equipment_id", "factory_id", "measurement_type", "value",
    "unit", "timestamp", "quality", "is_anomaly", "metadata",
)
QUALITIES = ("good", "warning", "bad")
MEASUREMENT_TYPES = ("temperature", "humidity", "pressure", "vibration", "current")

# How reasons name the type of a JSON value.
TYPE_NAMES = {
    "STRING": "str",
    "BIGINT": "int",
    "DECIMAL": "float",
    "DOUBLE": "float",
    "BOOLEAN": "bool",
    "ARRAY": "list",
    "VOID": "NoneType",
    "OBJECT": "dict",
}

MALFORMED = "Mensagem não é JSON válido"


@dataclass(frozen=True)
class Contract:
    required: tuple[str, ...] = REQUIRED_FIELDS
    qualities: tuple[str, ...] = QUALITIES
    measurement_types: tuple[str, ...] = MEASUREMENT_TYPES
    # JSON true/false as ``value``: rejected unless this is set.
    bool_is_number: bool = False

    @classmethod
    def from_json_schema(cls, text: str | None, **options) -> "Contract":
        """Read a JSON Schema document; parts it leaves out keep the defaults."""
        schema = json.loads(text) if text else {}
        properties = schema.get("properties", {})

        def enum(name: str, default: tuple[str, ...]) -> tuple[str, ...]:
            return tuple(properties.get(name, {}).get("enum") or default)

        return cls(
            required=tuple(schema.get("required") or REQUIRED_FIELDS),
            qualities=enum("quality", QUALITIES),
            measurement_types=enum("measurement_type", MEASUREMENT_TYPES),
            **options,
        )


def quoted_list(values: Iterable[str]) -> str:
    """``['a', 'b']``, sorted: the list style of the reason texts."""
    return "[" + ", ".join(f"'{v}'" for v in sorted(values)) + "]"


def with_reason(
    df: DataFrame, body: str, text: str, contract: Contract, out: str
) -> DataFrame:
    """Add the reason column; NULL for events that keep the contract.

    ``body`` is the column holding the message parsed to a variant (NULL for
    text that does not parse, such as a repeated key or NaN), ``text`` the
    column holding the message itself.

    Three projections: what the checks look at, the number of the first check
    that fails, and its message. Each looks up the one before, which keeps the
    generated code small enough to be compiled well.
    """
    # Keys need a pass over the text, and are looked at twice.
    looked_at = df.withColumn("_keys", F.json_object_keys(text)).withColumns(
        {
            "_missing": _missing_keys(contract),
            "_root": F.when(F.col("_keys").isNull(), _kind(F.col(body))),
            **{f"_{f}_kind": _kind(_field(body, f)) for f in _TYPED},
            **{f"_{f}": _content(body, f) for f in _ENUMS},
        }
    )
    judged = looked_at.withColumn("_check", _first_failure(body, contract))
    # The text of each reason, before and after its detail.
    texts = [
        (MALFORMED, ""),
        ("Evento deve ser dict, recebeu: ", ""),
        ("Campos ausentes: ['", "']"),
        ("'value' deve ser numérico, recebeu: ", ""),
        ("'is_anomaly' deve ser bool, recebeu: ", ""),
        ("'quality' inválido: ", f" (esperado: {quoted_list(contract.qualities)})"),
        ("'measurement_type' inválido: ", ""),
        ("'metadata' deve ser um objeto JSON", ""),
    ]
    before, after = (F.array(*[F.lit(t[i]) for t in texts]) for i in (0, 1))
    check = F.col("_check")
    type_shown = (
        F.when(check == 2, F.col("_root"))
        .when(check == 4, F.col("_value_kind"))
        .otherwise(F.col("_is_anomaly_kind"))
    )
    detail = (
        F.when(check.isin(1, 8), "")
        .when(check == 3, F.array_join("_missing", "', '"))
        .when(check == 6, _shown("quality"))
        .when(check == 7, _shown("measurement_type"))
        .otherwise(_type_name(type_shown))
    )
    reason = F.when(
        check.isNotNull(),
        F.concat(F.element_at(before, check), detail, F.element_at(after, check)),
    )
    return judged.select(*df.columns, reason.alias(out))


# Fields whose JSON type matters, and those that are enumerations.
_TYPED = ("value", "is_anomaly", "quality", "measurement_type", "metadata")
_ENUMS = ("quality", "measurement_type")


def _first_failure(body: str, contract: Contract) -> Column:
    """Number of the first check an event fails; NULL if it passes all."""
    value = F.col("_value_kind")
    numbers = ["BIGINT", "DOUBLE"] + ["BOOLEAN"] * contract.bool_is_number

    def in_enum(name: str, values: Iterable[str]) -> Column:
        return (F.col(f"_{name}_kind") == "STRING") & F.col(f"_{name}").isin(*values)

    failures = [
        F.col(body).isNull(),
        F.col("_root").isNotNull(),
        F.size("_missing") > 0,
        ~(value.isin(numbers) | value.startswith("DECIMAL")),
        F.col("_is_anomaly_kind") != "BOOLEAN",
        ~in_enum("quality", contract.qualities),
        ~in_enum("measurement_type", contract.measurement_types),
        ~F.col("_metadata_kind").startswith("OBJECT"),
    ]
    result = F.when(failures[0], 1)
    for number, failed in enumerate(failures[1:], start=2):
        result = result.when(failed, number)
    return result


def _missing_keys(contract: Contract) -> Column:
    required = F.array(*[F.lit(k) for k in sorted(contract.required)])
    return F.array_except(required, F.col("_keys"))


def _field(body: str, name: str) -> Column:
    return F.try_variant_get(F.col(body), f"$.{name}", "variant")


def _content(body: str, name: str) -> Column:
    return F.try_variant_get(F.col(body), f"$.{name}", "string")


def _kind(body: Column) -> Column:
    """Type of a variant, such as ``STRING``, ``DECIMAL(3,1)`` or ``OBJECT<...>``.

    A field that is not there has the type of JSON null.
    """
    return F.coalesce(F.schema_of_variant(body), F.lit("VOID"))


def _shown(name: str) -> Column:
    """A field's content the way reasons print it."""
    kind, content = F.col(f"_{name}_kind"), F.col(f"_{name}")
    return F.when(kind == "BOOLEAN", F.initcap(content)).otherwise(
        F.coalesce(content, F.lit("None"))
    )


def _type_name(kind: Column) -> Column:
    """The name reasons use for a type: parameters dropped, then looked up."""
    bare = F.regexp_extract(kind, "^([A-Z]+)", 1)
    pairs = [F.lit(part) for item in TYPE_NAMES.items() for part in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), bare), bare)
