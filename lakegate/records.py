"""Declarative description of the records wrapped in a source document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a raw text field becomes a typed column.
TEXT = "text"  # trimmed
CODE = "code"  # trimmed, upper case
INT = "int"
DOUBLE = "double"

# When a field makes its record invalid.
NOT_BLANK = "not_blank"  # the typed value must be non-NULL and non-empty
PRESENT = "present"  # the raw value must be non-NULL

_SQL_TYPES = {TEXT: "string", CODE: "string", INT: "int", DOUBLE: "double"}

# Columns that trace every row back to its source.
LINEAGE_TYPES = {
    "source_file": "string",
    "source_record_index": "int",
    "schema_drift": "boolean",
    "schema_drift_fields": "array<string>",
}


@dataclass(frozen=True)
class Field:
    """One output column: where it comes from and what it must satisfy."""

    name: str
    path: str
    kind: str = TEXT
    required: str | None = None

    @property
    def raw_name(self) -> str:
        return f"{self.name}_raw"

    @property
    def sql_type(self) -> str:
        return _SQL_TYPES[self.kind]


@dataclass(frozen=True)
class RecordSpec:
    """Fields in output order, which is also the order in which they are validated."""

    fields: tuple[Field, ...]
    business_key: tuple[str, ...]

    @property
    def record_keys(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(f.path.split(".")[0] for f in self.fields))

    @property
    def nested_keys(self) -> dict[str, tuple[str, ...]]:
        """Child keys of each nested object, by the key of that object."""
        nested: dict[str, tuple[str, ...]] = {}
        for f in self.fields:
            parent, _, child = f.path.partition(".")
            if child:
                nested[parent] = (*nested.get(parent, ()), child)
        return nested

    @property
    def struct_type(self) -> str:
        """SQL type that reads every path of a record in one pass, all as text.

        Nested objects become maps: they keep unknown keys, and a value of any
        other kind reads as NULL.
        """
        nested = self.nested_keys
        members = [
            f"`{key}`:{'map<string,string>' if key in nested else 'string'}"
            for key in self.record_keys
        ]
        return f"struct<{','.join(members)}>"

    @staticmethod
    def value_in(struct: str, field: Field) -> Column:
        """Raw text of ``field`` in a column read as :attr:`struct_type`."""
        parent, _, child = field.path.partition(".")
        value = F.col(f"{struct}.{parent}")
        return F.try_element_at(value, F.lit(child)) if child else value

    @property
    def processed_columns(self) -> tuple[str, ...]:
        return (*(f.name for f in self.fields), *LINEAGE_TYPES)

    @property
    def processed_types(self) -> dict[str, str]:
        return {**{f.name: f.sql_type for f in self.fields}, **LINEAGE_TYPES}


# Columns of a rejected row.
REJECTED_COLUMNS = (
    "source_file",
    "source_record_index",
    "rejection_reason",
    "raw_record",
    "schema_drift",
    "schema_drift_fields",
)

# Output columns, their source fields and the business key.
INDICATOR_OBSERVATIONS = RecordSpec(
    fields=(
        Field("indicator_id", "indicator.id", TEXT, NOT_BLANK),
        Field("indicator_name", "indicator.value"),
        Field("country_id", "country.id", CODE),
        Field("country_name", "country.value"),
        Field("country_iso3_code", "countryiso3code", CODE, NOT_BLANK),
        Field("observation_year", "date", INT, PRESENT),
        Field("observation_value", "value", DOUBLE, PRESENT),
        Field("unit", "unit"),
        Field("observation_status", "obs_status"),
        Field("decimal_places", "decimal", INT),
    ),
    business_key=("country_iso3_code", "indicator_id", "observation_year"),
)
