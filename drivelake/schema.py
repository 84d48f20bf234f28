"""Canonical Silver schema: the declared field list and its Spark types.

The field list is data, not code: it can be loaded from a YAML document with
the same layout as the canonical schema file (``columns:`` list of
``{name, source_column, datatype, nullable[, transformation]}``) or built by
``drivestats_fields()`` from the rule "five core fields, then a normalized
int and a raw bigint per SMART attribute".
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Mapping

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the canonical schema for identical results)
# ---------------------------------------------------------------------------
# SMART attribute numbers, in schema order.
SMART_ATTRIBUTES = (
    1, 2, 3, 4, 5, 7, 8, 9, 10, 11, 12, 13, 15, 183, 184, 187, 188, 189, 190,
    191, 192, 193, 194, 195, 196, 197, 198, 199, 200, 201, 223, 225, 240, 241,
    242, 250, 251, 252, 254, 255,
)
# Core fields: (canonical name, source column, datatype, nullable).
CORE_FIELDS = (
    ("snapshot_date", "date", "Date", False),
    ("drive_serial_number", "serial_number", "string", False),
    ("drive_model", "model", "string", False),
    ("capacity_bytes", "capacity_bytes", "bigint", True),
    ("failure_flag", "failure", "int", False),
)
# Operational metadata columns tolerated next to the canonical ones.
OPERATIONAL_COLUMNS = frozenset({
    "release_id", "source_file", "ingested_at", "bronze_ingested_at",
    "processing_run_id", "silver_processed_at",
})
# Business observation key of a Silver row.
BUSINESS_KEY = ("release_id", "snapshot_date", "drive_serial_number")
# Fields whose text is trimmed and blank-mapped to NULL before use.
TRIMMED_FIELDS = frozenset({"drive_serial_number", "drive_model"})
# Parse rules by the transformation that a schema declares, and by source column where it declares none.
PARSE_BY_TRANSFORMATION = {"to_date": "date", "to_timestamp": "timestamp"}
PARSE_BY_SOURCE = {"date": "date"}
# ---------------------------------------------------------------------------

_BASIC_TYPES = [kind() for kind in (T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.DoubleType,
                                    T.FloatType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)]
# Spark names a type twice (``long`` and ``bigint``); schema documents also say ``bool``.
_BY_NAME = {name: t for t in _BASIC_TYPES for name in (t.typeName(), t.simpleString())} | {"bool": T.BooleanType()}


def normalize_type(datatype: str | None) -> str | None:
    """The simple string of a datatype (``long`` -> ``bigint``); one that is none of Spark's basic names stays, in lower case."""
    if datatype is None:
        return None
    name = str(datatype).strip().lower()
    return _BY_NAME[name].simpleString() if name in _BY_NAME else name


def spark_type(datatype: str) -> T.DataType:
    name = normalize_type(datatype)
    return _BY_NAME[name] if name in _BY_NAME else T._parse_datatype_string(name)


@dataclass(frozen=True)
class Field:
    name: str
    source_column: str
    datatype: str
    nullable: bool = True
    transformation: str | None = None

    @property
    def type_name(self) -> str:
        return normalize_type(self.datatype)

    @property
    def spark_type(self) -> T.DataType:
        return spark_type(self.datatype)

    @property
    def parse(self) -> str:
        """How source text becomes a value: ``text`` (trimmed, blank is NULL), ``date``,
        ``timestamp`` or ``cast``.  Projection, validity and oracle SQL all follow it."""
        if self.name in TRIMMED_FIELDS:
            return "text"
        declared = PARSE_BY_TRANSFORMATION.get(self.transformation or "")
        return declared or PARSE_BY_SOURCE.get(self.source_column, "cast")


def drivestats_fields() -> list[Field]:
    """The 85 canonical fields: 5 core, then 40 SMART attributes x (int, bigint)."""
    fields = [Field(*f) for f in CORE_FIELDS]
    for n in SMART_ATTRIBUTES:
        fields.append(Field(f"smart_{n}_normalized", f"smart_{n}_normalized", "int", True))
        fields.append(Field(f"smart_{n}_raw", f"smart_{n}_raw", "bigint", True))
    return fields


def fields_from_mapping(columns: Iterable[Mapping]) -> list[Field]:
    out = []
    for c in columns:
        out.append(Field(
            name=c["name"],
            source_column=c.get("source_column", c["name"]),
            datatype=c["datatype"],
            nullable=bool(c.get("nullable", True)),
            transformation=c.get("transformation"),
        ))
    if not out:
        raise ValueError("Canonical schema contains no columns.")
    return out


def load_fields(text: str) -> list[Field]:
    """Parse a YAML schema document (``columns:`` list) into fields."""
    try:
        import yaml
    except ImportError as exc:  # pragma: no cover - yaml is optional
        raise RuntimeError("PyYAML is needed to load a YAML schema") from exc
    doc = yaml.safe_load(text) or {}
    return fields_from_mapping(doc.get("columns", []))
