"""Schemas of the eleven delivered tables and of the frames between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_KINDS = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
_KINDS |= {f"array<{k}>": T.ArrayType(v) for k, v in list(_KINDS.items())}


def _schema(text: str) -> T.StructType:
    """`name type` pairs, comma separated; every column is nullable. Needs no session."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (pair.split() for pair in text.split(","))])


TABLES: dict[str, T.StructType] = {
    "source": _schema("source_id string, corpus string, distribution string, version string, publisher string, licence string, url string, directory string, manifest string"),
    "source_file": _schema("file_id string, source_id string, relative_path string, role string, sha256_declared string"),
    "record": _schema(
        "record_id string, source_id string, native_record_id string, header_file_id string, signal_file_id string, n_leads long, "
        "sampling_rate_hz double, n_samples long, duration_s double, units_declared string, units_are_declared boolean, age string, sex string"
    ),
    "lead": _schema("record_id string, position long, name_native string, name_canonical string, units_declared string, gain double, baseline long, adc_zero long"),
    "label": _schema("record_id string, vocabulary string, code string, source_field string, asserted_by string"),
    "label_propagated": _schema("record_id string, source_id string, vocabulary string, code string, source_field string, asserted_by string, via_record_id string"),
    "label_map": _schema(
        "from_vocabulary string, from_code string, to_vocabulary string, to_code string, term string, map_source string, map_sha256 string, "
        "map_retrieved string, map_licence string, map_publisher string"
    ),
    "patient": _schema("patient_id string, source_id string, native_patient_id string, record_id string, age double, sex string"),
    "quality": _schema("record_id string, missing_leads string, flat_leads string, saturated_leads string, n_nonfinite long, n_samples_read long, signal_digest string, holds boolean"),
    "signal_group": _schema("record_id string, signal_group_id string, group_size long, fingerprint string"),
    "duplicate_link": _schema("record_a string, record_b string, sieve string, score double, scope string"),
}

#: One row per parsed header, before it is shaped into tables.
HEADER = _schema(
    "record_id string, source_id string, native_record_id string, header_path string, signal_paths array<string>, n_leads long, sampling_rate_hz double, "
    "n_samples long, units_declared array<string>, units_are_declared boolean, all_millivolts boolean, age string, sex string, dx array<string>"
).add("leads", T.ArrayType(_schema("position long, name_native string, name_canonical string, units_declared string, gain double, baseline long, adc_zero long, format string, file string, initial_value long")))


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])


def shaped(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in their order and types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in TABLES[table]])
