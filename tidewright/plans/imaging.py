"""Imaging metadata (DICOM JSON keyed by tag) to study, series and instance tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.scalars import dicom_value

# Attribute tags of the DICOM standard and the type each is read as.
STUDY = {"study_instance_uid": ("0020000D", "string"), "study_date": ("00080020", "string"), "study_time": ("00080030", "string"), "accession_number": ("00080050", "string"), "patient_name": ("00100010", "string"), "patient_id": ("00100020", "string"), "study_description": ("00081030", "string"), "number_of_series": ("00201206", "int"), "number_of_instances": ("00201208", "int")}
SERIES = {"study_instance_uid": ("0020000D", "string"), "series_instance_uid": ("0020000E", "string"), "modality": ("00080060", "string"), "series_number": ("00200011", "int"), "series_description": ("0008103E", "string"), "body_part": ("00180015", "string"), "number_of_instances": ("00201209", "int")}
INSTANCE = {"study_instance_uid": ("0020000D", "string"), "series_instance_uid": ("0020000E", "string"), "sop_instance_uid": ("00080018", "string"), "sop_class_uid": ("00080016", "string"), "instance_number": ("00200013", "int"), "rows": ("00280010", "int"), "columns": ("00280011", "int"), "slice_thickness": ("00180050", "double")}
MODALITIES = "00080061"


def _columns(raw: Column, spec: dict[str, tuple[str, str]]) -> list[Column]:
    return [dicom_value(raw, tag).try_cast(kind).alias(name) for name, (tag, kind) in spec.items()]


def studies(df: DataFrame, raw: str = "raw_json") -> DataFrame:
    many = F.from_json(F.get_json_object(raw, f"$.{MODALITIES}.Value"), "array<string>")
    return df.select(*_columns(F.col(raw), STUDY), many.alias("modalities_in_study"))


def series(df: DataFrame, parents: DataFrame | None = None, raw: str = "raw_json", parent_id: str = "study_id") -> DataFrame:
    """Series; a missing study id is filled from the row's parent column ``parent_id`` where there is one."""
    made = df.select(*[c for c in df.columns if c == parent_id], *_columns(F.col(raw), SERIES))
    return _filled(made, "study_instance_uid", parent_id, parents)


def instances(df: DataFrame, parents: DataFrame | None = None, raw: str = "raw_json", parent_id: str = "series_id") -> DataFrame:
    """Instances; missing series ids are filled from the parent column, study ids from the parent series."""
    made = df.select(*[c for c in df.columns if c == parent_id], *_columns(F.col(raw), INSTANCE))
    made = _filled(made, "series_instance_uid", parent_id, None)
    if parents is None:
        return made
    up = parents.select("series_instance_uid", F.col("study_instance_uid").alias("__study"))
    return made.join(up, "series_instance_uid", "left").withColumn("study_instance_uid", F.coalesce("study_instance_uid", "__study")).drop("__study").select(made.columns)


def _filled(df: DataFrame, column: str, parent_id: str, parents: DataFrame | None) -> DataFrame:
    if parent_id not in df.columns:
        return df
    out = df.withColumn(column, F.coalesce(column, parent_id)).drop(parent_id)
    return out if parents is None else out.join(parents.select(column).distinct(), column, "left_semi").select(out.columns)
