"""Logical table names, their schemas and where they are read from."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Columns that are read, per table of the long-event schema.
LONG_SCHEMAS = {
    "patients": "subject_id BIGINT, gender STRING, dob TIMESTAMP, dod TIMESTAMP",
    "admissions": (
        "subject_id BIGINT, hadm_id BIGINT, admittime TIMESTAMP, deathtime TIMESTAMP, insurance STRING,"
        " language STRING, ethnicity STRING"
    ),
    "icustays": "icustay_id BIGINT, hadm_id BIGINT, first_careunit STRING, intime TIMESTAMP, outtime TIMESTAMP",
    "chartevents": "icustay_id BIGINT, charttime TIMESTAMP, itemid INT, value STRING, error INT",
    "labevents": "hadm_id BIGINT, itemid INT, value STRING",
    "inputevents_mv": "icustay_id BIGINT, itemid INT, statusdescription STRING",
    "d_items": "itemid INT, label STRING",
    "diagnoses_icd": "hadm_id BIGINT, icd9_code STRING",
}

# Columns that are read, per table of the wide-vitals schema.
WIDE_SCHEMAS = {
    "patient": (
        "patientunitstayid BIGINT, patienthealthsystemstayid BIGINT, gender STRING, age STRING,"
        " unitdischargestatus STRING, unittype STRING, unitdischargeoffset INT, ethnicity STRING,"
        " hospitaladmitsource STRING, admissionheight DOUBLE, admissionweight DOUBLE, hospitalid BIGINT,"
        " wardid BIGINT, apacheadmissiondx STRING"
    ),
    "vitalperiodic": (
        "patientunitstayid BIGINT, observationoffset INT, systemicsystolic DOUBLE, systemicdiastolic DOUBLE,"
        " systemicmean DOUBLE, heartrate DOUBLE, respiration DOUBLE, temperature DOUBLE, sao2 DOUBLE,"
        " cvp DOUBLE, etco2 DOUBLE"
    ),
    "nursecharting": (
        "patientunitstayid BIGINT, nursingchartoffset INT, nursingchartcelltypevalname STRING,"
        " nursingchartvalue STRING"
    ),
    "lab": "patientunitstayid BIGINT, labname STRING, labresult DOUBLE",
    "medication": "patientunitstayid BIGINT, drugname STRING",
    "diagnosis": "patientunitstayid BIGINT, diagnosisstring STRING",
}


@dataclass
class Catalog:
    """Reads tables by logical name from a folder, a database or given frames.

    `locations` maps a logical name to another file or table name. Files are read
    with their declared schema, so nothing is inferred.
    """

    spark: SparkSession
    root: str | None = None
    database: str | None = None
    format: str = "parquet"
    locations: dict[str, str] = field(default_factory=dict)
    frames: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name in self.frames:
            return self.frames[name]
        place = self.locations.get(name, name)
        if self.root is not None:
            schema = {**LONG_SCHEMAS, **WIDE_SCHEMAS}.get(name)
            reader = self.spark.read.format(self.format)
            if self.format == "csv":
                reader = reader.option("header", True)
            if schema is not None:
                reader = reader.schema(schema)
            return reader.load(f"{self.root}/{place}")
        return self.spark.table(f"{self.database}.{place}" if self.database else place)

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)
