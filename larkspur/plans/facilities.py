"""Health facilities: parse, validate, mask, score, route."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.text import masked_id
from larkspur.operators import routing
from larkspur.operators.rows import map_values
from larkspur.session import cut
from larkspur.sources import readers

# Column names of the facility files.
FIELDS = (
    "facility_id", "facility_name", "city", "state", "zip_code", "county", "hospital_type", "ownership",
    "emergency_services", "overall_rating", "readmission_comparison", "patient_experience_comparison",
    "mortality_comparison",
)
COMPARISONS = ("readmission_comparison", "mortality_comparison", "patient_experience_comparison")

# Rating tiers, comparison scores, alert texts.
TIERS = {"5": "A", "4": "B", "3": "C", "2": "D", "1": "F"}
ABOVE = "Above the national average"
SCORES = {ABOVE: 2, "Same as the national average": 1, "Below the national average": 0, "Not Available": 1}
ALERT_REASON = "High readmission AND high mortality vs national average"
ALERT_SEVERITY = "HIGH"
VERSION = "v1.0"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Facility lines by header name; address columns that some files add are ignored."""
    return readers.delimited(spark, path, FIELDS)


def tidy(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.trim(c).alias(c) for c in raw.columns])


def validate(records: DataFrame) -> DataFrame:
    state = F.coalesce("state", F.lit(""))
    blank = lambda name: F.coalesce(name, F.lit("")) == ""
    return routing.with_errors(
        records,
        [
            ("missing_facility_id", blank("facility_id")),
            (F.concat(F.lit("invalid_state:"), state), ~state.rlike(r"^\p{L}{2}$")),
            ("missing_hospital_type", blank("hospital_type")),
        ],
    )


def score(records: DataFrame, salt: str) -> DataFrame:
    """Masked id, quality tier, risk from 0 to 100, the high-risk flag."""
    points = sum(F.coalesce(map_values(c, SCORES, 1), F.lit(1)) for c in COMPARISONS)
    return records.withColumns(
        {
            "facility_id_masked": masked_id("facility_id", salt),
            "pii_masked": F.lit(True),
            "quality_tier": map_values("overall_rating", TIERS, "UNKNOWN"),
            "risk_score": F.round((6 - points) / 6 * 100, 2),
            "is_high_risk": F.coalesce(
                (F.col("readmission_comparison") == ABOVE) & (F.col("mortality_comparison") == ABOVE), F.lit(False)
            ),
            "has_emergency": F.coalesce(F.col("emergency_services") == "Yes", F.lit(False)),
        }
    )


def routes(records: DataFrame, salt: str, at) -> dict[str, DataFrame]:
    """The three outputs: curated records, alerts, dead letters. The checked records are stored, so they are parsed once."""
    now = F.lit(at).cast("timestamp")
    stamped = records.withColumns({"ingested_at": now, "pipeline_version": F.lit(VERSION)})
    valid, invalid = routing.split(cut(validate(stamped)))
    scored = score(valid, salt).withColumn("enriched_at", now)
    alerts = scored.filter("is_high_risk").withColumns(
        {"alert_reason": F.lit(ALERT_REASON), "alert_severity": F.lit(ALERT_SEVERITY), "alert_created_at": now}
    )
    return {"curated": scored.filter("NOT is_high_risk"), "alerts": alerts, "dead_letter": invalid}


def run(records: DataFrame, folder: str, salt: str, at) -> dict[str, str]:
    """Write each output as JSON lines; returns their folders."""
    paths = {}
    for name, df in routes(records, salt, at).items():
        paths[name] = f"{folder}/{name}"
        df.write.mode("overwrite").json(paths[name])
    return paths
