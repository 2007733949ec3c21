"""Display names of published columns."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Column titles the report readers expect.
HEADERS: dict[str, dict[str, str]] = {
    "swd_sheet": {
        "studentcode": "Studentcode", "first_name": "First Name", "last_name": "Last Name",
        "date_of_birth": "Date of Birth", "current_iep_start_date": "Current IEP Start Date",
        "current_iep_end_date": "Current IEP End Date", "current_iep_amendment_date": "Current IEP Amendment Date",
        "current_primary_disability": "current Primary disability",
        "current_hours": "Current Hours of Specialized instruction", "current_swd_level": "current SWD Level",
        "highest_swd_level": "Highest SWD Level", "accommodation_504": "504AccommodationSIS", "lea_code": "LEACode"},
    "cohort_report": {
        "lea_name": "LEA Name", "lea_code": "LEA_Code", "school_name": "School Name", "school_code": "School_Code",
        "usi": "USI", "first_name": "Student First Name", "last_name": "Student Last Name",
        "date_of_birth": "Student Date of BIrth", "acgr_universe": "ACGR_Universe",
        "enrollment_indicator": "Enrollment_Indicator", "exit_indicator": "Exit_Indicator",
        "lea_indicator": "cohort Responsible lea indicator", "lea_detail": "cohort Responsible Lea Detail",
        "school_indicator": "cohort responsible School indicator",
        "school_detail": "cohort responsible school detail"},
    "sped_current": {
        "dedicated_aide": "Dedicated Aide", "aide_hours": "Dedicated Aide Hours",
        "school_hours_per_week": "School Hours/Week", "outside_minutes": "Mins. Outside Class",
        "inside_minutes": "Mins. Inside Class", "total_minutes": "Total Mins",
        "outside_hours": "Hours. Outside Class", "inside_hours": "Hours. Inside Class", "total_hours": "Total Hours",
        "outside_percent": "% Outside Class", "inside_percent": "% inside Class", "lre": "LRE",
        "total_hours_with_aide": "Total Hours + Dedicated Aide", "sped_level": "Special Education Level",
        "eligibility_status": "Special Ed Eligibility Status"},
}


def with_headers(df: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """Rename columns for readers; unlisted columns keep their names."""
    return df.withColumnsRenamed(dict(headers))
