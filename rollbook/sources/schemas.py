"""Column names and types of the source tables, their code columns, and the columns of the targets."""
from __future__ import annotations

SOURCES: dict[str, str] = {
    "roster": """usi string, source_local_id string, last_name string, first_name string, date_of_birth date,
        gender_code string, enrollment_grade_level_code string, race_ethnicity_code string,
        race_ethnicity_desc string, enrollment_responsible_lea_id string, enrollment_responsible_lea_name string,
        enrollment_attending_school_id string, enrollment_attending_school_name string,
        enrollment_stage5_date date, enrollment_entry_code string, enrollment_exit_date date,
        enrollment_exit_code string, enrollment_stage string, enrollment_status string, custom1 string,
        lep_indicator string, new_to_us string, native_language_code string, accommodation_504 string""",
    "audit_records": """usi string, local_id string, last_name string, first_name string, date_of_birth date,
        gender string, enrollment_grade_level_indicator string, race_ethnicity string, lea_code string,
        lea_name string, school_code string, school_name string, enrollment_date date, enrollment_code string,
        exit_date date, exit_code string, lep_indicator string""",
    "sped_students": "id bigint, studentcode string, district_code string",
    "sped_events": """id bigint, studentid bigint, district_code string, eventtype string, eventdate timestamp_ntz,
        begindate timestamp_ntz, enddate timestamp_ntz, datecreated timestamp_ntz, parenteventid bigint,
        sourcecustomername string, primary_disability string, inactive string""",
    "iep_amendments": """studentcode string, studentid bigint, lea string, eventid bigint, iep_type string,
        amendment_category string""",
    "service_history": """id bigint, studentid bigint, district_code string, eventid bigint, serviceid string,
        service_text string, time_spent string, time_units string, time_period string, num_sessions string,
        location string, inactive string, begin_date date, end_date date, provider_id string,
        consultation string, extended_school_year string""",
    "service_types": "serviceid string, exclude_from_618 string",
    "sped_schools": """schoolcode string, district_code string, name string, category bigint, units_per_day string,
        inactive string""",
    "school_category": "id bigint, school_type string, description string",
    "student_custom_data": "studentid bigint, district_code string, eventid bigint, name string, value string",
    "student_race": "usi string, raceethnicity string, race_fin string",
    "primary_disabilities": "id string, name string, code_618 string, district_code string, inactive string",
    "district_by_lea": "district_code string",
    "environment_map": "seds_environment string, childcount_environment string",
    "unified_errors": "studentcode string, district_code string, error_type string, cc_exclusion string",
    "lea_directory": """lea_id string, lea_name string, school_id string, school_name string,
        valid_for_enrollment string""",
    "level_history": "usi string, special_education_level string, school_year string",
    "student_records": """usi string, lea_code string, lea_name string, school_code string, school_name string,
        current_enrolled_grade string, first_name string, last_name string, date_of_birth date,
        student_current_status string, enrollment_status string, enrollment_status_final string,
        stage5_entry_date date, stage5_entry_code string, stage5_exit_code string, stage5_exit_date date""",
    "degree_schools": "school_id string, lea_id string, degree_granting string, non_granting string",
    "exit_enrollments": """usi string, leaid string, schoolid string, enrollment_exit_code string,
        enrollment_exit_date date, exitstatusid bigint, workflowid bigint, school_year string""",
    "exit_status": "exitstatusid bigint, display_status string",
    "workflow_status": "statusid bigint, status string",
    "shift_leas": "lea_code string, school_year string",
    "indicators": "usi string, tanf string, snap string, cfsa string, housing_status string",
    "date_table": "date date",
    "building_fields": """district string, building string, screen_number string, field_number string,
        field_value string""",
    "field_dictionary": "district string, screen_number string, field_number string, field_label string",
    "profile_master": """school_code string, school_hours string, point_of_pride_1 string,
        point_of_pride_2 string, point_of_pride_3 string, after_care_available string, before_after_hours string,
        care_is_free string, care_scale_or_voucher string, metro_bus string, metro_rail string,
        grades_served string, additional_enrichments string""",
}
SOURCES["roster_history"] = SOURCES["roster"] + ", logdate timestamp_ntz"

# Key and code columns, folded when a table is landed so that plans compare them by plain equality.
CODES: dict[str, list[str]] = {
    "roster": ["usi", "enrollment_responsible_lea_id", "enrollment_attending_school_id"],
    "roster_history": ["usi", "enrollment_responsible_lea_id", "enrollment_attending_school_id"],
    "audit_records": ["usi", "lea_code", "school_code"],
    "sped_students": ["studentcode", "district_code"],
    "sped_events": ["district_code", "eventtype", "inactive"],
    "iep_amendments": ["studentcode", "lea"],
    "service_history": ["district_code", "serviceid", "location", "inactive"],
    "service_types": ["serviceid"],
    "sped_schools": ["schoolcode", "district_code", "inactive"],
    "student_custom_data": ["district_code"],
    "student_race": ["usi"],
    "primary_disabilities": ["id", "district_code", "inactive"],
    "district_by_lea": ["district_code"],
    "unified_errors": ["studentcode", "district_code"],
    "lea_directory": ["lea_id", "school_id", "valid_for_enrollment"],
    "level_history": ["usi"],
    "student_records": ["usi", "lea_code", "school_code", "current_enrolled_grade", "stage5_exit_code"],
    "degree_schools": ["school_id", "lea_id"],
    "exit_enrollments": ["usi", "leaid", "schoolid", "enrollment_exit_code", "school_year"],
    "shift_leas": ["lea_code", "school_year"],
    "indicators": ["usi"],
    "building_fields": ["district", "building", "screen_number", "field_number"],
    "field_dictionary": ["district", "screen_number", "field_number"],
    "profile_master": ["school_code"],
}

#: Folded companions of texts that are published as they came but filtered by code, added when a source is landed.
COMPANIONS: dict[str, dict[str, str]] = {
    "roster": {"status_code": "enrollment_status", "stage_code": "enrollment_stage"},
    "roster_history": {"status_code": "enrollment_status", "stage_code": "enrollment_stage"},
    "unified_errors": {"error_code": "error_type", "exclusion_code": "cc_exclusion"},
}

#: Partition column of a landed history: the day of its date column.
DAY = "logday"

TARGETS: dict[str, str] = {
    "enrollments": """usi string, source_local_id string, last_name string, first_name string, dob date,
        gender string, grade string, race_eth string, lea_code string, lea_name string, school_code string,
        school_name string, entry_date date, entry_code string, exit_date date, exit_code string,
        enrollment_stage string, enrollment_status string, lep_indicator string, new_to_us string,
        native_language_code string, category string""",
    "swd_sheet": """studentcode string, first_name string, last_name string, date_of_birth date,
        current_iep_start_date string, current_iep_end_date string, current_iep_amendment_date string,
        current_primary_disability string, current_hours decimal(18,2), current_swd_level string,
        highest_swd_level string, accommodation_504 string, lea_code string""",
    "sped_current": """studentcode string, district_code string, school_code string, studentid bigint, iep_id bigint,
        iep_created timestamp_ntz, iep_event_date date, iep_begin_date date, iep_end_date date,
        primary_disability string, elig_id bigint, elig_created timestamp_ntz, elig_event_date date,
        elig_begin_date date, elig_end_date date, dated_id bigint, dated_created timestamp_ntz,
        dated_event_date date, dated_begin_date date, dated_end_date date, school_name string,
        units_per_day decimal(10,2), lea_type string, school_type string, lea_name string, iep_disability string,
        stars_id int, referral_date int, eligibility_status string, outside_minutes decimal(18,6),
        inside_minutes decimal(18,6), aide_minutes decimal(18,6), race_code string, race_description string,
        primary_disability_name string, code_618 string, dedicated_aide string, aide_total_minutes decimal(18,4),
        aide_hours decimal(18,2), school_hours_per_week decimal(12,2), total_minutes decimal(19,4),
        outside_hours decimal(18,2), inside_hours decimal(18,2), total_hours decimal(18,2),
        outside_percent decimal(18,0), inside_percent decimal(18,0), lre string,
        total_hours_with_aide decimal(18,2), sped_level string, seds_environment string,
        user_updated_environment int, user_updated_environment_date int, child_count_environment string,
        child_count_environment_source string, flag string, ude string, snapshot_date timestamp_ntz""",
    "cohort_report": """lea_name string, lea_code string, school_name string, school_code string, usi string,
        first_name string, last_name string, date_of_birth date, acgr_universe string,
        enrollment_indicator string, exit_indicator string, lea_indicator string, lea_detail string,
        school_indicator string, school_detail string""",
    "cohort_data": """usi string, lea_code string, lea_name string, school_code string, school_name string, grade string,
        first_name string, last_name string, date_of_birth date, student_current_status string,
        enrollment_status string, enrollment_status_final string, stage5_entry_date date, stage5_entry_code string,
        stage5_exit_code string, stage5_exit_date date, current_school_code string, current_lea_code string,
        current_entry_date date, ex_mn_exit_code string, ex_mn_exit_date string, ex_mn_display_status string,
        enrollment_indicator string, exit_indicator string, lea_detail string, lea_indicator string,
        school_detail string, school_indicator string, acgr_universe string""",
    "overage_dates": "date date, g9 date, g10 date, g11 date, g12 date",
    "school_profiles": """school_code string, lea_code string, social_media string, twitter_link string,
        facebook_link string, parent_org string, parent_org_link string, parent_org_poc string,
        poc_first_name string, poc_last_name string, poc_email string, poc_phone string,
        communication_policy string, communication_policy_link string, charter_representative string,
        charter_first_name string, charter_last_name string, charter_email string, charter_phone string,
        dcps_advisory_team string, dcps_advisory_link string, dcps_advisory_poc string, dcps_first_name string,
        dcps_last_name string, dcps_email string, dcps_phone string, operating_hours string,
        point_of_pride_1 string, point_of_pride_2 string, point_of_pride_3 string, feeder_schools string,
        care_available string, care_hours string, care_paid string, care_sliding string, care_voucher string,
        care_free string, bus_line string, metro_line string, school_programs string, extra_curricular string""",
    "school_environment": """school_code string, lea_code string, social_media string, twitter_link string,
        facebook_link string, parent_org string, parent_org_link string, parent_org_poc string,
        poc_first_name string, poc_last_name string, poc_email string, poc_phone string,
        communication_policy string, communication_policy_link string, charter_representative string,
        charter_first_name string, charter_last_name string, charter_phone string, advisory_team string,
        advisory_link string, advisory_poc string, dcps_first_name string, dcps_last_name string,
        dcps_email string, dcps_phone string, operating_hours string, point_of_pride_1 string,
        point_of_pride_2 string, point_of_pride_3 string, feeder_schools string, care_available string,
        care_hours string, care_paid string, care_sliding string, care_voucher string, care_free string,
        bus_line string, metro_line string, school_programs string, extra_curricular string""",
    "at_risk": """usi string, lea_code string, school_code string, grade string, dob date, overage string,
        tanf string, snap string, cfsa string, housing_status string, at_risk string,
        last_refreshed timestamp_ntz""",
}
