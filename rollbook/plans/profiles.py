"""School profile sheets from key/value fields, and the published school environment."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import is_yes, like_ci, norm, recode, when_flag
from rollbook.operators import enrich, pivot_fields, right_master

# The field labels of the two screens.
PARENT_SCREEN, ENVIRONMENT_SCREEN = "8003", "8004"
PARENT_LABELS = [
    "Communication Policy Link", "Extra Curriculum Activities?", "Facebook Link", "FOR CHARTER SCHOOLS ONLY",
    "FOR DCPS SCHOOLS ONLY", "Parent Communication Policy?", "Parent Org - POC?", "Parent Org Link",
    "Parent Organization?", "Parent Representative POC?", "POC Email Address", "POC First Name", "POC Last Name",
    "POC Phone Number xxx-xxx-xxxx", "School Advisory Team Link", "School Advisory Team POC?",
    "School Advisory Team?", "School Program Information", "School Social Media Presence?", "Twitter Link"]
ENVIRONMENT_LABELS = [
    "AC hours", "BC hours", "Extra-curricular activities", "Is AC Free?", "Is AC on Sliding Scale?", "Is AC Paid?",
    "Is AC Voucher?", "Is After Care (AC) available?", "Is BC Free?", "Is BC on Sliding Scale?", "Is BC Paid?",
    "Is BC Voucher?", "Is Before Care (BC) available?", "List feeder schools", "List school programs",
    "Operating Hours for School", "Point of Pride #1", "Point of Pride #2", "Point of Pride #3",
    "School's closest bus line", "School's closest metro line"]
PARENT_FEED, ENVIRONMENT_FEED = "Parent engagement", "School environment"

CONTACT = {"first_name": "POC First Name", "last_name": "POC Last Name", "email": "POC Email Address",
           "phone": "POC Phone Number xxx-xxx-xxxx"}


def labelled_fields(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Field values of the two screens with their labels and feed type."""
    screens = [PARENT_SCREEN, ENVIRONMENT_SCREEN]
    rows = enrich(values.where(F.col("screen_number").isin(screens)), [
        (dictionary.where(F.col("screen_number").isin(screens)), ["district", "screen_number", "field_number"],
         {"field_label": "field_label"})])
    feed = F.when(F.col("screen_number") == PARENT_SCREEN, PARENT_FEED).otherwise(ENVIRONMENT_FEED)
    return rows.withColumn("feed_type", feed)


def profile_sheets(values: DataFrame, dictionary: DataFrame,
                   screens: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """One wide sheet per screen: a row per district and building, a column per field label."""
    screens = screens or {PARENT_SCREEN: PARENT_LABELS, ENVIRONMENT_SCREEN: ENVIRONMENT_LABELS}
    fields = labelled_fields(values, dictionary)
    return {screen: pivot_fields(fields.where(F.col("screen_number") == screen), ["district", "building"],
                                 "field_label", "field_value", labels) for screen, labels in screens.items()}


def _field(name: str) -> Column:
    return F.col(f"`{name}`")


def school_profiles(parent: DataFrame, master: DataFrame) -> DataFrame:
    """Every school of the master list with its parent-engagement fields, contacts split by school kind."""
    master = master.withColumn("school_code", recode("school_code", {"141": "9000"}))
    rows = right_master(parent, master, {"school_code": "building"},
                        {"lea_code": "district", **{name: _field(name) for name in PARENT_LABELS}})
    charter, dcps = is_yes(_field("FOR CHARTER SCHOOLS ONLY")), is_yes(_field("FOR DCPS SCHOOLS ONLY"))
    plain = {"social_media": "School Social Media Presence?", "twitter_link": "Twitter Link",
             "facebook_link": "Facebook Link", "parent_org": "Parent Organization?",
             "parent_org_link": "Parent Org Link", "parent_org_poc": "Parent Org - POC?",
             **{f"poc_{n}": source for n, source in CONTACT.items()},
             "communication_policy": "Parent Communication Policy?",
             "communication_policy_link": "Communication Policy Link"}
    for_charter = {"representative": "Parent Representative POC?", **CONTACT}
    for_dcps = {"advisory_team": "School Advisory Team?", "advisory_link": "School Advisory Team Link",
                "advisory_poc": "School Advisory Team POC?", **CONTACT}
    care = F.when(norm("after_care_available") == "x", "Y").otherwise("N")

    def mentions(word: str) -> Column:
        return F.when(F.coalesce(like_ci("care_scale_or_voucher", f"%{word}%"), F.lit(False)), "Y").otherwise("N")
    return rows.select(
        "school_code", "lea_code",
        *[_field(source).alias(n) for n, source in plain.items()],
        *[when_flag(charter, _field(source)).alias(f"charter_{n}") for n, source in for_charter.items()],
        *[when_flag(dcps, _field(source)).alias(f"dcps_{n}") for n, source in for_dcps.items()],
        F.col("school_hours").alias("operating_hours"), "point_of_pride_1", "point_of_pride_2", "point_of_pride_3",
        F.lit("").alias("feeder_schools"), care.alias("care_available"),
        F.col("before_after_hours").alias("care_hours"), F.col("care_is_free").alias("care_paid"),
        mentions("sliding").alias("care_sliding"), mentions("voucher").alias("care_voucher"),
        F.lit("").alias("care_free"), F.col("metro_bus").alias("bus_line"), F.col("metro_rail").alias("metro_line"),
        F.col("grades_served").alias("school_programs"),
        F.col("additional_enrichments").alias("extra_curricular")).distinct()


def school_environment(profiles: DataFrame) -> DataFrame:
    """Publish rules: a value shows only where its own flag says yes. Names without a yes are NULL, not blank."""
    social, org, poc = is_yes("social_media"), is_yes("parent_org"), is_yes("parent_org_poc")
    policy, representative = is_yes("communication_policy"), is_yes("charter_representative")
    team, team_link, team_poc = (is_yes(f"dcps_advisory_{c}") for c in ("team", "link", "poc"))
    care = is_yes("care_available")

    def full_name(kind: str) -> Column:
        return F.concat(F.col(f"{kind}_first_name"), F.col(f"{kind}_last_name"))
    columns: dict[str, Column | str] = {
        "social_media": F.when(social, "Y").otherwise("N"),
        "twitter_link": when_flag(social, "twitter_link"),
        "facebook_link": when_flag(social, "facebook_link"),
        "parent_org": F.when(org, "Y").otherwise("N"),
        "parent_org_link": when_flag(org, "parent_org_link"),
        "parent_org_poc": when_flag(poc, "parent_org_poc", "N"),
        "poc_first_name": when_flag(poc, full_name("poc"), None),
        "poc_last_name": when_flag(poc, full_name("poc"), None),
        "poc_email": when_flag(poc, "poc_email"), "poc_phone": when_flag(poc, "poc_phone"),
        "communication_policy": when_flag(policy, "communication_policy", "N"),
        "communication_policy_link": when_flag(policy, "communication_policy_link"),
        "charter_representative": when_flag(representative, "charter_representative"),
        "charter_first_name": when_flag(representative, full_name("charter")),
        "charter_last_name": when_flag(representative, full_name("charter")),
        "charter_phone": when_flag(representative, "charter_phone"),
        "advisory_team": when_flag(team, "dcps_advisory_team"),
        "advisory_link": when_flag(team_link, "dcps_advisory_link"),
        "advisory_poc": when_flag(team_poc, "dcps_advisory_poc", "N"),
        "dcps_first_name": when_flag(team_poc, full_name("dcps"), None),
        "dcps_last_name": when_flag(team_poc, full_name("dcps"), None),
        "dcps_email": when_flag(team_poc, "dcps_email"), "dcps_phone": when_flag(team_poc, "dcps_phone")}
    plain = ["operating_hours", "point_of_pride_1", "point_of_pride_2", "point_of_pride_3", "feeder_schools",
             "care_available"]
    cared = {c: when_flag(care, c) for c in ("care_hours", "care_paid", "care_sliding", "care_voucher", "care_free")}
    return profiles.select("school_code", "lea_code", *[c.alias(n) for n, c in columns.items()], *plain,
                           *[c.alias(n) for n, c in cared.items()], "bus_line", "metro_line", "school_programs",
                           "extra_curricular").distinct()
