"""Row layouts and fixed domain values."""

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "binary": BinaryType(),
}


def layout(text: str) -> StructType:
    """'name type, ...' as a schema. Unlike fromDDL it needs no running session."""
    return StructType([StructField(*_field(part)) for part in text.split(",")])


def _field(part: str):
    name, kind = part.split()
    return name, _TYPES[kind]



# --------------------------------------------------------------------------
# Wire and table layouts, names as the producers write them.
# --------------------------------------------------------------------------

ACTIVITY_EVENT = layout(
    "Id string, Phone string, Date bigint, Month int, Year int, TimeStamp bigint, "
    "MembershipCode string, Event string, ReportCode string, EventName string, "
    "ReportName string, Data string"
)

ACTIVITY_TRANSACTION = layout(
    "Id string, Phone string, Date bigint, Month int, Year int, EventCode string, "
    "ReportCode string, ActivityId string, CampaignId string, RuleId string, "
    "CampaignName string, RuleName string, EventName string, ReportName string, "
    "MembershipCode string, Name string, Value int, TimeStamp bigint, Type string"
)

MEMBERSHIP_MONTHLY = layout(
    "phone string, membershipcode string, membershipname string, month int, year int, "
    "rank int, totalpoints bigint, timestamp bigint"
)

MEMBERSHIP_YEARLY = layout(
    "phone string, membershipcode string, membershipname string, year int, "
    "rank int, totalpoints bigint, timestamp bigint"
)

PROFILE = layout(
    "Id string, Phone string, Level int, TotalPoints bigint, Rank int, "
    "LastModified timestamp, MembershipCode string"
)

# With the columns that only matter to the stored table.
PROFILE_TABLE = StructType(
    PROFILE.fields
    + layout(
        "Package string, StartDate timestamp, CreatedAt timestamp, CreatedBy string, LastModifiedBy string"
    ).fields
)

DAILY_SUMMARY_REPORT = layout(
    "deviceimei string, date bigint, distance int, drivingtime int, month int, year int"
)

DEVICE_USER = layout("device_id string, Phone string")

LIVE_REPORT = layout(
    "id string, cell_id string, lat double, lng double, user_heading double, "
    "category_id string, expired_display_time bigint, road_link_id string, "
    "number_of_view int, number_of_confirm int, number_of_rejection int, "
    "minimization_hex_color string, geom_type string, lines string, status string, "
    "submit_time bigint, last_modified bigint, last_modified_by string"
)

USER_EVENT = layout("Event string, Datas string")

RULE_FLOW_METRICS = layout(
    "campaignid string, campaignname string, ruleid string, rulename string, date date, "
    "month int, year int, timestamp bigint, rule_sequence int, "
    "total_profiles_evaluated bigint, profiles_evaluated bigint, total_actions bigint, "
    "addpoint_actions bigint, points_awarded bigint, total_successful_actions bigint, "
    "total_points_awarded bigint, profiles_not_matched bigint"
)

ACTIVITY_SUMMARY_REPORT = layout(
    "Phone string, Date bigint, TotalSubmittedReport bigint, TotalApprovedReport bigint, "
    "TotalDrivingReport bigint, CreatedAt timestamp, CreatedBy string, "
    "LastModified timestamp, LastModifiedBy string"
)

# Tier codes and their display names.
TIER_NAMES = {
    "Level1": "Nhập môn",
    "Level2": "Ngôi sao đang lên",
    "Level3": "Uy tín",
    "Level4": "Nổi tiếng",
    "Level5": "Tối thượng",
}
DEFAULT_TIER = "Level1"

# Percentile tiers: a member above `low` and up to `high` of the ranked members.
PERCENTILE_TIERS = [
    (0.00, 0.01, "Level5"),
    (0.01, 0.05, "Level4"),
    (0.05, 0.10, "Level3"),
]
RISING_TIER = "Level2"
RISING_POINTS = 200

# "Not ranked yet", by the kind of row that is inserted.
UNRANKED_MEMBER = 9999
UNRANKED_YEARLY = 0
UNRANKED_PROFILE = 9999999
UNRANKED_DOCUMENT = 999999

SCORING_NAME = "AddPoint"
CREATE_USER_EVENT = "CreateUser"
BUSINESS_ZONE = "Asia/Ho_Chi_Minh"

# Event kinds counted by the daily event summary.
SUBMITTED, APPROVED, DRIVING = "SubmittedReport", "ApprovedReport", "DrivingReport"

# Live report states.
WAITING, VERIFIED = "WaitingVerification", "Verified"
VERIFY_AFTER_SECONDS = 300
RELEASE_BATCH = 100
RELEASE_TYPE = "LiveReportV2"

# Driving events.
DEVICE_PREFIX = "VML_"
MIN_DRIVING_METRES = 1000
DRIVING_EVENT = "DrivingDaily"
DRIVING_LABEL = "Lái xe hàng ngày"

# Level-change transactions.
LEVEL_RULE_ID = "8aaaa253-195f-4710-8d8f-23ce1e8c6f2d"
LEVEL_CAMPAIGN_NAME = "Cập nhật level"
LEVEL_RULE_NAME = "Upgrade level profile rule"
LEVEL_EVENT = "UpgradeLevel"
LEVEL_LABEL = "Nâng hạng cho người dùng"
MAX_LEVEL = 100
RECENT_PROFILE_MINUTES = 30

# Serving documents: key prefixes are deployment settings, these are defaults.
MONTHLY_PREFIX = "membership:monthly:"
YEARLY_PREFIX = "membership:yearly:"
PROFILE_PREFIX = "profile:"

# --------------------------------------------------------------------------
# Table layout: a directory per day; rows are sorted by member inside files.
# --------------------------------------------------------------------------

DAY_PARTITIONS = ("Year", "Month", "Date")
MONTH_PARTITIONS = ("year", "month")
YEAR_PARTITIONS = ("year",)
