"""Fixed values that must equal the source system's for identical results.

Everything in this module is data, written out plainly in its natural order.
"""

# --- Fixed values: event types (raw label, lower case -> code, display label, counts_as_event, is_safety_event)
EVENT_TYPES = [
    ("power up", "POWER_UP", "Power Up", True, False),
    ("driver change", "DRIVER_CHANGE", "Driver Change", True, False),
    ("unit (time/gps) update level", "HEARTBEAT", "Unit (Time/GPS) Update Level", False, False),
    ("impact", "IMPACT", "Impact", True, True),
    ("harsh braking", "HARSH_BRAKING", "Harsh Braking", True, True),
    ("harsh acceleration", "HARSH_ACCELERATION", "Harsh Acceleration", True, True),
    ("speeding", "SPEEDING", "Speeding", True, True),
    ("excess idle", "EXCESS_IDLE", "Excess Idle", True, True),
]

# --- Fixed values: safety event codes and the output column each one is counted in
SAFETY_COLUMNS = [
    ("IMPACT", "impacts"),
    ("HARSH_BRAKING", "harsh_braking"),
    ("HARSH_ACCELERATION", "harsh_acceleration"),
    ("SPEEDING", "speeding"),
    ("EXCESS_IDLE", "excess_idle"),
]

# --- Fixed values: header aliases (normalised header key -> column role)
HEADER_ALIASES = {
    "dateandtime": "event_time",
    "refno": "ref_no",
    "branchname": "branch",
    "txflagstrings": "event_type",
    "runhours": "run_hours",
    "drivername": "driver_first_name",
    "driversurname": "driver_surname",
}
REQUIRED_COLUMNS = list(HEADER_ALIASES.values())

# --- Fixed values: machine list header keys
MACHINE_LIST_KEYS = {"refno": "ref_no", "branchname": "branch", "machinetype": "machine_type"}
MACHINE_TYPES = ["Forklift", "Reach Truck", "PPT"]

# --- Fixed values: rejection reasons, in rule order (first failing rule wins)
REASONS = [
    "repeated_header_row",
    "wrong_column_count",
    "missing_required_value",
    "invalid_timestamp",
    "timestamp_after_file_delivery",
    "machine_not_in_machine_list",
    "unknown_event_type",
    "invalid_run_hours",
    "duplicate_row_in_file",
]

# --- Fixed values: plain words for rejection reasons on the dashboard
REASON_TEXT = {
    "duplicate_row_in_file": "duplicate rows",
    "repeated_header_row": "repeated header row",
    "wrong_column_count": "broken line (wrong column count)",
    "machine_not_in_machine_list": "unknown machine",
    "missing_required_value": "missing values",
    "invalid_timestamp": "invalid timestamp",
    "timestamp_after_file_delivery": "timestamp after delivery",
    "unknown_event_type": "unknown event type",
    "invalid_run_hours": "invalid run hours",
}

# --- Fixed values: names and patterns
NO_DRIVER = "No driver logged on"
DAILY_FILE_SUFFIX = "_DailyTelemetryData.csv"
DAILY_FILE_PATTERN = r"(?i)^\d{4}-\d{2}-\d{2}_DailyTelemetryData\.csv$"
FILE_DATE_PATTERN = r"(?i)(\d{4})-(\d{2})-(\d{2})_DailyTelemetryData\.csv$"
UNKNOWN_FILTER = "__unknown__"

# --- Fixed values: how filter values typed by users are read, first match wins (text, meaning)
MACHINE_TYPE_STARTS = [("fork", "Forklift"), ("reach", "Reach Truck"), ("ppt", "PPT"), ("pallet", "PPT")]
EVENT_TYPE_PARTS = [
    ("impact", "IMPACT"),
    ("brak", "HARSH_BRAKING"),
    ("accel", "HARSH_ACCELERATION"),
    ("speed", "SPEEDING"),
    ("idl", "EXCESS_IDLE"),
    ("power", "POWER_UP"),
    ("driver change", "DRIVER_CHANGE"),
    ("log", "DRIVER_CHANGE"),
]
ERROR_MESSAGE_MAX = 2000
LOCAL_ZONE = "Africa/Johannesburg"
