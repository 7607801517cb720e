"""Reference tables: thresholds, sensor templates, escalation and metric rules, signal defaults."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Thresholds per sensor type and subtype, in the columns of THRESHOLD_SCHEMA.
THRESHOLDS = [
    ("temperature", "bearing_temp", 30.0, 85.0, 25.0, 100.0, 15.0, 120.0, "celsius"),
    ("temperature", "exhaust_temp", 200.0, 450.0, 180.0, 500.0, 150.0, 600.0, "celsius"),
    ("temperature", "ambient_temp", -10.0, 45.0, -15.0, 50.0, -25.0, 60.0, "celsius"),
    ("pressure", "inlet_pressure", 50.0, 200.0, 40.0, 250.0, 20.0, 350.0, "bar"),
    ("pressure", "outlet_pressure", 20.0, 150.0, 15.0, 180.0, 5.0, 250.0, "bar"),
    ("pressure", "differential", 5.0, 50.0, 3.0, 60.0, 1.0, 80.0, "bar"),
    ("vibration", "axial_vibration", 0.0, 10.0, 0.0, 15.0, 0.0, 25.0, "mm_s"),
    ("vibration", "radial_vibration", 0.0, 12.0, 0.0, 18.0, 0.0, 30.0, "mm_s"),
    ("vibration", "velocity_vibration", 0.0, 8.0, 0.0, 12.0, 0.0, 20.0, "mm_s"),
    ("flow_rate", "flow_rate", 500.0, 8000.0, 200.0, 9000.0, 100.0, 10000.0, "m3_h"),
    ("flow_rate", "flow_velocity", 1.0, 15.0, 0.5, 18.0, 0.2, 25.0, "m_s"),
    ("flow_rate", "mass_flow", 100.0, 5000.0, 50.0, 6000.0, 20.0, 8000.0, "kg_s"),
]
THRESHOLD_SCHEMA = (
    "sensor_type string, subtype string, min_normal double, max_normal double, "
    "warning_low double, warning_high double, critical_low double, critical_high double, "
    "unit string"
)

# Sensors fitted to each piece of process equipment, and which types get them.
SENSOR_TEMPLATES = [
    ("TEMP-01", "temperature", "celsius", 0.0, 300.0),
    ("PRES-01", "pressure", "bar", 0.0, 500.0),
    ("VIBR-01", "vibration", "mm_s", 0.0, 50.0),
    ("FLOW-01", "flow_rate", "m3_h", 0.0, 10000.0),
    ("TEMP-02", "temperature", "celsius", 0.0, 300.0),
]
FITTED_TYPES = ("pump", "compressor", "turbine", "generator", "separator", "heater")

# Escalation actions per severity, in the columns of ESCALATION_SCHEMA.
ESCALATION_RULES = [
    (1, "INFO", "log", None, 0, 1, True),
    (2, "WARNING", "webhook", "warning-endpoint", 0, 3, True),
    (3, "WARNING", "email", "operations-mailbox", 60, 2, True),
    (4, "CRITICAL", "webhook", "critical-endpoint", 0, 3, True),
    (5, "CRITICAL", "pagerduty", "pager-endpoint", 0, 5, True),
    (6, "CRITICAL", "sms", "operations-phone", 30, 3, True),
]
ESCALATION_SCHEMA = (
    "rule_id int, severity string, action_type string, target_endpoint string, "
    "delay_seconds int, max_retries int, enabled boolean"
)

# Setpoint, seasonal amplitude and period in hours per sensor type and subtype.
SIGNALS = [
    ("temperature", "discharge_temp", 160.0, 5.0, 24.0),
    ("pressure", "discharge_pressure", 45.0, 2.0, 24.0),
    ("vibration", "bearing_vibration", 4.5, 0.0, 24.0),
    ("temperature", "oil_temp", 75.0, 3.0, 24.0),
    ("pressure", "oil_pressure", 5.5, 0.0, 24.0),
    ("pressure", "vessel_pressure", 28.0, 1.5, 24.0),
    ("temperature", "process_temp", 85.0, 4.0, 24.0),
    ("flow_rate", "oil_outlet_flow", 250.0, 20.0, 12.0),
    ("flow_rate", "water_outlet_flow", 120.0, 15.0, 12.0),
    ("flow_rate", "gas_outlet_flow", 500.0, 40.0, 12.0),
    ("pressure", "pump_discharge", 200.0, 0.0, 24.0),
    ("temperature", "bearing_temp", 55.0, 3.0, 24.0),
    ("vibration", "motor_vibration", 3.5, 0.0, 24.0),
    ("flow_rate", "injection_flow", 100.0, 10.0, 8.0),
    ("pressure", "suction_pressure", 4.0, 0.0, 24.0),
    ("temperature", "exhaust_temp", 420.0, 15.0, 24.0),
    ("vibration", "shaft_vibration", 3.0, 0.0, 24.0),
    ("pressure", "inlet_pressure", 18.0, 0.0, 24.0),
    ("temperature", "lube_oil_temp", 90.0, 5.0, 24.0),
    ("flow_rate", "fuel_gas_flow", 2500.0, 200.0, 6.0),
    ("temperature", "inlet_temp", 120.0, 8.0, 24.0),
    ("temperature", "outlet_temp", 65.0, 5.0, 24.0),
    ("pressure", "shell_pressure", 22.0, 0.0, 24.0),
    ("pressure", "tube_pressure", 20.0, 0.0, 24.0),
    ("flow_rate", "process_flow", 150.0, 12.0, 24.0),
    ("pressure", "tubing_pressure", 350.0, 10.0, 24.0),
    ("pressure", "casing_pressure", 220.0, 0.0, 24.0),
    ("temperature", "wellhead_temp", 110.0, 6.0, 24.0),
    ("flow_rate", "production_flow", 80.0, 8.0, 12.0),
    ("vibration", "choke_vibration", 2.0, 0.0, 24.0),
    ("pressure", "riser_pressure", 150.0, 0.0, 24.0),
    ("temperature", "riser_temp", 45.0, 5.0, 24.0),
    ("vibration", "viv_sensor", 5.0, 3.0, 6.0),
    ("flow_rate", "throughput_flow", 250.0, 20.0, 24.0),
    ("pressure", "annulus_pressure", 8.0, 0.0, 24.0),
    ("pressure", "stack_pressure", 690.0, 0.0, 24.0),
    ("pressure", "accumulator_pressure", 350.0, 0.0, 24.0),
    ("temperature", "hydraulic_temp", 45.0, 4.0, 24.0),
    ("vibration", "stack_vibration", 1.0, 0.0, 24.0),
    ("flow_rate", "hydraulic_flow", 20.0, 0.0, 24.0),
    ("temperature", "flame_temp", 800.0, 60.0, 24.0),
    ("flow_rate", "gas_flow", 4000.0, 500.0, 8.0),
    ("pressure", "header_pressure", 2.5, 0.0, 24.0),
    ("temperature", "tip_temp", 180.0, 15.0, 24.0),
    ("vibration", "structural_vibration", 6.0, 2.0, 24.0),
]
SIGNAL_SCHEMA = (
    "sensor_type string, subtype string, setpoint double, amplitude double, period_hours double"
)
# Signal of a sensor without an entry above.
DEFAULT_SIGNAL = {"setpoint": 50.0, "amplitude": 0.0, "period_hours": 24.0}

# Reading and alert retention in days; ``None`` keeps for ever.
RETENTION_DAYS = {"readings": 90, "rollup_1m": 180, "rollup_5m": 365, "rollup_15m": None}

# Rollup width, refresh start and end offsets, and schedule.
REFRESH_POLICIES = {
    "rollup_1m": ("1 minute", "2 hours", "1 minute", "1 minute"),
    "rollup_5m": ("5 minutes", "6 hours", "5 minutes", "5 minutes"),
    "rollup_15m": ("15 minutes", "1 day", "15 minutes", "15 minutes"),
}


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed table as a local relation. Catalyst knows its size and broadcasts it in joins;
    a frame made from Python rows has no size estimate and would be shuffled against."""
    names = [column.split()[0] for column in schema.split(", ")]
    columns = [list(values) for values in zip(*rows, strict=True)]
    return spark.createDataFrame(pa.table(dict(zip(names, columns, strict=True))), schema)


def thresholds(spark: SparkSession) -> DataFrame:
    return small_table(spark, THRESHOLDS, THRESHOLD_SCHEMA)


def escalation_rules(spark: SparkSession) -> DataFrame:
    return small_table(spark, ESCALATION_RULES, ESCALATION_SCHEMA)


def signals(spark: SparkSession) -> DataFrame:
    return small_table(spark, SIGNALS, SIGNAL_SCHEMA)
