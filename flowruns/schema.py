"""Column names and schemas of readings, runs, extents and checkpoints."""

from pyspark.sql import types as T

# Column names of the readings and run tables. They must equal the
# names the destination tables use, since rows are appended by column name.
DEVICE_ID = "DEVICE_ID"
TIMESTAMP = "TIMESTAMP"
FLOW_RATE = "FLOW_RATE"
PRESSURE = "PRESSURE"
TEMPERATURE = "TEMPERATURE"
MODE = "MODE"
VALVE_STATE = "VALVE_STATE"

START = "START_TIMESTAMP"
END = "END_TIMESTAMP"
RECORDS = "RECORDS"
DURATION = "DURATION"
ACT_START = "ACT_START_TIMESTAMP"
ACT_END = "ACT_END_TIMESTAMP"

# The stored run table is partitioned by the date of START_TIMESTAMP.
START_DATE = "START_DATE"

# Internal helper columns (never part of an output schema).
RUN_ID = "RUN_ID"
CHUNK = "_CHUNK"
IDLE = "IS_SKIPPED"

READINGS_SCHEMA = T.StructType([
    T.StructField(DEVICE_ID, T.StringType()),
    T.StructField(TIMESTAMP, T.TimestampNTZType()),
    T.StructField(FLOW_RATE, T.DoubleType()),
    T.StructField(PRESSURE, T.DoubleType()),
    T.StructField(TEMPERATURE, T.IntegerType()),
    T.StructField(MODE, T.IntegerType()),
    T.StructField(VALVE_STATE, T.IntegerType()),
])

RUNS_SCHEMA = T.StructType([
    T.StructField(DEVICE_ID, T.StringType()),
    T.StructField(START, T.TimestampNTZType()),
    T.StructField(END, T.TimestampNTZType()),
    T.StructField(RECORDS, T.LongType()),
    T.StructField("MAX_FLOW_RATE", T.DoubleType()),
    T.StructField("AVG_FLOW_RATE", T.DoubleType()),
    T.StructField("SUM_FLOW_RATE", T.DoubleType()),
    T.StructField("MIN_TEMPERATURE", T.IntegerType()),
    T.StructField("MAX_TEMPERATURE", T.IntegerType()),
    T.StructField("AVG_TEMPERATURE", T.DoubleType()),
    T.StructField("MIN_PRESSURE", T.DoubleType()),
    T.StructField("MAX_PRESSURE", T.DoubleType()),
    T.StructField("AVG_PRESSURE", T.DoubleType()),
    T.StructField("SD_PRESSURE", T.DoubleType()),
    T.StructField("SD_FLOW_RATE", T.DoubleType()),
    T.StructField("SYSTEM_MODE_2", T.LongType()),
    T.StructField("SYSTEM_MODE_3", T.LongType()),
    T.StructField("SYSTEM_MODE_5", T.LongType()),
    T.StructField(DURATION, T.LongType()),
])

RUN_COLUMNS = [f.name for f in RUNS_SCHEMA.fields]

EXTENT_SCHEMA = T.StructType([
    T.StructField(DEVICE_ID, T.StringType()),
    T.StructField(START, T.TimestampNTZType()),
    T.StructField(END, T.TimestampNTZType()),
])

CHECKPOINT_SCHEMA = T.StructType([T.StructField(TIMESTAMP, T.TimestampNTZType())])
