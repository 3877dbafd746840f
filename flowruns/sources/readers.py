"""Generic source, and the readings view the tests derive from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowruns import schema as S


def read_source(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
                options: dict[str, str] | None = None, schema=None) -> DataFrame:
    """Read any Spark data source lazily.

    Parquet in tests; a warehouse through ``fmt="jdbc"`` and its options (``url``,
    ``dbtable`` or ``query``, ...) on a cluster. Filters written on the result still
    reach the source: as ``PushedFilters`` for parquet, as a WHERE clause for JDBC.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings_from_events(events: DataFrame) -> DataFrame:
    """The readings table derived from the driver's ``events`` table.

    ``value`` is almost never 0, so idle readings come from the ``error`` event type,
    and NULL flows / pressures from fixed residues of ``event_id``. All of the data stays
    in; nothing is filtered here.
    """
    # The mapping of the readings fixture (event type -> mode, residues).
    return events.selectExpr(
        f"concat('d', CAST(user_id AS STRING)) AS {S.DEVICE_ID}",
        f"ts AS {S.TIMESTAMP}",
        "CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS DOUBLE) WHEN event_type = 'error' THEN 0.0D "
        f"ELSE value END AS {S.FLOW_RATE}",
        f"CASE WHEN event_id % 3 = 0 THEN CAST(NULL AS DOUBLE) ELSE round(value * 2, 2) END AS {S.PRESSURE}",
        f"CAST(get_json_object(props, '$.k') AS INT) AS {S.TEMPERATURE}",
        "CAST(CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'signup' THEN 5 ELSE 1 END AS INT) "
        f"AS {S.MODE}",
        f"CAST(event_id % 2 AS INT) AS {S.VALVE_STATE}",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(table(spark, sf_dir, "events"))
