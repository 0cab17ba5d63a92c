import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lexiloom.session import ship

    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.sql.adaptive.coalescePartitions.enabled", "true").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Applies a function of columns to values: one(fn, value, ...) gives the result for one row."""
    from pyspark.sql import functions as F

    def apply(fn, *values):
        names = [f"c{i}" for i in range(len(values))]
        kinds = ", ".join(f"{n} {'array<string>' if isinstance(v, list) else 'boolean' if isinstance(v, bool) else 'bigint' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for n, v in zip(names, values, strict=True))
        return spark.createDataFrame([tuple(values)], kinds).select(fn(*[F.col(n) for n in names]).alias("r")).first()["r"]

    return apply
