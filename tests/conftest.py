import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def schema(spark, tmp_path, request):
    """A fresh schema whose managed tables live in the test's folder."""
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name)[:60].lower()
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{tmp_path}/tables'")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def rows(df):
    """Rows as a sorted list of tuples, NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
