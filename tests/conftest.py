import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="spark-")
    session = (
        SparkSession.builder.master("local[8]").appName("gridloom-tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", f"{home}/warehouse").config("spark.checkpoint.dir", f"{home}/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from gridloom import ship

    ship(session)
    yield session
    session.stop()
