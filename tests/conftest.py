from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tracklens.plans.materialize import ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[*]")
        .appName("tracklens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # The session's checkpoint folder wins; a scratch folder only if unset.
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="tracklens-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tracklens-test-", dir="/tmp")
