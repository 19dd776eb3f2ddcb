import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tidemark-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-test-"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tiny_segments(spark):
    """Make every key of more than a few rows a hot key."""
    spark.conf.set("spark.tidemark.segmentRows", "7")
    yield
    spark.conf.unset("spark.tidemark.segmentRows")


def rows(df, *columns):
    """Collected rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
