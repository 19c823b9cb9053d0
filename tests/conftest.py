from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from propensia.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # small Arrow batches so that the ranking's cross-batch state is exercised
    s = build_session("local[4]", 8, extra={"spark.sql.execution.arrow.maxRecordsPerBatch": "500",
                                            "spark.driver.memory": "4g"})
    yield s
    s.stop()
