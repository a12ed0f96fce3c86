from __future__ import annotations

import pytest

from lakemill.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    s = session("local[4]", partitions=4, **{"spark.sql.warehouse.dir": str(folder / "warehouse"), "spark.driver.memory": "3g"})
    s.sparkContext.setCheckpointDir(str(folder / "checkpoint"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
