import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    wh = tempfile.mkdtemp(prefix="tessera-wh-")
    s = get_session("local[4]", app="tessera-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": wh,
                           "spark.driver.extraJavaOptions": f"-Dderby.system.home={wh}"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def landing():
    from fixtures import write_landing
    return write_landing(tempfile.mkdtemp(prefix="tessera-landing-"))
