import pytest

from harborline.session import get_session


def build():
    s = get_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def spark():
    return build()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
