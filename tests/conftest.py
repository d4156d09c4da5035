import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from edgewise.session import get_session
    s = get_session("local[4]", 4, app="edgewise-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="edgewise-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def t1_edges(spark):
    # FIXTURES toy graph T1
    e = [(1, 2), (1, 3), (1, 4), (2, 3), (2, 5), (3, 1), (3, 4), (4, 5), (5, 2)]
    return spark.createDataFrame(e, "src bigint, dst bigint")


def pairs_df(spark, rows):
    return spark.createDataFrame(rows, "u bigint, v bigint, label string")
