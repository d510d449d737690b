import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from cardwarden.schemas import TRANSACTIONS  # noqa: E402
from cardwarden.session import local_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def make_tx(spark):
    """Transactions with features from dicts; columns left out are null."""
    from cardwarden.plans.features import with_features

    def make(*rows, parts=2):
        names = TRANSACTIONS.fieldNames()
        data = [tuple(row.get(n) for n in names) for row in rows]
        return with_features(spark.createDataFrame(data, TRANSACTIONS).repartition(parts))

    return make
