from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from burnlens.session import checkpoint_root, local_session  # noqa: E402
from marts_helpers import SMOKE  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, app="burnlens-tests", **{"spark.sql.shuffle.partitions": "4"})
    checkpoint_root(s)  # only sets a private folder when the session names none
    yield s


@pytest.fixture(scope="session")
def models(spark):
    from burnlens.plans.models import Models
    return Models.from_testdata(spark, SMOKE)
