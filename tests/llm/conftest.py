import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session")
def worker_path(spark):
    """Tasks import the package from the copy that is sent to them."""
    from tagmill.shipping import ship

    ship(spark)
    return spark


@pytest.fixture(autouse=True)
def shipped(worker_path):
    return worker_path
