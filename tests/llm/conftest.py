import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    from docloom.llm.common import ship

    ship(spark)
