import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    from brevita.llm.common import prepare

    prepare(spark)
