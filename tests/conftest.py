import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from personalens.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    yield get_session("local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
