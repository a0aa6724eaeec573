import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkevents.session import local_session  # noqa: E402
from sparkevents.streaming.packing import use_rocksdb  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("4", "tests", 4, **{"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("ERROR")
    use_rocksdb(session)
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(str(x) for x in r))
