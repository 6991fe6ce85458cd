import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strata.session import get_session, use_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app_name="strata-tests", shuffle_partitions=8,
                    extra_conf={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint root only because none is configured here
    use_scratch(s, tempfile.mkdtemp(prefix="strata-ckpt-"))
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
