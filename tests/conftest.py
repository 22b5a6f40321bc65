import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import get_session, local_scratch  # noqa: E402

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="tessera-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(local_scratch("tessera-test-ckpt-"))
    yield s


@pytest.fixture(autouse=True)
def _whole_paths_in_plans(request):
    """Plans show the paths of scans whole, however long the shared folder's name has become."""
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").conf.set("spark.sql.maxMetadataStringLength", "1000")


@pytest.fixture()
def tmp_dir():
    return local_scratch("tessera-test-")


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns when none given)."""
    cols = cols or df.columns
    return sorted(tuple(r) for r in df.select(*cols).collect())
