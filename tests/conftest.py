import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from konform.session import checkpoint_dir, get_spark

    s = get_spark("local[4]", app="konform-tests", shuffle_partitions=4,
                  extra={"spark.default.parallelism": "4"})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="konform-test-")


def rows(df, *cols):
    """Sorted list of tuples (of the given columns, or all) for comparisons."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
