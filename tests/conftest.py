import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strataform import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[4]", shuffle_partitions=8, app_name="strataform-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def built_root(spark):
    """One audited build at sf0.001, shared by the tests that read its layers: the
    folder of its run and the audit rows."""
    import tempfile

    from strataform.plans.warehouse import run_build
    from strataform.sources.published import published

    root = tempfile.mkdtemp(prefix="strataform-test-build-")
    audit = run_build(spark, SF_SMALL, root)
    return published(spark, root)["run"], {r["step"]: r for r in audit.collect()}
