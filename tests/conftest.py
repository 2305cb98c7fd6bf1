import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from monthlake.session import build_session
    s = build_session("local[*]", 8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_table(spark):
    from monthlake.session import scratch_path
    return lambda name="t": scratch_path(spark, f"test-{name}")


def plan_text(df) -> str:
    """The formatted physical plan, as ``df.explain("formatted")`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
