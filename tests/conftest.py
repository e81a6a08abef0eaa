import contextlib
import io
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from layercake.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", "layercake-tests", 8, task_retries=1)
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    """A local folder for a test's files (tests only; library code uses the
    shared checkpoint folder)."""
    return str(tmp_path)


def plan_text(df):
    """The formatted physical plan, untruncated."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def rows(df, *cols):
    """Collected rows as tuples, sorted, for order-insensitive asserts."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@contextlib.contextmanager
def session_conf(spark, settings):
    """Set runtime SQL settings for the block, then restore them."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def final_plan(df):
    """Run ``df`` (collect) and return AQE's final physical plan as text."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
