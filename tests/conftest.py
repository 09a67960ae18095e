import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests",
        8,
        **{
            "spark.checkpoint.dir": f"{root}/shared",
            "spark.sql.warehouse.dir": f"{root}/warehouse",
        },
    )
    session.sparkContext.setCheckpointDir(f"{root}/shared")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples; NULL sorts first."""

    def collected(df, *columns):
        wanted = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in wanted.collect()),
            key=lambda t: tuple((v is not None, str(type(v)), v) for v in t),
        )

    return collected
