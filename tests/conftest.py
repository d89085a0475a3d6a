import pytest

from ledgermill.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("4", "tests", **{
        "spark.checkpoint.dir": shared,
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, ordered by the given columns or by text."""
    if order:
        return [tuple(r) for r in df.orderBy(*order).collect()]
    return sorted((tuple(r) for r in df.collect()), key=repr)
