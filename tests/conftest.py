import pytest

from biblioscope import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
