import pytest

from tidemark.session import clean_up, session


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    clean_up(spark)
    spark.stop()
