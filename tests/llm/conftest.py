import duckdb
import pytest
from pyspark.sql import SparkSession

from obsmatch.llm.common import configure
from obsmatch.session import local_session


@pytest.fixture(scope="session")
def llm() -> SparkSession:
    return configure(local_session(4, shuffle_partitions=4))


@pytest.fixture()
def duck():
    """Runs DuckDB SQL over pandas frames given by name; sorted rows."""

    def run(sql: str, **frames):
        con = duckdb.connect()
        for name, frame in frames.items():
            con.register(f"{name}_", frame)
            con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_")
        return sorted(map(repr, con.execute(sql).fetchall()))

    return run
