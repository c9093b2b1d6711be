import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=4, memory="4g", partitions=4)
    s.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    yield s
    s.stop()
