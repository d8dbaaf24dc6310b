"""The shared folder for stored tables."""

import pytest

from larch import session


class _Session:
    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}
        self.conf.setdefault("spark.sql.warehouse.dir", "/warehouse")


def test_checkpoint_folder_is_used():
    assert session.storage_folder(_Session(spark_master="yarn", spark_checkpoint_dir="/shared/")) == "/shared"
    assert session.new_folder(_Session(spark_checkpoint_dir="/shared"), "x").startswith("/shared/larch-x-")


def test_only_local_sessions_do_without():
    assert session.storage_folder(_Session(spark_master="local[8]")) == "/warehouse/_larch"
    with pytest.raises(ValueError):
        session.storage_folder(_Session(spark_master="spark://host:7077"))
