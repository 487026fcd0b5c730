import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidemark.session import SCALE_CONF, ensure_checkpoint_dir

    warehouse = tempfile.mkdtemp(prefix="tidemark-wh-")
    builder = (SparkSession.builder.master("local[8]").appName("tidemark-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.warehouse.dir", warehouse))
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def shuffle_files(spark) -> set[str]:
    """Shuffle files on the disk of a local session."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(";")
    return {f for f in files.split(";") if "shuffle_" in f}
