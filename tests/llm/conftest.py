import os
import sys
from types import SimpleNamespace

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def given(spark):
    """The smallest given tables."""
    names = ["documents", "embeddings", "pages", "labels", "conversations"]
    return SimpleNamespace(**{n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in names}, folder=FOLDER)
