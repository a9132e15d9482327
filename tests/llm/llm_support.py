"""What the operators' tests share."""

import pytest

from viewlake.llm.shipping import ship

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    """The executors' workers can import the package."""
    ship(spark)
