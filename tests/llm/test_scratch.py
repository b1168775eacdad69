"""Scratch tables have an owner: a query leaves what its result reads, no more."""

import pytest

from corvid.iterate import release
from corvid.llm.queries import QUERIES
from corvid.session import scratch_folders

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_a_query_leaves_only_what_its_result_reads(spark, name):
    release(spark)
    out = QUERIES[name](spark, SF)
    reads = {part for f in out.inputFiles() for part in f.split("/")}
    if name != "op9_warc":  # its archives are read by Python
        assert all(f.rsplit("/", 1)[1] in reads for f in scratch_folders(spark))
    assert out.count() >= 0  # still computes
    release(spark)
    assert scratch_folders(spark) == []
