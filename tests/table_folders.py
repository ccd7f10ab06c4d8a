"""Table folders that the tests read."""

import os

SMALL_SF = "/root/testdata/sf0.001"
ORACLE_SF = os.environ.get("PLAYSTATS_TEST_SF", "/root/testdata/sf0.001")
