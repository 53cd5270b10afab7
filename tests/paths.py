"""Where the test tables are."""

TESTDATA = "/root/testdata"
