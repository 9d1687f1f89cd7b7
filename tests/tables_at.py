"""Where the tables that tests read lie. A module of its own: each folder has a conftest."""

TESTDATA = "/root/testdata"
