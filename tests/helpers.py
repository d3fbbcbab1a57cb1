"""Shared by the tests; a name of its own, since every folder of tests may have a conftest."""

SMALL = "/root/testdata/sf0.001"
