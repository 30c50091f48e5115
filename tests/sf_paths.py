"""Folders of the driver's tables (in a module of its own: ``conftest`` names clash between test folders)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
