"""Folders of the given tables. (Not in conftest: a test folder may have its own.)"""

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"
