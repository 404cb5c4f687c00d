"""The library's operators on the test tables, with SQL that gives the same rows."""
