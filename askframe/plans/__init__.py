"""The operators wired to the shared test tables, with SQL to check them by."""
