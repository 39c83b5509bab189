"""DataFrame -> DataFrame operators.  Column names are arguments; no table names are
hard-coded."""
