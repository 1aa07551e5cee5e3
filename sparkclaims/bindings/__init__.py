"""The operators bound to the test tables: one query per operator, each beside
the SQL that states its result."""
