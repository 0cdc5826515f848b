"""The operators bound to the star-schema test tables, and the SQL they are checked against."""
