"""The queries over the library's operators, with the SQL that states their results."""
