"""Binding of the library to the shared test tables, and the SQL to check it with."""
