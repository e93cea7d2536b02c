"""The library on the test tables: bindings, registered queries and their SQL."""
