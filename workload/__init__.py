"""The library bound to the TPC-H-like tables, with an SQL oracle for each query."""
