"""Readers and writers: page tables and files, the warehouse, JDBC, exports."""
