"""Readers and writers: sales files, master sheets, star-schema tables, reports."""
