"""Readers and writers: tables, CSV, landing zone, dimension lists."""
