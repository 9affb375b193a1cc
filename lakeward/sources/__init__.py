"""Readers and writers: landed documents, landing CSV, event logs, snapshot tables."""
