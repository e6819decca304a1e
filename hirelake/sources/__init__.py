"""Readers and writers: lake layout (Bronze/Silver/Gold), JDBC, CSV, registry."""
