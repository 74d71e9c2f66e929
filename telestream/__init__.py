"""Telemetry streams as Spark tables: grouping, encoding, recovery, delivery, leases."""
