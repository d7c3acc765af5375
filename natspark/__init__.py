"""Spark jobs over carrier-grade NAT session logs: decoding, reports, replay, telemetry and incidents."""
