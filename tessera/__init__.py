"""Spark jobs for layered retail and finance tables: ingest, checks, cubes, marts, mining."""
