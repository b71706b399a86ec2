"""Landed payloads in, raw partitions, snapshots and reports out."""
