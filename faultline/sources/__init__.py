"""Sources: raw snapshots, landed payloads, written facts."""
