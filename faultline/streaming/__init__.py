"""Streaming: new snapshots merged into the facts as they land."""
