"""Tables, streams, partitioned layouts and snapshots."""
