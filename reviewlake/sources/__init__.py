"""Raw zone, seeds, and restorable table snapshots."""
