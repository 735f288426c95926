"""Writers of verified snapshots."""
