"""Table lifecycle: state, snapshot, compaction, catalog maintenance."""
