"""Table reads and writes, and the market tables derived from the event log."""
