"""Column-level building blocks: time grid arithmetic, text keys, notional values."""
