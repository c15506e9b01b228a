"""Sources (table readers, derived test tables) and sinks (CSV / JSON / evidence)."""
