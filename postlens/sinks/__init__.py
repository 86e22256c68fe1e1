"""Writers: per-state histogram tables and map feeds."""
