"""Reading and writing tables, the append-only raw layer, and the market views."""
