"""Column-level helpers (scalar functions F1-F17, text functions U1/U2)."""
