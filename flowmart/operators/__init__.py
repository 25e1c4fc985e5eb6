"""DataFrame -> DataFrame operators of the warehouse layers (DWD, DIM, DWS)."""
