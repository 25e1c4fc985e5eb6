"""Sources: table catalog, stream readers (S1-S6), JDBC readers (S7, S8) and
the mapping of the driver's test tables onto the warehouse's record shapes."""
