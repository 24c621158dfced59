"""Sources: landed-page scans and their paging rules, typed record tables,
the input parallelism guard, and the proxy views over the driver's test tables."""
