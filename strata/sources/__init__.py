"""Sources: raw feed readers, the versioned snapshot store, incremental reads
and the feed mapping over the driver's test tables."""
