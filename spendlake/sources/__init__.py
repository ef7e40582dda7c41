"""Sources: export CSVs, rule seeds, mart tables and the bank-shaped
adapters over the driver's benchmark tables."""
