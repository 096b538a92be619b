"""Reading deliveries, lookups and batches."""
