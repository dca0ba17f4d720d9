"""Plans: session settings, bindings of stored tables, the batch job."""
