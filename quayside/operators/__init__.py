"""Table operators: select, flatten, upsert, status fold, usage, batches, reports."""
