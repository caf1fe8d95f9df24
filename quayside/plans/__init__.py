"""Request planning, the scheduled runs, and the registered queries with their oracles."""
