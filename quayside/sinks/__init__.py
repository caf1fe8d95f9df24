"""Outputs: staged publishing through pointer tables, drift checks, JDBC writes."""
