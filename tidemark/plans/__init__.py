"""The reports: marts rebuilt from current tables, and the filtered page queries."""
