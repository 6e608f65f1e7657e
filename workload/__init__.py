"""The registered queries: what each computes on the given tables, and the same in plain SQL."""
