"""The registered queries: every operator over the given tables, with an SQL oracle each."""
