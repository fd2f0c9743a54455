"""Reading tabular text, table layouts, contracts, and writing results."""
