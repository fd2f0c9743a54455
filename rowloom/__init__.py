"""rowloom: keeps warehouse tables in step with all-text tabular sources, on Spark.

functions/  Column -> Column expressions (cleaning, dates, hashes, parsing)
sources/    reading and writing: tabular scans, layouts, contracts, sinks
operators/  DataFrame operators: validation, snapshot diff, merge, quality, ledgers
plans/      the transforms, marts and the end-to-end run built from them
"""
