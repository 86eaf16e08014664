"""Jobs from DataFrames to a DataFrame. None of them collects, caches or starts an action."""
