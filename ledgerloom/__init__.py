"""Commerce analytics on Spark: nested, repeatedly synced orders in, facts and dimensions out."""
