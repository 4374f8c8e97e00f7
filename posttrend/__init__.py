"""Early-virality analytics on Spark: snapshots in, features, scores, alerts and metrics out."""
