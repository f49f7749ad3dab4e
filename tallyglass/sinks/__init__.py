"""Writers: snapshots, predictions, metric history and monitoring reports."""
