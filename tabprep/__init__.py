"""tabprep: prepare, profile, augment and evaluate machine-learning tables on Spark."""
