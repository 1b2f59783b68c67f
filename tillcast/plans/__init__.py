"""End-to-end runs: the feature batch and the full forecast run."""
