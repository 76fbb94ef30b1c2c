"""User-level jobs: prepare, score, report, and all three in one run."""
