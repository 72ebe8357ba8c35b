"""The four jobs: explore, prepare features, train, score."""
