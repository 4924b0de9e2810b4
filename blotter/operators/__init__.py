"""DataFrame operators: conforming, rollups, rankings and plot datasets."""
