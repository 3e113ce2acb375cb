"""Physical building blocks: row layout for windows, group statistics, Gram sums, quantiles."""
