"""Reading series, rolling ticks up to bars, picking snapshots, writing results."""
