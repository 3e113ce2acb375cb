"""Column builders: rolling features, technical indicators and calendar columns."""
