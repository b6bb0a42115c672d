"""DataFrame operators: flatten, extract, dedupe, rolling, anchored, mode, stations."""
