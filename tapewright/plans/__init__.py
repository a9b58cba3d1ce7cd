"""Jobs: they own reads, writes and the order of steps."""
