"""Where events come from and where results go: files, topics, stored tables."""
