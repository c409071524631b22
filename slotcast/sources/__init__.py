"""Where rows come from and where they go: upstream tables, landing files, table versions."""
