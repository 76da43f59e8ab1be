"""Where rows come from: landing files, dimensions, made-up test sales."""
