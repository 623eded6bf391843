"""Jobs and views made of operators."""
