"""Plan helpers shared by the operators: shared scratch tables and size-checked broadcasts."""
