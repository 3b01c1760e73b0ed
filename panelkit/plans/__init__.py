"""The lakehouse built from the operators: silver refinement, gold tables, refresh order."""
