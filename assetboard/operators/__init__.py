"""DataFrame operators. Board keys are columns; no operator loops over boards."""
