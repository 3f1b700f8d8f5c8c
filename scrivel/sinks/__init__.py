"""Writers and the projections that fix their columns."""
