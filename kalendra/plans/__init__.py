"""Jobs composed of the operators: per-source normalisers and the two workflows."""
