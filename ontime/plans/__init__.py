"""User-level reports (R1-R19) built from the operators."""
