"""One DataFrame transformation per function."""
