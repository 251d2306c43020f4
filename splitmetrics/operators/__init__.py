"""Building blocks shared by the analyses."""
