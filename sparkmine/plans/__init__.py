"""Session settings, materialisation and skew handling shared by the operators."""
