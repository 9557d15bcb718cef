"""Part of riskflow."""
