"""Barcode, alignment, consensus, correction, quality-control and simulation operators."""
