"""Operators for training-data work: sketches, draws, overlaps, packing, mixing, spam pages."""
