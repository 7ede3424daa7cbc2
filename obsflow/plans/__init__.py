"""Whole-batch composition, skew-safe building blocks, registered queries."""
