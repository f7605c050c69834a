"""Readers and writers: tables by extended file names, rasters from binary files, vector texts and coordinate systems."""
