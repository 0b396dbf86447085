"""Training-data operators: quality, near duplicates, repeats, archives, fingerprints, packing,
byte-level BPE, sharding and URL lists. Nothing else in the package imports this folder."""
