"""Plans: the star container, the question set, and two presets (the crime pipeline and the
mapping of the driver's TPC-H-like tables onto the same star)."""
