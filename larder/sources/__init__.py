"""Where tables come from: retail files, the nested catalogue, and the TPC-H-like test tables."""
