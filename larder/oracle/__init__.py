"""Independent SQL twins of the registered queries, for a row-by-row comparison.

They count money in whole cents and round by integer arithmetic, so they share
no rounding code with the DataFrame plans.
"""
