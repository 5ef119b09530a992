"""Business questions as logical plans: each takes the retail tables and returns a DataFrame.

Shared rules:

* facts are aggregated on their own key before they meet a dimension, so a key
  holding a large share of the rows is combined map-side instead of shuffled;
* nothing carries a broadcast hint unless its row count is fixed by the plan; Spark
  picks broadcast joins by size;
* every ranking ends in key columns, so ties are broken the same way every time.
"""
