"""Report operators: DataFrame in, DataFrame out.

Sums are associative, so every summing operator accepts extract rows as well as
the pre-aggregated supplier-day cells of :mod:`cashcycle.operators.cells`.
"""
