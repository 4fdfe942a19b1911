"""Operators of a large-scale training-data pipeline.

Every operator takes and returns DataFrames. Text passes run in ``mapInArrow`` tasks
over whole batches as byte arrays; joins, grouping and components are Spark's.
"""
