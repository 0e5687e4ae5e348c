"""Gridded-hazard and portfolio-risk analytics as Spark DataFrame operators.

Every operator is ``op(df, ..., **params) -> DataFrame`` over long-form tables with one row per
(layer, scenario, member, cell, time). Missing is NULL, never NaN.
"""
