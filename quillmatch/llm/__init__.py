"""Operators of a training-data pipeline over text, token, media and vector tables.

Nothing outside this subpackage imports it.  ``queries`` maps query names to
callables ``(spark, sf_dir) -> DataFrame``; every operator also has a general
interface of its own in the module that carries its name.
"""
