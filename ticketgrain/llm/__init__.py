"""Operators of a training-data pipeline over document tables.

Every operator takes a DataFrame with an id and a text column and returns a DataFrame.
Ids may be null or repeated, texts null, empty or very long; further columns never matter,
whatever their names.  Nothing outside this folder imports it.
"""
