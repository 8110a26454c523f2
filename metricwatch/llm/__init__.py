"""Operators for preparing large training corpora. Nothing else in the library imports this package.

Common rules of every operator (each docstring adds its own): a null text counts as an empty text,
whole texts are read, repeated rows are rows of their own unless said otherwise, an empty table
gives an empty result, and only the named columns of an input are read, so further columns of any
name never clash.
"""
